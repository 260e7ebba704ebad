"""Quality masks of native pixels and of dense swaths."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.functions import indices as ix
from lakespark.functions.bands import nearest_band, wavelength
from lakespark.functions.flags import FlagMap, flag_exclusion, flag_is_set, require_land
from lakespark.functions.geo import has_geolocation
from lakespark.functions.indices import f32, true_or_false
from lakespark.schema import NATIVE_WAVELENGTHS

BRIGHT_LIMIT = 0.08
RESCUE_FAI_MIN = 0.0
BLOCK_ROWS = 256


def _col(name: str) -> Column:
    return F.col(name)


def bright(rhos865: Column, limit: float = BRIGHT_LIMIT) -> Column:
    return true_or_false(rhos865 > f32(limit))


def land_adjacency(
    df: DataFrame, flag_map: FlagMap, n: int, block_rows: int | None = None, out: str = "adjacent"
) -> DataFrame:
    """Mark non-land pixels within ``n`` 4-connected steps of a LAND pixel.

    With ``block_rows`` the spread stops at the edges of row blocks. Places are
    matched by (scene, line, column); several pixels may share a place.
    """
    if n <= 0:
        return df.withColumn(out, F.lit(False))
    land = flag_is_set(_col("l2_flags"), flag_map, "LAND")
    steps = [
        (dr, dc) for dr in range(-n, n + 1) for dc in range(-n, n + 1) if abs(dr) + abs(dc) <= n
    ]
    offsets = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in steps])
    block = (
        F.floor(_col("source_row") / block_rows).cast("int") if block_rows else F.lit(0).cast("int")
    )
    spread = (
        df.where(land)
        .select("scene_id", "source_row", "source_col")
        .distinct()
        .select(
            "scene_id",
            block.alias("_block"),
            F.explode(offsets).alias("o"),
            "source_row",
            "source_col",
        )
        .select(
            "scene_id",
            "_block",
            (_col("source_row") + _col("o.r")).alias("source_row"),
            (_col("source_col") + _col("o.c")).alias("source_col"),
        )
        .distinct()
        .withColumn("_near", F.lit(True))
    )
    return (
        df.withColumn("_block", block)
        .join(spread, ["scene_id", "_block", "source_row", "source_col"], "left")
        .withColumn(out, true_or_false(_col("_near")) & ~land)
        .drop("_block", "_near")
    )


def native_bands(df: DataFrame) -> dict[int, str]:
    """Column of each analysis band, searched by nominal wavelength."""
    return {w: nearest_band(df.columns, "rhos", w, 30.0) for w in NATIVE_WAVELENGTHS}


def native_qa(
    df: DataFrame,
    flag_map: FlagMap,
    detection_limit: float = ix.DETECTION_LIMIT,
    ss681_max: float = 0.0,
    ss665_min: float = 0.0,
    adjacency_pixels: int = 0,
    bright_screen: bool = False,
    bright_limit: float = BRIGHT_LIMIT,
    block_rows: int = BLOCK_ROWS,
    ndci_prefix: str = "rhos",
) -> DataFrame:
    """Masks and masked indices of every geolocated pixel that lies in a lake.

    ``df`` has decoded bands (missing = NULL) and ``Hylak_id``, which is 0 or NULL
    outside lakes. LAND pixels are kept; pixels outside lakes are not.
    """
    require_land(flag_map)
    kept = df.where(
        (_col("Hylak_id") > 0)
        & _col("latitude").isNotNull()
        & _col("longitude").isNotNull()
        & _col("l2_flags").isNotNull()
    )
    if adjacency_pixels > 0:
        # land outside lakes spreads too, so the spread is computed on the whole swath
        kept = land_adjacency(df, flag_map, adjacency_pixels, block_rows, "_adjacent").where(
            (_col("Hylak_id") > 0)
            & _col("latitude").isNotNull()
            & _col("longitude").isNotNull()
            & _col("l2_flags").isNotNull()
        )
    else:
        kept = kept.withColumn("_adjacent", F.lit(False))

    name = native_bands(df)
    waves = {w: wavelength(n) for w, n in name.items()}
    b = {w: _col(n) for w, n in name.items()}
    red = _col(nearest_band(df.columns, ndci_prefix, 665))
    edge = _col(nearest_band(df.columns, ndci_prefix, 709))
    core = (620, 665, 681, 709)

    def flag(which):
        return flag_is_set(_col("l2_flags"), flag_map, which)

    spectral = ix.ci_family(
        kept,
        [name[w] for w in core],
        [waves[w] for w in core],
        detection_limit,
        ss681_max,
        ss665_min,
        prefix="_",
    )
    top, top_nm = ix.mph(b[665], b[681], b[709], b[754], b[885], waves)
    spectral = spectral.withColumns(
        {
            "_FAI": ix.fai(b[665], b[754], b[865], waves),
            "_MPH": top,
            "_MPH_nm": top_nm,
            "_NDCI": ix.ndci(red, edge),
            "_ndci_ok": ix.ndci_valid(red, edge),
            "_land": flag("LAND"),
            "cldice_mask": flag("CLDICE"),
            "hisatzen_mask": flag("HISATZEN"),
            "navfail_mask": flag("NAVFAIL"),
        }
    )
    clear_view = ~_col("_land") & ~_col("hisatzen_mask") & ~_col("navfail_mask")
    evidence = (
        _col("_ci_detection")
        & true_or_false(_col("_FAI") > F.lit(RESCUE_FAI_MIN))
        & true_or_false(b[754] > b[490])
    )
    masks = spectral.withColumns(
        {
            "bloom_rescue_mask": clear_view & _col("cldice_mask") & evidence,
            "cyan_strict_valid_mask": clear_view & ~_col("cldice_mask"),
        }
    )
    masks = masks.withColumns(
        {
            "valid_water_mask": _col("cyan_strict_valid_mask") | _col("bloom_rescue_mask"),
            "cloud_excluded_mask": ~_col("_land")
            & _col("cldice_mask")
            & ~_col("bloom_rescue_mask"),
        }
    )
    if adjacency_pixels > 0:
        away = ~_col("_adjacent")
        masks = masks.withColumns(
            {m: _col(m) & away for m in ("valid_water_mask", "cyan_strict_valid_mask")}
        )
    if bright_screen:
        dark = ~bright(b[865], bright_limit)
        masks = masks.withColumns(
            {
                m: _col(m) & dark
                for m in ("valid_water_mask", "cyan_strict_valid_mask", "bloom_rescue_mask")
            }
        )
    masks = masks.withColumns(
        {
            "ci_valid_mask": _col("valid_water_mask") & _col("_ci_finite"),
            "ndci_valid_mask": _col("valid_water_mask") & _col("_ndci_ok"),
            "mph_valid_mask": _col("valid_water_mask") & _col("_MPH").isNotNull(),
            "fai_valid_mask": _col("valid_water_mask") & _col("_FAI").isNotNull(),
        }
    ).withColumns(
        {
            "ci_candidate_mask": _col("ci_valid_mask") & _col("_ci_candidate"),
            "ci_detection_mask": _col("ci_valid_mask") & _col("_ci_detection"),
        }
    )
    return _native_columns(mask_indices(masks), name)


def mask_indices(df: DataFrame) -> DataFrame:
    """Index values only where their own mask allows them; stored as float32."""

    def where(mask, value):
        return F.when(_col(mask), _col(value)).cast("float")

    return df.withColumns(
        {
            "SS_681": where("ci_valid_mask", "_SS_681"),
            "SS_665": where("ci_valid_mask", "_SS_665"),
            "CI": where("ci_candidate_mask", "_CI"),
            "CI_cyano": where("ci_detection_mask", "_CI_cyano"),
            "NDCI": where("ndci_valid_mask", "_NDCI"),
            "MPH": where("mph_valid_mask", "_MPH"),
            "MPH_peak_nm": where("mph_valid_mask", "_MPH_nm"),
            "FAI": where("fai_valid_mask", "_FAI"),
        }
    )


def _native_columns(df: DataFrame, band_names: dict[int, str]) -> DataFrame:
    from lakespark.schema import NATIVE, PROVENANCE, with_missing_columns

    # bands are stored under their nominal wavelengths
    renamed = df.withColumnsRenamed(
        {n: f"rhos_{w}" for w, n in band_names.items() if n != f"rhos_{w}"}
    )
    order = [f.name for f in NATIVE] + [f.name for f in PROVENANCE]
    full = with_missing_columns(renamed, NATIVE)
    return full.select(*[c for c in order if c.lower() in {x.lower() for x in full.columns}])


# --- selectors on native tables -------------------------------------------------


def _positive(mask: str) -> Column:
    return F.coalesce(_col(mask).cast("int") > 0, F.lit(False))


def primary_valid(df: DataFrame, out: str = "primary_valid") -> DataFrame:
    """Primary mask; everything counts when the table has no such mask."""
    has = "valid_water_mask" in df.columns
    return df.withColumn(out, _positive("valid_water_mask") if has else F.lit(True))


def comparison_valid(
    df: DataFrame, out: str = "comparison_valid", scope: Iterable[str] = ("scene_id",)
) -> DataFrame:
    """Strict mask where the scope has any strict value at all, else the primary mask."""
    if "cyan_strict_valid_mask" not in df.columns:
        return primary_valid(df, out)
    scope = list(scope)
    any_strict = df.groupBy(*scope).agg(
        F.max(_col("cyan_strict_valid_mask").isNotNull()).alias("_any_strict")
    )
    chosen = F.when(_col("_any_strict"), _positive("cyan_strict_valid_mask")).otherwise(
        _positive("valid_water_mask") if "valid_water_mask" in df.columns else F.lit(True)
    )
    # one row per scope, so the optimizer can choose a size-checked broadcast; a NULL key is a scope too
    of = any_strict.withColumnsRenamed({k: f"_of_{k}" for k in scope})
    same = reduce(and_, [_col(k).eqNullSafe(_col(f"_of_{k}")) for k in scope])
    return df.join(of, same).withColumn(out, chosen).drop("_any_strict", *[f"_of_{k}" for k in scope])


def masked_display(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Science columns are NULL where the pixel is not primary-valid."""
    flagged = primary_valid(df, "_keep")
    shown = {c: F.when(_col("_keep"), _col(c)) for c in columns if c in df.columns}
    return flagged.withColumns(shown).drop("_keep")


# --- dense swaths ------------------------------------------------------------------

WATER_DEFINITIONS = ("l2_land", "hydrolakes", "intersection", "union", "hydrolakes_if_loaded")


def water_definition(
    df: DataFrame, flag_map: FlagMap, mode: str, in_lake: str | None = None, out: str = "water"
) -> DataFrame:
    """Add ``geolocated`` and the water mask of ``mode``.

    ``in_lake`` names a boolean lake-membership column, or is None when no lakes
    are loaded; then union and hydrolakes_if_loaded fall back to the land flag.
    """
    if mode not in WATER_DEFINITIONS:
        raise ValueError(f"unknown water definition {mode!r}")
    if in_lake is None and mode in ("hydrolakes", "intersection"):
        raise ValueError(f"water definition {mode!r} needs lakes")
    require_land(flag_map)
    land = flag_is_set(_col("l2_flags"), flag_map, "LAND")
    located = has_geolocation(_col("latitude"), _col("longitude")) & _col("l2_flags").isNotNull()
    open_water = located & ~land
    if in_lake is None or mode == "l2_land":
        water = open_water
    else:
        lake = located & true_or_false(_col(in_lake))
        water = {
            "hydrolakes": lake,
            "hydrolakes_if_loaded": lake,
            "intersection": open_water & lake,
            "union": open_water | lake,
        }[mode]
    return df.withColumns({"geolocated": located, out: water})


def ci_exclusion_reason(ss681_max=0.0, ss665_min=0.0, detection_limit=ix.DETECTION_LIMIT) -> Column:
    """0 none, 1 not water, 2 QA, 3 missing input, 4 SS681, 5 SS665, 6 below limit, 7 detected."""
    eligible = _col("water") & ~_col("qa_excluded")
    candidate = eligible & _col("ci_candidate")
    confirmed = true_or_false(_col("SS_665") > f32(ss665_min))
    above = true_or_false(_col("CI") > f32(detection_limit))
    gate = true_or_false(_col("SS_681") < f32(ss681_max))
    return (
        F.when(eligible & _col("ci_detection"), 7)
        .when(candidate & confirmed & ~above, 6)
        .when(candidate & ~confirmed, 5)
        .when(eligible & _col("ci_finite") & ~gate, 4)
        .when(eligible & ~_col("ci_finite"), 3)
        .when(_col("water") & _col("qa_excluded"), 2)
        .when(_col("geolocated") & ~_col("water"), 1)
        .otherwise(0)
    )


def ndci_exclusion_reason(red: Column, edge: Column) -> Column:
    """0 none, 1 not water, 2 QA, 3 red missing, 4 edge missing, 5 denominator, 6 valid."""
    eligible = _col("water") & ~_col("qa_excluded")
    return (
        F.when(eligible & ix.ndci_valid(red, edge), 6)
        .when(eligible & red.isNotNull() & edge.isNotNull(), 5)
        .when(eligible & red.isNotNull() & edge.isNull(), 4)
        .when(eligible & red.isNull(), 3)
        .when(_col("water") & _col("qa_excluded"), 2)
        .when(_col("geolocated") & ~_col("water"), 1)
        .otherwise(0)
    )


def scene_masks(
    df: DataFrame,
    flag_map: FlagMap,
    exclude: str | Iterable[str] = ("NAVFAIL",),
    mode: str = "union",
    in_lake: str | None = None,
    adjacency_pixels: int = 0,
    bright_screen: bool = False,
    bright_limit: float = BRIGHT_LIMIT,
) -> DataFrame:
    """Geolocation, water, exclusion and validity masks of a dense swath."""
    out = water_definition(df, flag_map, mode, in_lake)
    out = land_adjacency(out, flag_map, adjacency_pixels)
    screen = F.lit(False)
    if bright_screen:
        screen = bright(_col(nearest_band(df.columns, "rhos", 865, 25.0)), bright_limit)
    return (
        out.withColumns(
            {
                "flag_excluded": flag_exclusion(_col("l2_flags"), flag_map, exclude),
                "bright": screen,
            }
        )
        .withColumn("qa_excluded", _col("flag_excluded") | _col("adjacent") | _col("bright"))
        .withColumn("valid_water_mask", _col("water") & ~_col("qa_excluded"))
    )


def build_dense_indices(
    df: DataFrame,
    flag_map: FlagMap,
    detection_limit: float = ix.DETECTION_LIMIT,
    ss681_max: float = 0.0,
    ss665_min: float = 0.0,
    ndci_prefix: str = "rhos",
    **mask_options,
) -> DataFrame:
    """Dense-swath index table: masks, indices before and after masking, reason codes.

    Candidate, detection and negative-count columns are NULL (not applicable)
    where the CI inputs are not valid.
    """
    core = [nearest_band(df.columns, "rhos", w) for w in (620, 665, 681, 709)]
    red = _col(nearest_band(df.columns, ndci_prefix, 665))
    edge = _col(nearest_band(df.columns, ndci_prefix, 709))
    out = scene_masks(df, flag_map, **mask_options)
    out = ix.ci_family(
        out, core, [wavelength(c) for c in core], detection_limit, ss681_max, ss665_min
    )
    out = out.withColumns(
        {
            "ndci_finite": ix.ndci_valid(red, edge),
            "_ndci": ix.ndci(red, edge),
            "CI_exclusion_reason": ci_exclusion_reason(ss681_max, ss665_min, detection_limit),
            "NDCI_exclusion_reason": ndci_exclusion_reason(red, edge),
            "ci_valid_mask": _col("valid_water_mask") & _col("ci_finite"),
        }
    ).withColumn("ndci_valid_mask", _col("valid_water_mask") & _col("ndci_finite"))
    valid = _col("ci_valid_mask")
    return out.withColumns(
        {
            "ci_candidate_mask": F.when(valid, _col("ci_candidate")),
            "ci_detection_mask": F.when(valid, _col("ci_detection")),
            "negative_core_rhos_count": ix.negative_band_count(core, valid),
            "CI_pre_mask": F.when(_col("geolocated"), _col("CI")),
            "CI_cyano_pre_mask": F.when(_col("geolocated"), _col("CI_cyano")),
            "NDCI_pre_mask": F.when(_col("geolocated"), _col("_ndci")),
            "SS_681": F.when(valid, _col("SS_681")),
            "SS_665": F.when(valid, _col("SS_665")),
            "CI": F.when(valid & _col("ci_candidate"), _col("CI")),
            "CI_cyano": F.when(valid & _col("ci_detection"), _col("CI_cyano")),
            "NDCI": F.when(_col("ndci_valid_mask"), _col("_ndci")),
            "qa_excluded_mask": _col("water") & _col("qa_excluded"),
        }
    ).drop("_ndci")
