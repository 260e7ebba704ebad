"""Per-lake statistics, mask diagnostics, spectra and product checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.functions.flags import FlagMap, flag_is_set, requested_flags
from lakespark.functions.indices import DETECTION_LIMIT, f32, true_or_false
from lakespark.operators.quantiles import summarize
from lakespark.schema import NATIVE, NATIVE_BANDS, with_missing_columns


def _on(mask: str) -> Column:
    return F.coalesce(F.col(mask).cast("int") > 0, F.lit(False))


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _value(metric: str, basis: Column | None = None) -> Column:
    value = F.col(metric).cast("double")
    return value if basis is None else F.when(basis, value)


def _ready(df: DataFrame) -> DataFrame:
    """Absent masks count as unset, absent indices as missing."""

    return with_missing_columns(df, NATIVE)


# Statistics of each index: which mask its values must satisfy, and output names.
_WINDOW_METRICS = {
    "CI": ("ci_candidate_mask", "CI", "candidates", ("mean", "median", "p10", "p90", "max")),
    "CI_cyano": ("ci_detection_mask", "CIcyano", "detections", ("mean", "median", "p90")),
    "NDCI": ("valid_water_mask", "NDCI", "retained", ("mean", "median", "p90")),
    "MPH": ("valid_water_mask", "MPH", "retained", ("mean", "median", "p10", "p90", "max")),
    "FAI": ("valid_water_mask", "FAI", "retained", ("mean", "median", "p10", "p90", "max")),
}
# Columns that counts, means and maxima read.
_USED = (
    "valid_water_mask", "cyan_strict_valid_mask", "bloom_rescue_mask", "cldice_mask", "ci_valid_mask",
    "ci_candidate_mask", "ci_detection_mask", *_WINDOW_METRICS,
)
#: Columns that `scene_share_stats` reads beside its keys.
SHARE_COLUMNS = (*_USED, "cloud_excluded_mask")
_PROBABILITY = {"median": 0.5, "p10": 0.1, "p90": 0.9}


def lake_window_stats(native: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per scene, window and lake, from native pixels only."""
    df = _ready(native)
    keys = list(keys or ["scene_id", "window_id", "Hylak_id"])
    values = {m: _value(m, _on(basis)) for m, (basis, *_) in _WINDOW_METRICS.items()}
    n, retained, ci_ok, hits = (
        F.col(c)
        for c in (
            "native_polygon_pixels",
            "retained_pixels",
            "ci_input_valid_pixels",
            "ci_cyano_detection_pixels",
        )
    )
    simple = {"mean": F.avg, "max": F.max}
    counts = [
        F.count(F.lit(1)).alias("native_polygon_pixels"),
        count_if(_on("valid_water_mask")).alias("retained_pixels"),
        count_if(_on("cyan_strict_valid_mask")).alias("cyan_strict_pixels"),
        count_if(_on("bloom_rescue_mask")).alias("bloom_rescued_pixels"),
        count_if(_on("cldice_mask")).alias("CLDICE_pixels"),
        count_if(_on("ci_valid_mask")).alias("ci_input_valid_pixels"),
        count_if(_on("ci_candidate_mask")).alias("ci_candidate_pixels"),
        count_if(_on("ci_detection_mask")).alias("ci_cyano_detection_pixels"),
        *[
            simple[s](values[m]).alias(f"{short}_{s}_{tail}")
            for m, (_, short, tail, wanted) in _WINDOW_METRICS.items()
            for s in wanted
            if s in simple
        ],
    ]
    asked = {
        f"{short}_{s}_{tail}": (m, _PROBABILITY[s])
        for m, (_, short, tail, wanted) in _WINDOW_METRICS.items()
        for s in wanted
        if s in _PROBABILITY
    }
    return summarize(df, keys, values, asked, counts, uses=_USED).withColumns(
        {
            "retained_percent": F.lit(100.0) * retained / n,
            "ci_cyano_detection_fraction_of_ci_valid": F.try_divide(hits, ci_ok),
            "ci_cyano_detection_fraction_of_retained": F.try_divide(hits, retained),
        }
    )


def scene_share_stats(native: DataFrame) -> DataFrame:
    """One row per scene and lake over all windows. Deduplicate locations first."""
    df = _ready(native)
    keys = ["scene_id", "Hylak_id"]
    bases = {
        "CI": "ci_candidate_mask",
        "CI_cyano": "ci_detection_mask",
        "NDCI": "valid_water_mask",
        "MPH": "valid_water_mask",
        "FAI": "valid_water_mask",
    }
    values = {m: _value(m, _on(b)) for m, b in bases.items()}
    counts = [
        F.count(F.lit(1)).alias("native_lake_pixels"),
        count_if(_on("valid_water_mask")).alias("primary_retained_pixels"),
        count_if(_on("cyan_strict_valid_mask")).alias("generic_flag_exclusion_sensitivity_pixels"),
        count_if(_on("bloom_rescue_mask")).alias("bloom_rescued_pixels"),
        count_if(_on("cldice_mask")).alias("CLDICE_pixels"),
        count_if(_on("cloud_excluded_mask")).alias("cloud_excluded_pixels"),
        count_if(_on("ci_valid_mask")).alias("ci_input_valid_pixels"),
        count_if(_on("ci_candidate_mask")).alias("ci_candidate_pixels"),
        count_if(_on("ci_detection_mask")).alias("ci_cyano_detection_pixels"),
        *[F.count(values[m]).alias(f"{m}_valid_pixels") for m in bases],
        *[F.avg(values[m]).alias(f"{m}_mean") for m in bases],
        *[F.max(values[m]).alias(f"{m}_max") for m in bases],
    ]
    asked = {f"{m}_{s}": (m, p) for m in bases for s, p in _PROBABILITY.items()}
    rescued = F.try_divide(F.col("bloom_rescued_pixels"), F.col("CLDICE_pixels"))
    return (
        summarize(df, keys, values, asked, counts, uses=SHARE_COLUMNS)
        .withColumn("bloom_rescue_fraction_of_CLDICE", rescued)
    )


def dense_lake_stats(dense: DataFrame, lakes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per lake over a dense swath that carries ``Hylak_id``; lakes without pixels stay."""
    df = dense.where(F.col("Hylak_id") > 0)
    per = [*keys, "Hylak_id"]
    hits = _on("ci_detection_mask")
    values = {
        "CI": _value("CI"),
        "CIcyano": _value("CI_cyano", hits),
        "NDCI": _value("NDCI", _on("valid_water_mask")),
    }
    counts = [
        F.count(F.lit(1)).alias("native_polygon_pixels"),
        count_if(_on("valid_water_mask")).alias("retained_pixels"),
        count_if(_on("bright")).alias("bright_screen_pixels"),
        count_if(_on("ci_valid_mask")).alias("ci_input_valid_pixels"),
        F.count("CI").alias("ci_candidate_pixels"),
        count_if(hits).alias("ci_cyano_detection_pixels"),
    ]
    tails = {"CI": "candidates", "CIcyano": "detections", "NDCI": "retained"}
    asked = {
        f"{m}_{s}_{tails[m]}": (m, p) for m in values for s, p in _PROBABILITY.items()
    }
    stats = summarize(df, per, values, asked, counts)
    names = lakes.select(
        F.col("Hylak_id"),
        F.coalesce("Lake_name", F.lit("")).alias("Lake_name"),
        F.col("Lake_area").alias("Lake_area_km2"),
    )
    n_cols = [c for c in stats.columns if c not in per and c not in asked]
    out = names.join(stats, "Hylak_id", "left").fillna(0, subset=n_cols)
    pixels, kept, ok, det = (
        F.col(c)
        for c in (
            "native_polygon_pixels",
            "retained_pixels",
            "ci_input_valid_pixels",
            "ci_cyano_detection_pixels",
        )
    )
    return out.withColumns(
        {
            "retained_percent": F.try_divide(F.lit(100.0) * kept, pixels),
            "ci_cyano_detection_fraction_of_ci_valid": F.try_divide(det, ok),
            "ci_cyano_detection_fraction_of_retained": F.try_divide(det, kept),
        }
    )


def with_lake_metadata(stats: DataFrame, lakes: DataFrame) -> DataFrame:
    """Name (missing = empty), area, country and continent of each statistics row."""
    meta = lakes.select(
        "Hylak_id",
        F.coalesce("Lake_name", F.lit("")).alias("Lake_name"),
        F.col("Lake_area").cast("double").alias("Lake_area_km2"),
        F.coalesce("Country", F.lit("")).alias("Country"),
        F.coalesce("Continent", F.lit("")).alias("Continent"),
    )
    return stats.join(meta, "Hylak_id", "left")


# --- mask diagnostics of dense swaths (input: qa.build_dense_indices) ----------------

# Names of the stages in stored tables.
STAGES = (
    "total_pixels",
    "geolocated_pixels",
    "water_pixels",
    "after_selected_flags",
    "after_land_adjacency",
    "valid_water_pixels",
    "ci_finite_before_qa",
    "ci_finite_all_geolocated",
    "ci_candidates_all_geolocated",
    "ci_detections_all_geolocated",
    "ci_finite_after_qa",
    "ci_candidates_after_qa",
    "ci_detections_after_qa",
    "ndci_valid_before_qa",
    "ndci_valid_all_geolocated",
    "ndci_valid_after_qa",
)


def mask_funnel(dense: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How many pixels each stage keeps, before and after QA."""
    water, located, valid = F.col("water"), F.col("geolocated"), F.col("valid_water_mask")
    flagged, near_land = F.col("flag_excluded"), F.col("adjacent")
    finite, cand, det, nd = (
        F.col(c) for c in ("ci_finite", "ci_candidate", "ci_detection", "ndci_finite")
    )
    conditions = (
        F.lit(True),
        located,
        water,
        water & ~flagged,
        water & ~flagged & ~near_land,
        valid,
        water & finite,
        located & finite,
        located & cand,
        located & det,
        valid & finite,
        valid & finite & cand,
        valid & finite & det,
        water & nd,
        located & nd,
        valid & nd,
    )
    return dense.groupBy(*keys).agg(*[count_if(c).alias(s) for s, c in zip(STAGES, conditions)])


def flag_counts(
    dense: DataFrame, flag_map: FlagMap, requested: str | Iterable[str] = (), keys: Sequence[str] = ()
) -> DataFrame:
    """Per flag: water pixels that carry it, their share, and whether it was requested."""
    chosen = requested_flags(requested)
    flags = list(flag_map)
    # one counter per flag in a single pass, then turned into rows
    per_scope = dense.groupBy(*keys).agg(
        count_if(F.col("water")).alias("_water"),
        *[
            count_if(F.col("water") & flag_is_set(F.col("l2_flags"), flag_map, f)).alias(f"_f{i}")
            for i, f in enumerate(flags)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("flag"),
                F.lit(f in chosen).alias("selected_for_exclusion"),
                F.col(f"_f{i}").alias("water_pixel_count"),
            )
            for i, f in enumerate(flags)
        ]
    )
    share = F.lit(100.0) * F.col("water_pixel_count") / F.greatest(F.col("_water"), F.lit(1))
    return (
        per_scope.select(*keys, "_water", F.explode(rows).alias("r"))
        .select(*keys, "_water", "r.*")
        .withColumn("percent_of_water", share)
        .drop("_water")
    )


def shape_quantiles(dense: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Percentiles 1, 5, 25, 50, 75, 95 and 99 of both spectral shapes over CI-valid pixels."""
    metrics = {m: _value(m, F.col("ci_valid_mask")) for m in ("SS_681", "SS_665")}
    asked = {f"{m}_p{q:02d}": (m, q / 100.0) for m in metrics for q in (1, 5, 25, 50, 75, 95, 99)}
    return summarize(dense, keys, metrics, asked)


def gate_rejections(
    dense: DataFrame,
    keys: Sequence[str] = (),
    ss665_min: float = 0.0,
    detection_limit: float = DETECTION_LIMIT,
) -> DataFrame:
    """Candidates lost to the SS665 gate and to the CI limit, with the resulting message kind."""
    cand = true_or_false(F.col("ci_candidate_mask"))
    confirmed = true_or_false(F.col("SS_665") > f32(ss665_min))
    above = true_or_false(F.col("CI") > f32(detection_limit))
    out = dense.groupBy(*keys).agg(
        count_if(F.col("water") & F.col("ci_finite")).alias("ci_finite_before_qa"),
        count_if(F.col("ci_valid_mask")).alias("ci_finite_after_qa"),
        count_if(cand).alias("ci_candidates"),
        count_if(true_or_false(F.col("ci_detection_mask"))).alias("ci_detections"),
        count_if(cand & ~confirmed).alias("ss665_rejected"),
        count_if(cand & confirmed & ~above).alias("ci_threshold_rejected"),
    )
    message = (
        F.when(F.col("ci_finite_before_qa") == 0, "no finite CI input in selected water")
        .when(F.col("ci_finite_after_qa") == 0, "all finite CI input removed by the mask")
        .when(
            (F.col("ci_candidates") > 0) & (F.col("ci_detections") == 0),
            "candidates present, none confirmed",
        )
        .when(
            (F.col("ci_candidates") > 0) & (F.col("ss665_rejected") > 0),
            "some candidates rejected by SS665",
        )
        .otherwise("no loss to report")
    )
    return out.withColumn("diagnosis", message)


REPORTED = (
    "geolocated_pixels", "water_pixels", "valid_water_pixels", "ci_finite_before_qa", "ci_finite_after_qa",
    "ci_candidates_after_qa", "ci_detections_after_qa", "ndci_valid_before_qa", "ndci_valid_after_qa",
)


def funnel_stage_report(funnel: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Long stage table: stage, pixels, percent of water."""
    stages = [(name, F.col(name)) for name in REPORTED]
    stages.insert(2, ("water_pixels_removed", F.col("water_pixels") - F.col("valid_water_pixels")))
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("stage_order"),
                F.lit(label).alias("stage"),
                count.cast("long").alias("pixels"),
            )
            for i, (label, count) in enumerate(stages)
        ]
    )
    share = F.when(
        F.col("stage_order") > 0, F.try_divide(F.lit(100.0) * F.col("pixels"), F.col("water_pixels"))
    )
    return (
        funnel.select(*keys, "water_pixels", F.explode(rows).alias("r"))
        .select(*keys, "water_pixels", "r.*")
        .withColumn("percent_of_water", share)
        .drop("water_pixels")
    )


def funnel_flag_report(counts: DataFrame) -> DataFrame:
    """Flag rows worth showing: requested, or present in water."""
    return counts.where(F.col("selected_for_exclusion") | (F.col("water_pixel_count") > 0))


def dense_summary(dense: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    hits, ok = F.col("ci_detections"), F.col("ci_valid_pixels")
    return (
        dense.groupBy(*keys)
        .agg(
            count_if(F.col("water")).alias("water_pixels"),
            count_if(F.col("valid_water_mask")).alias("valid_water_pixels"),
            count_if(F.col("water") & F.col("qa_excluded")).alias("qa_excluded_pixels"),
            count_if(F.col("water") & F.col("bright")).alias("bright_excluded_pixels"),
            count_if(F.col("ci_valid_mask")).alias("ci_valid_pixels"),
            count_if(true_or_false(F.col("ci_candidate_mask"))).alias("ci_candidates"),
            count_if(true_or_false(F.col("ci_detection_mask"))).alias("ci_detections"),
            count_if(F.col("ndci_valid_mask")).alias("ndci_valid_pixels"),
            count_if(true_or_false(F.col("negative_core_rhos_count") > 0)).alias(
                "negative_core_rhos_pixels"
            ),
        )
        .withColumn("ci_detection_fraction_ci_valid", F.try_divide(hits, ok))
    )


def swath_coverage(
    swath: DataFrame,
    flag_map: FlagMap,
    keys: Sequence[str] = (),
    band: str = "rhos_681",
    stride: int = 1,
) -> DataFrame:
    """Finite share of one band: everywhere, over land and over non-land."""
    land = flag_is_set(F.col("l2_flags"), flag_map, "LAND")
    finite = F.col(band).isNotNull()
    sampled = swath
    if stride > 1:
        sampled = swath.where(
            (F.col("source_row") % stride == 0) & (F.col("source_col") % stride == 0)
        )
    out = sampled.groupBy(*keys).agg(
        count_if(finite).alias("finite_all_pixels"),
        F.count(F.lit(1)).alias("sampled_all_pixels"),
        count_if(finite & land).alias("finite_land_pixels"),
        count_if(land).alias("sampled_land_pixels"),
        count_if(finite & ~land).alias("finite_nonland_pixels"),
        count_if(~land).alias("sampled_nonland_pixels"),
    )
    return out.withColumns(
        {
            f"finite_fraction_{p}": F.try_divide(
                F.col(f"finite_{p}_pixels"), F.col(f"sampled_{p}_pixels")
            )
            for p in ("all", "land", "nonland")
        }
    )


# --- spectra ---------------------------------------------------------------------------


def lake_spectrum(native: DataFrame, keys: Sequence[str] = ("scene_id", "Hylak_id")) -> DataFrame:
    """Per lake and band: mean, median, population deviation and count over stored pixels.

    No QA filter: every stored pixel with a finite value counts.
    """
    keys = list(keys)
    bands = F.array(
        *[
            F.struct(
                F.lit(int(b.split("_")[1])).alias("wavelength_nm"),
                F.col(b).cast("double").alias("rhos"),
            )
            for b in NATIVE_BANDS
        ]
    )
    per = [*keys, "wavelength_nm"]
    long = native.select(*keys, F.explode(bands).alias("e")).select(*keys, "e.*")
    counts = [
        F.avg("rhos").alias("mean_rhos"),
        F.stddev_pop("rhos").alias("std_rhos"),
        F.count("rhos").alias("n"),
    ]
    return summarize(long, per, {"rhos": F.col("rhos")}, {"median_rhos": ("rhos", 0.5)}, counts)


# --- product checks --------------------------------------------------------------------


def _violation_rules(columns: Sequence[str]) -> Mapping[str, Column]:
    ci_ok, cand, det, nd = (
        _on(m) for m in ("ci_valid_mask", "ci_candidate_mask", "ci_detection_mask", "ndci_valid_mask")
    )
    return {
        "ci_mismatch": F.col("CI").isNotNull() != cand,
        "cyano_mismatch": F.col("CI_cyano").isNotNull() != det,
        "candidate_outside_valid": cand & ~ci_ok,
        "detection_outside_candidate": det & ~cand,
        "ndci_missing": nd & F.col("NDCI").isNull(),
    }


REQUIRED_NATIVE = (
    "scene_id", "config_hash", "latitude", "longitude", "Hylak_id", "l2_flags",
    "valid_water_mask", "cyan_strict_valid_mask", "bloom_rescue_mask",
    "CI", "CI_cyano", "NDCI", "MPH", "FAI", *NATIVE_BANDS,
)


def check_columns(df: DataFrame, required: Sequence[str] = REQUIRED_NATIVE) -> list[str]:
    present = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in present]


def check_native(native: DataFrame, keys: Sequence[str] = ("scene_id", "config_hash")) -> DataFrame:
    """Per stored product: row count, violation counts and the verdict.

    A product that has no rows has no result row, which callers treat as invalid.
    """
    absent = check_columns(native)
    if absent:
        raise ValueError(f"native table lacks {absent}")
    rules = _violation_rules(native.columns)
    out = native.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[count_if(c).alias(n) for n, c in rules.items()],
        count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("unlocated"),
    )
    clean = F.lit(True)
    for n in [*rules, "unlocated"]:
        clean = clean & (F.col(n) == 0)
    return out.withColumn("valid", clean & (F.col("rows") > 0))


def check_dense(dense: DataFrame, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    rules = _violation_rules(dense.columns)
    out = dense.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[count_if(c).alias(n) for n, c in rules.items()]
    )
    clean = F.lit(True)
    for n in rules:
        clean = clean & (F.col(n) == 0)
    return out.withColumn("valid", clean)


def lake_list(
    rows: DataFrame, lakes: DataFrame, keys: Sequence[str] = ("scene_id",)
) -> DataFrame:
    """Distinct lakes of a native or statistics table, with names."""
    ids = rows.select(*keys, "Hylak_id").where(F.col("Hylak_id").isNotNull()).distinct()
    names = lakes.select("Hylak_id", F.coalesce("Lake_name", F.lit("")).alias("Lake_name"))
    return ids.join(names, "Hylak_id", "left")




# Metrics that a time series may show.
SERIES_METRICS = (
    "ci_cyano_detection_fraction_of_ci_valid",
    "ci_cyano_detection_fraction_of_retained",
    "CI_mean_candidates",
    "CI_median_candidates",
    "CIcyano_mean_detections",
    "CIcyano_median_detections",
    "NDCI_mean_retained",
    "NDCI_median_retained",
    "MPH_mean_retained",
    "FAI_mean_retained",
    "retained_percent",
)


def lake_timeseries(stats: DataFrame, lake_id: int, metric: str) -> DataFrame:
    """Rows of one lake by acquisition time; unreadable times come first as NULL."""
    if metric not in SERIES_METRICS:
        raise KeyError(metric)
    return (
        stats.where(F.col("Hylak_id") == int(lake_id))
        .withColumn("time", F.try_to_timestamp("acquisition_start"))
        .orderBy("time", "scene_id")
    )
