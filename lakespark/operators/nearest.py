"""Radius-bounded nearest-pixel joins.

Both sides are hashed into cubes of twice the search radius on the unit sphere (or
squares of a plane), so a target looks into the few cubes its search ball meets and
the join is an equi-join. Chords order like arcs, so the result is exact, with no
special case at the poles or the dateline.

Pixels at one place are reduced to one before the join, so a cube holds no more than the
resolution of the swath allows. The choice is a hash aggregate on a fixed-width key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.functions import geo
from lakespark.functions.indices import DETECTION_LIMIT, dn_is_science, dn_to_ci, f32, true_or_false
from lakespark.operators.dedupe import first_by
from lakespark.operators.qa import comparison_valid, primary_valid
from lakespark.operators.quantiles import summarize
from lakespark.schema import NATIVE_BANDS, NATIVE_WAVELENGTHS
from lakespark.session import settle

NEAREST_RADIUS_M = 600.0
_CUBE = ["_cx", "_cy", "_cz"]
#: Adds coordinates (and the reach) to rows that have a latitude and a longitude.
Located = Callable[[DataFrame], DataFrame]
_ROUND = 1.0 + 1e-9


def search_radius(resolution_m: float) -> float:
    return max(NEAREST_RADIUS_M, 2.0 * float(resolution_m))


def _cubes(names: Sequence[str], size: Column, axes: Sequence[str] = ("_x", "_y", "_z")) -> dict[str, Column]:
    return {n: F.floor(F.col(a) / size).cast("long") for n, a in zip(names, axes)}


def _box_distance2(names: Sequence[str], size: Column, axes: Sequence[str] = ("_tx", "_ty", "_tz")) -> Column:
    """Squared distance from a point to a cube given by its indices."""
    total = F.lit(0.0)
    for n, axis in zip(names, axes):
        lo = F.col(n) * size
        gap = F.greatest(lo - F.col(axis), F.col(axis) - (lo + size), F.lit(0.0))
        total = total + gap * gap
    return total


def _meets_sphere(size: Column) -> Column:
    near, far = F.lit(0.0), F.lit(0.0)
    for n in _CUBE:
        lo = F.col(n) * size
        hi = lo + size
        a = F.greatest(lo, -hi, F.lit(0.0))
        b = F.greatest(F.abs(lo), F.abs(hi))
        near, far = near + a * a, far + b * b
    return (near <= _ROUND) & (far * _ROUND >= 1.0)


def _point_distance2() -> Column:
    return (
        (F.col("_tx") - F.col("_x")) * (F.col("_tx") - F.col("_x"))
        + (F.col("_ty") - F.col("_y")) * (F.col("_ty") - F.col("_y"))
        + (F.col("_tz") - F.col("_z")) * (F.col("_tz") - F.col("_z"))
    )


_STEPS = float(1 << 58)


def _id_span() -> Column:
    return F.expr("cast(18446744073709551616 as decimal(20,0))")


def _lowest_id() -> Column:
    return F.expr("cast(9223372036854775808 as decimal(20,0))")


def _ordered() -> Column:
    """Distance, then obs_id, as one fixed-width number, so that ``min`` can hash.

    The squared distance keeps 58 bits relative to the reach, which is finer than the
    coordinates themselves. Ids of either sign keep their order.
    """
    step = F.floor(F.col("_d2") / (F.col("_reach") * F.col("_reach")) * F.lit(_STEPS))
    place = F.col("obs_id").cast("decimal(20,0)") + _lowest_id()
    return (step.cast("decimal(18,0)") * _id_span() + place).cast("decimal(38,0)")


def _key_obs() -> Column:
    return (F.expr("_key % cast(18446744073709551616 as decimal(20,0))") - _lowest_id()).cast("long")


def _key_distance2() -> Column:
    step = F.expr("_key div cast(18446744073709551616 as decimal(20,0))").cast("double")
    return step / F.lit(_STEPS) * (F.col("_reach") * F.col("_reach"))


def nearest_within(
    targets: DataFrame,
    pixels: DataFrame,
    on: Sequence[str],
    target_id: Sequence[str],
    spherical: bool,
) -> DataFrame:
    """Every target with ``d2`` and ``obs_id`` of its nearest pixel in reach, else NULL.

    Both sides carry ``_reach`` (a function of ``on``) and coordinates: ``_tx _ty _tz``
    on targets, ``_x _y _z`` on pixels. Equal distances go to the smaller obs_id.
    Targets without coordinates find nothing. Targets travel to every cube in reach; where pixels are fewer than
    targets, `_nearest_at_home` is the better way.
    """
    on, target_id = list(on), list(target_id)
    cube = F.col("_reach") * F.lit(2.0)
    reach2 = F.col("_reach") * F.col("_reach") * F.lit(_ROUND)

    # copies of one place are one place; a hot cube is split by the skew handling of the join
    places = (
        pixels.groupBy(*on, "_reach", "_x", "_y", "_z")
        .agg(F.min("obs_id").alias("obs_id"))
        .withColumns(_cubes(_CUBE, cube))
        .drop("_reach")
    )
    # one row per target and cube that its search ball meets
    own = F.lit(True)
    seen = targets
    for n, axis in zip(_CUBE, ("_tx", "_ty", "_tz")):
        span = F.sequence(
            F.floor((F.col(axis) - F.col("_reach") * _ROUND) / cube).cast("long"),
            F.floor((F.col(axis) + F.col("_reach") * _ROUND) / cube).cast("long"),
        )
        seen = seen.withColumn(n, F.explode_outer(span))
        own = own & (F.col(n) == F.floor(F.col(axis) / cube).cast("long"))
    useful = _box_distance2(_CUBE, cube) <= reach2
    if spherical:
        useful = useful & _meets_sphere(cube)
    # a target keeps its own cube in any case, so that every target reaches the aggregate
    seen = seen.where(F.coalesce(own | useful, F.lit(True)))

    rest = [F.first(c).alias(c) for c in targets.columns if c not in target_id]
    best = (
        seen.join(places, [*on, *_CUBE], "left")
        .withColumn("_d2", _point_distance2())
        .groupBy(*target_id)
        .agg(*rest, F.min(F.when(F.col("_d2") <= reach2, _ordered())).alias("_key"))
    )
    return _answer(best, targets.columns)


#: Width of a home cube in reaches: wide, so that few pixels travel to more than one, and no wider, so that a target meets few.
HOME = 12.0


def _home(names: Sequence[str]) -> Column:
    """Number of a cube, 21 bits for each index; cubes far apart may share one, which only brings more pixels together."""
    number = F.lit(0).cast("long")
    for n in names:
        number = F.shiftleft(number, 21).bitwiseOR(F.col(n).bitwiseAND(F.lit((1 << 21) - 1)))
    return number


def home_of_point(axes: Sequence[str], reach: Column, spherical: bool) -> Column:
    """Number of the home cube of a point."""
    number = F.lit(0).cast("long")
    for axis in axes if spherical else axes[:2]:
        index = F.floor(F.col(axis) / (reach * F.lit(HOME))).cast("long")
        number = F.shiftleft(number, 21).bitwiseOR(index.bitwiseAND(F.lit((1 << 21) - 1)))
    return number


def to_homes(df: DataFrame, axes: Sequence[str], reach: Column, far: Column, spherical: bool) -> DataFrame:
    """``df`` once for every home cube (``_home``) that comes as near as ``far`` to the point in ``axes``."""
    size = reach * F.lit(HOME)
    names = _CUBE if spherical else _CUBE[:2]
    for n, axis in zip(names, axes):
        df = df.withColumn(n, F.explode(F.sequence(*(F.floor((F.col(axis) + side) / size).cast("long") for side in (-far, far)))))
    useful = _box_distance2(names, size, axes) <= far * far
    if spherical:
        useful = useful & _meets_sphere(size)
    return df.where(useful).withColumn("_home", _home(names)).drop(*names)


def deal(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """``df`` by home cube, in the same tasks for all that are dealt so; joins on these keys exchange nothing more."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *on, "_home")


def _nearest_at_home(
    targets: DataFrame, pixels: DataFrame, on: list[str], target_id: list[str], spherical: bool, at_target: Located, at_pixel: Located,
    off: float = 0.0,
) -> DataFrame:
    """Pixels travel to the home cubes in reach, targets to their own, and narrow: coordinates are computed anew there.

    Targets that have ``_home`` are there already, and lie at most ``off`` from a point in that cube.
    """
    reach2 = F.col("_reach") * F.col("_reach") * F.lit(_ROUND)
    place = [c for c in ("latitude", "longitude") if c not in on]
    spread_out = to_homes(at_pixel(pixels), ("_x", "_y", "_z"), F.col("_reach"), (F.col("_reach") + off) * _ROUND, spherical)
    # copies of one place are one place
    places = deal(spread_out.select(*on, "_home", *place, "obs_id"), on).groupBy(*on, "_home", *place).agg(F.min("obs_id").alias("obs_id"))
    places = at_pixel(places).select(*on, "_home", "_x", "_y", "_z", "obs_id")
    homed = targets
    if "_home" not in targets.columns:
        home = home_of_point(("_tx", "_ty", "_tz"), F.col("_reach"), spherical)
        homed = deal(at_target(targets).withColumn("_home", home).select(*targets.columns, "_home"), on)
    homed = at_target(homed)
    kept = [c for c in targets.columns if c != "_home"]
    rest = [F.first(c).alias(c) for c in dict.fromkeys([*kept, "_reach"]) if c not in target_id and c not in on]
    # pairs out of reach end in the join, so that few are compared by their whole key
    places = places.withColumnsRenamed({c: f"_p{c}" for c in (*on, "_home")})
    same = [F.col(c) == F.col(f"_p{c}") for c in (*on, "_home")]
    best = (
        homed.join(places, [*same, _point_distance2() <= reach2], "left")
        .withColumn("_d2", _point_distance2())
        # the keys of the join are keys here too, so what they brought together stays together
        .groupBy(*target_id, *(c for c in on if c not in target_id), "_home")
        .agg(*rest, F.min(_ordered()).alias("_key"))
    )
    return _answer(best, kept)


def _answer(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({"d2": _key_distance2(), "obs_id": _key_obs()}).select(
        *columns, "d2", "obs_id"
    )


def _on_sphere(df: DataFrame, lat: str, lon: str, names: Sequence[str]) -> DataFrame:
    v = geo.unit_sphere_xyz(F.col(lat), F.col(lon))
    return (
        df.withColumn("_v", v)
        .withColumns({n: F.col(f"_v.{a}") for n, a in zip(names, "xyz")})
        .drop("_v")
    )


def nearest_on_sphere(
    targets: DataFrame,
    pixels: DataFrame,
    radius_m: float | Column,
    target_id: Sequence[str],
    on: Sequence[str] = ("scene_id", "Hylak_id"),
    lat: str = "latitude",
    lon: str = "longitude",
    spread: str = "targets",
    off: float = 0.0,
) -> DataFrame:
    """Targets with ``obs_id`` and ``match_distance_m``; NULL when nothing is in reach.

    ``radius_m`` is a number, or a column that both sides have and ``on`` determines. ``spread`` names the side that
    travels to every cube in reach, best the smaller one; spread pixels meet a target in its own cube only, and the choice needs
    no exchange after the join (``radius_m`` is a number then).
    """
    reach = geo.metres_to_chord(radius_m)
    if not isinstance(radius_m, Column):
        reach = F.lit(reach)

    def at_target(df: DataFrame) -> DataFrame:
        return _on_sphere(df, lat, lon, ("_tx", "_ty", "_tz")).withColumn("_reach", reach)

    def at_pixel(df: DataFrame) -> DataFrame:
        return _on_sphere(df, "latitude", "longitude", ("_x", "_y", "_z"))

    located = pixels.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if spread == "pixels":
        narrow = located.select(*on, "latitude", "longitude", "obs_id").withColumn("_reach", reach)
        found = _nearest_at_home(targets, narrow, list(on), list(target_id), True, at_target, at_pixel, off)
    else:
        found = nearest_within(at_target(targets), at_pixel(located).withColumn("_reach", reach), on, target_id, spherical=True)
    found = found.withColumn("_m", geo.chord_to_metres(F.sqrt("d2")))
    near = F.col("_m") <= radius_m
    return found.select(
        *(c for c in targets.columns if c != "_home"),
        F.when(near, F.col("obs_id")).alias("obs_id"),
        F.when(near, F.col("_m")).alias("match_distance_m"),
    )


def same_lake_nearest(
    targets: DataFrame, pixels: DataFrame, radius_m: float, target_id: Sequence[str], off: float = 0.0
) -> DataFrame:
    """Nearest pixel of the same scene and lake, chosen before QA is looked at.

    Targets may have come into being in a cube ``_home`` that a point at most ``off`` (a chord) from them lies in.
    """
    return nearest_on_sphere(targets, pixels, radius_m, target_id, spread="pixels", off=off)


def mercator_scales(pixels: DataFrame) -> DataFrame:
    """(scene_id, Hylak_id, _scale): the Mercator scale at the median latitude of a lake's pixels in a scene."""
    on = ["scene_id", "Hylak_id"]
    middle = summarize(_on_mercator(pixels), on, {"lat": F.col("latitude")}, {"lat_median": ("lat", 0.5)})
    scale = F.lit(1.0) / F.greatest(F.cos(F.radians("lat_median")), F.lit(0.2))
    return middle.select(*on, scale.alias("_scale"))


def _on_mercator(pixels: DataFrame) -> DataFrame:
    x, y = geo.to_webmercator(F.col("latitude"), F.col("longitude"))
    return pixels.where(x.isNotNull() & y.isNotNull()).withColumns({"_x": x, "_y": y, "_z": F.lit(0.0)})


def same_lake_nearest_mercator(
    targets: DataFrame, pixels: DataFrame, radius_m: float, target_id: Sequence[str], scales: DataFrame | None = None, off: float = 0.0
) -> DataFrame:
    """Planar nearest in Web Mercator; targets carry ``x`` and ``y``.

    The radius is stretched by the Mercator scale at the median latitude of the
    lake's pixels, and distances are scaled back to ground metres. ``scales``: `mercator_scales` of the
    pixels, where they are known; targets that are at home carry their ``_scale``, and ``off`` is as in `same_lake_nearest`, on the plane.
    """
    on = ["scene_id", "Hylak_id"]
    scales = mercator_scales(pixels) if scales is None else scales
    reach = F.lit(float(radius_m)) * F.col("_scale")
    p = _on_mercator(pixels).select(*on, "latitude", "longitude", "obs_id").join(scales, on).withColumn("_reach", reach)
    t = targets if "_scale" in targets.columns else targets.join(scales, on, "left")

    def at_target(df: DataFrame) -> DataFrame:
        return df.withColumns({"_tx": F.col("x"), "_ty": F.col("y"), "_tz": F.lit(0.0), "_reach": reach})

    found = _nearest_at_home(t, p, on, list(target_id), False, at_target, _on_mercator, off)
    return found.select(
        *(c for c in targets.columns if c not in ("_home", "_scale")), "obs_id", (F.sqrt("d2") / F.col("_scale")).alias("match_distance_m")
    )


def dedupe_targets(assigned: DataFrame, cell: Sequence[str] = ("scene_id", "row", "col")) -> DataFrame:
    """One source per target cell: matched before unmatched, then the shortest distance."""
    far = F.coalesce(
        F.when(F.col("obs_id").isNotNull(), F.col("match_distance_m")), F.lit(float("inf"))
    )
    return first_by(assigned, {c: F.col(c) for c in cell}, [far, "Hylak_id"])


def regularize(assigned: DataFrame, pixels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of the chosen pixel for every target cell; no averaging, no gap filling."""
    values = pixels.select("scene_id", "obs_id", *columns)
    return assigned.join(values, ["scene_id", "obs_id"], "left")


# --- comparison with reference cells ------------------------------------------------------


def _reference_columns(cells: DataFrame) -> DataFrame:
    dn, valid = F.col("dn"), F.col("valid")
    return cells.withColumns(
        {
            "obpg_raw_dn": dn.cast("int"),
            "obpg_science_valid": dn_is_science(dn, valid),
            "obpg_CI_cyano": dn_to_ci(dn, valid),
        }
    ).withColumn(
        "obpg_detected_gt_0_0001", true_or_false(F.col("obpg_CI_cyano") > f32(DETECTION_LIMIT))
    )


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name).cast("int") > 0, F.lit(False))


def compare_native_first(
    cells: DataFrame,
    pixels: DataFrame,
    max_distance_m: float = 600.0,
    qa_basis: str = "primary",
    cell_id: Sequence[str] = ("scene_id", "Hylak_id", "cell_id"),
) -> DataFrame:
    """Nearest same-lake pixel of each reference cell first, its QA second.

    ``cells``: scene_id, Hylak_id, cell_id, latitude, longitude, dn, valid. A pixel
    that fails QA is never replaced by a farther one that passes.
    """
    found = nearest_on_sphere(cells, pixels, max_distance_m, cell_id, spread="pixels")
    scope = ["scene_id", "Hylak_id"]
    # the strict fallback looks at the matched pixels of the pair being compared
    source = primary_valid(pixels, "nearest_primary_bloom_aware_valid")
    keep = source.select(
        "scene_id",
        "obs_id",
        F.col("latitude").alias("nearest_native_latitude"),
        F.col("longitude").alias("nearest_native_longitude"),
        "nearest_primary_bloom_aware_valid",
        F.col("cyan_strict_valid_mask"),
        F.col("valid_water_mask"),
        _flag("cldice_mask").alias("nearest_CLDICE"),
        _flag("hisatzen_mask").alias("nearest_HISATZEN"),
        _flag("navfail_mask").alias("nearest_NAVFAIL"),
        _flag("bloom_rescue_mask").alias("nearest_bloom_rescued"),
        _flag("ci_valid_mask").alias("local_ci_input_valid"),
        _flag("ci_candidate_mask").alias("local_ci_candidate"),
        _flag("ci_detection_mask").alias("local_ci_detection_before_selected_QA"),
        F.col("CI_cyano").alias("local_CI_cyano"),
    )
    joined = found.join(keep, ["scene_id", "obs_id"], "left")
    joined = comparison_valid(joined, "nearest_generic_strict_valid", scope)
    match = F.col("obs_id").isNotNull()
    booleans = [
        "nearest_primary_bloom_aware_valid",
        "nearest_generic_strict_valid",
        "nearest_CLDICE",
        "nearest_HISATZEN",
        "nearest_NAVFAIL",
        "nearest_bloom_rescued",
        "local_ci_input_valid",
        "local_ci_candidate",
        "local_ci_detection_before_selected_QA",
    ]
    out = _reference_columns(joined).withColumns(
        {
            "local_match_found": match,
            "local_match_distance_m": F.col("match_distance_m"),
            **{b: match & true_or_false(F.col(b)) for b in booleans},
        }
    )
    chosen = (
        "nearest_generic_strict_valid"
        if qa_basis.lower() == "strict"
        else "nearest_primary_bloom_aware_valid"
    )
    out = out.withColumn("nearest_selected_QA_valid", F.col(chosen)).withColumn(
        "local_ci_cyano_detected",
        F.col("local_match_found")
        & F.col("nearest_selected_QA_valid")
        & F.col("local_ci_detection_before_selected_QA")
        & true_or_false(F.col("local_CI_cyano") > f32(DETECTION_LIMIT)),
    )
    return _with_pair_flag(out).select(
        *cell_id,
        "obs_id",
        "latitude",
        "longitude",
        "obpg_raw_dn",
        "obpg_science_valid",
        "obpg_CI_cyano",
        "obpg_detected_gt_0_0001",
        "local_match_found",
        "local_match_distance_m",
        "nearest_native_latitude",
        "nearest_native_longitude",
        "nearest_primary_bloom_aware_valid",
        "nearest_generic_strict_valid",
        "nearest_selected_QA_valid",
        "nearest_CLDICE",
        "nearest_HISATZEN",
        "nearest_NAVFAIL",
        "nearest_bloom_rescued",
        "local_ci_input_valid",
        "local_ci_candidate",
        "local_ci_detection_before_selected_QA",
        "local_ci_cyano_detected",
        "local_CI_cyano",
        "paired_above_0_0001_for_correlation",
    )


def _with_pair_flag(df: DataFrame) -> DataFrame:
    both = (
        true_or_false(F.col("obpg_CI_cyano") > f32(DETECTION_LIMIT))
        & F.col("local_ci_cyano_detected")
    )
    return df.withColumn("paired_above_0_0001_for_correlation", both)


def comparison_pairs(compared: DataFrame) -> DataFrame:
    """Usable pairs as doubles x (reference) and y (local)."""
    return compared.where("paired_above_0_0001_for_correlation").withColumns(
        {"x": F.col("obpg_CI_cyano").cast("double"), "y": F.col("local_CI_cyano").cast("double")}
    )


def compare_qa_first(
    cells: DataFrame,
    pixels: DataFrame,
    max_distance_m: float = 600.0,
    cell_id: Sequence[str] = ("scene_id", "Hylak_id", "cell_id"),
) -> DataFrame:
    """Older rule: pixels are filtered by QA first, then the nearest is taken."""
    passed = comparison_valid(pixels, "_ok", ["scene_id", "Hylak_id"]).where("_ok")
    found = nearest_on_sphere(cells, passed, max_distance_m, cell_id, spread="pixels")
    values = pixels.select(
        "scene_id",
        "obs_id",
        _flag("ci_valid_mask").alias("local_ci_input_valid"),
        _flag("ci_candidate_mask").alias("local_ci_candidate"),
        _flag("ci_detection_mask").alias("_det"),
        F.col("CI_cyano").alias("local_CI_cyano"),
    )
    joined = _reference_columns(found.join(values, ["scene_id", "obs_id"], "left"))
    match = F.col("obs_id").isNotNull()
    out = joined.withColumns(
        {
            "local_match_found": match,
            "local_match_distance_m": F.col("match_distance_m"),
            "local_ci_input_valid": match & true_or_false(F.col("local_ci_input_valid")),
            "local_ci_candidate": match & true_or_false(F.col("local_ci_candidate")),
            "local_ci_cyano_detected": match
            & true_or_false(F.col("_det") & (F.col("local_CI_cyano") > f32(DETECTION_LIMIT))),
        }
    )
    return _with_pair_flag(out).select(
        *cell_id,
        "latitude",
        "longitude",
        "obpg_raw_dn",
        "obpg_science_valid",
        "obpg_CI_cyano",
        "obpg_detected_gt_0_0001",
        "local_match_found",
        "local_match_distance_m",
        "local_ci_input_valid",
        "local_ci_candidate",
        "local_ci_cyano_detected",
        "local_CI_cyano",
        "paired_above_0_0001_for_correlation",
    )


# --- spectra at requested points -----------------------------------------------------------

PIXEL_BASES = {
    "stored_lake": None,
    "valid_water": "valid_water_mask",
    "ci_valid": "ci_valid_mask",
}


def coordinate_spectra(
    points: DataFrame,
    pixels: DataFrame,
    basis: str = "stored_lake",
    max_distance_m: float = 2000.0,
) -> DataFrame:
    """Spectrum of the nearest pixel among all lakes that pass ``basis``.

    ``points``: scene_id, label, latitude, longitude. One row per point and band; a
    point without a pixel in reach has one row with status ``rejected``.
    """
    mask = PIXEL_BASES[basis]
    usable = pixels if mask is None or mask not in pixels.columns else pixels.where(_flag(mask))
    found = nearest_on_sphere(points, usable, max_distance_m, ["scene_id", "label"], ["scene_id"])
    values = pixels.select(
        "scene_id",
        "obs_id",
        F.col("latitude").alias("pixel_latitude"),
        F.col("longitude").alias("pixel_longitude"),
        "Hylak_id",
        *NATIVE_BANDS,
    )
    bands = F.array(
        *[
            F.struct(
                F.lit("rhos_884" if w == 885 else b).alias("product"),
                F.lit(884.0 if w == 885 else float(w)).alias("wavelength_nm"),
                F.col(b).cast("double").alias("value"),
            )
            for w, b in zip(NATIVE_WAVELENGTHS, NATIVE_BANDS)
        ]
    )
    ok = F.col("obs_id").isNotNull()
    none = F.array(F.lit(None).cast("struct<product:string,wavelength_nm:double,value:double>"))
    return (
        found.join(values, ["scene_id", "obs_id"], "left")
        .withColumn("b", F.explode(F.when(ok, bands).otherwise(none)))
        .select(
            "scene_id",
            F.col("label").alias("point"),
            F.col("latitude").alias("target_latitude"),
            F.col("longitude").alias("target_longitude"),
            "pixel_latitude",
            "pixel_longitude",
            "Hylak_id",
            "match_distance_m",
            F.lit(basis).alias("pixel_basis"),
            F.when(ok, "matched").otherwise("rejected").alias("status"),
            "b.product",
            "b.wavelength_nm",
            "b.value",
        )
    )


def nearest_ci_valid(
    points: Sequence[tuple[str, float, float]], pixels: DataFrame
) -> DataFrame:
    """Nearest CI-valid pixel of each scene for a few (label, lat, lon) points, unbounded.

    Planar distance in float32 with longitudes shrunk by the cosine of the target
    latitude; ties go to the first line, then column. The points are literals, so
    every task reduces its own pixels to one row per point before the exchange.
    """
    import math

    if len(points) > 20:
        raise ValueError("at most 20 points")
    asked = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(float(lat)).alias("lat"),
                F.lit(float(lon)).alias("lon"),
                f32(max(math.cos(math.radians(lat)), 0.1)).alias("shrink"),
            )
            for label, lat, lon in points
        ]
    )
    usable = pixels.where(
        _flag("ci_valid_mask") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    dy = F.col("latitude") - F.col("p.lat").cast("float")
    dx = (F.col("longitude") - F.col("p.lon").cast("float")) * F.col("p.shrink")
    bands = [c for c in pixels.columns if c.startswith(("rhos_", "Rrs_"))]
    record = F.struct(
        (dy * dy + dx * dx).alias("d"),
        F.col("source_row").alias("row"),
        F.col("source_col").alias("column"),
        "obs_id",
        F.col("latitude").alias("pixel_latitude"),
        F.col("longitude").alias("pixel_longitude"),
        *bands,
    )
    near = usable.withColumn("p", F.explode(asked))
    # the least distances first, a number that hashes, so that only pixels at it are compared as whole records
    least = settle(near.groupBy("scene_id", F.col("p.label").alias("_label")).agg(F.min(dy * dy + dx * dx).alias("_least")))
    near = near.withColumn("_label", F.col("p.label")).join(least, ["scene_id", "_label"]).where((dy * dy + dx * dx) == F.col("_least"))
    return (
        near.groupBy(
            "scene_id",
            F.col("p.label").alias("label"),
            F.col("p.lat").alias("target_latitude"),
            F.col("p.lon").alias("target_longitude"),
        )
        .agg(F.min(record).alias("r"))
        .select("scene_id", "label", "target_latitude", "target_longitude", "r.*")
        .drop("d")
    )


def pixel_spectrum(chosen: DataFrame) -> DataFrame:
    """Bands of both prefixes of `nearest_ci_valid` rows, one row per wavelength."""
    from lakespark.functions.bands import wavelength

    bands = [c for c in chosen.columns if c.startswith(("rhos_", "Rrs_"))]
    entries = F.array(
        *[
            F.struct(
                F.lit(wavelength(b)).alias("wavelength_nm"),
                F.lit(b.split("_")[0]).alias("prefix"),
                F.lit(b).alias("product"),
                F.col(b).cast("double").alias("value"),
            )
            for b in sorted(bands, key=wavelength)
        ]
    )
    ids = [c for c in chosen.columns if c not in bands]
    pick = lambda prefix, col: F.max(F.when(F.col("e.prefix") == prefix, F.col(f"e.{col}")))
    return (
        chosen.withColumn("e", F.explode(entries))
        .groupBy(*ids, F.col("e.wavelength_nm").alias("wavelength_nm"))
        .agg(
            pick("rhos", "product").alias("rhos_product"),
            pick("rhos", "value").alias("rhos"),
            pick("Rrs", "product").alias("Rrs_product"),
            pick("Rrs", "value").alias("Rrs"),
        )
    )


def cell_latitude() -> Column:
    """Of the centre of a `raster_grid` cell."""
    return F.col("north") - (F.col("row") + 0.5) * F.col("dlat")


def cell_longitude() -> Column:
    return F.col("west") + (F.col("col") + 0.5) * F.col("dlon")


def _inside_own_cell(grid: DataFrame, pixels: DataFrame, radius: Column) -> DataFrame:
    """Nearest pixel of the cells of a `raster_grid` that have one within the circle which the cell holds.

    A pixel inside that circle lies in no other cell, so none of another cell is nearer: an aggregate without a join of pairs.
    """
    sized = grid.select("scene_id", "west", "south", "east", "north", "dlon", "dlat", radius.alias("_radius"))
    # where longitudes wrap or latitudes pass a pole, cells and distances do not fit together
    sized = sized.where("east - west <= 360 and south >= -90 and north <= 90 and dlon > 0 and dlat > 0")
    placed = pixels.join(F.broadcast(sized), "scene_id").withColumns(
        {
            "row": F.floor((F.col("north") - F.col("latitude")) / F.col("dlat")).cast("long"),
            "col": F.floor((F.col("longitude") - F.col("west")) / F.col("dlon")).cast("long"),
            "_reach": geo.metres_to_chord(F.col("_radius")),
        }
    )
    centred = placed.withColumns({"_lat": cell_latitude(), "_lon": cell_longitude()})
    both = _on_sphere(_on_sphere(centred, "_lat", "_lon", ("_tx", "_ty", "_tz")), "latitude", "longitude", ("_x", "_y", "_z"))
    sideways = F.asin(F.cos(F.radians("_lat")) * F.sin(F.least(F.radians("dlon") / 2, F.lit(math.pi / 2))))
    # a little less than the circle, for rounding
    inner = 2.0 * F.sin(F.least(F.radians("dlat") / 2, sideways) / 2) * 0.99
    near = both.withColumn("_d2", _point_distance2()).where(F.col("_d2") <= F.least(inner, "_reach") * F.least(inner, "_reach"))
    best = near.groupBy("scene_id", "row", "col", "_radius", "_reach").agg(F.min(_ordered()).alias("_key"))
    metres = geo.chord_to_metres(F.sqrt(_key_distance2()))
    found = best.withColumns({"obs_id": _key_obs(), "match_distance_m": metres})
    return found.where(F.col("match_distance_m") <= F.col("_radius")).select("scene_id", "row", "col", "obs_id", "match_distance_m")


def swath_to_grid(
    cells: DataFrame,
    pixels: DataFrame,
    layers: Sequence[str],
    cell_id: Sequence[str] = ("scene_id", "row", "col"),
    grid: DataFrame | None = None,
) -> DataFrame:
    """Nearest pixel of the scene for every grid cell, without a lake key.

    ``cells`` carry the resolution that their grid has; the search reaches 2.25 times as far. Each of
    ``layers`` is taken from that pixel. What is needed of the pixels is written once.

    With the `raster_grid` that the cells are those of, cells with a pixel close to their centre are answered by an aggregate,
    however dense the swath; the whole reach is searched for the others.
    """
    radius = F.greatest(F.lit(NEAREST_RADIUS_M), F.lit(2.25) * F.col("resolution_m"))
    t = cells.withColumn("_radius", radius)
    held = settle(pixels.select("scene_id", "obs_id", "latitude", "longitude", *(c for c in layers if c not in ("latitude", "longitude"))))
    p = held.select("scene_id", "obs_id", "latitude", "longitude")
    found = None
    if grid is not None:
        seen = settle(t.join(_inside_own_cell(grid, p, radius), ["scene_id", "row", "col"], "left"))
        found = seen.where(F.col("obs_id").isNotNull())
        t = seen.where(F.col("obs_id").isNull()).drop("obs_id", "match_distance_m")
    # one radius for each scene
    reach = t.groupBy("scene_id").agg(F.max("_radius").alias("_radius"))
    rest = nearest_on_sphere(t, p.join(reach, "scene_id"), F.col("_radius"), cell_id, ["scene_id"])
    found = rest if found is None else found.unionByName(rest)
    return found.drop("_radius").join(held.select("scene_id", "obs_id", *layers), ["scene_id", "obs_id"], "left")
