"""Statistics, diagnostics, ordering and display limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakespark import fixtures as fx
from lakespark.operators import dedupe, display, stats
from lakespark.queries.base import DENSE, INDEXED, NATIVE, dense, i, native, query, r, sql

CTX = {"indexed": INDEXED, "nat": NATIVE}
DCTX = {"indexed": INDEXED, "dense": DENSE}


def q_of(col: str, p: float, where: str = "true") -> str:
    return f"quantile_cont(cast({col} as double), {p}e0) filter ({where} and {col} is not null)"


def avg_of(col: str, where: str) -> str:
    return f"avg(cast({col} as double)) filter ({where})"


def max_of(col: str, where: str) -> str:
    return f"max(cast({col} as double)) filter ({where})"


def n_of(where: str, name: str) -> str:
    return i(f"count(*) filter ({where})", name)


def spread(col, where, name, tail, parts):
    text = {
        "mean": avg_of(col, where),
        "median": q_of(col, 0.5, where),
        "p10": q_of(col, 0.1, where),
        "p90": q_of(col, 0.9, where),
        "max": max_of(col, where),
    }
    return ", ".join(r(text[p], f"{name}_{p}{tail}") for p in parts)


_FULL = ("mean", "median", "p10", "p90", "max")
A01_COLUMNS = f"""{i("count(*)", "native_polygon_pixels")},
  {n_of("valid_water_mask", "retained_pixels")}, {n_of("cyan_strict_valid_mask", "cyan_strict_pixels")},
  {n_of("bloom_rescue_mask", "bloom_rescued_pixels")}, {n_of("cldice_mask", "CLDICE_pixels")},
  {n_of("ci_valid_mask", "ci_input_valid_pixels")}, {n_of("ci_candidate_mask", "ci_candidate_pixels")},
  {n_of("ci_detection_mask", "ci_cyano_detection_pixels")},
  {r("100e0*count(*) filter (valid_water_mask)/count(*)", "retained_percent")},
  {r("count(*) filter (ci_detection_mask)/nullif(cast(count(*) filter (ci_valid_mask) as double), 0)", "ci_cyano_detection_fraction_of_ci_valid")},
  {r("count(*) filter (ci_detection_mask)/nullif(cast(count(*) filter (valid_water_mask) as double), 0)", "ci_cyano_detection_fraction_of_retained")},
  {spread("CI", "ci_candidate_mask", "CI", "_candidates", _FULL)},
  {spread("CI_cyano", "ci_detection_mask", "CIcyano", "_detections", ("mean", "median", "p90"))},
  {spread("NDCI", "valid_water_mask", "NDCI", "_retained", ("mean", "median", "p90"))},
  {spread("MPH", "valid_water_mask", "MPH", "_retained", _FULL)},
  {spread("FAI", "valid_water_mask", "FAI", "_retained", _FULL)}"""


@query(
    "a01_lake_window_stats",
    sql(
        f"""select {i("scene_id")}, window_id, {i("hylak_id", "Hylak_id")}, {A01_COLUMNS}
            from nat group by scene_id, window_id, hylak_id""",
        **CTX,
    ),
)
def a01(spark, sf):
    return stats.lake_window_stats(native(spark, sf))


@query(
    "a01_scene_stats_hot_groups",
    sql(f"""select {i("scene_id")}, {A01_COLUMNS} from nat group by scene_id""", **CTX),
)
def a01_hot(spark, sf):
    """Few large groups: the plan that never buffers a group."""
    return stats.lake_window_stats(native(spark, sf), ["scene_id"])


# first observation per scene, lake and float32-rounded place
_KEY = "cast(round_even(cast({c}*cast(1e6 as float) as double), 0)/1e6 as float)"
DEDUPED = f"""select * from (select *, row_number() over (
    partition by scene_id, hylak_id, {_KEY.format(c="latitude")}, {_KEY.format(c="longitude")}
    order by window_id, source_row, source_col, obs_id) as rn_ from nat) where rn_ = 1"""


@query("o01_dedupe_locations", sql(f"select {i('obs_id')}, {i('scene_id')}, {i('hylak_id', 'Hylak_id')}, {r('CI')} from dd", indexed=INDEXED, nat=NATIVE, dd=DEDUPED))
def o01(spark, sf):
    return dedupe.dedupe_locations(native(spark, sf), ["CI"]).select("obs_id", "scene_id", "Hylak_id", "CI")


_BASES = {"CI": "ci_candidate_mask", "CI_cyano": "ci_detection_mask", "NDCI": "valid_water_mask",
          "MPH": "valid_water_mask", "FAI": "valid_water_mask"}
A02_COLUMNS = f"""{i("count(*)", "native_lake_pixels")}, {n_of("valid_water_mask", "primary_retained_pixels")},
  {n_of("cyan_strict_valid_mask", "generic_flag_exclusion_sensitivity_pixels")},
  {n_of("bloom_rescue_mask", "bloom_rescued_pixels")}, {n_of("cldice_mask", "CLDICE_pixels")},
  {n_of("cloud_excluded_mask", "cloud_excluded_pixels")},
  {r("count(*) filter (bloom_rescue_mask)/nullif(cast(count(*) filter (cldice_mask) as double), 0)", "bloom_rescue_fraction_of_CLDICE")},
  {n_of("ci_valid_mask", "ci_input_valid_pixels")}, {n_of("ci_candidate_mask", "ci_candidate_pixels")},
  {n_of("ci_detection_mask", "ci_cyano_detection_pixels")},
  {", ".join(n_of(f"{b} and {m} is not null", f"{m}_valid_pixels") for m, b in _BASES.items())},
  {", ".join(spread(m, b, m, "", _FULL) for m, b in _BASES.items())}"""


@query(
    "a02_scene_share_stats",
    sql(
        f"select {i('scene_id')}, {i('hylak_id', 'Hylak_id')}, {A02_COLUMNS} from dd group by scene_id, hylak_id",
        indexed=INDEXED, nat=NATIVE, dd=DEDUPED,
    ),
)
def a02(spark, sf):
    return stats.scene_share_stats(dedupe.dedupe_locations(native(spark, sf), stats.SHARE_COLUMNS))


@query(
    "a03_dense_lake_stats",
    sql(
        f"""select {i("l.hylak_id", "Hylak_id")}, lake_name as "Lake_name", {r("lake_area", "Lake_area_km2")},
          {n_of("d.obs_id is not null", "native_polygon_pixels")}, {n_of("valid_water_mask", "retained_pixels")},
          {n_of("bright", "bright_screen_pixels")}, {n_of("ci_valid_mask", "ci_input_valid_pixels")},
          {n_of("cand1", "ci_candidate_pixels")}, {n_of("det1", "ci_cyano_detection_pixels")},
          {r("100e0*count(*) filter (valid_water_mask)/nullif(cast(count(d.obs_id) as double), 0)", "retained_percent")},
          {r("count(*) filter (det1)/nullif(cast(count(*) filter (ci_valid_mask) as double), 0)", "ci_cyano_detection_fraction_of_ci_valid")},
          {r("count(*) filter (det1)/nullif(cast(count(*) filter (valid_water_mask) as double), 0)", "ci_cyano_detection_fraction_of_retained")},
          {spread("ci0", "cand1", "CI", "_candidates", ("median", "p10", "p90"))},
          {spread("cy0", "det1", "CIcyano", "_detections", ("median", "p10", "p90"))},
          {spread("nd0", "ndci_valid_mask", "NDCI", "_retained", ("median", "p10", "p90"))}
        from lakes l left join dense d on d.hylak_id = l.hylak_id and d.hylak_id % 3 <> 0
        group by l.hylak_id, lake_name, lake_area""",
        ["pixels", "lakes"],
        **DCTX,
    ),
)
def a03(spark, sf):
    # every third lake has no pixels at all
    d = dense(spark, sf).where(F.col("Hylak_id") % 3 != 0)
    return stats.dense_lake_stats(d, fx.lakes(spark, sf))


_STAGES = dict(
    zip(
        stats.STAGES,
        (
            "true", "geolocated", "water", "water and not flag_excluded", "water and not flag_excluded",
            "valid_water_mask", "water and fin", "geolocated and fin", "geolocated and cand0",
            "geolocated and det0", "valid_water_mask and fin", "valid_water_mask and cand0",
            "valid_water_mask and det0", "water and nd_ok", "geolocated and nd_ok", "valid_water_mask and nd_ok",
        ),
    )
)


@query(
    "a04_mask_funnel",
    sql(f"select {i('scene_id')}, {', '.join(n_of(c, s) for s, c in _STAGES.items())} from dense group by scene_id", **DCTX),
)
def a04(spark, sf):
    return stats.mask_funnel(dense(spark, sf), ["scene_id"])


@query(
    "a05_flag_counts",
    sql(
        f"""select {i("scene_id")}, flag, {i("flag = 'NAVFAIL'", "selected_for_exclusion")},
            {i("count(*) filter (water and (l2_flags & mask) <> 0)", "water_pixel_count")},
            {r("100e0*count(*) filter (water and (l2_flags & mask) <> 0)/greatest(count(*) filter (water), 1)", "percent_of_water")}
          from dense, (values ('LAND',1),('CLDICE',2),('HISATZEN',4),('NAVFAIL',8)) f(flag, mask) group by scene_id, flag""",
        **DCTX,
    ),
)
def a05(spark, sf):
    return stats.flag_counts(dense(spark, sf), fx.FLAG_MAP, ["NAVFAIL"], ["scene_id"])


@query(
    "a06_shape_quantiles",
    sql(
        f"""select {i("scene_id")}, {", ".join(r(q_of(c, q / 100, "ci_valid_mask"), f"{n}_p{q:02d}") for n, c in (("SS_681", "ss681"), ("SS_665", "ss665")) for q in (1, 5, 25, 50, 75, 95, 99))}
            from dense group by scene_id""",
        **DCTX,
    ),
)
def a06(spark, sf):
    return stats.shape_quantiles(dense(spark, sf), ["scene_id"])


@query(
    "a07_gate_rejections",
    sql(
        f"""select {i("scene_id")}, {n_of("water and fin", "ci_finite_before_qa")}, {n_of("ci_valid_mask", "ci_finite_after_qa")},
          {n_of("cand1", "ci_candidates")}, {n_of("det1", "ci_detections")},
          {n_of("cand1 and not coalesce(ss665 > 0, false)", "ss665_rejected")},
          {n_of("cand1 and ss665 > 0 and not coalesce(ci0 > cast(0.0001e0 as float), false)", "ci_threshold_rejected")},
          case when count(*) filter (water and fin) = 0 then 'no finite CI input in selected water'
               when count(*) filter (ci_valid_mask) = 0 then 'all finite CI input removed by the mask'
               when count(*) filter (cand1) > 0 and count(*) filter (det1) = 0 then 'candidates present, none confirmed'
               when count(*) filter (cand1) > 0 and count(*) filter (cand1 and not coalesce(ss665 > 0, false)) > 0
                 then 'some candidates rejected by SS665' else 'no loss to report' end as diagnosis
        from dense group by scene_id""",
        **DCTX,
    ),
)
def a07(spark, sf):
    return stats.gate_rejections(dense(spark, sf), ["scene_id"])


_REPORTED = (
    ("geolocated_pixels", "geolocated"),
    ("water_pixels", "water"),
    ("water_pixels_removed", "water and not valid_water_mask"),
    ("valid_water_pixels", "valid_water_mask"),
    ("ci_finite_before_qa", "water and fin"),
    ("ci_finite_after_qa", "valid_water_mask and fin"),
    ("ci_candidates_after_qa", "valid_water_mask and cand0"),
    ("ci_detections_after_qa", "valid_water_mask and det0"),
    ("ndci_valid_before_qa", "water and nd_ok"),
    ("ndci_valid_after_qa", "valid_water_mask and nd_ok"),
)


@query(
    "a08_funnel_report",
    sql(
        " union all ".join(
            f"""select {i("scene_id")}, {i(str(k), "stage_order")}, '{label}' as stage, {n_of(c, "pixels")},
              {r("null" if k == 0 else f"100e0*count(*) filter ({c})/nullif(count(*) filter (water), 0)", "percent_of_water")}
              from dense group by scene_id"""
            for k, (label, c) in enumerate(_REPORTED)
        ),
        **DCTX,
    ),
)
def a08(spark, sf):
    return stats.funnel_stage_report(stats.mask_funnel(dense(spark, sf), ["scene_id"]), ["scene_id"])


@query(
    "a08_flag_report",
    sql(
        f"""select {i("scene_id")}, flag, {i("flag in ('NAVFAIL', 'LAND')", "selected_for_exclusion")},
            {i("count(*) filter (water and (l2_flags & mask) <> 0)", "water_pixel_count")},
            {r("100e0*count(*) filter (water and (l2_flags & mask) <> 0)/greatest(count(*) filter (water), 1)", "percent_of_water")}
          from dense, (values ('LAND',1),('CLDICE',2),('HISATZEN',4),('NAVFAIL',8),('HILT',16)) f(flag, mask)
          group by scene_id, flag
          having flag in ('NAVFAIL', 'LAND') or count(*) filter (water and (l2_flags & mask) <> 0) > 0""",
        **DCTX,
    ),
)
def a08_flags(spark, sf):
    counts = stats.flag_counts(
        dense(spark, sf), {**fx.FLAG_MAP, "HILT": 16}, ["navfail", "LAND"], ["scene_id"]
    )
    return stats.funnel_flag_report(counts)


@query(
    "a15_lake_spectrum",
    sql(
        " union all ".join(
            f"""select {i("scene_id")}, {i("hylak_id", "Hylak_id")}, {i(str(w), "wavelength_nm")},
              {r(f"avg(cast(rhos_{w} as double))", "mean_rhos")}, {r(q_of(f"rhos_{w}", 0.5), "median_rhos")},
              {r(f"stddev_pop(cast(rhos_{w} as double))", "std_rhos")}, {i(f"count(rhos_{w})", "n")} from nat group by scene_id, hylak_id"""
            for w in (490, 560, 620, 665, 681, 709, 754, 865, 885)
        ),
        **CTX,
    ),
)
def a15(spark, sf):
    return stats.lake_spectrum(native(spark, sf))


@query(
    "a18_display_limits",
    sql(
        f"""select {i("scene_id")}, {i("Hylak_id", "Hylak_id")}, {r("case when n = 0 then 0 else lo end", "lo")},
            {r("case when n = 0 then 1 when hi <= lo then lo + 1e-6 else hi end", "hi")} from (
          select *, case when n <= 20 or p98 <= p02 then v0 else p02 end as lo, case when n <= 20 or p98 <= p02 then v1 else p98 end as hi from (
            select scene_id, hylak_id as "Hylak_id", count(*) filter (CI_cyano > 0) as n,
              {q_of("CI_cyano", 0.02, "CI_cyano > 0")} as p02, {q_of("CI_cyano", 0.98, "CI_cyano > 0")} as p98,
              min(cast(CI_cyano as double)) filter (CI_cyano > 0) as v0, max(cast(CI_cyano as double)) filter (CI_cyano > 0) as v1
            from nat group by scene_id, hylak_id))""",
        **CTX,
    ),
)
def a18(spark, sf):
    return display.display_limits(native(spark, sf), "CI_cyano", ["scene_id", "Hylak_id"])


@query(
    "a18_robust_limits",
    sql(
        f"""select {i("scene_id")}, {i("hylak_id", "Hylak_id")},
            {r("case when p02 is not null and p02 <> p98 then p02 else 0 end", "lo")},
            {r("case when p02 is not null and p02 <> p98 then p98 else 0.02e0 end", "hi")} from (
          select scene_id, hylak_id, {q_of("CI_cyano", 0.02)} as p02, {q_of("CI_cyano", 0.98)} as p98 from nat group by scene_id, hylak_id)""",
        **CTX,
    ),
)
def a18_robust(spark, sf):
    return display.robust_limits(native(spark, sf), "CI_cyano", (0.0, 0.02), ["scene_id", "Hylak_id"])


_RGB = (665, 560, 490)


@query(
    "a19_stretch_limits",
    sql(
        f"""select {i("scene_id")}, {", ".join(
            f'{r(q_of(f"rhos_{w}", 0.01, "rhos_665 is not null"), f"rhos_{w}_lo")}, {r(q_of(f"rhos_{w}", 0.995, "rhos_665 is not null"), f"rhos_{w}_hi")}'
            for w in _RGB)} from pixels group by scene_id"""
    ),
)
def a19(spark, sf):
    return display.stretch_limits(
        fx.pixels(spark, sf), [f"rhos_{w}" for w in _RGB], "raster", ["scene_id"]
    )


# positions in line, column, obs order; the taken ones follow linspace(0, N-1, n)
_SAMPLE_N = 500
SAMPLED = f"""select p.* from (select *, row_number() over (partition by scene_id order by window_id, source_row, source_col, obs_id) - 1 as pos,
     count(*) over (partition by scene_id) as total from pixels) p
   where total <= {_SAMPLE_N} or exists (select 1 from generate_series(0, {_SAMPLE_N - 1}) g(k)
     where cast(floor(k*((total-1)/{_SAMPLE_N - 1}e0)) as bigint) = pos)"""


@query("o03_even_sample", sql(f"select {i('obs_id')}, {i('scene_id')} from smp", smp=SAMPLED))
def o03(spark, sf):
    return dedupe.even_sample(fx.pixels(spark, sf), _SAMPLE_N).select("obs_id", "scene_id")


@query(
    "o03_stride_sample",
    sql(f"select {i('obs_id')} from pixels where source_row % 3 = 0 and source_col % 3 = 0"),
)
def o03_stride(spark, sf):
    return dedupe.stride_sample(fx.pixels(spark, sf), 3).select("obs_id")


@query(
    "a20_spatial_buckets",
    sql(
        f"""select {i("scene_id")}, {i("bx")}, {i("by_", "by")}, {i("count(*)", "n")},
            {i("min(obs_id)", "first_obs")}, {i("max(obs_id)", "last_obs")}, {r("sum(lat6)", "lat_sum")} from (
          select *, floor(cast(longitude as double)/0.02e0) as bx, floor(cast(latitude as double)/0.02e0) as by_,
                 round(cast(latitude as double), 6) as lat6 from pixels where latitude is not null and longitude is not null) group by scene_id, bx, by_""",
    ),
)
def a20(spark, sf):
    b = display.spatial_buckets(fx.pixels(spark, sf), ["rhos_665"])
    total = F.aggregate("points", F.lit(0.0), lambda acc, p: acc + p["lat6"])
    return b.select(
        "scene_id", "bx", "by", "n",
        F.get("points", F.lit(0))["obs_id"].alias("first_obs"),
        F.element_at("points", -1)["obs_id"].alias("last_obs"),
        total.alias("lat_sum"),
    )


_PARTS = {"all": "true", "land": "(l2_flags & 1) <> 0", "nonland": "(l2_flags & 1) = 0"}


@query(
    "a21_swath_coverage",
    sql(
        f"""select {i("scene_id")}, {", ".join(
            f'{n_of(f"rhos_665 is not null and {c}", f"finite_{p}_pixels")}, {n_of(c, f"sampled_{p}_pixels")}, '
            + r(f"count(*) filter (rhos_665 is not null and {c})/nullif(cast(count(*) filter ({c}) as double), 0)", f"finite_fraction_{p}")
            for p, c in _PARTS.items())}
          from pixels where source_row % 2 = 0 and source_col % 2 = 0 group by scene_id"""
    ),
)
def a21(spark, sf):
    return stats.swath_coverage(
        fx.pixels(spark, sf), fx.FLAG_MAP, ["scene_id"], "rhos_665", stride=2
    )


# some products are broken on purpose: CI is lost where obs_id is a multiple of 1009
_BROKEN = {
    "ci_mismatch": "(case when obs_id % 1009 = 0 then null else CI end is not null) <> ci_candidate_mask",
    "cyano_mismatch": "(CI_cyano is not null) <> ci_detection_mask",
    "candidate_outside_valid": "ci_candidate_mask and not ci_valid_mask",
    "detection_outside_candidate": "ci_detection_mask and not ci_candidate_mask",
    "ndci_missing": "ndci_valid_mask and NDCI is null",
    "unlocated": "latitude is null or longitude is null",
}


@query(
    "a22_check_native",
    sql(
        f"""select {i("scene_id")}, 'cfg0' as config_hash, {i("count(*)", "rows")}, {", ".join(n_of(c, n) for n, c in _BROKEN.items())},
          {i(" and ".join(f"count(*) filter ({c}) = 0" for c in _BROKEN.values()), "valid")} from nat group by scene_id""",
        **CTX,
    ),
)
def a22(spark, sf):
    n = native(spark, sf)
    broken = n.withColumn("CI", F.when(F.col("obs_id") % 1009 != 0, F.col("CI")))
    return stats.check_native(broken)


_DENSE_RULES = {
    "ci_mismatch": "(case when cand1 then ci0 end is not null) <> coalesce(cand1, false)",
    "cyano_mismatch": "(case when det1 then cy0 end is not null) <> coalesce(det1, false)",
    "candidate_outside_valid": "cand1 and not ci_valid_mask",
    "detection_outside_candidate": "det1 and not cand1",
    "ndci_missing": "ndci_valid_mask and nd0 is null",
}


@query(
    "a22_check_dense",
    sql(
        f"""select {i("scene_id")}, {i("count(*)", "rows")}, {", ".join(n_of(c, n) for n, c in _DENSE_RULES.items())},
          {i(" and ".join(f"count(*) filter ({c}) = 0" for c in _DENSE_RULES.values()), "valid")} from dense group by scene_id""",
        **DCTX,
    ),
)
def a22_dense(spark, sf):
    return stats.check_dense(dense(spark, sf))


@query(
    "a23_lake_list",
    sql(
        f"""select {i("scene_id")}, {i("n.hylak_id", "Hylak_id")}, coalesce(lake_name, '') as "Lake_name"
            from (select distinct scene_id, hylak_id from nat) n left join lakes l on l.hylak_id = n.hylak_id""",
        ["pixels", "lakes"],
        **CTX,
    ),
)
def a23(spark, sf):
    return stats.lake_list(native(spark, sf), fx.lakes(spark, sf))


@query(
    "a25_dense_summary",
    sql(
        f"""select {i("scene_id")}, {n_of("water", "water_pixels")}, {n_of("valid_water_mask", "valid_water_pixels")},
          {n_of("water and qa_excluded", "qa_excluded_pixels")}, {n_of("water and bright", "bright_excluded_pixels")},
          {n_of("ci_valid_mask", "ci_valid_pixels")}, {n_of("cand1", "ci_candidates")}, {n_of("det1", "ci_detections")},
          {n_of("ndci_valid_mask", "ndci_valid_pixels")},
          {n_of("ci_valid_mask and (rhos_620 < 0 or rhos_665 < 0 or rhos_681 < 0 or rhos_709 < 0)", "negative_core_rhos_pixels")},
          {r("count(*) filter (det1)/nullif(cast(count(*) filter (ci_valid_mask) as double), 0)", "ci_detection_fraction_ci_valid")}
        from dense group by scene_id""",
        **DCTX,
    ),
)
def a25(spark, sf):
    return stats.dense_summary(dense(spark, sf), ["scene_id"])


@query(
    "j22_with_lake_metadata",
    sql(
        f"""select {i("scene_id")}, {i("n.hylak_id", "Hylak_id")}, {i("n", "pixels")}, coalesce(lake_name, '') as "Lake_name",
            {r("lake_area", "Lake_area_km2")}, coalesce(country, '') as "Country", coalesce(continent, '') as "Continent"
          from (select scene_id, hylak_id, count(*) as n from nat group by all) n left join
            (select hylak_id, case when hylak_id % 4 = 0 then null else lake_name end as lake_name, lake_area, country, continent
             from lakes where hylak_id % 7 <> 0) l on l.hylak_id = n.hylak_id""",
        ["pixels", "lakes"],
        **CTX,
    ),
)
def j22(spark, sf):
    counts = native(spark, sf).groupBy("scene_id", "Hylak_id").agg(F.count("*").alias("pixels"))
    lakes = fx.lakes(spark, sf).where(F.col("Hylak_id") % 7 != 0)
    unnamed = lakes.withColumn("Lake_name", F.when(F.col("Hylak_id") % 4 != 0, F.col("Lake_name")))
    joined = stats.with_lake_metadata(counts, unnamed)
    # lakes outside the catalogue have no metadata at all
    return joined.fillna("", subset=["Lake_name", "Country", "Continent"])


@query(
    "o02_dedupe_stats",
    sql(
        f"select {i('scene_id')}, window_id, {i('hylak_id', 'Hylak_id')}, {i('count(*)', 'pixels')} from nat group by all",
        **CTX,
    ),
)
def o02(spark, sf):
    s = native(spark, sf).groupBy("scene_id", "window_id", "Hylak_id").agg(F.count("*").alias("pixels"))
    return dedupe.dedupe_stats(dedupe.union_frames([s, s]))


@query(
    "o05_sorted_head",
    sql(
        f"""select {i("scene_id")}, name, {i("size_bytes")} from scenes order by start_ts, scene_id limit 50""",
        ["scenes"],
    ),
)
def o05(spark, sf):
    day = fx.scenes(spark, sf).withColumn("day", F.substring("start", 1, 10))
    return dedupe.sorted_head(day, ["day", "scene_id"], 50).select("scene_id", "name", "size_bytes")


@query(
    "o06_union_frames",
    sql(
        f"""select {i("obs_id")}, {r("rhos_665")}, {r("null", "rhos_709")} from pixels where scene_id < 4
            union all select {i("obs_id")}, {r("null", "rhos_665")}, {r("rhos_709")} from pixels where scene_id >= 4"""
    ),
)
def o06(spark, sf):
    p = fx.pixels(spark, sf)
    early = p.where(F.col("scene_id") < 4).select("obs_id", "rhos_665")
    late = p.where(F.col("scene_id") >= 4).select("obs_id", "rhos_709")
    return dedupe.union_frames([early, late])
