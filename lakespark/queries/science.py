"""Column functions and quality masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakespark import fixtures as fx
from lakespark.functions import bands, flags, geo, indices, names
from lakespark.operators import qa
from lakespark.operators.display import true_color
from lakespark.queries.base import DENSE, INDEXED, NATIVE, dense, i, many, native, native_sql, query, r, sql
from lakespark.schema import NATIVE_BANDS, NATIVE_INDICES, NATIVE_MASKS

CORE = ["rhos_620", "rhos_665", "rhos_681", "rhos_709"]


def band(w: int):
    return F.col(f"rhos_{w}")


WAVES = {885: 884.0}


@query(
    "c01_nearest_band",
    sql(
        f"""select brand, case when gap <= 12 then band end as band, {r("gap", "gap_nm")} from (
          select p_brand as brand, arg_min(band, (gap, band)) as band, min(gap) as gap from (
            select p_brand, concat('rhos_', cast(400 + p_size*11 as string)) as band,
                   abs(400e0 + p_size*11 - 681) as gap from part) group by p_brand)""",
        [],
    ),
)
def c01(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    named = part.select(
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("rhos_"), (400 + F.col("p_size") * 11).cast("string")).alias("product"),
    )
    return bands.nearest_band_rows(named, ["brand"], "product", "rhos", 681.0)


@query(
    "c02_decode_fill",
    sql(
        f"""select {i("obs_id")}, {r("case when rhos_620 < cast(0.02e0 as float) then null else rhos_620 end", "rhos_620")},
            {r("rhos_665")} from pixels"""
    ),
)
def c02(spark, sf):
    p = fx.pixels(spark, sf)
    low = F.col("rhos_620") < indices.f32(0.02)
    stored = F.when(low, indices.f32(bands.FILL_VALUE)).otherwise(F.col("rhos_620"))
    gaps = F.when(F.col("rhos_665").isNull(), F.lit(float("nan"))).otherwise(F.col("rhos_665"))
    return p.select(
        "obs_id",
        bands.decode_fill(stored).alias("rhos_620"),
        bands.decode_fill(gaps).alias("rhos_665"),
    )


@query(
    "c03_flag_is_set",
    sql(
        f"""select {i("obs_id")}, {i("(l2_flags & 1) <> 0", "land")}, {i("(l2_flags & 2) <> 0", "cldice")},
            {i("(l2_flags & 4) <> 0", "hisatzen")}, {i("(l2_flags & 8) <> 0", "navfail")}, {i("false", "hilt")} from pixels"""
    ),
)
def c03(spark, sf):
    def test(name):
        return flags.flag_is_set(F.col("l2_flags"), fx.FLAG_MAP, name).alias(name.lower())

    return fx.pixels(spark, sf).select(
        "obs_id", *[test(n) for n in ("land", "CLDICE", "HISATZEN", "NAVFAIL", "HILT")]
    )


@query(
    "c04_ci_family",
    sql(
        f"""select {i("obs_id")}, {i("fin", "ci_finite")}, {r("ss681", "SS_681")}, {r("ss665", "SS_665")},
            {i("cand0", "ci_candidate")}, {r("ci0", "CI")}, {i("det0", "ci_detection")}, {r("cy0", "CI_cyano")} from indexed""",
        indexed=INDEXED,
    ),
)
def c04(spark, sf):
    return indices.ci_family(fx.pixels(spark, sf), CORE).select(
        "obs_id", "ci_finite", "SS_681", "SS_665", "ci_candidate", "CI", "ci_detection", "CI_cyano"
    )


@query(
    "c05_ndci",
    sql(f"""select {i("obs_id")}, {r("nd0", "NDCI")}, {i("nd_ok", "ndci_valid")} from indexed""", indexed=INDEXED),
)
def c05(spark, sf):
    return fx.pixels(spark, sf).select(
        "obs_id",
        indices.ndci(band(665), band(709)).alias("NDCI"),
        indices.ndci_valid(band(665), band(709)).alias("ndci_valid"),
    )


@query(
    "c06_line_height",
    sql(
        f"""select {i("obs_id")}, {r("h681", "h681", 12)}, {r("h709", "h709", 12)}, {r("h754", "h754", 12)} from indexed""",
        indexed=INDEXED,
    ),
    decimals=12,
)
def c06(spark, sf):
    def height(center, w):
        return indices.line_height(center, band(665), band(884), w, 665, 884).alias(f"h{w}")

    return fx.pixels(spark, sf).select(
        "obs_id", height(band(681), 681), height(band(709), 709), height(band(754), 754)
    )


@query(
    "c07_fai",
    sql(f"""select {i("obs_id")}, {r("fai0", "FAI")}, {i("fai0 is not null", "fai_valid")} from indexed""", indexed=INDEXED),
)
def c07(spark, sf):
    value = indices.fai(band(665), band(754), band(865))
    return fx.pixels(spark, sf).select(
        "obs_id", value.alias("FAI"), value.isNotNull().alias("fai_valid")
    )


@query(
    "c08_mph",
    sql(f"""select {i("obs_id")}, {r("mph0", "MPH")}, {r("peak0", "MPH_peak_nm")} from indexed""", indexed=INDEXED),
)
def c08(spark, sf):
    top, peak = indices.mph(band(665), band(681), band(709), band(754), band(884), WAVES)
    return fx.pixels(spark, sf).select("obs_id", top.alias("MPH"), peak.alias("MPH_peak_nm"))


_XYZ = """select *, radians(cast(latitude as double)) as la, radians(cast(longitude as double)) as lo,
  cos(la)*cos(lo) as x, cos(la)*sin(lo) as y, sin(la) as z from pixels"""


@query(
    "c09_unit_sphere",
    sql(f"""select {i("obs_id")}, {r("x")}, {r("y")}, {r("z")} from t""", t=_XYZ),
)
def c09(spark, sf):
    v = geo.unit_sphere_xyz(F.col("latitude"), F.col("longitude"))
    return fx.pixels(spark, sf).select("obs_id", v.alias("v")).select("obs_id", "v.*")


@query(
    "c10_chord_to_metres",
    sql(
        f"""select {i("obs_id")}, {r("12742000e0*asin(least(1e0, sqrt((x-x0)*(x-x0)+(y-y0)*(y-y0)+(z-z0)*(z-z0))/2e0))", "metres", 3)}
            from (select *, cos(radians(40e0))*cos(radians(-85e0)) as x0, cos(radians(40e0))*sin(radians(-85e0)) as y0,
                  sin(radians(40e0)) as z0 from t)""",
        t=_XYZ,
    ),
    decimals=3,
)
def c10(spark, sf):
    p = fx.pixels(spark, sf).withColumns(
        {
            "a": geo.unit_sphere_xyz(F.col("latitude"), F.col("longitude")),
            "b": geo.unit_sphere_xyz(F.lit(40.0), F.lit(-85.0)),
        }
    )
    chord = geo.chord_between(*[F.col(f"a.{k}") for k in "xyz"], *[F.col(f"b.{k}") for k in "xyz"])
    return p.select("obs_id", geo.chord_to_metres(chord).alias("metres"))


@query(
    "c11_dn_to_ci",
    sql(
        f"""select {i("cell_id")}, {i("dn")}, {i("valid and dn between 0 and 250", "science")},
            {r("case when valid and dn between 0 and 250 then cast(pow(10e0, (3e0/250e0)*dn - 4.2e0) as float) end", "ci")} from raster""",
        ["raster"],
    ),
)
def c11(spark, sf):
    dn, ok = F.col("dn"), F.col("valid")
    return fx.raster(spark, sf).select(
        "cell_id", "dn", indices.dn_is_science(dn, ok).alias("science"), indices.dn_to_ci(dn, ok).alias("ci")
    )


_NAME_RE = names.SCENE_NAME


@query(
    "c12_parse_scene_name",
    sql(
        f"""select {i("scene_id")}, nullif(regexp_extract(name, '{_NAME_RE}', 1), '') as platform,
            nullif(regexp_extract(name, '{_NAME_RE}', 2), '') as sensing_start,
            nullif(regexp_extract(name, '{_NAME_RE}', 3), '') as sensing_stop,
            {i(f"try_cast(regexp_extract(name, '{_NAME_RE}', 5) as integer)", "duration_s")},
            {i(f"try_cast(regexp_extract(name, '{_NAME_RE}', 6) as integer)", "cycle")},
            {i(f"try_cast(regexp_extract(name, '{_NAME_RE}', 7) as integer)", "relative_orbit")},
            {i(f"try_cast(regexp_extract(name, '{_NAME_RE}', 8) as integer)", "frame")},
            case when regexp_matches(name, '{_NAME_RE}') then
              concat(regexp_extract(name, '{_NAME_RE}', 1), '_R', regexp_extract(name, '{_NAME_RE}', 7), '_F',
                     regexp_extract(name, '{_NAME_RE}', 8)) end as native_frame_id
          from scenes""",
        ["scenes"],
    ),
)
def c12(spark, sf):
    parsed = fx.scenes(spark, sf).select(
        "scene_id", names.parse_scene_name(F.concat("name", F.lit(".SEN3"))).alias("p")
    )
    fields = ("platform", "sensing_start", "sensing_stop", "duration_s", "cycle", "relative_orbit", "frame", "native_frame_id")
    return parsed.select("scene_id", *[f"p.{f}" for f in fields])


@query(
    "c13_acquisition_interval",
    sql(
        f"""select {i("scene_id")}, case when ok then strftime(t0, '%Y-%m-%dT%H:%M:%S') end as start,
            case when ok then strftime(t1, '%Y-%m-%dT%H:%M:%S') end as stop, {i("case when ok then sec end", "duration_s")}
          from (select *, epoch(t1) - epoch(t0) as sec, coalesce(sec > 0 and sec <= 7200, false) as ok from (
            select scene_id, try_strptime(regexp_extract_all(name, '\\d{{8}}T\\d{{6}}')[1], '%Y%m%dT%H%M%S') as t0,
                   try_strptime(regexp_extract_all(name, '\\d{{8}}T\\d{{6}}')[2], '%Y%m%dT%H%M%S') as t1 from scenes))""",
        ["scenes"],
    ),
)
def c13(spark, sf):
    got = fx.scenes(spark, sf).select("scene_id", names.acquisition_interval(F.col("name")).alias("p"))
    return got.select("scene_id", "p.start", "p.stop", "p.duration_s")


_TILE = "select o_orderkey as k, cast(o_orderkey % 72 as integer)*5 - 180 as w, cast(o_orderkey % 36 as integer)*5 - 90 as s from orders"
_LABEL = """concat('G05_', case when s >= 0 then 'N' else 'S' end, lpad(cast(abs(s) as string), 2, '0'), '_',
  case when w >= 0 then 'E' else 'W' end, lpad(cast(abs(w) as string), 3, '0'))"""


@query(
    "c14_grid_label",
    sql(f"""select {i("k")}, {_LABEL} as label, {r("w", "west")}, {r("s", "south")}, {r("w+5", "east")}, {r("s+5", "north")} from t""", [], t=_TILE),
)
def c14(spark, sf):
    k = F.col("o_orderkey")
    tiles = spark.read.parquet(f"{sf}/orders.parquet").select(
        k.alias("k"), (k % 72 * 5 - 180).alias("w"), (k % 36 * 5 - 90).alias("s")
    )
    labelled = tiles.select("k", names.grid_label(F.col("w"), F.col("s")).alias("label"))
    return labelled.withColumn("b", names.grid_id_to_bbox(F.col("label"))).select("k", "label", "b.*")


@query(
    "c15_window_id",
    sql(
        f"""select {i("scene_id")}, case when fx is null then 'FULL' else
            concat('W_', left(sha1(concat_ws(',', printf('%.6f', fx), printf('%.6f', fy), printf('%.6f', fx+0.2e0), printf('%.6f', fy+0.2e0))), 10)) end as window_id
          from scenes""",
        ["scenes"],
    ),
)
def c15(spark, sf):
    s = fx._view(spark, sf, "scenes")
    x, y = F.col("fx"), F.col("fy")
    return s.select("scene_id", names.window_id(x, y, x + 0.2, y + 0.2).alias("window_id"))


@query(
    "c16_selectors",
    sql(
        f"""select {i("obs_id")}, {i("valid_water_mask", "primary_valid")},
            {i("case when scene_id % 2 = 0 then cyan_strict_valid_mask else valid_water_mask end", "comparison_valid")},
            {r("case when valid_water_mask then rhos_665 end", "rhos_665")} from nat""",
        indexed=INDEXED,
        nat=NATIVE,
    ),
)
def c16(spark, sf):
    n = native(spark, sf)
    # scenes without any strict value fall back to the primary mask
    n = n.withColumn(
        "cyan_strict_valid_mask", F.when(F.col("scene_id") % 2 == 0, F.col("cyan_strict_valid_mask"))
    )
    picked = qa.comparison_valid(qa.primary_valid(n))
    return qa.masked_display(picked, ["rhos_665"]).select(
        "obs_id", "primary_valid", "comparison_valid", "rhos_665"
    )


@query(
    "c17_exclusion_reasons",
    sql(
        f"""select {i("obs_id")},
          {i('''case when land then 1 when qa_excluded then 2 when not fin then 3 when not cand0 then 4
             when not (ss665 > 0) then 5 when not det0 then 6 else 7 end''', "CI_exclusion_reason")},
          {i('''case when land then 1 when qa_excluded then 2 when rhos_665 is null then 3 when rhos_709 is null then 4
             when not nd_ok then 5 else 6 end''', "NDCI_exclusion_reason")} from dense""",
        indexed=INDEXED,
        dense=DENSE,
    ),
)
def c17(spark, sf):
    return dense(spark, sf).select("obs_id", "CI_exclusion_reason", "NDCI_exclusion_reason")


@query(
    "c18_negative_bands",
    sql(
        f"""select {i("obs_id")}, {i('''case when ci_valid_mask then
          (rhos_620 - cast(0.02e0 as float) < 0)::int + (rhos_665 - cast(0.02e0 as float) < 0)::int
          + (rhos_681 - cast(0.02e0 as float) < 0)::int + (rhos_709 - cast(0.02e0 as float) < 0)::int end''', "negative_bands")} from nat""",
        indexed=INDEXED,
        nat=NATIVE,
    ),
)
def c18(spark, sf):
    n = native(spark, sf)
    lowered = n.withColumns({c: F.col(c) - indices.f32(0.02) for c in CORE})
    return lowered.select(
        "obs_id", indices.negative_band_count(CORE, F.col("ci_valid_mask")).alias("negative_bands")
    )


@query(
    "c19_valid_bbox",
    sql(
        f"""select {i("o_orderkey", "k")}, {i("w >= -180 and w < e and e <= 180 and s >= -90 and s < n and n <= 90", "ok")} from (
          select o_orderkey, o_orderkey % 400 - 200e0 as w, o_orderkey % 190 - 95e0 as s,
                 o_orderkey % 390 - 195e0 as e, o_orderkey % 185 - 90e0 as n from orders)""",
        [],
    ),
)
def c19(spark, sf):
    k = F.col("o_orderkey")
    ok = geo.valid_bbox(k % 400 - 200.0, k % 190 - 95.0, k % 390 - 195.0, k % 185 - 90.0)
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("k"), ok.alias("ok"))


@query(
    "c20_expand_box",
    sql(
        f"""select {i("hylak_id")}, {r("greatest(-180e0, x0 - dlon)", "w")}, {r("greatest(-90e0, y0 - 3e0/111.32e0)", "s")},
            {r("least(180e0, x0 + 0.05e0 + dlon)", "e")}, {r("least(90e0, y0 + 0.05e0 + 3e0/111.32e0)", "n")}
          from (select *, 3e0/greatest(111.32e0*cos(radians(greatest(-85e0, least(85e0, (y0 + y0 + 0.05e0)/2e0)))), 1e0) as dlon from lakes)""",
        ["lakes"],
    ),
)
def c20(spark, sf):
    v = fx._view(spark, sf, "lakes")
    x, y = F.col("x0"), F.col("y0")
    return v.select("hylak_id", geo.expand_box(x, y, x + 0.05, y + 0.05, 3.0).alias("b")).select("hylak_id", "b.*")


@query(
    "c21_slug",
    sql(
        f"""select {i("k")}, coalesce(nullif(trim(regexp_replace(trim(t), '[^A-Za-z0-9._-]+', '_', 'g'), '_'), ''), 'region') as slug
          from (select p_partkey as k, case when p_partkey % 7 = 0 then '  ##' else concat('  ', p_name, ' (', p_brand, ')/') end as t from part)""",
        [],
    ),
)
def c21(spark, sf):
    text = F.when(F.col("p_partkey") % 7 == 0, "  ##").otherwise(
        F.concat(F.lit("  "), "p_name", F.lit(" ("), "p_brand", F.lit(")/"))
    )
    return spark.read.parquet(f"{sf}/part.parquet").select(
        F.col("p_partkey").alias("k"), names.slug(text).alias("slug")
    )


@query(
    "c22_daily_key",
    sql(
        f"""select {i("scene_id")}, strftime(d, '%Y-%m-%d') as day,
            concat('L', strftime(d, '%Y%j'), '.L3m_DAY_CYAN_CI_cyano_CYAN_CONUS_300m.tif') as key
          from (select scene_id, case when scene_id % 5 = 0 then date '2020-02-29' else cast(start_ts as date) end as d from scenes)""",
        ["scenes"],
    ),
)
def c22(spark, sf):
    s = fx.scenes(spark, sf)
    override = F.when(F.col("scene_id") % 5 == 0, " 2020-02-29 ").otherwise("")
    d = names.scene_utc_date(F.col("start"), override)
    return s.select(
        "scene_id", F.date_format(d, "yyyy-MM-dd").alias("day"), names.daily_reference_key(d).alias("key")
    )


@query(
    "c23_projections",
    sql(
        f"""select {i("obs_id")}, {r("x", "mx", 3)}, {r("y", "my", 3)},
            {r("degrees(atan(sinh(y/6378137e0)))", "lat", 3)}, {r("degrees(x/6378137e0)", "lon", 3)},
            {r("6371007.181e0*lo*cos(la)", "sx", 3)}, {r("6371007.181e0*la", "sy", 3)}
          from (select *, radians(cast(latitude as double)) as la, radians(cast(longitude as double)) as lo,
                6378137e0*lo as x, 6378137e0*ln(tan(pi()/4 + la/2)) as y from pixels)""",
    ),
    decimals=3,
)
def c23(spark, sf):
    lat, lon = F.col("latitude"), F.col("longitude")
    x, y = geo.to_webmercator(lat, lon)
    back_lat, back_lon = geo.from_webmercator(F.col("mx"), F.col("my"))
    sx, sy = geo.to_sinusoidal(lat, lon)
    return fx.pixels(spark, sf).select(
        "obs_id", x.alias("mx"), y.alias("my"), sx.alias("sx"), sy.alias("sy")
    ).withColumns({"lat": back_lat, "lon": back_lon})


@query(
    "c25_c28_export_and_modes",
    sql(
        f"""select {i("obs_id")}, {many(r, [f"rhos_{w}" for w in (490, 560, 620, 665, 681, 709, 754, 865)])},
            {r("rhos_885", "rhos_884")}, {i("cyan_strict_valid_mask", "generic_flag_exclusion_sensitivity_mask")} from nat""",
        indexed=INDEXED,
        nat=NATIVE,
    ),
)
def c25(spark, sf):
    shown = bands.export_names(native(spark, sf))
    return bands.select_bands(
        shown, "full_swath_rhos", keep=["obs_id", "generic_flag_exclusion_sensitivity_mask"]
    )


@query(
    "c27_stretch",
    sql(
        f"""select {i("obs_id")}, {many(lambda c: r(f"case when rhos_{c[1]} is not null then pow(least(1e0, greatest(0e0, (cast(rhos_{c[1]} as double) - lo{c[1]})/greatest(hi{c[1]} - lo{c[1]}, 1e-8))), 0.85e0) end", c[0]), [("red", 665), ("green", 560), ("blue", 490)])},
            {i("case when rhos_665 is null then 0 else 255 end", "alpha")}
          from pixels join (select scene_id as sid, {", ".join(f"quantile_cont(cast(rhos_{w} as double), 0.02e0) as lo{w}, quantile_cont(cast(rhos_{w} as double), 0.98e0) as hi{w}" for w in (665, 560, 490))}
            from pixels group by scene_id) on sid = scene_id""",
    ),
)
def c27(spark, sf):
    shown = true_color(fx.pixels(spark, sf), ["rhos_665", "rhos_560", "rhos_490"], "map", ["scene_id"])
    return shown.select("obs_id", "red", "green", "blue", "alpha")


_MASKS = many(i, NATIVE_MASKS)
_FLOATS = many(r, ("latitude", "longitude", *NATIVE_BANDS, *NATIVE_INDICES))
_IDS = f"{i('obs_id')}, {i('scene_id')}, {i('hylak_id', 'Hylak_id')}, {i('source_row')}, {i('source_col')}, {i('l2_flags')}"
_NATIVE_COLS = ["obs_id", "scene_id", "Hylak_id", "source_row", "source_col", "l2_flags", *NATIVE_MASKS,
                "latitude", "longitude", *NATIVE_BANDS, *NATIVE_INDICES]


@query("q01_q06_native_qa", sql(f"select {_IDS}, {_MASKS}, {_FLOATS} from nat", indexed=INDEXED, nat=NATIVE))
def q01(spark, sf):
    return native(spark, sf).select(*_NATIVE_COLS)


# A place is adjacent when a LAND pixel of the same scene (and line block) lies within
# two steps; the expansion of the land places mirrors the definition, not the join.
def _adjacent(block: str, n: int) -> str:
    ball = ",".join(
        f"({a},{b})" for a in range(-n, n + 1) for b in range(-n, n + 1) if abs(a) + abs(b) <= n
    )
    return f"""select distinct scene_id as asid, source_row + dr as arow, source_col + dc as acol, {block} as ablk
      from pixels, (values {ball}) v(dr, dc) where (l2_flags & 1) <> 0"""


_BLOCK = "cast(floor(source_row/256e0) as bigint)"
_WITH_ADJ = f"""select i.*, a.asid is not null and not land as adj from indexed i
  left join adj_places a on asid = scene_id and arow = source_row and acol = source_col and ablk = {_BLOCK}"""


@query(
    "q04_q05_native_screens",
    sql(
        f"select {_IDS}, {_MASKS}, {many(r, NATIVE_INDICES)} from nat",
        indexed=INDEXED,
        adj_places=_adjacent(_BLOCK, 2),
        with_adj=_WITH_ADJ,
        nat=native_sql("with_adj", "adj", "coalesce(rhos_865 > cast(0.03e0 as float), false)"),
    ),
)
def q04(spark, sf):
    out = native(spark, sf, adjacency_pixels=2, bright_screen=True, bright_limit=0.03)
    return out.select(*_NATIVE_COLS[:6], *NATIVE_MASKS, *NATIVE_INDICES)


@query(
    "q04_land_adjacency",
    sql(
        f"""select {i("obs_id")}, {i("b.asid is not null and (l2_flags & 1) = 0", "adjacent_in_block")},
            {i("w.asid is not null and (l2_flags & 1) = 0", "adjacent_in_scene")} from pixels
          left join blocked b on b.asid = scene_id and b.arow = source_row and b.acol = source_col and b.ablk = {_BLOCK}
          left join whole w on w.asid = scene_id and w.arow = source_row and w.acol = source_col""",
        blocked=_adjacent(_BLOCK, 1),
        whole=_adjacent("0", 1),
    ),
)
def q04_plain(spark, sf):
    p = fx.pixels(spark, sf)
    blocked = qa.land_adjacency(p, fx.FLAG_MAP, 1, qa.BLOCK_ROWS, "adjacent_in_block")
    return qa.land_adjacency(blocked, fx.FLAG_MAP, 1, None, "adjacent_in_scene").select(
        "obs_id", "adjacent_in_block", "adjacent_in_scene"
    )


@query(
    "q02_water_definition",
    sql(
        f"""select {i("obs_id")}, {i("not land", "l2_land")}, {i("inlake", "hydrolakes")}, {i("not land and inlake", "intersection")},
            {i("not land or inlake", "union_water")}, {i("inlake", "hydrolakes_if_loaded")}, {i("not land", "union_without_lakes")}
          from (select *, rhos_560 > cast(0.02e0 as float) as inlake from indexed)""",
        indexed=INDEXED,
    ),
)
def q02(spark, sf):
    p = fx.pixels(spark, sf).withColumn("lake", F.col("rhos_560") > indices.f32(0.02))
    outs = {m: m for m in qa.WATER_DEFINITIONS if m != "union"} | {"union": "union_water"}
    for mode, out in outs.items():
        p = qa.water_definition(p, fx.FLAG_MAP, mode, "lake", out)
    p = qa.water_definition(p, fx.FLAG_MAP, "union", None, "union_without_lakes")
    return p.select("obs_id", *outs.values(), "union_without_lakes")


_EXCLUDED = {
    "bloom_retaining": 8, "balanced_inland": 10, "relaxed_inland": 10, "diagnostic": 0,
    "conservative": 14, "cyan_comparable": 6, "bloom_aware_cyan": 12,
}


@query(
    "q03_flag_exclusion",
    sql(
        f"""select {i("obs_id")}, {many(lambda p: i(f"(l2_flags & {_EXCLUDED[p]}) <> 0", p), _EXCLUDED)} from pixels"""
    ),
)
def q03(spark, sf):
    f = F.col("l2_flags")
    return fx.pixels(spark, sf).select(
        "obs_id", *[flags.flag_exclusion(f, fx.FLAG_MAP, p).alias(p) for p in flags.PROFILES]
    )


@query(
    "q07_dense_indices",
    sql(
        f"""select {i("obs_id")}, {many(i, ("geolocated", "water", "valid_water_mask", "bright", "ci_valid_mask", "ndci_valid_mask"))},
            {i("water and qa_excluded", "qa_excluded_mask")},
            {i("case when ci_valid_mask then cand0 end", "ci_candidate_mask")}, {i("case when ci_valid_mask then det0 end", "ci_detection_mask")},
            {r("case when ci_valid_mask then ss681 end", "SS_681")}, {r("case when ci_valid_mask then ss665 end", "SS_665")},
            {r("case when cand1 then ci0 end", "CI")}, {r("case when det1 then cy0 end", "CI_cyano")},
            {r("case when ndci_valid_mask then nd0 end", "NDCI")},
            {r("ci0", "CI_pre_mask")}, {r("cy0", "CI_cyano_pre_mask")}, {r("nd0", "NDCI_pre_mask")} from dense""",
        indexed=INDEXED,
        dense=DENSE,
    ),
)
def q07(spark, sf):
    return dense(spark, sf).select(
        "obs_id", "geolocated", "water", "valid_water_mask", "bright", "ci_valid_mask", "ndci_valid_mask",
        "qa_excluded_mask", "ci_candidate_mask", "ci_detection_mask", "SS_681", "SS_665", "CI", "CI_cyano",
        "NDCI", "CI_pre_mask", "CI_cyano_pre_mask", "NDCI_pre_mask",
    )


