"""Adapter views: pixels, lakes, scenes and so on, derived from the star-schema tables.

The SQL text of a view runs unchanged in Spark and in the checking database, so
both see the same rows. Literals are doubles because decimals divide differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespark.functions.bands import decode_bands
from lakespark.functions.geo import box_polygon

FLAG_MAP = {"LAND": 1, "CLDICE": 2, "HISATZEN": 4, "NAVFAIL": 8}
BANDS = tuple(f"rhos_{w}" for w in (490, 560, 620, 665, 681, 709, 754, 865, 884))
# Corners of the hexagon inside each lake tile.
HEXAGON = (
    (0.005, 0.005), (0.030, 0.003), (0.047, 0.020), (0.028, 0.025), (0.040, 0.046), (0.010, 0.042),
)
# Slanted footprint of a scene, relative to its south-west corner.
FOOTPRINT = ((0.02, 0.0), (0.20, 0.03), (0.18, 0.20), (0.0, 0.17))
CELL_STEP = 0.004
RASTER_ORIGIN = (-85.0, 40.0)


def _band(name, base, span, a, b, m):
    return f"cast({base}e0 + {span}e0*((s*{a}+{b})%{m})/{m}.0e0 as float) as {name}"


def _ring_values(corners):
    pairs = zip(range(len(corners)), corners, (*corners[1:], corners[0]))
    return ", ".join(f"({i},{a[0]}e0,{a[1]}e0,{c[0]}e0,{c[1]}e0)" for i, a, c in pairs)


def _stamp(hour, minute):
    return (
        "concat(lpad(cast(year(o_orderdate) as string),4,'0'), lpad(cast(month(o_orderdate) as string),2,'0'),"
        " lpad(cast(day(o_orderdate) as string),2,'0'), 'T',"
        f" lpad(cast({hour} as string),2,'0'), lpad(cast({minute} as string),2,'0'), '00')"
    )


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "h": (
        (),
        "select *, l_orderkey*7919 + l_partkey*104729 + l_suppkey*31 + l_linenumber*1299709 as s from {lineitem}",
    ),
    "pixels": (
        ("h",),
        f"""select l_orderkey*1000 + row_number() over (partition by l_orderkey
              order by l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity) as obs_id,
            l_orderkey % 8 as scene_id, 'FULL' as window_id, l_suppkey + 1 as hylak_id,
            cast(s % 512 as int) as source_row,
            cast(cast(floor(s/512e0) as bigint) % 512 as int) as source_col,
            cast(-85.0e0 + (l_suppkey % 10)*0.05e0 + ((s*29+9) % 1009)/1009.0e0*0.05e0 as float) as longitude,
            cast( 40.0e0 + (cast(floor(l_suppkey/10e0) as bigint) % 100)*0.05e0
                  + ((s*43+11) % 1013)/1013.0e0*0.05e0 as float) as latitude,
            (case when s%53=0 then 1 else 0 end) + (case when cast(floor(s/7e0) as bigint)%5=0 then 2 else 0 end)
              + (case when s%37=0 then 4 else 0 end) + (case when s%61=0 then 8 else 0 end) as l2_flags,
            {_band("rhos_490", 0.005, 0.030, 23, 8, 947)},
            {_band("rhos_560", 0.008, 0.030, 31, 9, 941)},
            {_band("rhos_620", 0.010, 0.030, 3, 1, 997)},
            case when s%101=0 then null
                 else cast(0.020e0 + 0.030e0*((s*5+2)%991)/991.0e0 as float) end as rhos_665,
            {_band("rhos_681", 0.020, 0.030, 7, 3, 983)},
            {_band("rhos_709", 0.020, 0.040, 11, 4, 977)},
            {_band("rhos_754", 0.005, 0.050, 13, 5, 971)},
            {_band("rhos_865", 0.005, 0.040, 17, 6, 967)},
            {_band("rhos_884", 0.005, 0.030, 19, 7, 953)}
          from h""",
    ),
    "lakes": (
        (),
        """select s_suppkey + 1 as hylak_id, s_name as lake_name, 10 + abs(s_acctbal)/100.0e0 as lake_area,
            n_name as country, r_name as continent,
            -85.0e0 + (s_suppkey % 10)*0.05e0 as x0,
            40.0e0 + (cast(floor(s_suppkey/10e0) as bigint) % 100)*0.05e0 as y0
          from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    ),
    "edges": (
        ("lakes",),
        f"""select hylak_id, i, x0+ax as x1, y0+ay as y1, x0+cx as x2, y0+cy as y2
          from lakes, (values {_ring_values(HEXAGON)}) v(i,ax,ay,cx,cy)""",
    ),
    "scenes": (
        (),
        f"""select o_orderkey as scene_id,
            case when o_orderkey % 89 = 0 then concat('UNPARSABLE_', cast(o_orderkey as string))
              else concat(case when o_orderkey % 2 = 0 then 'S3A' else 'S3B' end, '_OL_1_EFR____',
                {_stamp("o_orderkey % 24", "o_orderkey % 50")}, '_', {_stamp("o_orderkey % 24", "o_orderkey % 50 + o_orderkey % 4")}, '_',
                {_stamp("23", "59")}, '_0180_', lpad(cast(o_orderkey % 150 as string),3,'0'), '_',
                lpad(cast(o_orderkey % 385 + 1 as string),3,'0'), '_',
                lpad(cast((o_orderkey % 160) * 60 as string),4,'0'), '_LN1_O_NT_002') end as name,
            o_orderdate as start_ts, o_orderkey % 24 as start_hour, o_totalprice as price,
            cast(floor(o_totalprice) as bigint) as size_bytes,
            case o_orderstatus when 'F' then 'done' when 'O' then 'queued'
              else case when o_orderkey % 2 = 0 then 'failed' else 'running' end end as status,
            case when o_orderkey % 97 = 0 then null else -85.15e0 + (o_orderkey % 5)*0.15e0 end as fx,
            case when o_orderkey % 97 = 0 then null
              else 39.95e0 + (cast(floor(o_orderkey/5e0) as bigint) % 34)*0.15e0 end as fy,
            o_custkey as cust
          from {{orders}}""",
    ),
    "scene_edges": (
        ("scenes",),
        f"""select scene_id, i, fx+ax as x1, fy+ay as y1, fx+cx as x2, fy+cy as y2
          from scenes, (values {_ring_values(FOOTPRINT)}) v(i,ax,ay,cx,cy) where fx is not null""",
    ),
    "regions": (
        (),
        """select n_nationkey as region_id, n_name as region_name,
            -85.0e0 + (n_nationkey % 5)*0.1e0 + 0.003e0 as w,
            40.0e0 + cast(floor(n_nationkey/5e0) as bigint)*0.1e0 + 0.004e0 as s,
            -85.0e0 + (n_nationkey % 5)*0.1e0 + 0.061e0 as e,
            40.0e0 + cast(floor(n_nationkey/5e0) as bigint)*0.1e0 + 0.057e0 as n,
            r_name as continent
          from {nation} join {region} on n_regionkey = r_regionkey""",
    ),
    "raster": (
        (),
        """select p_partkey as cell_id, cast(floor(p_partkey/50e0) as bigint) as row, p_partkey % 50 as col,
            (p_partkey*37 + p_size*5) % 256 as dn, p_partkey % 19 <> 0 as valid
          from {part}""",
    ),
    "cells": (
        ("raster",),
        """select *, -85.0e0 + (col + 0.5e0)*0.004e0 as lon, 40.0e0 + (row + 0.5e0)*0.004e0 as lat from raster""",
    ),
    # one request point per continent: the middle of its lakes
    "points": (
        ("lakes",),
        """select continent as label, round(avg(y0 + 0.025e0), 6) as latitude, round(avg(x0 + 0.025e0), 6) as longitude
          from lakes group by continent""",
    ),
    "ledger": (
        ("scenes",),
        """select cast(scene_id as string) as scene_id,
            case when cust % 2 = 0 then 'cfg0' else 'cfg1' end as config_hash,
            name as scene_name, scene_id as k, size_bytes, scene_id % 7 as candidate_lakes, status,
            scene_id % 3 as attempts, scene_id % 6 as window_count,
            cast(floor(price*100e0) as bigint) as compact_bytes, scene_id % 50 as stats_rows,
            start_ts, fx, fy
          from scenes""",
    ),
}


def with_clause(names, extra: dict[str, str] | None = None, tables=None) -> str:
    """``WITH`` text of the named views, their dependencies, and further CTEs."""
    ordered: dict[str, str] = {}

    def add(name):
        needs, text = VIEWS[name]
        for need in needs:
            add(need)
        ordered.setdefault(name, text)

    for name in names:
        add(name)
    tables = tables or {}
    shown = {
        t: tables.get(t, t)
        for t in ("lineitem", "orders", "supplier", "nation", "region", "part")
    }
    ctes = {k: v.format(**shown) for k, v in ordered.items()}
    ctes.update(extra or {})
    if not ctes:
        return ""
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items())


def _view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    names = ("lineitem", "orders", "supplier", "nation", "region", "part")
    text = with_clause([name], tables={t: "{" + t + "}" for t in names})
    used = {
        t: spark.read.parquet(f"{sf}/{t}.parquet") for t in names if "{" + t + "}" in text
    }
    if "lineitem" in used:
        # one exchange on the key that numbering needs anyway; a small file is a single split
        used["lineitem"] = used["lineitem"].repartition("l_orderkey")
    return spark.sql(f"{text} select * from {name}", **used)


def _ring(x0, y0, corners):
    points = [F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y")) for dx, dy in corners]
    return F.array(F.array(F.array(*points, points[0])))


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Swath pixels that carry the lake id a stored product would carry."""
    df = _view(spark, sf, "pixels")
    return decode_bands(
        df.withColumns(
            {
                "Hylak_id": F.col("hylak_id").cast("long"),
                "obs_id": F.col("obs_id").cast("long"),
                "l2_flags": F.col("l2_flags").cast("long"),
                "config_hash": F.lit("cfg0"),
            }
        ),
        BANDS,
    )


def swath(spark: SparkSession, sf: str) -> DataFrame:
    """Swath pixels before any lake is assigned."""
    return pixels(spark, sf).drop("Hylak_id")


def lakes(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, "lakes").select(
        F.col("hylak_id").cast("long").alias("Hylak_id"),
        F.col("hylak_id").cast("long").alias("lake_order"),
        F.col("lake_name").alias("Lake_name"),
        F.col("lake_area").alias("Lake_area"),
        F.col("country").alias("Country"),
        F.col("continent").alias("Continent"),
        _ring(F.col("x0"), F.col("y0"), HEXAGON).alias("polygons"),
    )


def scenes(spark: SparkSession, sf: str) -> DataFrame:
    footprint = F.when(F.col("fx").isNotNull(), _ring(F.col("fx"), F.col("fy"), FOOTPRINT))
    start = F.col("start_ts") + F.make_dt_interval(hours=F.col("start_hour").cast("int"))
    return _view(spark, sf, "scenes").select(
        "scene_id",
        "name",
        F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("start"),
        "size_bytes",
        "status",
        footprint.alias("footprint"),
    )


def pixel_scenes(spark: SparkSession, sf: str) -> DataFrame:
    """One record per scene that has pixels; the footprint covers the lake block."""
    lake_block = _view(spark, sf, "lakes").agg(F.max("y0").alias("top"))
    found = pixels(spark, sf).select("scene_id").distinct()
    whole = box_polygon(F.lit(-85.1), F.lit(39.9), F.lit(-84.4), F.col("top") + 0.1)
    return found.join(lake_block).select(
        "scene_id",
        F.format_string(
            "S3A_OL_1_EFR____202401%02dT120000_202401%02dT120300_20240120T120000_0180_108_%03d_2520_LN1_O_NT_002",
            F.col("scene_id") + 1,
            F.col("scene_id") + 1,
            F.col("scene_id") + 11,
        ).alias("name"),
        F.format_string("2024-01-%02dT12:00:00.000Z", F.col("scene_id") + 1).alias("start"),
        whole.alias("footprint"),
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, "regions").select(
        "region_id",
        "region_name",
        "continent",
        box_polygon(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("polygons"),
    )


def raster(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, "raster")


def points(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf, "points")


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    start = F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    footprint = F.when(F.col("fx").isNotNull(), _ring(F.col("fx"), F.col("fy"), FOOTPRINT))
    return _view(spark, sf, "ledger").select(
        "scene_id",
        "config_hash",
        "scene_name",
        start.alias("acquisition_start"),
        F.lit(None).cast("string").alias("acquisition_end"),
        F.lit(None).cast("string").alias("s3_path"),
        "size_bytes",
        F.col("candidate_lakes").cast("long"),
        "status",
        F.col("attempts").cast("long"),
        F.lit("full_scene").alias("processing_strategy"),
        F.col("window_count").cast("long"),
        F.lit("auto").alias("download_method"),
        "compact_bytes",
        F.col("stats_rows").cast("long"),
        F.lit(None).cast("string").alias("last_error"),
        F.lit("2024-01-01T00:00:00Z").alias("updated_utc"),
        F.to_json(
            F.struct(F.col("scene_id").alias("id"), F.col("scene_name").alias("name"), footprint.alias("footprint"))
        ).alias("scene_json"),
    )
