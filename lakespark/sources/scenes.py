"""Scene catalogue pages: one row per scene, date and box filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespark.functions.geo import box_polygon
from lakespark.operators.membership import scenes_in_region
from lakespark.sources.lakes import geojson_polygons

_RECORD = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField(
            "ContentDate",
            T.StructType([T.StructField("Start", T.StringType()), T.StructField("End", T.StringType())]),
        ),
        T.StructField("ContentLength", T.LongType()),
        T.StructField("Online", T.BooleanType()),
        T.StructField("S3Path", T.StringType()),
        # kept as text: Polygon and MultiPolygon differ in nesting
        T.StructField("GeoFootprint", T.StringType()),
    ]
)
PAGE = T.StructType([T.StructField("value", T.ArrayType(_RECORD))])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).option("multiLine", True).json(path)


def scene_rows(pages: DataFrame) -> DataFrame:
    """One row per scene of the catalogue pages, with the defaults of absent fields."""
    item = pages.select(F.explode("value").alias("v")).select("v.*")
    name = F.regexp_replace(F.coalesce("Name", F.lit("")), r"\.SEN3$", "")
    return item.where(F.col("Id").isNotNull()).select(
        F.col("Id").alias("scene_id"),
        name.alias("name"),
        F.when(name != "", F.element_at(F.split(name, "_"), 1)).otherwise("S3").alias("satellite"),
        F.coalesce("ContentDate.Start", F.lit("")).alias("start"),
        F.coalesce("ContentDate.End", F.lit("")).alias("end"),
        F.coalesce("ContentLength", F.lit(0)).cast("long").alias("size_bytes"),
        F.coalesce("Online", F.lit(True)).alias("online"),
        F.col("S3Path").alias("s3_path"),
        geojson_polygons(F.col("GeoFootprint")).alias("footprint"),
    )


def filter_scenes(
    scenes: DataFrame,
    start_date: str,
    end_date: str,
    bbox: tuple[float, float, float, float] | None = None,
    max_products: int | None = None,
    newest_first: bool = False,
) -> DataFrame:
    """Scenes that start on the given days (end day included), optionally in a box."""
    t = F.try_to_timestamp(F.col("start"))
    first = F.lit(start_date).cast("date").cast("timestamp")
    after = F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp")
    out = scenes.where((t >= first) & (t < after))
    if bbox is not None:
        w, s, e, n = (F.lit(float(v)) for v in bbox)
        spark = scenes.sparkSession
        out = scenes_in_region(out, spark.range(1).select(box_polygon(w, s, e, n).alias("polygons")))
    order = [F.col("start").desc() if newest_first else F.col("start").asc(), F.col("scene_id")]
    if max_products:
        return out.orderBy(*order).limit(int(max_products))
    return out.orderBy(*order)
