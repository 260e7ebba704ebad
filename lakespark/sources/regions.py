"""Administrative boundaries: rows of a GeoJSON collection and selection by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespark.sources.lakes import geojson_polygons

# Property names that may hold the name and the code, by priority.
NAME_FIELDS = ("shapeName", "NAME_1", "name", "Name", "NAME", "admin1Name", "ADM1_EN")
CODE_FIELDS = ("shapeISO", "HASC_1", "iso_3166_2", "ISO_3166_2")

COLLECTION = "features array<struct<properties:map<string,string>, geometry:string>>"


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COLLECTION).option("multiLine", True).json(path)


def admin_rows(collection: DataFrame) -> DataFrame:
    """(idx, key, label, name, polygons) of every feature that has a geometry."""
    # features without a usable geometry do not count
    shaped = F.transform(
        "features",
        lambda f: F.struct(f["properties"].alias("properties"), geojson_polygons(f["geometry"]).alias("polygons")),
    )
    usable = F.filter(shaped, lambda f: F.coalesce(F.size(F.flatten(f["polygons"])) > 0, F.lit(False)))
    numbered = collection.select(F.posexplode(usable).alias("idx", "f")).select("idx", "f.*")
    prop = lambda k: F.col("properties")[k]
    name = F.coalesce(
        F.nullif(F.coalesce(*[prop(k) for k in NAME_FIELDS]), F.lit("")),
        F.concat(F.lit("ADM1 "), (F.col("idx") + 1).cast("string")),
    )
    code = F.nullif(F.lower(F.coalesce(*[prop(k) for k in CODE_FIELDS])), F.lit("nan"))
    shown = F.coalesce(*[prop(k) for k in CODE_FIELDS])
    ident = F.coalesce(prop("shapeID"), F.col("idx").cast("string"))
    label = F.when(
        code.isNotNull() & (shown != ""), F.concat(name, F.lit(" ("), shown, F.lit(")"))
    ).otherwise(name)
    return numbered.select(
        "idx",
        F.concat(F.col("idx").cast("string"), F.lit(":"), ident).alias("key"),
        label.alias("label"),
        name.alias("name"),
        "polygons",
    )


def match_admin(regions: DataFrame, names: Sequence[str]) -> DataFrame:
    """How each name matches: the chosen label, or the ambiguity that prevents it.

    A label, or its part before `` (``, may match exactly; otherwise a unique
    substring is accepted. Columns: query, status (exact, partial, ambiguous, none),
    label, matches (up to ten labels).
    """
    q = F.lower(F.trim(F.col("query")))
    low = F.lower("label")
    short = F.element_at(F.split(low, r" \("), 1)
    asked = F.explode(F.array(*[F.lit(n) for n in names]))
    exact = F.coalesce((low == q) | (short == q), F.lit(False))
    labels = lambda c: F.array_sort(F.collect_set(c))
    hits = (
        regions.select("label", asked.alias("query"))
        .where(F.contains(low, q) & (q != ""))
        .withColumn("_exact", exact)
        .groupBy("query")
        .agg(
            F.count_if("_exact").alias("n_exact"),
            F.count("label").alias("n"),
            F.min(F.when(F.col("_exact"), F.col("label"))).alias("l_exact"),
            F.min("label").alias("l_any"),
            labels(F.when(F.col("_exact"), F.col("label"))).alias("m_exact"),
            labels("label").alias("m_any"),
        )
    )
    queries = regions.sparkSession.createDataFrame([(n,) for n in names], "query string")
    some_exact = F.col("n_exact") > 0
    return queries.join(hits, "query", "left").select(
        "query",
        F.when(F.col("n_exact") == 1, "exact")
        .when(F.col("n") == 1, "partial")
        .when(F.col("n").isNull(), "none")
        .otherwise("ambiguous")
        .alias("status"),
        F.when(F.col("n_exact") == 1, F.col("l_exact")).when(F.col("n") == 1, F.col("l_any")).alias("label"),
        F.slice(F.when(some_exact, F.col("m_exact")).otherwise(F.col("m_any")), 1, 10).alias("matches"),
    )


def select_admin(regions: DataFrame, name: str) -> DataFrame:
    """The one region that ``name`` means; an error lists up to ten candidates."""
    found = match_admin(regions, [name]).head()
    if found["status"] in ("exact", "partial"):
        return regions.where(F.col("label") == found["label"])
    raise ValueError(f"region {name!r} is {found['status']}: {', '.join(found['matches'] or [])}")


def region_by_key(regions: DataFrame, key: str) -> DataFrame:
    return regions.where(F.col("key") == key)
