"""Requested points for spectra."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_POINTS = 20


def clean_points(df: DataFrame, order: str = "pos") -> DataFrame:
    """Trimmed labels, lenient numbers, rows without coordinates dropped, default labels.

    ``order`` numbers the request rows; default labels count the rows that remain.
    """
    kept = df.select(
        order,
        F.trim(F.coalesce(F.col("label").cast("string"), F.lit(""))).alias("label"),
        F.expr("try_cast(latitude as double)").alias("latitude"),
        F.expr("try_cast(longitude as double)").alias("longitude"),
    ).where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    # a request holds at most MAX_POINTS rows, see `point_requests`
    number = F.row_number().over(Window.orderBy(order))
    label = F.when(F.col("label") == "", F.concat(F.lit("P"), number.cast("string")))
    return kept.withColumn("label", label.otherwise(F.col("label")))


def valid_points(df: DataFrame):
    return F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)


def point_requests(df: DataFrame, order: str = "pos") -> DataFrame:
    """Clean request table; an error when empty, longer than 20 or out of range."""
    head = df.where(
        F.expr("try_cast(latitude as double) is not null and try_cast(longitude as double) is not null")
    ).limit(MAX_POINTS + 1)
    n = head.count()
    if n == 0:
        raise ValueError("add at least one point with latitude and longitude")
    if n > MAX_POINTS:
        raise ValueError(f"at most {MAX_POINTS} points")
    points = clean_points(df, order)
    if not points.where(~valid_points(points)).isEmpty():
        raise ValueError("latitude or longitude out of range")
    return points
