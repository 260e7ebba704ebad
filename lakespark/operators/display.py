"""Display limits, contrast stretch and hover buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.operators.dedupe import even_sample
from lakespark.operators.quantiles import summarize

HOVER_CELL = 0.02


def display_limits(df: DataFrame, metric: str, keys: Sequence[str] = ()) -> DataFrame:
    """Colour range of a metric: 2nd to 98th percentile, with the small-sample rules."""
    keys = list(keys)
    value = F.col(metric).cast("double")
    shown = F.when(value > 0, value) if metric == "CI_cyano" else value
    out = summarize(
        df,
        keys,
        {"v": shown},
        {"p02": ("v", 0.02), "p98": ("v", 0.98)},
        [F.count(shown).alias("n"), F.min(shown).alias("v_min"), F.max(shown).alias("v_max")],
    )
    empty = F.coalesce("n", F.lit(0)) == 0
    narrow = (F.col("n") <= 20) | (F.col("p98") <= F.col("p02"))
    lo = F.when(narrow, F.col("v_min")).otherwise(F.col("p02"))
    hi = F.when(narrow, F.col("v_max")).otherwise(F.col("p98"))
    return out.select(
        *keys,
        F.when(empty, 0.0).otherwise(lo).alias("lo"),
        F.when(empty, 1.0).when(hi <= lo, lo + 1e-6).otherwise(hi).alias("hi"),
    )


def robust_limits(
    df: DataFrame, metric: str, default: tuple[float, float], keys: Sequence[str] = ()
) -> DataFrame:
    """2nd to 98th percentile, or the default pair when empty or constant."""
    keys = list(keys)
    spread = summarize(
        df, keys, {"v": F.col(metric)}, {"p02": ("v", 0.02), "p98": ("v", 0.98)}
    )
    usable = F.col("p02").isNotNull() & (F.col("p02") != F.col("p98"))
    return spread.select(
        *keys,
        F.when(usable, F.col("p02")).otherwise(default[0]).alias("lo"),
        F.when(usable, F.col("p98")).otherwise(default[1]).alias("hi"),
    )


# Percentile pair, default range, exponent, and whether a band's
# sample is limited to pixels in which all three bands are present.
STRETCHES = {
    "map": ((0.02, 0.98), None, 0.85, False),
    "raster": ((0.01, 0.995), (0.0, 0.15), 0.82, True),
    "swath": ((0.01, 0.99), (0.0, 0.12), 0.8, True),
}


def stretch_limits(
    df: DataFrame, bands: Sequence[str], style: str = "map", keys: Sequence[str] = ()
) -> DataFrame:
    """``{band}_lo`` and ``{band}_hi`` per group."""
    (p_lo, p_hi), default, _, together = STRETCHES[style]
    complete = reduce(and_, [F.col(b).isNotNull() for b in bands])
    metrics = {b: F.when(complete, F.col(b)) if together else F.col(b) for b in bands}
    asked = {}
    for b in bands:
        asked[f"{b}_lo"] = (b, p_lo)
        asked[f"{b}_hi"] = (b, p_hi)
    keys = list(keys)
    limits = summarize(df, keys, metrics, asked)
    if default is None:
        return limits
    fixed = {}
    for b in bands:
        usable = F.col(f"{b}_hi") > F.col(f"{b}_lo")
        fixed[f"{b}_lo"] = F.when(usable, F.col(f"{b}_lo")).otherwise(default[0])
        fixed[f"{b}_hi"] = F.when(usable, F.col(f"{b}_hi")).otherwise(default[1])
    return limits.withColumns(fixed)


def stretch(value: Column, lo: Column, hi: Column, gamma: float) -> Column:
    """Value clipped to its range, scaled to 0..1 and raised to ``gamma``."""
    scaled = (value.cast("double") - lo) / F.greatest(hi - lo, F.lit(1e-8))
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled))
    return F.when(value.isNotNull() & lo.isNotNull(), F.pow(clipped, F.lit(gamma)))


def true_color(
    df: DataFrame, bands: Sequence[str], style: str = "map", keys: Sequence[str] = ()
) -> DataFrame:
    """Stretched red, green and blue plus ``alpha`` (255 where all three bands exist)."""
    gamma = STRETCHES[style][2]
    limits = stretch_limits(df, bands, style, keys)
    if keys:
        joined = df.join(limits, list(keys))
    else:
        one = F.lit(1).alias("_one")
        joined = df.select("*", one).join(limits.select("*", one), "_one").drop("_one")
    channels = {
        out: stretch(F.col(b), F.col(f"{b}_lo"), F.col(f"{b}_hi"), gamma)
        for out, b in zip(("red", "green", "blue"), bands)
    }
    complete = reduce(and_, [F.col(b).isNotNull() for b in bands])
    drop = [f"{b}_{end}" for b in bands for end in ("lo", "hi")]
    return joined.withColumns(
        {**channels, "alpha": F.when(complete, 255).otherwise(0)}
    ).drop(*drop)


def hover_points(
    df: DataFrame, values: Sequence[str], cell: float = HOVER_CELL, max_points: int | None = None
) -> DataFrame:
    """Points with their bucket indices and six-decimal coordinates; all, or an even sample of ``max_points``."""
    sampled = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if max_points is not None:
        sampled = even_sample(sampled, max_points)
    return sampled.select(
        "scene_id",
        F.floor(F.col("longitude").cast("double") / cell).cast("long").alias("bx"),
        F.floor(F.col("latitude").cast("double") / cell).cast("long").alias("by"),
        F.round(F.col("latitude").cast("double"), 6).alias("lat6"),
        F.round(F.col("longitude").cast("double"), 6).alias("lon6"),
        "Hylak_id",
        "obs_id",
        *values,
    )


def spatial_buckets(
    df: DataFrame, values: Sequence[str], cell: float = HOVER_CELL, max_points: int | None = None
) -> DataFrame:
    """Points of each scene and bucket as one sorted array.

    An array holds the pixels of ``cell`` degrees squared, which the resolution of the swath bounds.
    """
    points = hover_points(df, values, cell, max_points)
    record = F.struct("obs_id", "lat6", "lon6", "Hylak_id", *values)
    return points.groupBy("scene_id", "bx", "by").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(record)).alias("points")
    )
