"""Pair metrics of the comparison with an external reference product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.functions.indices import DETECTION_LIMIT, f32, true_or_false
from lakespark.operators.quantiles import (
    DOUBLE_LADDER,
    average_ranks,
    summarize,
)
from lakespark.operators.stats import count_if
from lakespark.session import settle

RATIO_FLOOR = 0.01
BINS = 8
MIN_PER_BIN = 5


def paired(
    df: DataFrame, reference: str, local: str, limit: float = DETECTION_LIMIT
) -> DataFrame:
    """Rows in which both values exceed the limit (compared in float32), as doubles x and y."""
    both = true_or_false((F.col(reference) > f32(limit)) & (F.col(local) > f32(limit)))
    return df.where(both).withColumns(
        {"x": F.col(reference).cast("double"), "y": F.col(local).cast("double")}
    )


def pair_coverage(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts along the way from cells inside a lake to usable pairs.

    Takes the audit columns of `nearest.compare_native_first`.
    """
    found = F.col("local_match_found")
    return cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("obpg_grid_cells_inside_lake"),
        count_if(F.col("obpg_science_valid")).alias("obpg_science_valid_cells"),
        count_if(F.col("obpg_detected_gt_0_0001")).alias("obpg_detection_cells_gt_0_0001"),
        count_if(found).alias("local_nearest_same_lake_matches"),
        count_if(found & F.col("nearest_primary_bloom_aware_valid")).alias("nearest_primary_valid"),
        count_if(found & F.col("nearest_selected_QA_valid")).alias("nearest_selected_QA_valid"),
        count_if(found & F.col("nearest_CLDICE")).alias("nearest_CLDICE_pixels"),
        count_if(found & F.col("nearest_bloom_rescued")).alias("nearest_bloom_rescued_pixels"),
        count_if(F.col("local_ci_cyano_detected")).alias("local_detection_matches_gt_0_0001"),
        count_if(F.col("paired_above_0_0001_for_correlation")).alias("paired_detection_pixels"),
    )


def _correlation(x: str, y: str, guard: Column) -> Column:
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(guard, r)


def pair_metrics(pairs: DataFrame, keys: Sequence[str] = (), full: bool = False) -> DataFrame:
    """Agreement of x and y per group; ``full`` adds the regression and ratio block."""
    keys = list(keys)
    # ranks and medians read the pairs several times; the way they were made is long
    pairs = settle(pairs.select(*keys, "x", "y"))
    ranked = average_ranks(average_ranks(pairs, keys, "x", "rx"), keys, "y", "ry")
    d = F.col("y") - F.col("x")
    varied = (F.count(F.lit(1)) >= 2) & (F.stddev_pop("x") > 0) & (F.stddev_pop("y") > 0)
    high = F.col("x") >= RATIO_FLOOR
    extra = []
    if full:
        extra = [
            F.when(varied, F.regr_slope("y", "x")).alias("linear_slope"),
            F.when(varied, F.regr_intercept("y", "x")).alias("linear_intercept"),
            F.avg(F.when(high, d)).alias("mean_bias_obpg_ge_0_01"),
        ]
    aggs = [
        F.count(F.lit(1)).alias("paired_above_detection_limit_pixels"),
        _correlation("x", "y", varied).alias("pearson_r"),
        _correlation("rx", "ry", varied).alias("spearman_rho"),
        F.avg(d).alias("mean_bias_local_minus_obpg"),
        F.avg(F.abs(d)).alias("mae"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        *extra,
    ]
    if not full:
        return ranked.groupBy(*keys).agg(*aggs)
    ratio = F.col("y") / F.col("x")
    asked = {
        "median_local_over_obpg": ("ratio", 0.5),
        "median_ratio_obpg_ge_0_01": ("ratio_high", 0.5),
    }
    metrics = {"ratio": ratio, "ratio_high": F.when(high, ratio)}
    return summarize(ranked, keys, metrics, asked, aggs, DOUBLE_LADDER)


def binned_medians(
    pairs: DataFrame, keys: Sequence[str] = (), limit: float = DETECTION_LIMIT, bins: int = BINS
) -> DataFrame:
    """Median x and y in geometric bins of x; bins with fewer than five pairs are dropped."""
    keys = list(keys)
    one = [] if keys else [F.lit(1).alias("_all")]
    scope = keys or ["_all"]
    data = settle(pairs.select(*keys, "x", "y")).select("*", *one)
    span = data.groupBy(*scope).agg(
        F.greatest(F.min("x"), F.lit(limit)).alias("x_min"), F.max("x").alias("x_max")
    )
    step = (F.ln("x_max") - F.ln("x_min")) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        inner = F.exp(F.ln(F.col("x_min")) + i.cast("double") * step)
        return (
            F.when(i == 0, F.col("x_min"))
            .when(i == bins, F.col("x_max") * F.lit(1.000001))
            .otherwise(inner)
        )

    edges = F.transform(F.sequence(F.lit(0), F.lit(bins)), edge)
    # at most `bins` + 1 edges travel with a group; the bin is where x falls among them
    binned = (
        data.join(span.where(F.col("x_max") > F.col("x_min")).withColumn("edges", edges), scope)
        .withColumn("bin", F.size(F.filter("edges", lambda e: e <= F.col("x"))) - 1)
        .where((F.col("bin") >= 0) & (F.col("bin") < bins))
    )
    per = [*scope, "bin"]
    medians = summarize(
        binned,
        per,
        {"x": F.col("x"), "y": F.col("y")},
        {"median_x": ("x", 0.5), "median_y": ("y", 0.5)},
        [F.count(F.lit(1)).alias("n")],
    )
    return medians.where(F.col("n") >= MIN_PER_BIN).select(
        *keys, "bin", "n", "median_x", "median_y"
    )
