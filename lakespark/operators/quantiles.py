"""Exact grouped quantiles and average ranks for groups of any size.

The values of a group of at most ``WHOLE`` rows meet in one row and are sorted there. Larger groups take
two passes over their rows. The first counts values in a fixed set of buckets (logarithmic, sign-aware,
monotone), which combine inside each task: a few hundred rows for each group, however large. The buckets that hold a
requested rank, one small row for each group, then meet the rows again, and only values in those buckets are counted one
by one. A float32 bucket of 1/8 octave holds at most 2**20 distinct values; float64 columns are
narrowed twice more before values are counted.

Quantiles interpolate linearly between order statistics. NULL and NaN are no values;
infinite values are ordered like any other; a NULL key is a group of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakespark.session import settle

# Buckets per octave at each narrowing.
FLOAT_LADDER = (1 << 3,)
DOUBLE_LADDER = (1 << 3, 1 << 20, 1 << 37)
_OCTAVES = 1100  # more than the exponent range of float64 on either side of 1
# Largest group, in rows, whose values meet in one row.
WHOLE = 1 << 15

Wanted = Mapping[str, tuple[str, float]]


def bucket(value: Column, per_octave: int) -> Column:
    """Monotone integer bucket of a double; infinite values have buckets of their own, NULL has none."""
    beyond = F.lit(2 * per_octave * _OCTAVES).cast("long")
    infinite = F.abs(value) == F.lit(float("inf"))
    finite = F.when(infinite, F.lit(1.0)).otherwise(F.abs(value))
    magnitude = F.floor(F.log2(finite) * F.lit(float(per_octave))).cast("long")
    shifted = F.when(infinite, beyond).otherwise(magnitude + F.lit(per_octave * _OCTAVES).cast("long"))
    return F.when(value > 0, shifted).when(value < 0, -shifted).when(value == 0, F.lit(0).cast("long"))


def _before(count: str, partition: Sequence[str], order: str) -> Column:
    """How many values precede this row's values in its partition."""
    w = Window.partitionBy(*partition).orderBy(order)
    return F.sum(count).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col(count)


def _ranks(p: float, n: str = "n") -> tuple[str, str, str]:
    """Lower rank, upper rank and fraction of the quantile ``p`` of ``n`` values, as SQL."""
    at = f"({float(p)!r}D * ({n} - 1))"
    lo = f"cast(floor({at}) as bigint)"
    return lo, f"least({lo} + 1, {n} - 1)", f"({at} - floor({at}))"


def _covers(rank_lo: str, rank_hi: str) -> str:
    return f"({rank_hi} >= before and {rank_lo} < before + c)"


def _asked(wanted: Wanted, number: Mapping[str, int]) -> Column:
    """Does this bucket or value hold any requested rank of its metric ``m``?"""
    tests = [f"(m = {number[m]} and {_covers(*_ranks(p)[:2])})" for m, p in sorted(set(wanted.values()))]
    return F.expr(" or ".join(tests) or "false")


def _join_groups(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet NULL keys; ``on`` stays as it is in ``left``."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    return left.join(other, match, how).drop(*[f"_r_{k}" for k in on])


def _values(metrics: Mapping[str, Column]) -> dict[str, Column]:
    """A column for each metric: NULL where there is no value."""

    def usable(c: Column) -> Column:
        v = c.cast("double") + F.lit(0.0)
        return F.when(~F.isnan(v), v)

    return {f"_v{k}": usable(c) for k, c in enumerate(metrics.values())}


def _quantiles(rows: DataFrame, keys: list[str], metrics: Mapping[str, Column], wanted: Wanted, ladder: Sequence[int]) -> DataFrame:
    """One row for each group that has values, with a column for each entry of ``wanted``, from a stored table with `_values`."""
    number = {m: k for k, m in enumerate(metrics)}
    found = None
    for per_octave in ladder:
        codes = _codes(number, per_octave)
        if found is None:
            coded = rows.select(*keys, F.posexplode(codes).alias("m", "b")).where(F.col("b").isNotNull())
            sums = coded.groupBy(*keys, "m", "b").agg(F.count(F.lit(1)).alias("c"))
            # the buckets of a group meet in one task: a bounded number of rows
            sums = sums.repartition(*keys)
            placed = sums.withColumn("before", _before("c", [*keys, "m"], "b")).withColumn("n", F.sum("c").over(Window.partitionBy(*keys, "m")))
        else:
            coded = _inside(rows, found, keys, number, coarser).withColumn("b", bucket(F.col("v"), per_octave))
            sums = coded.groupBy(*keys, "m", "outer", "b").agg(F.count(F.lit(1)).alias("c"), F.min("base").alias("base"), F.min("n").alias("n"))
            placed = sums.repartition(*keys).withColumn("before", F.col("base") + _before("c", [*keys, "m", "outer"], "b"))
        target = F.struct("m", "b", F.col("before").alias("base"), "n")
        # at most two buckets for each requested quantile; as a table its size is known, which decides whether it is broadcast
        found = settle(placed.where(_asked(wanted, number)).groupBy(*keys).agg(F.collect_list(target).alias("_t")))
        coarser = per_octave
    counted = (
        _inside(rows, found, keys, number, coarser)
        .groupBy(*keys, "m", "outer", "v")
        .agg(F.count(F.lit(1)).alias("c"), F.min("base").alias("base"), F.min("n").alias("n"))
        .repartition(*keys)
        .withColumn("before", F.col("base") + _before("c", [*keys, "m", "outer"], "v"))
        .where(_asked(wanted, number))
    )
    answers = []
    for k, (metric, p) in enumerate(wanted.values()):
        lo, hi, t = _ranks(p)
        mine = f"m = {number[metric]}"
        answers += [f"max(case when {mine} and {_covers(x, x)} then v end) as {n}{k}" for n, x in (("lo", lo), ("hi", hi))]
        answers.append(f"max(case when {mine} then {t} end) as t{k}")
    picked = counted.groupBy(*keys).agg(*map(F.expr, answers))
    return picked.select(*keys, *(F.expr(_interpolated(f"lo{k}", f"hi{k}", f"t{k}")).alias(out) for k, out in enumerate(wanted)))


def _interpolated(lo: str, hi: str, t: str) -> str:
    return f"case when {t} = 0 or {lo} = {hi} then {lo} else {lo} + ({hi} - {lo}) * {t} end"


def _whole(rows: DataFrame, keys: list[str], metrics: Mapping[str, Column], wanted: Wanted, aggs: Sequence[Column]) -> DataFrame:
    """One row for each group, with ``aggs`` and a column for each entry of ``wanted``; a group's values are held in one row."""
    number = {m: k for k, m in enumerate(metrics)}
    lists = [F.collect_list(f"_v{k}").alias(f"_s{k}") for k in number.values()]
    held = rows.groupBy(*keys).agg(*aggs, *lists)
    held = held.withColumns({f"_s{k}": F.sort_array(f"_s{k}") for k in number.values()})
    held = held.withColumns({f"_c{k}": F.size(f"_s{k}") for k in number.values()})
    found = {}
    for out, (metric, p) in wanted.items():
        k = number[metric]
        lo, hi, t = _ranks(p, f"_c{k}")
        found[out] = F.expr(_interpolated(f"get(_s{k}, cast({lo} as int))", f"get(_s{k}, cast({hi} as int))", t))
    names = [c for c in held.columns if c not in {f"_{x}{k}" for x in "sc" for k in number.values()}]
    return held.select(*names, *(c.alias(out) for out, c in found.items()))


def _codes(number: Mapping[str, int], per_octave: int) -> Column:
    return F.array(*(bucket(F.col(f"_v{k}"), per_octave) for k in number.values()))


def _inside(rows: DataFrame, found: DataFrame, keys: Sequence[str], number: Mapping[str, int], per_octave: int) -> DataFrame:
    """Values (m, v) of the rows that lie in one of the buckets ``_t`` of their group, with that bucket as ``outer``, base and n."""
    coded = rows.select(*keys, F.array(*(f"_v{k}" for k in number.values())).alias("_v"), _codes(number, per_octave).alias("_b"))
    met = _join_groups(coded, found, keys)
    hits = F.filter("_t", lambda t: F.get("_b", t["m"]) == t["b"])
    one = met.select(*keys, "_v", F.explode(hits).alias("_h"))
    return one.select(*keys, "_h.m", F.get("_v", F.col("_h.m")).alias("v"), F.col("_h.b").alias("outer"), "_h.base", "_h.n")


def summarize(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, Column],
    wanted: Wanted,
    aggs: Sequence[Column] = (),
    ladder: Sequence[int] = FLOAT_LADDER,
    uses: Sequence[str] | None = None,
) -> DataFrame:
    """One row per group: ordinary aggregates plus exact quantiles.

    ``metrics`` maps a metric to its value column (NULL where a row does not
    count); ``wanted`` maps an output column to (metric, probability). A group
    without values of a metric gets NULL. What both passes read is written to a table once: the keys and
    values or, if ``uses`` names the columns that metrics and ``aggs`` need, those, so that ``df`` is read only once.
    """
    keys, aggs = list(keys), list(aggs)
    if not keys:
        one = summarize(df.withColumn("_all", F.lit(1)), ["_all"], metrics, wanted, aggs, ladder, uses)
        # an empty input still has one (empty) group
        always = df.sparkSession.range(1).select(F.lit(1).alias("_all"))
        return always.join(one, "_all", "left").drop("_all")
    values = [c.alias(n) for n, c in _values(metrics).items()]
    if uses is None:
        rows = settle(df.select(*keys, *values))
        found = _by_size(rows, keys, metrics, wanted, (), ladder)
        return _join_groups(df.groupBy(*keys).agg(*aggs), found, keys, "left") if aggs else found
    rows = settle(df.select(*keys, *(c for c in uses if c not in keys)))
    return _by_size(rows.select("*", *values), keys, metrics, wanted, aggs, ladder)


def _by_size(rows: DataFrame, keys: list[str], metrics: Mapping[str, Column], wanted: Wanted, aggs: Sequence[Column], ladder: Sequence[int]) -> DataFrame:
    """Aggregates and quantiles of each group of a stored table, by the way that fits the group's size."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # one row for each WHOLE rows of the input at most
    large = settle(sizes.where(F.col("_n") > WHOLE).select(*keys))
    if large.isEmpty():
        return _whole(rows, keys, metrics, wanted, aggs)
    small = _whole(_join_groups(rows, F.broadcast(large), keys, "left_anti"), keys, metrics, wanted, aggs)
    wide = _join_groups(rows, F.broadcast(large), keys, "left_semi")
    base = wide.groupBy(*keys).agg(*aggs) if aggs else large
    return small.unionByName(_join_groups(base, _quantiles(wide, keys, metrics, wanted, ladder), keys, "left"))


def average_ranks(
    df: DataFrame, keys: Sequence[str], value: str, rank: str, ladder=FLOAT_LADDER
) -> DataFrame:
    """Add the 1-based average rank of ``value`` within its group (ties share the mean).

    Distinct values are ranked inside their bucket, buckets inside the next larger one, and so on up the
    ladder; no group is ever sorted as a whole.
    """
    keys = list(keys)
    if not keys:
        return average_ranks(
            df.withColumn("_all", F.lit(1)), ["_all"], value, rank, ladder
        ).drop("_all")
    distinct = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    steps = [f"_b{k}" for k in range(len(ladder))]
    distinct = distinct.withColumns({b: bucket(F.col(value).cast("double"), per) for b, per in zip(steps, ladder, strict=True)})
    ranked = distinct.withColumn("_rank", _before("_c", [*keys, *steps], value))
    for depth in range(len(steps)):
        outer, inner = [*keys, *steps[:depth]], [*keys, *steps[: depth + 1]]
        sums = distinct.groupBy(*inner).agg(F.sum("_c").alias("_s"))
        offsets = sums.withColumn("_base", _before("_s", outer, steps[depth])).drop("_s")
        ranked = ranked.join(offsets, inner).withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_base")
    ranked = ranked.select(*keys, value, (F.col("_rank") + (F.col("_c") + 1) / F.lit(2.0)).alias(rank))
    return df.join(ranked, [*keys, value], "left")
