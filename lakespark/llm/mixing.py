"""Mixing sources to target weights, with DataFrame functions only.

Each source is a stream of its documents in a permuted order, repeated, of which it gives as many words as
its target says. These are cut into blocks of equally many words, of which the last may be short, so a source's
words come out whole whatever the size of a block; its quota is the number of its blocks. A binary tree over the output shards
splits the quotas: what the left half of a node's shards gets of each source is a
multivariate hypergeometric draw, so every shard receives exact whole numbers that add up to the
quotas. A shard then takes its own run of each source's permuted blocks, and shuffles them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakespark.session import settle

#: Weights of the sources in order, repeating; share of all words that the mix holds; most repeats.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SHARDS = 16
#: The corpus has this many blocks, of at least a word each.
BLOCKS = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def order_key() -> Column:
    """Place of a row (doc_id, text) in the permuted order, 0 to 2^60."""
    name = F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and the permutation key ``at`` (0 to 2^60) of every row.

    The key is taken from a digest of id and text, so it does not depend on partitions. A null text has size 0.
    """
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), order_key().alias("at"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, target and nth (order by code point, null last) of every source.

    Sources share ``share`` of all words by weight. A target stops at ``repeats`` times the
    source's words, and the excess goes to the others by weight until none is above. The rows are one
    for each source; only these are ordered together.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = total.withColumn("nth", F.row_number().over(by_name) - 1)
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod("nth", F.lit(len(weights))))
    capped = ranked.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(repeats)).withColumn("full_at", F.col("cap") / F.col("w"))
    # the level at which a source is full rises along this order; those before are full
    along = Window.orderBy("full_at", "nth")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("full_at", "nth").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    # the first source that is not full sets the level for all that follow
    tried = capped.withColumn("level", level)
    held = tried.withColumn("last", F.first(F.when(F.col("full_at") > F.col("level"), F.col("level")), ignorenulls=True).over(everything))
    target = F.least("cap", F.coalesce(F.col("last") * F.col("w"), F.col("cap")))
    return held.select("source", "source_size", target.alias("target"), "nth")


def _log_factorial(n: Column) -> Column:
    """ln n! by the product for small n and Stirling's series beyond."""
    x = n + 1.0
    shifted = F.log(x) + F.log(x + 1) + F.log(x + 2) + F.log(x + 3) + F.log(x + 4)
    y = x + 5
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) - shifted


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """How many of ``marked`` among ``total`` are in ``drawn`` draws: the quantile of ``u`` in (0, 1).

    The distribution is summed over the values within eight standard deviations of the mean.
    """
    share = marked / F.greatest(total, F.lit(1.0))
    spread = 8 * F.sqrt(drawn * share * (1 - share) + 1) + 8
    low = F.greatest(F.lit(0.0), drawn - (total - marked), F.floor(drawn * share - spread).cast("double"))
    high = F.least(marked, drawn, F.ceil(drawn * share + spread).cast("double"))
    mode = F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("double")

    def log_weight(x: Column, of: Column) -> Column:
        parts = (x, of["marked"] - x, of["drawn"] - x, of["total"] - of["marked"] - of["drawn"] + x)
        return -sum((_log_factorial(n) for n in parts[1:]), _log_factorial(parts[0]))

    def quantile(of: Column, weights: Column, goal: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), of["low"].alias("x"))
        step = lambda s, w: F.struct((s["sum"] + w).alias("sum"), (s["x"] + F.when(s["sum"] + w < goal, 1.0).otherwise(0.0)).alias("x"))
        return F.least(of["high"], F.aggregate(weights, start, step)["x"])

    def search(of: Column, peak: Column) -> Column:
        span = F.sequence(of["low"].cast("long"), of["high"].cast("long"))
        weighed = F.transform(span, lambda x: F.exp(log_weight(x.cast("double"), of) - peak))
        return _let(weighed, lambda ws: _let(of["u"] * F.aggregate(ws, F.lit(0.0), lambda s, w: s + w), lambda goal: quantile(of, ws, goal)))

    of = F.struct(u.alias("u"), total.alias("total"), marked.alias("marked"), drawn.alias("drawn"), low.alias("low"), high.alias("high"), mode.alias("mode"))
    return _let(of, lambda o: _let(log_weight(F.greatest(o["low"], F.least(o["high"], o["mode"])), o), lambda peak: search(o, peak)))


def _uniform(*of) -> Column:
    return (F.pmod(F.xxhash64(*of), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = 1) -> DataFrame:
    """source, shard, first and count: the run of each source's blocks that each shard draws.

    ``quotas``: (source, nth, quota). The tree starts as one node with the quotas of all sources as an array
    and splits each node's shards in halves until each has one. A node splits in one row, source by source,
    each conditional on what the sources before it left.
    """
    ordered = F.array_sort(F.collect_list(F.struct("nth", "quota")))
    nodes = quotas.groupBy().agg(F.transform(ordered, lambda q: q["quota"].cast("double")).alias("have")).select(F.lit(0).alias("first_shard"), F.lit(shards).alias("width"), "have")
    widest = shards
    while widest > 1:
        half = (F.col("width") / 2).cast("int")
        all_blocks = F.aggregate("have", F.lit(0.0), lambda s, x: s + x)
        # blocks go to shards in equal numbers; the remainder to the first ones
        want = F.floor(all_blocks * half / F.col("width")).cast("double")
        start = F.struct(all_blocks.alias("left"), want.alias("want"), F.lit(0).alias("i"), F.array().cast("array<double>").alias("got"))

        def draw(s: Column, marked: Column) -> Column:
            x = hypergeometric(_uniform(F.col("first_shard"), F.col("width"), s["i"], F.lit(seed)), s["left"], marked, s["want"])
            return _let(x, lambda v: F.struct((s["left"] - marked).alias("left"), (s["want"] - v).alias("want"), (s["i"] + 1).alias("i"), F.concat(s["got"], F.array(v)).alias("got")))

        split = nodes.withColumn("left_part", F.when(half > 0, F.aggregate("have", start, draw)["got"]))
        sides = F.when(
            half > 0,
            F.array(
                F.struct(F.col("first_shard"), half.alias("width"), F.col("left_part").alias("have")),
                F.struct((F.col("first_shard") + half).alias("first_shard"), (F.col("width") - half).alias("width"), F.zip_with("have", "left_part", lambda a, b: a - b).alias("have")),
            ),
        ).otherwise(F.array(F.struct("first_shard", "width", "have")))
        nodes = settle(split.select(F.explode(sides).alias("n")).select("n.*"))
        widest -= widest // 2
    counts = nodes.select(F.col("first_shard").alias("shard"), F.posexplode("have").alias("nth", "blocks"))
    run = Window.partitionBy("nth").orderBy("shard")
    runs = counts.select("nth", "shard", F.col("blocks").cast("long").alias("count"), (F.sum("blocks").over(run) - F.col("blocks")).cast("long").alias("first"))
    return runs.join(quotas.select("nth", "source"), "nth").select("source", "nth", "shard", "first", "count")


def _streams(sized: DataFrame, parts: int) -> DataFrame:
    """Each row with ``start``: the words of its source that stand before it in the permuted order.

    The order is cut into ``parts`` ranges of the key, so that no source is summed in one task:
    running sums within a range of a source, plus the sums of the ranges before.
    """
    ranged = sized.withColumn("part", F.floor(F.col("at") / (float(1 << 60) / parts)).cast("long"))
    inside = Window.partitionBy("source", "part").orderBy("at", "doc_id", "size")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("words")).withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), "base")
    running = ranged.withColumn("inner", F.sum("size").over(inside) - F.col("size"))
    joined = running.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return joined.select(*sized.columns, (F.col("base") + F.col("inner")).alias("start"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, shards: int = SHARDS, seed: int = 1) -> DataFrame:
    """The drawn mixture: one row for each row of ``docs`` (doc_id, text, source).

    Columns: doc_id, source, size (words), source_size, target, ``at`` (the row's place in the permuted order) and ``pieces``, an array of (shard, place,
    from_word, to_word): which words of the document go to which shard, and its random place there.
    The words of a source add up to its target, rounded, at every size of the corpus. A document of more
    than one block may be cut between blocks. Null sources form a source of
    their own, last in order; null and empty texts have size 0 and no pieces. Repeated rows are
    separate documents. An empty table gives no rows. Equal input and seed give equal pieces.
    """
    sized = settle(sizes(docs))
    of_source = settle(targets(sized, weights, share, repeats))
    # two scalars: the words of the corpus, and its rows
    whole = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("words"), F.count("*").alias("rows")).first()
    block = max(1, whole["words"] // BLOCKS)
    parts = max(1, int(whole["rows"] ** 0.5))
    quotas = settle(
        of_source.select(
            "source", "nth", "source_size", "target",
            F.round("target").cast("long").alias("drawn"),
            F.ceil(F.round("target") / block).cast("long").alias("quota"),
        )
    )
    runs = settle(split_quotas(quotas, shards, seed))
    drawn = runs.groupBy("nth").agg(F.array_sort(F.collect_list(F.struct("first", "count", "shard"))).alias("runs"))
    plan = settle(quotas.join(drawn, "nth").withColumnRenamed("source", "s"))
    streams = _streams(sized, parts)
    # a row for each source: small while a source holds many documents, which the count shows
    small = plan.count() <= 10_000
    placed = streams.join(F.broadcast(plan) if small else plan, F.col("source").eqNullSafe(F.col("s")))

    # blocks follow each other over the rounds of the source, so one may end a round and begin the next; the last
    # ends with the words to draw
    end = F.col("start") + F.col("size")
    rounds = F.sequence(F.lit(0), F.lit(repeats - 1))

    def of_round(e: Column) -> Column:
        lead = e * F.col("source_size")

        def of_run(r: Column) -> Column:
            lo = F.greatest(r["first"] * block - lead, F.col("start"))
            hi = F.least(F.least((r["first"] + r["count"]) * block, F.col("drawn")) - lead, end)
            place = F.xxhash64(F.col("at"), e, r["shard"], F.lit(seed))
            return F.struct(r["shard"].alias("shard"), place.alias("place"), (lo - F.col("start")).alias("from_word"), (hi - F.col("start")).alias("to_word"))

        return F.filter(F.transform("runs", of_run), lambda p: p["from_word"] < p["to_word"])

    pieces = F.when(F.col("size") > 0, F.flatten(F.transform(rounds, of_round))).otherwise(F.array())
    return placed.select("doc_id", "source", "size", "source_size", "target", pieces.alias("pieces"), "at")


def taken(mixed: DataFrame) -> Column:
    """Words of the document that the mix takes, repeats counted."""
    return F.aggregate(mixed["pieces"], F.lit(0).cast("long"), lambda s, p: s + p["to_word"] - p["from_word"])


def with_rows(mixed: DataFrame, docs: DataFrame) -> DataFrame:
    """``mixed`` joined to the rows it came from: (row, size, source_size, target, pieces), with ``row`` all columns of the document.

    Rows that agree in doc_id, text and source are told apart by number.
    """
    key = ["doc_id", "at", "source"]
    numbered = F.row_number().over(Window.partitionBy(*key).orderBy("at"))
    left = docs.select("doc_id", order_key().alias("at"), "source", F.struct(*docs.columns).alias("row")).withColumn("nth", numbered)
    right = mixed.withColumn("nth", numbered).withColumnsRenamed({c: f"_{c}" for c in (*key, "nth")})
    match = (F.col("nth") == F.col("_nth")) & (F.col("at") == F.col("_at"))
    for c in ("doc_id", "source"):
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(right, match).select("row", "size", "source_size", "target", "pieces")
