"""Prefix trie of conversations, by hashing blocks of turns.

Conversations are first grouped by what they say up to every ``BLOCK``-th turn. Inside a block whose
continuing members all go on alike, the turns need no grouping: each is a node with the members of the
block. Turn boundaries are compared only inside blocks where siblings diverge, and there among one
representative of each distinct block.

The digest of a prefix is the sum, in three lanes, of a keyed hash of each turn and its place. Sums
can be taken in parts, so no conversation has to be read as a whole by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakespark.session import settle

#: Turns of a block.
BLOCK = 4
LANES = 3
#: Turn numbers, and blocks or nodes of one conversation, that are ordered together: powers of two.
TURN_BITS, CHAIN_BITS = 10, 8
#: Conversation ids that are written as one piece before a list of ids is hashed, as a power of two.
ID_BITS = 12
_NO_TURN = -(1 << 60)
_PAST = (Window.unboundedPreceding, -1)


def _lanes(prefix: str) -> list[str]:
    return [f"{prefix}{k}" for k in range(LANES)]


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id (long), position, digest (SHA-256 of role and text) and bytes (of the text) of every turn.

    Positions count from 0 by turn, null first; turns with one number follow by their digest. Null roles and
    texts are empty. Repeated rows are turns of their own. Rows without conv_id belong to no conversation and are
    left out. A conversation is counted in stretches of turn numbers, so that a very long one is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.shiftright(F.col("turn").cast("long"), TURN_BITS), F.lit(_NO_TURN)).alias("stretch"),
        "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    counts = rows.groupBy("conv_id", "stretch").agg(F.count("*").alias("c"))
    past = F.sum("c").over(Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(*_PAST))
    starts = counts.select("conv_id", "stretch", F.coalesce(past, F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "stretch").orderBy("turn", "digest"))
    return rows.withColumn("nth", nth).join(starts, ["conv_id", "stretch"]).select("conv_id", (F.col("start") + F.col("nth") - 1).alias("position"), "digest", "bytes")


def share_openings(turns: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """Conversations rebuilt so that those of a family may open alike: conv_id, position, digest, bytes.

    Conversation c starts with the first h turns of conversation c - c % family (all if there are fewer), and goes on
    with its own turns after its first h, where h = crc32(decimal c) % (most + 1). The remainder has the sign of c.
    """
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    cut = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).alias("cut")
    known = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    plan = settle(lengths.select("conv_id", base, cut).join(known, "base", "left").select("conv_id", "base", "cut", F.least("cut", F.coalesce("there", F.lit(0))).alias("opening")))
    heads = turns.where(F.col("position") < most).withColumnRenamed("conv_id", "base")
    opening = heads.join(plan, "base").where("position < opening").select("conv_id", "position", "digest", "bytes")
    own = turns.join(plan, "conv_id").where("position >= cut").select("conv_id", (F.col("position") - F.col("cut") + F.col("opening")).alias("position"), "digest", "bytes")
    return opening.union(own)


def _with_past(df: DataFrame, key: str, order: str, values: dict[str, str]) -> DataFrame:
    """For each row the sums of ``values`` (result: column) over the rows of its key before it.

    Sums of stretches of the order first, then inside a stretch: no key is ordered as a whole. The order must be
    unique within a key and about dense.
    """
    rows = df.withColumn("_s", F.shiftright(order, CHAIN_BITS))
    parts = rows.groupBy(key, "_s").agg(*(F.sum(c).alias(f"_{o}") for o, c in values.items()))
    along = Window.partitionBy(key).orderBy("_s").rowsBetween(*_PAST)
    starts = parts.select(key, "_s", *(F.coalesce(F.sum(f"_{o}").over(along), F.lit(0)).alias(f"_{o}") for o in values))
    inside = Window.partitionBy(key, "_s").orderBy(order).rowsBetween(*_PAST)
    near = rows.withColumns({o: F.coalesce(F.sum(c).over(inside), F.lit(0)) for o, c in values.items()})
    joined = near.join(starts, [key, "_s"])
    return joined.select(*df.columns, *((F.col(o) + F.col(f"_{o}")).alias(o) for o in values))


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each node (depth, lanes).

    Ids are sorted and written in pieces of neighbouring ids; a hash reads the pieces of its node one after the other, and
    keeps nothing of them.
    """
    key = ["depth", *_lanes("q")]
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*key, F.shiftright("conv_id", ID_BITS).alias("nth")).agg(piece.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*key, "ids")), strict=True):
                if node != at:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _rows(done)
        if at is not None:
            yield _rows([(*at, state.hexdigest())])

    def _rows(done):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*key, "ends_sha256"])

    dealt = pieces.repartition(*key).sortWithinPartitions(*key, "nth").select(*key, "ids")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in key) + ", ends_sha256 string")


def _nodes(turns: DataFrame, chains: DataFrame) -> DataFrame:
    """Nodes below the root: conv_id (smallest member), depth, bytes, n_convs, lanes r of the node and p of its parent.

    ``chains``: the blocks of all conversations with the lanes before (p) and after (q) them.
    """
    p, q, r, g = (_lanes(c) for c in "pqrg")
    children = settle(chains.groupBy("block", "k", *p, *q).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")))
    siblings = children.groupBy("block", *p).agg((F.count("*") > 1).alias("diverge"))
    marked = children.join(siblings, ["block", *p]).select("conv_id", "block", "n_convs", "diverge", *p)
    shown = turns.join(marked, ["conv_id", "block"])
    inside = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(*_PAST)
    before = {c: F.col(c) + F.coalesce(F.sum(x).over(inside), F.lit(0)) for c, x in zip(p, g, strict=True)}
    each = shown.withColumns(before).withColumns({c: F.col(a) + F.col(x) for c, a, x in zip(r, p, g, strict=True)})
    key = [(F.col("position") + 1).alias("depth"), "bytes", *p, *r]
    each = settle(each.select("conv_id", "n_convs", "diverge", *key))
    names = ["depth", "bytes", *p, *r]
    together = each.where("diverge").groupBy(*names).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    return each.where("not diverge").select("conv_id", "n_convs", *names).unionByName(together)


def _totals(chain: DataFrame) -> DataFrame:
    """Sums over all descendants of each row of (conv_id, up, leaves, saved), by doubling the jumps upwards."""
    rows = settle(chain)
    while not rows.where(F.col("up").isNotNull()).isEmpty():
        below = rows.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        hop = rows.where(F.col("up").isNotNull()).select(F.col("conv_id").alias("up"), F.col("up").alias("next"))
        rows = settle(
            rows.join(below, "conv_id", "left")
            .join(hop, "up", "left")
            .select("conv_id", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
        )
    return rows.select("conv_id", "leaves", "saved")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each node of the trie of the conversations ``ids`` (conv_id) with ``turns`` (see ``numbered``).

    A node is a distinct sequence of first turns, the root (depth 0) the empty one. conv_id, its smallest member, and depth
    name it. parent_conv_id (null at the root), n_convs, n_children, n_leaves (childless nodes of its subtree, itself
    included), saved_tokens (over its subtree, bytes of a node's turn times members after the first) and ends_sha256 (of
    the ids that end here) follow. Conversations without turns end at the root. Without conversations there is no row.

    A conversation owns the nodes of which it is the smallest member: one chain, hung below the chain of a smaller
    conversation. Subtree sums are taken over this much smaller tree of chains, in as many rounds as the logarithm of its height.
    """
    p, q, r, g = (_lanes(c) for c in "pqrg")
    block = F.floor(F.col("position") / BLOCK).alias("block")
    hashed = [F.shiftrightunsigned(F.xxhash64(F.lit(k), "digest", F.col("position").cast("long")), 24).alias(c) for k, c in enumerate(g)]
    turns = settle(turns.select("conv_id", "position", block, "bytes", *hashed))
    ids = settle(ids.select("conv_id").where(F.col("conv_id").isNotNull()).distinct())
    blocks = turns.groupBy("conv_id", "block").agg(F.count("*").alias("k"), *(F.sum(c).alias(c) for c in g))
    chains = _with_past(blocks, "conv_id", "block", dict(zip(p, g, strict=True)))
    chains = settle(chains.select("conv_id", "block", "k", *p, *((F.col(a) + F.col(x)).alias(c) for c, a, x in zip(q, p, g, strict=True))))
    last = chains.groupBy("conv_id").agg(F.max(F.struct((F.col("block") * BLOCK + F.col("k")).alias("depth"), *q)).alias("end"))
    zero = lambda c: F.coalesce(F.col(f"end.{c}"), F.lit(0)).cast("long").alias(c)
    ends = _end_digests(ids.join(last, "conv_id", "left").select("conv_id", zero("depth"), *map(zero, q)))

    below = _nodes(turns, chains)
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select("*", *(F.lit(0).cast("long").alias(c) for c in ("depth", "bytes", *p, *r)))
    nodes = settle(below.unionByName(root))
    own, up = ["depth", *r], ["depth", *p]
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *(F.col(a).alias(c) for a, c in zip(p, r, strict=True))).agg(F.count("*").alias("n_children"))
    ends = ends.withColumnsRenamed(dict(zip(q, r, strict=True)))
    nodes = settle(nodes.join(kids, own, "left").join(ends, own, "left").fillna({"n_children": 0, "ends_sha256": hashlib.sha256(b"").hexdigest()}))
    over = nodes.select((F.col("depth") + 1).alias("depth"), *(F.col(a).alias(c) for a, c in zip(r, p, strict=True)), F.col("conv_id").alias("parent_conv_id"))
    value = {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")}
    hung = settle(nodes.where("depth > 0").join(over, up).withColumns(value).drop(*p, *r))

    heads = hung.where("conv_id <> parent_conv_id or depth = 1")
    # what hangs from the root counts for no chain
    above = heads.select("conv_id", F.col("depth").alias("first"), F.when(F.col("depth") > 1, F.col("parent_conv_id")).alias("up"))
    above = settle(above.join(hung.groupBy("conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "conv_id"))
    totals = _totals(above.select("conv_id", "up", "leaves", "saved"))
    attached = (
        above.where(F.col("up").isNotNull())
        .select("conv_id", F.col("up").alias("at"), (F.col("first") - 1).alias("depth"))
        .join(totals, "conv_id")
        .groupBy(F.col("at").alias("conv_id"), "depth")
        .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    )
    chain = hung.join(attached, ["conv_id", "depth"], "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")})
    passed = _with_past(chain, "conv_id", "depth", {"past_leaves": "leaves", "past_saved": "saved"}).drop("leaves", "saved").join(totals, "conv_id")
    inner = passed.withColumns({"n_leaves": F.col("leaves") - F.col("past_leaves"), "saved_tokens": F.col("saved") - F.col("past_saved")})
    whole = nodes.withColumns(value).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    top = nodes.where("depth = 0").join(F.broadcast(whole)).withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(*columns).unionByName(top.select(*columns))
