"""Near-duplicate documents: min-max hashing finds candidates, whole shingle sets confirm them.

A document is the set of its distinct shingles of ``k`` consecutive words. Every permutation
gives two signature values, the smallest and the largest image of the set, each of which
agrees between two documents with the probability of their similarity. ``BANDS`` bands
of ``BAND_VALUES`` values make the keys under which documents meet. On small sets the smallest and the largest
image are not independent, so those also meet under their first shingles, which misses no pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.llm.common import Words, lists, map_arrow, mix, signed, slices
from lakespark.llm.graph import components
from lakespark.session import settle

#: A pair of similarity s meets in no band with probability (1 - s^6)^40: 5e-6 at 0.8, where both sets are large. For a union of
#: u shingles a smallest and a largest value agree with s (s u - 1)/(u - 1): 7e-6 at 0.8 and 60 shingles.
BANDS, BAND_VALUES = 40, 6
#: Sets of up to so many shingles find each other exactly.
SMALL = 50
PERMUTATIONS = BANDS * BAND_VALUES // 2
#: Sets above ``LONG`` shingles are told apart by ``VALUES`` signature values where too many share keys.
LONG, VALUES = 160, 128
#: Documents and shingles of one confirmation group.
GROUP_ROWS, GROUP_SHINGLES = 48, 2_000_000
#: Documents of one side of a block pair.
BLOCK_ROWS = 96

_FACTORS = (mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer than ``k`` words is one shingle."""
    words = Words(column)
    hashes, at = words.shingles(k)
    bounds = np.searchsorted(at, words.first)
    out = []
    for i in range(len(column)):
        s = hashes[bounds[i] : bounds[i + 1]]
        if len(s) == 0 and words.first[i] < words.first[i + 1]:
            whole = np.uint64(words.first[i + 1] - words.first[i])
            with np.errstate(over="ignore"):
                for h in words.hashes[words.first[i] : words.first[i + 1]]:
                    whole = whole * np.uint64(0x9FB21C651E98DF25) + h
            s = mix(np.array([whole], np.uint64))
        s = np.sort(s)
        if len(s) > 1:
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        out.append(s)
    return out


def signatures(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """Smallest and largest image (documents, 2 * permutations) of each set; no set may be empty."""
    values = np.empty((len(sets), 2 * permutations), np.uint32)
    sizes = np.array([len(s) for s in sets])
    a = 0
    while a < len(sets):
        ends = np.cumsum(sizes[a:])
        b = a + max(1, int(np.searchsorted(ends, 1 << 15, side="right")))
        x = (np.concatenate(sets[a:b]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate(([0], ends[: b - a - 1]))
        image = np.empty_like(x)
        for j in range(permutations):
            np.multiply(x, _FACTORS[j], out=image)
            values[a:b, 2 * j] = np.minimum.reduceat(image, starts)
            values[a:b, 2 * j + 1] = np.maximum.reduceat(image, starts)
        a = b
    return values


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Keys (documents, BANDS) of the min-max signatures; no set may be empty."""
    parts = signatures(sets, PERMUTATIONS).reshape(len(sets), BANDS, BAND_VALUES).astype(np.uint64)
    keys = np.broadcast_to(mix(np.arange(7, 7 + BANDS, dtype=np.uint64)), parts.shape[:2]).copy()
    for j in range(BAND_VALUES):
        keys = mix(keys + parts[:, :, j])
    return keys


def prefix_length(n: int, percent: int) -> int:
    """Of two sets that are linked, so many first shingles (in any one order of all shingles) have one in common."""
    return n + percent * -n // 100 + 1


def first_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the first shingles of a sorted small set."""
    return mix(s[: prefix_length(len(s), percent)] ^ np.uint64(0x5851F42D4C957F2D)) if len(s) <= SMALL else s[:0]


def sketch(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set (two longs) and the keys under which it meets others."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), k)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), dtype=np.int64)
        filled = [s for s in sets if len(s)]
        keys = [np.concatenate(pair) for pair in zip(band_keys(filled), (first_keys(s, percent) for s in filled), strict=True)] if filled else []
        counts = np.zeros(len(sets), np.int64)
        counts[sizes > 0] = [len(x) for x in keys]
        keys = signed(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.array(digests[0::2]), pa.array(digests[1::2]), lists(keys, counts, pa.int64())],
            ["doc_id", "n_shingles", "hi", "lo", "keys"],
        )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, hi long, lo long, keys array<long>"
    return map_arrow(docs.select("doc_id", "text"), run, schema)


def local_links(sets: list[np.ndarray], percent: int, labels: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets of one confirmation group; sets of one label are linked already."""
    n = len(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    new = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
    ids = np.cumsum(new) - 1
    shared = np.bincount(ids) > 1 if len(ids) else np.zeros(0, bool)
    kept = shared[ids] if len(ids) else shared
    rows, ids = rows[kept], (np.cumsum(shared) - 1)[ids[kept]]
    common = np.zeros((n, n))
    for a in range(0, int(ids[-1]) + 1 if len(ids) else 0, 8192):
        lo, hi = np.searchsorted(ids, (a, a + 8192))
        present = np.zeros((n, 8192), np.float32)
        present[rows[lo:hi], ids[lo:hi] - a] = 1
        common += present @ present.T
    sizes = np.array([len(s) for s in sets])
    union = sizes[:, None] + sizes[None, :] - common
    linked = (100 * common >= percent * union) & (common > 0)
    root = np.arange(n) if labels is None else np.unique(labels, return_inverse=True)[1]
    forest = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        if root[i] != root[j]:
            root[root == root[j]] = root[i]
            forest.append((int(i), int(j)))
    return forest


def confirm(groups: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) inside each group (g, h) of rows (g, h, node, of, text), on whole sets.

    Nodes of one component ``of`` are linked already; of the others' links only a spanning forest is returned.

    Groups are bounded by the caller. They reach tasks sorted, so a task holds the sets of one group and
    a slice of texts.
    """

    def links(nodes: list, of: list, sets: list[np.ndarray]) -> pa.RecordBatch | None:
        found = local_links(sets, percent, of) if len(set(of)) > 1 else []
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array([nodes[p[side]] for p in found], pa.int64()) for side in (0, 1)], ["a", "b"])

    def run(batches):
        at, nodes, of, sets = None, [], [], []
        for batch in batches:
            for part in slices(batch):
                keys = zip(part.column("g").to_pylist(), part.column("h").to_pylist(), strict=True)
                for group, node, label, found in zip(keys, *(part.column(c).to_pylist() for c in ("node", "of")), shingle_sets(part.column("text"), k), strict=True):
                    if group != at:
                        if (out := links(nodes, of, sets)) is not None:
                            yield out
                        at, nodes, of, sets = group, [], [], []
                    nodes.append(node)
                    of.append(label)
                    sets.append(found)
        if (out := links(nodes, of, sets)) is not None:
            yield out

    dealt = groups.select("g", "h", "node", "of", "text").repartition("g", "h").sortWithinPartitions("g", "h")
    return dealt.mapInArrow(run, "a long, b long")


def _parts(rows: DataFrame, by: str) -> DataFrame:
    """For each value of ``by`` the number of confirmation groups that its rows (n) make."""
    need = F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(F.sum("n") / GROUP_SHINGLES))
    return rows.groupBy(by).agg(need.cast("long").alias("parts"))


def least_agreement(percent: int) -> int:
    """So many of ``VALUES`` signature values agree at least between linked sets, but for 6.5 standard deviations."""
    p = percent / 100
    return max(1, int(VALUES * p - 6.5 * (VALUES * p * (1 - p)) ** 0.5))


def rare_keys(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, n, of, key): the rarest items of each of ``nodes`` (node, of, text), as many as no linked pair can avoid to share.

    Items of a set of up to ``LONG`` shingles are those, so that nothing is missed; larger sets have the values of a
    signature as items, ``VALUES`` whatever their length. Sets that may meet one of the other sort have both. Rarest are
    items that one component ``of`` has for itself, which lead nowhere, then those of few nodes. Two
    texts that have only a common form in common share none of the rest.
    """
    reach = LONG * 100 // percent

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sets = shingle_sets(batch.column("text"), k)
        picked = [(i, False, s) for i, s in enumerate(sets) if 0 < len(s) <= reach]
        large = [i for i, s in enumerate(sets) if len(s) > LONG]
        if large:
            place = np.arange(1, VALUES + 1, dtype=np.uint64) << np.uint64(32)
            picked += [(i, True, mix(v | place)) for i, v in zip(large, signatures([sets[i] for i in large], VALUES // 2).astype(np.uint64), strict=True)]
        if not picked:
            return None
        counts = np.array([len(items) for _, _, items in picked])
        rows = pa.array(np.repeat([i for i, _, _ in picked], counts))
        columns = [
            batch.column("node").take(rows),
            batch.column("of").take(rows),
            pa.array(np.repeat([len(sets[i]) for i, _, _ in picked], counts)),
            pa.array(np.repeat([sort for _, sort, _ in picked], counts)),
            pa.array(signed(np.concatenate([items for _, _, items in picked]))),
        ]
        return pa.RecordBatch.from_arrays(columns, ["node", "of", "n", "signed", "key"])

    every = settle(map_arrow(nodes.select("node", "of", "text"), run, "node long, of long, n long, signed boolean, key long"))
    shared = every.groupBy("key").agg(F.min("of").alias("least"), F.max("of").alias("most"), F.count("*").alias("c")).where("least < most")
    ordered = every.join(shared.select("key", "c"), "key").groupBy("node", "of", "n", "signed").agg(F.sort_array(F.collect_list(F.struct("c", "key"))).alias("items"))
    own = F.when(F.col("signed"), F.lit(VALUES)).otherwise(F.col("n")) - F.size("items")
    need = F.when(F.col("signed"), F.lit(VALUES - least_agreement(percent) + 1)).otherwise(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    room = F.greatest(need - own, F.lit(0)).cast("int")
    return ordered.select("node", "n", "of", F.explode(F.slice("items", F.lit(1), room)["key"]).alias("key"))


def _once(rows: DataFrame) -> DataFrame:
    """``rows`` (node, n, of, key) with the keys of equal sets of nodes reduced to one."""
    lanes = [F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(i), "node"), 32)).alias(f"s{i}") for i in range(2)]
    sets = rows.groupBy("key").agg(F.count("*").alias("c"), *lanes)
    chosen = sets.groupBy("c", "s0", "s1").agg(F.min("key").alias("key"))
    return rows.join(chosen.select("key"), "key", "left_semi")


def _open_keys(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (node, n, of, key) of keys under which different components of ``links`` still meet, with each node's component."""
    of = F.coalesce("component", "node").alias("of")
    placed = rows.select("node", "n", "key").distinct().join(components(links), "node", "left").select("node", "n", "key", of)
    return settle(_shared_keys(placed, "of", "of").select("node", "n", "of", "key"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (g, h, node, of) of bounded groups in which every two nodes of different components that share a key meet.

    A node is at home under its largest key. Nodes with one home meet there, so under another key they are no more compared with
    each other than the nodes of one component are. The largest such class of a key is its main side: its blocks
    meet those of the others, and those meet each other. A crowd that shares many keys so meets under one of them.
    """
    sized = rows.join(rows.groupBy("key").agg(F.count("*").alias("size")), "key")
    home = sized.groupBy("node").agg(F.max(F.struct("size", "key"))["key"].alias("home"))
    rows = settle(rows.join(home, "node"))
    member = F.array(F.struct(F.lit(0).alias("sort"), F.col("of").alias("id")), F.struct(F.lit(1).alias("sort"), F.col("home").alias("id")))
    classes = rows.select("key", F.explode(F.when(F.col("home") == F.col("key"), F.slice(member, 1, 1)).otherwise(member)).alias("class"))
    largest = classes.groupBy("key", "class").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "class"))["class"].alias("largest"))
    own = F.when(F.col("largest.sort") == 0, F.col("of")).otherwise(F.col("home"))
    sides = rows.join(largest, "key").withColumn("main", own == F.col("largest.id"))
    need = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / (GROUP_SHINGLES // 2))).cast("long")
    parts = sides.groupBy("key", "main").agg(need.alias("parts"))
    parts = parts.groupBy("key").agg(F.max(F.when(~F.col("main"), F.col("parts"))).alias("others"), F.max(F.when(F.col("main"), F.col("parts"))).alias("mains"))
    # without others all nodes of a key meet at their home
    parts = parts.where(F.col("others").isNotNull())
    every = F.col("others") + F.col("mains")
    block = F.when(F.col("main"), F.col("others") + _part_of(F.col("node"), F.col("mains"))).otherwise(_part_of(F.col("node"), F.col("others")))
    dealt = sides.join(parts, "key").withColumn("block", block)
    met = F.filter(F.sequence(F.lit(0).cast("long"), F.when(F.col("main"), F.col("others")).otherwise(every) - 1), lambda j: j != F.col("block"))
    pairs = dealt.select("node", "of", F.col("key").alias("g"), "block", every.alias("every"), F.explode(met).alias("other"))
    return pairs.select("node", "of", "g", (F.least("block", "other") * F.col("every") + F.greatest("block", "other")).alias("h"))


def _part_of(node, parts):
    return F.pmod(F.xxhash64(node, F.lit("part")), parts)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Documents are linked if 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest doc_id that links reach. Null, empty and blank texts
    have no shingles and no links. Repeated rows with one doc_id are one document. A row with a null
    doc_id follows exact copies of its set only; if those have no doc_id either, its
    component is null and it is kept. An empty table gives an empty result.

    1. Exact copies of a set collapse to the smallest doc_id (a combining aggregate).
    2. Every representative meets, hub by hub, the smallest representative of the band
       that it shares most often; hubs with many partners are split into bounded groups.
    3. Documents under keys where different components still meet are keyed anew, by
       their rarest items (``rare_keys``): each is compared in its largest group, then
       key by key, in bounded blocks where a group is large. Only links of a spanning forest leave a task.
    """
    rows = settle(sketch(docs, k, percent))
    copies = settle(
        rows.where("n_shingles > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.count("*").alias("c")).where("c > 1").drop("c")
    )
    placed = settle(
        rows.join(copies, ["hi", "lo"], "left").select(
            "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("node", "doc_id")).otherwise(F.col("doc_id")).alias("node")
        )
    )
    nodes = rows.where("n_shingles > 0").join(copies, ["hi", "lo"], "left").where("doc_id = coalesce(node, doc_id)")
    banded = settle(
        _shared_keys(nodes.select(F.col("doc_id").cast("long").alias("node"), F.col("n_shingles").alias("n"), F.explode("keys").alias("key")), "node")
    )
    stars = banded.where("node <> hub").groupBy("node", "n", "hub").agg(F.count("*").alias("c"))
    stars = settle(stars.groupBy("node").agg(F.max("n").alias("n"), F.max_by("hub", F.struct("c", "hub")).alias("hub")))
    texts = settle(
        docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(banded.select("node").distinct(), "node", "left_semi")
    )

    parts = _parts(stars, "hub")
    spokes = stars.join(parts, "hub").select(F.col("hub").alias("g"), _part_of(F.col("node"), F.col("parts")).alias("h"), "node")
    hubs = parts.select(F.col("hub").alias("g"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("h"), F.col("hub").alias("node"))
    first = settle(confirm(spokes.union(hubs).withColumn("of", F.col("node")).join(texts, "node"), k, percent))

    left = _open_keys(banded, first)
    crowd = left.select("node", "of").distinct()
    rare = settle(_once(settle(rare_keys(texts.join(crowd, "node"), k, percent))))
    # every node once, in a part of its largest group: what is alike in a crowd mostly comes together here
    sized = rare.join(rare.groupBy("key").agg(F.count("*").alias("size")), "key")
    nearest = settle(sized.groupBy("node", "n", "of").agg(F.max(F.struct("size", "key"))["key"].alias("key")))
    dealt = nearest.join(_parts(nearest, "key"), "key").select("node", "of", F.col("key").alias("g"), _part_of(F.col("node"), F.col("parts")).alias("h"))
    found = first.union(settle(confirm(dealt.join(texts, "node"), k, percent)))

    left = _once(_open_keys(rare, found))
    found = found.union(settle(confirm(_blocks(left).join(texts, "node"), k, percent)))

    final = components(found)
    return placed.join(final, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "node").cast(docs.schema["doc_id"].dataType).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "node"), F.coalesce("component", "node").isNull()).alias("kept"),
    )


def _shared_keys(rows: DataFrame, by: str, *more: str) -> DataFrame:
    """Rows (node, n, hub, ...) of keys that hold several values of ``by``, with the key's smallest node as hub."""
    shared = rows.groupBy("key").agg(F.min(by).alias("least"), F.max(by).alias("most"), F.min("node").alias("hub")).where("least < most")
    return rows.join(shared, "key").select("node", "n", "key", "hub", *more)
