"""Benchmark decontamination: rare word n-grams find passages, a local alignment scores them.

The benchmark is taken in blocks of bounded size. A first pass counts in how many documents each n-gram of
the block's items stands; an item keeps its rarer n-grams as seeds. A second pass looks up the
seeds in every document, and aligns the item with the passage that a run of seeds marks
(Smith-Waterman over words). Neither pass moves a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.llm.common import Words, map_arrow, signed

#: Words of a seed; share of an item's n-grams, rarest first, that are seeds.
SEED_WORDS, RARE_SHARE = 3, 0.75
#: Least alignment score of a hit, as a share of the score of an exact copy, in items too short for ``EVIDENCE``.
LEAST_SCORE = 0.4
#: Alignment score of a hit whatever the length of the item: so many words match beyond mismatches and gaps.
EVIDENCE = 20
#: Each run of so many n-grams of an item keeps its rarer ones too, so an excerpt has seeds however often it was copied.
RUN = 6
#: Characters of benchmark text that one pass handles.
BLOCK_CHARS = 8_000_000
_FILTER = 1 << 22


class Items:
    """The items of one block: their words and n-grams."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        words = Words(pa.array(texts, pa.string()))
        self.first, self.words = words.first, words.hashes
        grams, at = words.shingles(SEED_WORDS)
        self.grams, which = np.unique(grams, return_inverse=True)
        order = np.argsort(which, kind="stable")
        self.item, self.place = words.row[at][order], (at - words.first[words.row[at]])[order]
        self.slot = np.searchsorted(which[order], np.arange(len(self.grams) + 1))
        self.open = np.ones(len(self.item), dtype=bool)

    def keep_rare(self, frequency: np.ndarray) -> None:
        """Leave open as seeds the n-grams up to the ``RARE_SHARE`` quantile of frequency of the item, or of their run in it."""
        f = np.repeat(frequency, np.diff(self.slot))
        run = (self.first // RUN + np.arange(len(self.first)))[self.item] + self.place // RUN
        self.open = (f <= self._quantile(f, self.item)) | (f <= self._quantile(f, run))

    @staticmethod
    def _quantile(f: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The ``RARE_SHARE`` quantile of ``f`` in the group of each entry."""
        order = np.lexsort((f, group))
        _, begin, which, count = np.unique(group[order], return_index=True, return_inverse=True, return_counts=True)
        out = np.empty_like(f)
        out[order] = f[order][begin + np.ceil(RARE_SHARE * count).astype(int) - 1][which]
        return out

    def lookup(self) -> np.ndarray:
        passed = np.zeros(_FILTER, dtype=bool)
        passed[(self.grams & np.uint64(_FILTER - 1)).astype(np.intp)] = True
        return passed

    def found(self, passed: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``grams``, number of the n-gram) of those that are in the block."""
        at = np.flatnonzero(passed[(grams & np.uint64(_FILTER - 1)).astype(np.intp)])
        if len(self.grams) == 0 or len(at) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        same = self.grams[n] == grams[at]
        return at[same], n[same]


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each row of ``a`` with the same row of ``b``, and its end in ``b``.

    A match counts 1, a mismatch and a gap -1. Zeros pad ``a``, and match nothing.
    """
    rows, width = b.shape
    steps = np.arange(width, dtype=np.int32)
    h = np.zeros((rows, width + 1), dtype=np.int32)
    best, end = np.zeros(rows, dtype=np.int32), np.zeros(rows, dtype=np.int64)
    for i in range(a.shape[1]):
        word = a[:, i : i + 1]
        t = h[:, :-1] + np.where((word == b) & (word != 0), 1, -1)
        np.maximum(t, h[:, 1:] - 1, out=t)
        np.maximum(t, 0, out=t)
        # gaps in the item: each value sinks by 1 to the right
        t += steps
        np.maximum.accumulate(t, axis=1, out=t)
        t -= steps
        h[:, 1:] = t
        at = t.argmax(axis=1)
        top = t[np.arange(rows), at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return best, end


def passages(items: Items, words: Words, grams: np.ndarray, at: np.ndarray, passed: np.ndarray):
    """(row, item, from word, to word) of the passages that seeds mark, words counted over the batch.

    Seeds of one item whose diagonals lie within a quarter of its length make one passage. An
    item of 20 words or more needs two different seeds.
    """
    place, n = items.found(passed, grams)
    reps = np.diff(items.slot)[n]
    entry = np.repeat(items.slot[:-1][n] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
    word = np.repeat(at[place], reps)
    kept = items.open[entry]
    entry, word = entry[kept], word[kept]
    item, row = items.item[entry], words.row[word]
    diagonal = word - items.place[entry]
    order = np.lexsort((diagonal, item, row))
    row, item, diagonal, entry = row[order], item[order], diagonal[order], entry[order]
    length = np.diff(items.first)
    slack = 4 + length // 4
    if len(row) == 0:
        return row, item, diagonal, diagonal
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[item[1:]])
    start = np.flatnonzero(new)
    cluster = np.cumsum(new) - 1
    seeds = np.bincount(np.unique(cluster * len(items.item) + entry) // len(items.item), minlength=len(start))
    row, item = row[start], item[start]
    low, high = np.minimum.reduceat(diagonal, start), np.maximum.reduceat(diagonal, start)
    a = np.maximum(low - slack[item], words.first[row])
    b = np.minimum(high + length[item] + slack[item], words.first[row + 1])
    kept = (seeds >= 2) | (length[item] < 20)
    return row[kept], item[kept], a[kept], b[kept]


def _padded(values: np.ndarray, a: np.ndarray, b: np.ndarray, backwards: bool = False) -> np.ndarray:
    width = int((b - a).max())
    at = (b[:, None] - 1 - np.arange(width)) if backwards else (a[:, None] + np.arange(width))
    inside = (at >= a[:, None]) & (at < b[:, None])
    return np.where(inside, values[np.clip(at, 0, len(values) - 1)], np.uint64(0))


def hits_of(items: Items, passed: np.ndarray, column: pa.Array, least: float):
    """(row, item, score, start word, end word) of the contaminated passages of a batch, the best of each pair."""
    words = Words(column)
    grams, at = words.shingles(SEED_WORDS)
    row, item, a, b = passages(items, words, grams, at, passed)
    order = np.argsort(b - a, kind="stable")
    parts = []
    for i in range(0, len(order), 1024):
        o = order[i : i + 1024]
        x, y = items.first[item[o]], items.first[item[o] + 1]
        score, end = align(_padded(items.words, x, y), _padded(words.hashes, a[o], b[o]))
        share = score / (y - x)
        good = (share >= least) | (score >= EVIDENCE)
        if not good.any():
            continue
        o, x, y, end, share = o[good], x[good], y[good], end[good], share[good]
        to = a[o] + end
        _, back = align(_padded(items.words, x, y, True), _padded(words.hashes, a[o], to, True))
        base = words.first[row[o]]
        parts.append((row[o], item[o], share, to - back - base, to - base))
    if not parts:
        return None
    row, item, share, start, end = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((start, -share, item, row))
    first = np.ones(len(order), dtype=bool)
    r, t = row[order], item[order]
    first[1:] = (r[1:] != r[:-1]) | (t[1:] != t[:-1])
    pick = order[first]
    return row[pick], item[pick], share[pick], start[pick], end[pick]


def contamination(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word: items that a document holds, copied or edited.

    One row for each row of ``docs`` (doc_id, text) and item whose best passage reaches ``least`` as a share of
    the item, or a score of ``EVIDENCE`` words, as excerpts of long items do; score is that share, 1 for an exact copy. Null and empty texts, and items of fewer than three words, give no rows; repeated
    rows of either table give repeated rows, null ids are carried. Words are ``[^\\x20\\x09-\\x0D]+``, A-Z
    lower-cased. An empty table on either side gives an empty result. Other columns are ignored.
    """
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, score double, start_word long, end_word long"
    usable = benchmark.where(F.length("text") > 0).select("item_id", "text")
    chars = usable.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-chars // BLOCK_CHARS)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    texts = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], schema)
    item_type = pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else pa.string()
    for k in range(blocks):
        # about BLOCK_CHARS characters, whatever the size of the benchmark
        rows = usable.where(part == k).collect() if blocks > 1 else usable.collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        items = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        counted = {r["gram"]: r["n"] for r in _frequencies(texts, items).collect()}
        items.keep_rare(np.array([counted.get(int(g), 0) for g in signed(items.grams)], dtype=np.int64))
        names = pa.array(items.ids, item_type)

        def run(batch: pa.RecordBatch, items=items, names=names) -> pa.RecordBatch | None:
            found = hits_of(items, items.lookup(), batch.column("text"), least)
            if found is None:
                return None
            row, item, share, start, end = found
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), names.take(pa.array(item)), pa.array(np.round(share, 6)), pa.array(start), pa.array(end)],
                ["doc_id", "item_id", "score", "start_word", "end_word"],
            )

        out = out.union(map_arrow(texts, run, schema))
    return out


def _frequencies(texts: DataFrame, items: Items) -> DataFrame:
    """(gram, n): the documents that hold each n-gram of the block; at most as many rows as it has n-grams."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column("text"))
        grams, at = words.shingles(SEED_WORDS)
        place, n = items.found(items.lookup(), grams)
        once = np.unique(words.row[at[place]] * len(items.grams) + n) % max(1, len(items.grams))
        gram, count = np.unique(once, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(signed(items.grams)[gram]), pa.array(count)], ["gram", "n"])

    return map_arrow(texts.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no contaminated passage; rows with a null doc_id stay if clean themselves."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.coalesce(F.sha2("text", 256), F.lit(""))))
    keyed = docs.withColumn("_key", key)
    bad = contamination(keyed.select(F.col("_key").alias("doc_id"), "text"), benchmark, least).select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(bad, "_key", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
