"""Substring deduplication by hashing lines, cut further at sentence ends.

Units are normalised (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, single blanks between), and
their digests are grouped over the whole table. Of equal units the one of the smallest doc_id, and there the
first, stays; the others go, and their places in the original text are reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.llm.common import Words, _power, map_arrow, mix, signed
from lakespark.session import settle

#: Least words of a stretch of neighbouring repeated units that is removed.
LEAST_WORDS = 10
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_FACTORS = (np.uint64(0xC6A4A7935BD1E995), np.uint64(0x9FB21C651E98DF25))


def units(column: pa.Array) -> dict[str, np.ndarray]:
    """Units of every text: row, number in the row, start and end (code points), words and a 128-bit digest.

    A unit ends at a line break, after a word that ends with ``.``, ``!`` or ``?``, or with the text.
    """
    w = Words(column)
    if len(w.starts) == 0:
        return {k: np.zeros(0, np.int64) for k in ("row", "number", "start", "end", "words", "hi", "lo", "again")}
    lines = np.cumsum(w.data == 10)
    new = np.ones(len(w.starts), dtype=bool)
    new[1:] = (w.row[1:] != w.row[:-1]) | _ENDS[w.data[w.ends[:-1] - 1]] | (lines[w.starts[1:]] != lines[w.starts[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(new)))
    place = (np.arange(len(new)) - np.repeat(first, count)).astype(np.uint64)
    digests = [mix(np.add.reduceat(mix(w.hashes ^ f) * _power(f, place), first) + count.astype(np.uint64)) for f in _FACTORS]
    row = w.row[first]
    points = np.cumsum((w.data & 0xC0) != 0x80)
    before = np.concatenate(([0], points))
    base = before[w.offsets[row]]
    last = first + count - 1
    # equal units of one row: all but the first are repeats, whatever other rows hold
    order = np.lexsort((np.arange(len(row)), digests[1], digests[0], row))
    same = np.zeros(len(row), dtype=bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (digests[0][order][1:] == digests[0][order][:-1]) & (digests[1][order][1:] == digests[1][order][:-1])
    again = np.zeros(len(row), dtype=bool)
    again[order] = same
    number = np.arange(len(row)) - np.searchsorted(row, row)
    return {
        "row": row, "number": number, "start": before[w.starts[first]] - base, "end": before[w.ends[last]] - base,
        "words": count, "hi": signed(digests[0]), "lo": signed(digests[1]), "again": again,
    }


_UNIT = "number long, start long, end long, words long, hi long, lo long, again boolean"


def text_key() -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.lit("text"), F.col("text"))


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, text_key, n_removed (units), removed_words and spans, an array of (start, end) in code points.

    One row for each text of each doc_id of ``docs`` (doc_id, text) that loses something. Neighbouring repeated units
    of a document make a stretch; it goes if it has at least ``least_words`` words, so that a
    short phrase which many texts share stays. Rows of one doc_id count as one document, and are not
    repeats of each other, but spans are those of each text; rows with a null doc_id, and null, empty or blank texts, have no spans.
    """
    names = [part.split()[0] for part in _UNIT.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = units(batch.column("text"))
        row = pa.array(found["row"])
        columns = [*(batch.column(c).take(row) for c in ("doc_id", "text_key")), *(pa.array(found[n]) for n in names)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select("doc_id", text_key().alias("text_key"), "text")
    every = settle(map_arrow(known, run, f"doc_id {kind}, text_key long, {_UNIT}"))
    earliest = settle(
        every.where("not again").groupBy("hi", "lo").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id").select("hi", "lo", "first_id")
    )
    later = every.where("not again").join(earliest, ["hi", "lo"]).where("doc_id > first_id")
    shown = ["doc_id", "text_key", "number", "start", "end", "words"]
    repeated = later.select(*shown).union(every.where("again").select(*shown))
    per_doc = repeated.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("number", "start", "end", "words"))).alias("units"))
    return _stretches(per_doc, kind, least_words)


def _stretches(per_doc: DataFrame, kind: str, least_words: int) -> DataFrame:
    """Stretches of neighbouring units, in numpy over the units of a batch of documents."""

    def run(batches):
        for batch in batches:
            lists = batch.column("units")
            size = np.diff(lists.offsets.to_numpy())
            flat_units = lists.flatten()
            number, start, end, words = (flat_units.field(n).to_numpy() for n in ("number", "start", "end", "words"))
            doc = np.repeat(np.arange(len(size)), size)
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (number[1:] > number[:-1] + 1)
            first = np.flatnonzero(new)
            total = np.add.reduceat(words, first)
            good = total >= least_words
            first, last = first[good], (np.append(first[1:], len(doc)) - 1)[good]
            of = doc[first]
            n = np.bincount(of, minlength=len(size))
            removed = np.bincount(of, last - first + 1, len(size)).astype(np.int64)
            lost = np.bincount(of, total[good], len(size)).astype(np.int64)
            pairs = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(end[last])], ["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pairs)
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(removed), pa.array(lost), spans], ["doc_id", "text_key", "n_removed", "removed_words", "spans"])
            yield out.filter(pa.array(n > 0))

    return per_doc.mapInArrow(run, f"doc_id {kind}, text_key long, n_removed long, removed_words long, spans array<struct<start: bigint, end: bigint>>")


def remove_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated stretches cut out of ``text``; other columns and rows stay as they are."""
    found = repeated_spans(docs, least_words).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans"))
    row = F.struct(*docs.columns).alias("_row")
    joined = docs.select("doc_id", "text", row).join(found, (F.col("doc_id") == F.col("_id")) & (text_key() == F.col("_key")), "left").select("text", "_row", "_spans")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
            if text and spans:
                cuts = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
                text = "".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
            out.append(text)
        return batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    cut = map_arrow(joined, run, joined.schema)
    return cut.select(*(F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns))
