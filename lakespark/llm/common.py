"""Reading tables, Arrow mapping and token hashing shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespark.session import configure

#: Rows of one Arrow batch, and bytes of text handled at once inside a task.
BATCH_ROWS = 2000
CHUNK_BYTES = 1 << 20
#: Bytes of words that are hashed at once.
HASHED = 1 << 16


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def crc_of_id(name: str = "doc_id") -> Column:
    return F.crc32(F.col(name).cast("string").cast("binary"))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str) -> DataFrame:
    """``fn`` over slices of Arrow batches that hold about ``CHUNK_BYTES`` of data each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, cut where the bytes of its strings pass ``limit``."""
    sizes = np.full(batch.num_rows, 16, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    ends = np.cumsum(sizes)
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def flat(column: pa.Array, tail: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings of a column, each followed by ``tail``, and the row offsets. Null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if tail:
        column = pc.binary_join_element_wise(column, pa.scalar(tail, pa.large_string()), pa.scalar("", pa.large_string()))
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow strings over one buffer of UTF-8 bytes."""
    off = np.ascontiguousarray(offsets, dtype=np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.string())


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind) if kind else pa.array(values))


# --- words and their hashes -----------------------------------------------------------------

_SEPARATORS = np.zeros(256, dtype=bool)
_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


#: Everything but ASCII letters and digits and the bytes of other letters.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


_BYTE_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(64)], dtype=np.uint64)
_STEP64 = np.uint64(pow(0xD6E8FEB86659FD93, 64, 1 << 64))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a column of texts, A-Z lower-cased, with 64-bit hashes.

    ``starts`` and ``ends`` are byte positions in ``data``; words of one row lie
    in ``first[row]:first[row + 1]``.
    """

    def __init__(self, column: pa.Array, separators: np.ndarray = _SEPARATORS):
        """``separators``: for each byte whether it parts words; the blank must be one."""
        raw, self.offsets = flat(column, " ")
        self.data = _FOLD[raw]
        inside = np.zeros(len(raw) + 1, dtype=np.int8)
        inside[1:] = ~separators[raw]
        edges = np.diff(inside)
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)  # each text ends with a separator
        self.first = np.searchsorted(self.starts, self.offsets)
        self.row = np.repeat(np.arange(len(column)), np.diff(self.first))
        self.hashes = span_hashes(self.data, self.starts, self.ends)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``k`` consecutive words of a row, and the number of their first word."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total = total * np.uint64(0x9FB21C651E98DF25) + self.hashes[j : j + n]
        at = np.flatnonzero(self.row[:n] == self.row[k - 1 :])
        return mix(total[at]), at


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order, not empty and do not overlap."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inner = np.concatenate(([0], np.cumsum(lengths)))
    keys = mix(_BYTE_KEYS + np.uint64(seed)) if seed else _BYTE_KEYS
    total = np.zeros(len(lengths), np.uint64)
    # the terms of a word add up, so a block of bytes may end inside one
    for a in range(0, int(inner[-1]), HASHED):
        b = min(a + HASHED, int(inner[-1]))
        first = int(np.searchsorted(inner, a, side="right")) - 1
        last = int(np.searchsorted(inner, b, side="left"))
        edges = np.maximum(inner[first:last], a)
        parts = np.diff(np.append(edges, b))
        place = np.arange(a, b) - np.repeat(inner[first:last], parts)
        terms = keys[data[place + np.repeat(starts[first:last], parts)]] * _POWERS[place & 63]
        far = place >= 64
        if far.any():
            terms[far] *= _power(_STEP64, place[far] >> 6)
        total[first:last] += np.add.reduceat(terms, edges - a)
    return mix(total + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    out = np.ones(len(exponents), dtype=np.uint64)
    e = exponents.astype(np.uint64)
    b = np.uint64(base)
    with np.errstate(over="ignore"):
        while e.any():
            out = np.where(e & np.uint64(1), out * b, out)
            b = b * b
            e = e >> np.uint64(1)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
