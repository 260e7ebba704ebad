"""Media columns: texts stored as lossless WebP pictures, and features of what is read back."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakespark.llm import webp
from lakespark.llm.common import map_arrow, slices

UNIT = 3 * webp.WIDTH
BLANK = b" "
#: Bytes of media that are decoded side by side.
TOGETHER = 4 << 20


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 of a text (null: empty), blanks appended up to a positive multiple of ``UNIT``; and its own length."""
    raw = (text or "").encode()
    return raw + BLANK * (-len(raw) % UNIT if raw else UNIT), len(raw)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (of the text) and media (a WebP file) of every row of ``docs`` (doc_id, text).

    Null and empty texts give a row of blanks. Equal texts, repeated rows included, give equal files. A text of any length
    is one file: longer ones are animations of tiles. Other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made: dict[str | None, tuple[bytes, int]] = {}
        for text in batch.column("text").to_pylist():
            if text not in made:
                payload, n = payload_of(text)
                made[text] = webp.encode(payload), n
        rows = [made[text] for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([n for _, n in rows], pa.int64()), pa.array([m for m, _ in rows], pa.binary())],
            ["doc_id", "n_bytes", "media"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes long, media binary")


def features(samples: np.ndarray) -> str:
    """Rows, mean, standard deviation and entropy (bits) of the samples, and the share of equal horizontal neighbours."""
    counts = np.bincount(samples.ravel(), minlength=256)
    share = counts[counts > 0] / samples.size
    line = samples.reshape(-1)
    level = float(counts @ np.arange(256)) / samples.size
    spread = max(0.0, float(counts @ np.arange(256) ** 2) / samples.size - level * level) ** 0.5
    repeats = float((line[3:] == line[:-3]).mean())
    return f"rows={len(samples)};mean={level:.4f};std={spread:.4f};entropy={-float(share @ np.log2(share)):.4f};repeats={repeats:.4f}"


def read(stored: DataFrame) -> DataFrame:
    """What the stored files hold: digests of payload and file, and features, for each row of ``store``.

    A file that is no WebP, or a broken one, raises ValueError.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, TOGETHER):
                media = part.column("media").to_pylist()
                distinct = list(dict.fromkeys(media))
                known = {}
                for file, samples in zip(distinct, webp.decode(distinct), strict=True):
                    payload = samples.tobytes()
                    known[file] = (
                        len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]),
                        len(file), hashlib.sha256(file).hexdigest(), features(samples),
                    )
                columns = list(zip(*(known[m] for m in media), strict=True))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *arrays], ["doc_id", "n_bytes", *names])

    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.mapInArrow(
        run,
        f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
        "media_bytes long, media_sha256 string, feature string",
    )
