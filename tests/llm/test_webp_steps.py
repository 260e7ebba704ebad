"""The encoder of the query uses the whole format where it pays, and what it writes reads back."""

import numpy as np
import pytest

from lakespark.llm import webp

RNG = np.random.default_rng(5)
GREEN = RNG.integers(0, 256, 2048)
WORDS = [bytes(RNG.integers(97, 123, n)) + b" " for n in RNG.integers(2, 9, 200)]


def padded(data: bytes) -> bytes:
    return data + b" " * (-len(data) % 192)


def rgb(*channels) -> bytes:
    return np.stack(channels, axis=1).astype(np.uint8).tobytes()


ROWS, COLUMNS = np.divmod(np.arange(2048), 64)
SMOOTH = np.stack([40 + 3 * ROWS + COLUMNS, 200 - 2 * ROWS + COLUMNS, 30 + ROWS * COLUMNS // 16], axis=1) + RNG.integers(0, 2, (2048, 3))
FEW = RNG.integers(0, 256, (11, 3))
CASES = {
    "predictor": ((webp.PREDICTOR,), SMOOTH.astype(np.uint8).tobytes()),
    "green": ((webp.SUBTRACT_GREEN,), rgb(GREEN + RNG.integers(0, 3, 2048), GREEN, GREEN + RNG.integers(0, 3, 2048))),
    "cross": ((webp.CROSS_COLOR,), rgb(GREEN.astype(np.int8) // 2 + RNG.integers(0, 3, 2048), GREEN, RNG.integers(0, 3, 2048) - GREEN.astype(np.int8) // 2)),
    "palette": ((webp.PALETTE,), FEW[RNG.integers(0, 11, 2048)].astype(np.uint8).tobytes()),
}


def steps(media: bytes) -> list[tuple[tuple[int, ...], int]]:
    found = [webp.Picture(data) for _, data in webp.pictures(media)]
    return [(tuple(t[0] for t in p.transforms), p.cache_bits) for p in found]


@pytest.mark.parametrize("name", CASES)
def test_transforms_are_written_where_they_pay(name):
    kinds, payload = CASES[name]
    media = webp.encode(payload)
    assert any(kinds[0] in used for used, _ in steps(media))
    assert webp.decode([media])[0].tobytes() == payload


def test_files_of_the_query_use_the_colour_cache(spark):
    from test_queries import SF

    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").where("length(text) > 6000").limit(20).collect()]
    payloads = [padded(t.encode()) for t in texts]
    files = [webp.encode(p) for p in payloads]
    assert any(bits for f in files for _, bits in steps(f))
    assert [x.tobytes() for x in webp.decode(files)] == payloads


def test_a_passage_repeats_from_afar():
    first = RNG.integers(0, 256, 3000).astype(np.uint8).tobytes()
    payload = padded(first + first)
    media = webp.encode(payload)
    assert len(media) < 0.6 * len(payload)
    assert webp.decode([media])[0].tobytes() == payload


def test_cache_and_copies_together():
    pixels = np.concatenate((RNG.integers(0, 40, 600), np.arange(600) % 7, RNG.integers(0, 40, 80))) * 0x10305 | 0xFF000000
    for bits in (1, 4, 9):
        w = webp.begin_picture(64, 20)
        w.put(0, 1)
        webp.write_pixels(w, pixels, 64, bits)
        p = webp.Picture(w.bytes())
        assert (webp.decode_pixels([p])[0][0] == pixels).all()


@pytest.mark.parametrize("height, width", [(1, 5), (7, 1), (9, 13), (32, 64)])
def test_every_mode_is_undone(height, width):
    argb = RNG.integers(0, 1 << 24, height * width) | 0xFF000000
    for size in (2, 3, 5):
        c = webp._channels(argb.reshape(height, width))
        modes = RNG.integers(0, 14, (webp._up(height, size), webp._up(width, size)))
        of = modes[np.arange(height)[:, None] >> size, np.arange(width) >> size]
        left = np.stack([webp._residuals(c, m) for m in range(14)])[of, np.arange(height)[:, None], np.arange(width)]
        assert (webp._unpredict(webp._packed(left), size, 0xFF000000 | modes << 8) == argb.reshape(height, width)).all()
    (kind, size, data), rest = webp._predict(argb, width)
    assert (webp._unpredict(rest.reshape(height, width), size, data) == argb.reshape(height, width)).all()


def test_random_payloads_of_many_kinds_read_back_together():
    kinds = [p for _, p in CASES.values()] + [padded(b"".join(RNG.choice(WORDS, n))) for n in (1, 40, 900, 4000)] + [b"\0" * 192, bytes(range(192)) * 70]
    assert [x.tobytes() for x in webp.decode([webp.encode(p) for p in kinds])] == kinds
