"""Secret scan: three patterns, and a battery of randomness tests over other tokens.

A token of letters, digits and base64 marks that holds a letter and a digit is suspected of
being random. Chi-squared uniformity over the alphabet of its inferred encoding, a runs
test and the serial correlation give p-values, which are combined. Within each band
of lengths the tokens that are not random are sorted out at a false-discovery rate over the whole table;
what the tests do not reject is reported as ``random``.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.llm.common import map_arrow

#: Kinds in the order of the report.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")

#: Rate of random tokens that may be sorted out by mistake, and least lengths of the bands.
RATE = 0.05
BANDS = (20, 32, 48, 80)
#: p-values are counted in bins of a twentieth of a power of ten; the last one is open.
BINS = 400

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENCODINGS = tuple(
    (name, {c: i for i, c in enumerate(alphabet)})
    for name, alphabet in (
        ("hex", _DIGITS + "abcdef"),
        ("HEX", _DIGITS + "ABCDEF"),
        ("base32", _UPPER + "234567"),
        ("base36", _DIGITS + _LOWER),
        ("BASE36", _DIGITS + _UPPER),
        ("base62", _DIGITS + _UPPER + _LOWER),
        ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
        ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
        ("any", _UPPER + _LOWER + _DIGITS + "+/-_"),
    )
)


def encoding(token: str) -> tuple[str, dict[str, int]]:
    """The narrowest encoding whose alphabet covers the token."""
    used = set(token)
    return next((name, index) for name, index in _ENCODINGS if used <= index.keys())


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_squared_tail(x: float, df: int) -> float:
    """Upper tail by the cube-root approximation."""
    spread = 2 / (9 * df)
    return _tail(((x / df) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def uniformity(values: list[int], size: int, groups: int = 8) -> float:
    """Chi-squared test of equal use of an alphabet of ``size``, in ``groups`` neighbouring parts."""
    seen = [0] * groups
    for v in values:
        seen[v * groups // size] += 1
    share = [sum(1 for v in range(size) if v * groups // size == g) / size for g in range(groups)]
    x = sum((s - len(values) * p) ** 2 / (len(values) * p) for s, p in zip(seen, share, strict=True))
    return _chi_squared_tail(x, groups - 1)


def runs(values: list[int], size: int) -> float:
    """Two-sided test of the number of runs in the lower and the upper half of the alphabet."""
    high = [2 * v >= size for v in values]
    n1, n2 = sum(high), len(high) - sum(high)
    if not n1 or not n2:
        return 2.0 ** (1 - len(high))
    n = n1 + n2
    mean, var = 1 + 2 * n1 * n2 / n, 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
    count = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    return min(1.0, 2 * _tail(abs(count - mean) / math.sqrt(max(var, 1e-9))))


def serial(values: list[int]) -> float:
    """Two-sided test of the correlation of neighbouring symbols."""
    n, mean = len(values), sum(values) / len(values)
    total = sum((v - mean) ** 2 for v in values)
    if not total:
        return 2.0 ** (1 - n)
    r = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:], strict=False)) / total
    return min(1.0, 2 * _tail(abs(r + 1 / n) * math.sqrt(n)))


def randomness(token: str) -> float:
    """Combined p-value of the battery under the hypothesis that the token is random."""
    _, index = encoding(token)
    values = [index[c] for c in token]
    p = [uniformity(values, len(index)), runs(values, len(index)), serial(values)]
    half = -sum(math.log(max(x, 1e-300)) for x in p)
    return math.exp(-half) * (1 + half + half * half / 2)


def band(length: int) -> int:
    return sum(length >= b for b in BANDS) - 1


def bin_of(p: float) -> int:
    return min(BINS, int(-20 * math.log10(max(p, 1e-300))))


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of the three patterns, in code points."""
    spans = [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, base: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, band, bin) of tokens to test, none of which overlaps a base span."""
    out = []
    at, reach = 0, 0
    for m in _TOKEN.finditer(text):
        # both lists are in order: of the base spans that start before the token ends, the furthest end decides
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        token = m[0]
        if reach <= m.start() and _DIGIT.search(token) and _LETTER.search(token):
            out.append((m.start(), m.end(), band(len(token)), bin_of(randomness(token))))
    return out


_SPAN = "struct<start: bigint, kind: int, end: bigint, inner: bigint>"
_CANDIDATE = "struct<start: bigint, end: bigint, band: int, bin: int>"
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("inner", pa.int64())]))
_ARROW_CANDIDATE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("band", pa.int32()), ("bin", pa.int32())]))


def _scan(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``_base`` and ``_tested``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, tested = [], []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text or "")
            base.append([dict(zip(("start", "kind", "end", "inner"), s, strict=True)) for s in spans])
            tested.append([dict(zip(("start", "end", "band", "bin"), c, strict=True)) for c in candidates(text or "", spans)])
        columns = [*batch.columns, pa.array(base, _ARROW_SPAN), pa.array(tested, _ARROW_CANDIDATE)]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_base", "_tested"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, run, f"{fields}, _base array<{_SPAN}>, _tested array<{_CANDIDATE}>")


def limits(counts: list[tuple[int, int, int]], rate: float = RATE) -> list[int]:
    """For each band of lengths the bin from which tokens are sorted out as not random.

    ``counts``: (band, bin, tokens). The step-up rule: the weakest p-value whose expected
    share of mistakes among all at least as strong stays within ``rate``.
    """
    out = []
    for b in range(len(BANDS)):
        bins = {i: n for at, i, n in counts if at == b}
        total, above, limit = sum(bins.values()), 0, BINS + 1
        for i in range(BINS, -1, -1):
            above += bins.get(i, 0)
            if above and 10 ** (-i / 20) <= rate * above / total:
                limit = i
        out.append(limit)
    return out


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` with ``secrets``: an array of (start, kind, end, inner) by start, then kind.

    Positions are code points of the whole text, ends exclusive; ``inner`` is where the secret itself
    starts, ``kind`` an index of ``KINDS``. A null or empty text has an empty array. The table
    is read twice: for the counts of p-values (at most bands times bins rows reach the
    driver), and for the result. A column called secrets is replaced.
    """
    tested = _scan(docs.select("text")).select(F.explode("_tested").alias("t"))
    counts = tested.groupBy(F.col("t.band").alias("band"), F.col("t.bin").alias("bin")).count().collect()
    limit = F.array(*(F.lit(x) for x in limits([tuple(r) for r in counts], rate)))
    random = F.transform(
        F.filter("_tested", lambda t: t["bin"] < F.get(limit, t["band"])),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end"), t["start"].alias("inner")),
    )
    found = _scan(docs.drop("secrets", "_base", "_tested"))
    return found.withColumn("secrets", F.array_sort(F.concat("_base", random))).drop("_base", "_tested")


def spelled(spans) -> F.Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; what is found in overlapping spans once.

    An assignment keeps its name and loses its value. Null texts stay null. ``n_chars``, where
    ``docs`` has it, follows the new text.
    """
    # columns of the documents travel in one, so that none can clash with the result's
    found = find_secrets(docs.select("text", F.struct(*docs.columns).alias("_row")), rate)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("secrets").to_pylist(), strict=True):
            if spans:
                pieces, end = [], 0
                for s in sorted(spans, key=lambda s: s["inner"]):
                    if s["inner"] >= end:
                        pieces += [text[end : s["inner"]], mark]
                    end = max(end, s["end"])
                text = "".join((*pieces, text[end:]))
            out.append(text)
        return batch.set_column(at, "text", pa.array(out, pa.string()))

    done = map_arrow(found, run, found.schema)

    def column(name: str) -> F.Column:
        old = F.col("_row").getField(name)
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return done.select(*(column(c) for c in docs.columns))
