"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Boosted shallow trees are fitted to the statistics of labelled texts. Every path from a root to a node is a
rule, a conjunction of comparisons. A lasso logistic regression weighs the rules, and the few that keep a weight are
compiled into Spark column expressions over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.llm.common import Words, flat, map_arrow

#: Bound of the training sample: documents of each label.
SAMPLE = 3000
TREES, DEPTH, RATE = 32, 3, 0.3
#: Thresholds of a statistic that trees may choose, and least weight of a leaf (documents).
CUTS, LEAST = 48, 8
#: Weight of the lasso penalty against the mean loss, and steps of its fit.
PENALTY, STEPS = 1e-3, 1500
#: Words of a window.
WINDOW = 32

#: Letters count in either case; bytes above 127 as letters.
STATISTICS = (
    "log_bytes", "word_bytes", "upper", "digits", "marks", "stops", "high", "lines", "distinct", "same",
    "longest_run", "commonest", "bare", "pairs_again", "window_marks", "window_upper", "window_same", "window_bare",
)


def _class(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in characters]] = True
    return out


_MARKS, _STOPS, _DIGITS = _class("#$%&*!|@~^_=<>\\{}[]`+/"), _class(".,;:?'\"()-"), _class("0123456789")
_UPPER, _LETTER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True
_HIGH = np.arange(256) > 127


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each whole text. A null, empty or blank text has zeros."""
    w = Words(column)
    raw, _ = flat(column, " ")
    rows, out = len(column), np.zeros((len(column), len(STATISTICS)))
    if not rows:
        return out
    starts = w.offsets[:-1]  # each text holds a byte at least, the blank that ends it

    def count(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask[raw], starts, dtype=np.int64)

    n = np.diff(w.first)
    some = np.maximum(n, 1)
    length = np.diff(w.offsets) - 1
    letters, upper = count(_LETTER), count(_UPPER)
    put = dict(zip(STATISTICS, out.T, strict=True))
    inner = np.bincount(w.row, w.ends - w.starts, rows)
    put["log_bytes"][:] = np.log1p(length)
    put["word_bytes"][:] = inner / some
    put["upper"][:] = upper / np.maximum(letters, 1)
    put["digits"][:] = count(_DIGITS) / np.maximum(length, 1)
    put["marks"][:], put["stops"][:] = count(_MARKS) / some, count(_STOPS) / some
    put["high"][:] = count(_HIGH) / np.maximum(length, 1)
    put["lines"][:] = count(_class("\n")) / some
    if len(w.hashes):
        first_of = np.flatnonzero(n)
        at = w.first[first_of]
        last, second = raw[w.ends - 1], raw[np.minimum(w.starts + 1, w.ends - 1)]
        marked, shout = _MARKS[last], _UPPER[second] & (w.ends - w.starts > 1)
        bare = np.add.reduceat(_LETTER[raw] | _DIGITS[raw], np.stack((w.starts, w.ends), axis=1).ravel(), dtype=np.int32)[::2] == 0
        same = np.zeros(len(w.hashes), dtype=bool)
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.row[1:] == w.row[:-1])
        nth = np.arange(len(w.row)) - w.first[w.row]
        window = np.flatnonzero(nth % WINDOW == 0)
        size = np.minimum(WINDOW, w.first[w.row[window] + 1] - window)
        in_row = np.searchsorted(window, at)
        for name, flag in (("marks", marked), ("upper", shout), ("same", same), ("bare", bare)):
            # a short rest counts as a whole window
            share = np.add.reduceat(flag, window, dtype=np.int32) / np.maximum(size, WINDOW // 2)
            put[f"window_{name}"][first_of] = np.maximum.reduceat(share, in_row)
        put["same"][:] = np.bincount(w.row, same, rows) / some
        put["bare"][:] = np.bincount(w.row, bare, rows) / some
        breaks = np.flatnonzero(~same)
        runs = np.diff(np.append(breaks, len(same)))
        put["longest_run"][first_of] = np.log(np.maximum.reduceat(runs, np.searchsorted(breaks, at)))
        counts, of = _repeats(w.hashes, w.row)
        put["distinct"][:] = np.bincount(of, minlength=rows) / some
        top = np.zeros(rows)
        np.maximum.at(top, of, counts)
        put["commonest"][:] = top / some
        pairs, where = w.shingles(2)
        _, of = _repeats(pairs, w.row[where])
        put["pairs_again"][:] = 1 - np.bincount(of, minlength=rows) / np.maximum(n - 1, 1)
        put["pairs_again"][n < 2] = 0
    return out


def _repeats(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each distinct value of a row occurs, and its row."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (r[1:] != r[:-1]))))
    return np.diff(np.append(new, len(v))), r[new]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``_stats`` (array of STATISTICS) of every whole ``text``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(batch.column(text))
        width = len(STATISTICS)
        stats = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, width), pa.int32()), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([*batch.columns, stats], [*batch.schema.names, "_stats"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, run, f"{fields}, _stats array<double>")


# --- trees, rules, lasso -------------------------------------------------------------------

#: (statistic, above, threshold): statistic > threshold if above, else <=.
Test = tuple[int, bool, float]


@dataclass(frozen=True)
class Model:
    """Rules (conjunctions of tests) with weights; the score is the logistic function of bias plus weights that apply."""

    rules: tuple[tuple[Test, ...], ...]
    weights: tuple[float, ...]
    bias: float


def _best_split(codes: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int] | None:
    """(gain, statistic, code) of the best split of a node: codes up to the code go left."""
    best = None
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for j in range(codes.shape[1]):
        gl = np.cumsum(np.bincount(codes[:, j], g, CUTS + 1))[:-1]
        hl = np.cumsum(np.bincount(codes[:, j], h, CUTS + 1))[:-1]
        nl = np.cumsum(np.bincount(codes[:, j], minlength=CUTS + 1))[:-1]
        gr, hr, nr = g.sum() - gl, h.sum() - hl, len(g) - nl
        gain = np.where((nl >= LEAST) & (nr >= LEAST), gl**2 / (hl + 1.0) + gr**2 / (hr + 1.0) - whole, -1.0)
        at = int(gain.argmax())
        if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
            best = (float(gain[at]), j, at)
    return best


def tree_paths(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[tuple[Test, ...]]:
    """Paths to all nodes of boosted trees for the logistic loss, without repeats."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.01, 0.99, CUTS), method="nearest")) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1)
    level = np.full(len(y), np.log((weight * y).sum() / (weight * (1 - y)).sum()))
    found: dict[tuple[Test, ...], None] = {}

    def grow(rows: np.ndarray, path: tuple[Test, ...], g: np.ndarray, h: np.ndarray) -> None:
        if path:
            # comparisons of one statistic in one direction collapse to the strictest
            strict: dict[tuple[int, bool], float] = {}
            for j, above, t in path:
                old = strict.get((j, above))
                strict[j, above] = t if old is None else (max if above else min)(old, t)
            found[tuple(sorted((j, a, t) for (j, a), t in strict.items()))] = None
        split = _best_split(codes[rows], g[rows], h[rows]) if len(path) < DEPTH and len(rows) >= 2 * LEAST else None
        if split is None or split[2] >= len(cuts[split[1]]):
            level[rows] += RATE * g[rows].sum() / (h[rows].sum() + 1.0)
            return
        _, j, at = split
        left = codes[rows, j] <= at
        grow(rows[left], (*path, (j, False, float(cuts[j][at]))), g, h)
        grow(rows[~left], (*path, (j, True, float(cuts[j][at]))), g, h)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-level.clip(-30, 30)))
        grow(np.arange(len(y)), (), weight * (y - p), weight * p * (1 - p) + 1e-9)
    return list(found)


def applies(rules: list[tuple[Test, ...]], x: np.ndarray) -> np.ndarray:
    """Which rule (column) holds for which row."""
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for j, above, t in rule:
            out[:, k] *= (x[:, j] > t) if above else (x[:, j] <= t)
    return out


def lasso(a: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with an absolute penalty, by accelerated proximal steps."""
    weight = weight / weight.sum()
    center, spread = weight @ a, np.sqrt(np.maximum(weight @ a**2 - (weight @ a) ** 2, 0))
    spread = np.maximum(spread, 0.02)
    z = (a - center) / spread
    step = 4.0 / max(np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2 + 1.0, 1e-9)
    w, b = np.zeros(a.shape[1]), float(np.log((weight @ y) / (weight @ (1 - y))))
    seen_w, seen_b, t = w, b, 1.0
    for _ in range(STEPS):
        e = weight * (1 / (1 + np.exp(-(z @ seen_w + seen_b).clip(-30, 30))) - y)
        moved = seen_w - step * (z.T @ e)
        new_w, new_b = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0), seen_b - step * e.sum()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        seen_w, seen_b = new_w + (last - 1) / t * (new_w - w), new_b + (last - 1) / t * (new_b - b)
        done = np.abs(new_w - w).max(initial=0) < 1e-7
        w, b = new_w, new_b
        if done:
            break
    return w / spread, b - float((w / spread) @ center)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Model:
    """Trees, rules and lasso weights for statistics ``x`` and labels 0 or 1; one label gives its constant, none gives a half."""
    weight = np.ones(len(y)) if weight is None else weight
    if not len(y) or y.min() == y.max():
        return Model((), (), 0.0 if not len(y) else (5.0 if y[0] else -5.0))
    paths = tree_paths(x, y.astype(float), weight)
    a = applies(paths, x)
    # rules that hold for the same texts are one
    _, first = np.unique(np.packbits(a.astype(bool), axis=0), axis=1, return_index=True)
    paths = [paths[i] for i in sorted(first)]
    w, bias = lasso(applies(paths, x), y.astype(float), weight)
    kept = np.flatnonzero(w)
    return Model(tuple(paths[i] for i in kept), tuple(float(w[i]) for i in kept), float(bias))


def compiled(model: Model, stats: Column) -> Column:
    """The score as a column expression over an array of statistics."""

    def holds(rule: tuple[Test, ...]) -> Column:
        out = F.lit(True)
        for j, above, t in rule:
            value = F.get(stats, F.lit(j))
            out = out & ((value > F.lit(t)) if above else (value <= F.lit(t)))
        return out

    total = F.lit(model.bias)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def training_sample(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """(quality, key, _stats) of at most SAMPLE documents of each label, by the order of a hash.

    Null ids and labels other than 0 and 1 stay out. Only the sampled ids (at most 2 * SAMPLE) are broadcast, and only
    statistics leave the tasks.
    """
    key = F.xxhash64(F.col("doc_id"), F.lit("quality sample"))
    marked = labels.where(allowed & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.select("doc_id", F.col("quality").cast("int").alias("quality"), key.alias("key"))
    picked = [marked.where(F.col("quality") == y).orderBy("key", "doc_id").limit(SAMPLE) for y in (0, 1)]
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked[0].union(picked[1])), "doc_id")
    return with_statistics(chosen.select("quality", "key", "text")).drop("text")


def learn(docs: DataFrame, labels: DataFrame, allowed: Column) -> Model:
    """Fit the ensemble on a bounded sample; a label weighs as much as it has rows among all ``allowed`` ones."""
    counts = {r["quality"]: r["count"] for r in labels.where(allowed & F.col("quality").isin(0, 1)).groupBy("quality").count().collect()}
    rows = sorted(training_sample(docs, labels, allowed).collect(), key=lambda r: (r["key"], r["quality"], tuple(r["_stats"])))
    x = np.array([r["_stats"] for r in rows]).reshape(-1, len(STATISTICS))
    y = np.array([r["quality"] for r in rows], dtype=int)
    have = np.bincount(y, minlength=2)
    weight = np.array([counts[v] / have[v] for v in y]) if len(y) else np.zeros(0)
    return fit(x, y, weight / weight.mean() if len(y) else weight)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``quality``: 0 to 1, higher for better texts, from the statistics of the whole ``text``.

    Null, empty and blank texts have statistics of zero and the score that the rules give those. A column called quality
    is replaced.
    """
    docs = docs.drop("quality")
    row = F.struct(*docs.columns).alias("_row")
    found = with_statistics(docs.select(F.col("text").alias("_text"), row), "_text")
    return found.select("_row.*", F.round(compiled(model, F.col("_stats")), 6).alias("quality"))
