"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

Each word enters with a word input (an embedding of the vocabulary, and its log-odds between
the labels) and a character input (the mean embedding of its letter triples). A text
is read in overlapping windows, and its score is that of its worst window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.llm import recurrent as rn
from lakespark.llm.common import PUNCTUATION, Words, map_arrow

UNITS, LETTERS = 8, 8
#: Words of a window, and words from one window to the next.
WINDOW, STRIDE = 32, 16
#: Bounds of the training sample: documents of each label, and characters of the passage taken of a clean and of a toxic one.
SAMPLE, PASSAGE = 1500, (5000, 60_000)
#: Folds of the sample: the log-odds that a document is trained with are counted without its own fold.
FOLDS = 5
#: Documents of the sample that must hold a word of the vocabulary.
SEEN = 10
#: Documents that are added to both labels before the log-odds of a word.
PRIOR = 8
TRIPLES = 4096
STEPS, DOCS = 320, 32


def training_sample(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """(text, toxic) of at most SAMPLE documents of each label, by the order of a hash.

    Only ids travel before the bound is reached. Null labels, ids and texts stay out. Of a text longer than PASSAGE
    a passage of that length at a hashed place is taken; a text that occurs repeatedly is taken once.
    """
    key = F.xxhash64(F.col("doc_id"), F.lit("toxicity sample"))
    marked = labels.where(allowed & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"), key.alias("key"))
    known = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    picked = [marked.where(F.col("toxic") == y).orderBy("key", "doc_id").limit(SAMPLE) for y in (0, 1)]
    # at most 2 * SAMPLE ids
    found = known.join(F.broadcast(picked[0].union(picked[1])), "doc_id")
    size = F.when(F.col("toxic") == 1, PASSAGE[1]).otherwise(PASSAGE[0])
    start = F.pmod(F.xxhash64("key", F.lit("passage")), F.greatest(F.length("text") - size + 1, F.lit(1))) + 1
    return found.select("key", "toxic", F.when(F.length("text") > size, F.substring("text", start.cast("int"), size)).otherwise(F.col("text")).alias("text"))


def _letters(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triple numbers of all bytes of words, the first of each word, and the lengths of words."""
    inside = np.where(PUNCTUATION[words.data], np.uint8(0), words.data).astype(np.uint32)
    padded = np.concatenate(([0], inside, [0])).astype(np.uint32)
    triple = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA6B) + padded[2:] * np.uint32(0xC2B2AE35)
    triple ^= triple >> np.uint32(15)
    triple *= np.uint32(0x2C1B3C6D)
    lengths = words.ends - words.starts
    inner = np.cumsum(lengths) - lengths
    return (triple >> np.uint32(20))[inside > 0].astype(np.intp), inner, lengths


def _vocabulary(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted word hashes and the number (from 1) of each."""
    order = np.argsort(hashes)
    return hashes[order], (order + 1).astype(np.int32)


def _numbers(model: dict, hashes: np.ndarray) -> np.ndarray:
    if not len(model["keys"]):
        return np.zeros(len(hashes), np.int32)
    at = np.minimum(np.searchsorted(model["keys"], hashes), len(model["keys"]) - 1)
    return np.where(model["keys"][at] == hashes, model["ids"][at], 0)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and first word of all overlapping windows; a row without words has none."""
    counts = np.diff(first)
    n = np.where(counts > 0, 1 + -(-np.maximum(counts - WINDOW, 0) // STRIDE), 0)
    row = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, first[:-1][row] + nth * STRIDE


def fit(texts: list[str], toxic: list[int], seed: int = 11) -> dict | None:
    """Train on documents with labels; None if a label is missing.

    A clean document is clean in every window. Of a toxic one only the window counts
    that scores highest so far (at first the one with the strongest word).
    """
    y = np.array(toxic)
    if len(set(toxic)) < 2:
        return None
    rng = np.random.default_rng(seed)
    parts = [Words(pa.array(texts[i : i + 100], pa.string()), PUNCTUATION) for i in range(0, len(texts), 100)]
    hashes = np.concatenate([w.hashes for w in parts])
    first = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(w.first) for w in parts]))))
    in_text = np.repeat(np.arange(len(texts)), np.diff(first))
    pairs = np.unique(np.stack((hashes, in_text.astype(np.uint64)), axis=1), axis=0)
    vocabulary, at, seen = np.unique(pairs[:, 0], return_inverse=True, return_counts=True)
    doc = pairs[:, 1].astype(int)
    fold = rng.integers(0, FOLDS, len(texts))

    def log_odds(use: np.ndarray) -> np.ndarray:
        """Of every word, counted over the documents ``use``."""
        counted = use[doc]
        bad, have = np.bincount(at, y[doc] * counted, len(vocabulary)), np.bincount(at, counted, len(vocabulary))
        return np.log((bad + PRIOR) / ((y * use).sum() + 2 * PRIOR)) - np.log((have - bad + PRIOR) / (((1 - y) * use).sum() + 2 * PRIOR))

    common = np.argsort(-seen, kind="stable")[: int((seen >= SEEN).sum())]
    model: dict = dict(zip(("keys", "ids"), _vocabulary(vocabulary[common]), strict=True))
    every = [log_odds(np.ones(len(texts))), *(log_odds((fold != f).astype(float)) for f in range(FOLDS))]
    # the first row serves scoring, the others the documents of each fold
    strengths = np.array([np.concatenate(([0.0], x[common])) for x in every], dtype=np.float32)
    strength = strengths[0]

    n = UNITS
    params = {"words": 0.01 * rn.scaled(rng, 1, len(strength) * 3 * n).reshape(-1, 3 * n), "odds": 0.3 * rn.scaled(rng, 1, 3 * n)}
    params |= {"triples": 0.3 * rn.scaled(rng, 1, (TRIPLES + 1) * LETTERS).reshape(-1, LETTERS), "letters": rn.scaled(rng, LETTERS, 3 * n)}
    params |= {"look": rn.scaled(rng, 2 * n, n), "point": rn.scaled(rng, n, 1)[:, 0], "out": rn.scaled(rng, 2 * n, 1)[:, 0], "bias": np.zeros(1, np.float32)}
    for side in "fb":
        params |= {f"U{side}": rn.scaled(rng, n, 3 * n), f"c{side}": np.zeros(3 * n, np.float32)}
    model |= params | {"strength": strength}

    number = np.append(_numbers(model, hashes), 0)
    spelled = [_letters(w) for w in parts]
    triple = np.concatenate([t.astype(np.int16) for t, _, _ in spelled])
    lengths = np.append(np.concatenate([n for _, _, n in spelled]), 0)
    inner = np.cumsum(lengths) - lengths
    row, start = windows(first)
    grid = start[:, None] + np.arange(WINDOW)
    grid[grid >= first[row + 1][:, None]] = len(hashes)
    value = strength[number[grid]].max(axis=1)
    of = np.searchsorted(row, np.arange(len(texts) + 1))
    filled = np.flatnonzero(np.diff(of))
    kinds = [filled[y[filled] == v] for v in (0, 1)]
    if not all(len(x) for x in kinds):
        return None
    adam = rn.Adam(params, 0.02)
    hard = kinds[0]
    for step in range(STEPS):
        if step and step % 55 == 0:
            value = np.concatenate([score_windows(model, w, *windows(w.first)) for w in parts])
            worst = np.maximum.reduceat(value, of[kinds[0]])
            hard = kinds[0][np.argsort(-worst, kind="stable")[: max(1, len(worst) // 10)]]
        chosen, goal = [], []
        for d in rng.choice(kinds[1], DOCS):
            chosen.append(of[d] + int(value[of[d] : of[d + 1]].argmax()))
            goal.append(1.0)
        for d in (*rng.choice(kinds[0], DOCS), *rng.choice(hard, DOCS // 2)):
            chosen += [of[d] + int(value[of[d] : of[d + 1]].argmax()), int(rng.integers(of[d], of[d + 1]))]
            goal += [0.0, 0.0]
        # a word of a clean text stays clean however often it is said
        alone = [int(rng.integers(first[d], first[d + 1])) for d in rng.choice(kinds[0], DOCS // 4)]
        goal += [0.0] * len(alone)
        g = np.concatenate((grid[chosen], np.repeat(np.array(alone)[:, None], WINDOW, axis=1))).T
        place = np.arange(int(lengths[g].max(initial=1)))
        tri = np.where(place < lengths[g][..., None], triple[np.minimum(inner[g][..., None] + place, len(triple) - 1)], TRIPLES)
        ids = number[g]
        odds = strengths[1 + fold[np.concatenate((row[chosen], in_text[alone])).astype(int)], ids]
        weight = (tri < TRIPLES).astype(np.float32)
        weight /= np.maximum(weight.sum(axis=2, keepdims=True), 1)
        mean = np.einsum("tbld,tbl->tbd", params["triples"][tri], weight)
        gates = params["words"][ids] + odds[..., None] * params["odds"][0] + mean @ params["letters"]
        used = g < len(hashes)
        gates *= used[..., None]
        out, kept = {}, {}
        for side in "fb":
            out[side], kept[side] = rn.forward(gates, params[f"U{side}"], params[f"c{side}"], side == "b")
        h = np.concatenate((out["f"], out["b"]), axis=2)
        look = rn.squash(h @ params["look"])
        share = rn.softmax(np.where(used, look @ params["point"], -30).T).T[..., None]
        pooled = (share * h).sum(axis=0)
        e = (1 / (1 + np.exp(-(pooled @ params["out"] + params["bias"]))) - np.array(goal, np.float32)) / len(goal)
        grads = {"out": pooled.T @ e, "bias": e.sum(keepdims=True)}
        dp = e[:, None] * params["out"]
        ds = (h * dp).sum(axis=2)
        ds = share[..., 0] * (ds - (share[..., 0] * ds).sum(axis=0)) * used
        dl = ds[..., None] * params["point"] * rn.slope(look)
        grads |= {"point": np.einsum("tbn,tb->n", look, ds), "look": np.einsum("tbh,tbn->hn", h, dl)}
        dh = share * dp + dl @ params["look"].T
        dg = 0.0
        for side, part in (("f", dh[..., :n]), ("b", dh[..., n:])):
            d, grads[f"U{side}"], grads[f"c{side}"] = rn.backward(part.astype(np.float32), kept[side], params[f"U{side}"])
            dg = dg + d
        dg *= used[..., None]
        grads["words"] = np.zeros_like(params["words"])
        np.add.at(grads["words"], ids.ravel(), dg.reshape(-1, 3 * n))
        grads["words"][0] = 0
        grads["odds"] = (odds[..., None] * dg).sum(axis=(0, 1))[None]
        grads["letters"] = np.einsum("tbd,tbg->dg", mean, dg)
        grads["triples"] = np.zeros_like(params["triples"])
        np.add.at(grads["triples"], tri.ravel(), ((dg @ params["letters"].T)[:, :, None, :] * weight[..., None]).reshape(-1, LETTERS))
        grads["triples"][TRIPLES] = 0
        adam.step({k: v.astype(np.float32) for k, v in grads.items()}, 1.0 if step < 0.7 * STEPS else 0.2)
    return model


def score_windows(model: dict, words: Words, row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of each window (row, first word)."""
    number = _numbers(model, words.hashes)
    triple, inner, lengths = _letters(words)
    mean = np.empty((len(number) + 1, LETTERS), np.float32)
    if len(number):
        mean[:-1] = np.add.reduceat(model["triples"][triple], inner, axis=0)
        mean[:-1] /= lengths[:, None]
    table = np.zeros((len(number) + 1, 3 * UNITS), np.float32)
    table[:-1] = mean[:-1] @ model["letters"]
    table[:-1] += model["words"][number]
    table[:-1] += model["strength"][number][:, None] * model["odds"]
    table = rn.halved(table)
    out = np.empty(len(row), np.float32)
    look = np.ascontiguousarray(model["look"].T)
    for a in range(0, len(row), 1024):
        r, s = row[a : a + 1024], start[a : a + 1024]
        left = words.first[r + 1] - s
        # all windows have equally many steps, so a text's score does not depend on its neighbours
        at = s + np.arange(WINDOW)[:, None]
        used = np.arange(WINDOW)[:, None] < left
        at[~used] = len(number)
        room = np.empty((len(r), 3 * UNITS), np.float32)
        h = np.concatenate(
            [
                rn.states(lambda t: np.take(table, at[t], axis=0, out=room, mode="clip").T, WINDOW, len(r), model[f"U{side}"], model[f"c{side}"], side == "b")
                for side in "fb"
            ],
            axis=1,
        )
        weight = np.exp(np.matmul(model["point"][None, :], rn.squash(np.matmul(look, h)))[:, 0].clip(-30, 30)) * used
        logit = (np.matmul(model["out"][None, :], h)[:, 0] * weight).sum(axis=0) / weight.sum(axis=0) + model["bias"]
        out[a : a + 1024] = 1 / (1 + np.exp(-logit.clip(-30, 30)))
    return out


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with ``toxicity``: the highest window probability of the whole text, 0 to 1.

    A null text, an empty one and one without letters or digits score 0, and so does every text
    without a model. A column called toxicity is replaced.
    """
    docs = docs.drop("toxicity")
    if model is None:
        return docs.withColumn("toxicity", F.lit(0.0))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column("text"), PUNCTUATION)
        row, start = windows(words.first)
        best = np.zeros(batch.num_rows)
        if len(row):
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            best[row[first]] = np.maximum.reduceat(score_windows(model, words, row, start), first)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(best, 6))], [*batch.schema.names, "toxicity"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, run, f"{fields}, toxicity double")


def learn(docs: DataFrame, labels: DataFrame, allowed: Column) -> dict | None:
    """Draw the bounded sample and fit the network on it."""
    rows = sorted(training_sample(docs, labels, allowed).collect(), key=lambda r: (r["key"], r["text"]))
    rows = list({r["text"]: r for r in rows}.values())
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])
