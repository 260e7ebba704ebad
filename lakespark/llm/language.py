"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakespark.llm import recurrent as rn
from lakespark.llm.common import _FOLD, flat, map_arrow

UNITS = 6
#: Bounds of the training sample: strata by hash for each language, and passages of each stratum.
STRATA, PER_STRATUM = 32, 24
PASSAGE = 96
STEPS, ROWS = 140, 192
#: Bytes that one step reads; their positions share its label.
PAIR = 2
#: Bytes that a window labels, and bytes of context read on either side.
WINDOW, CONTEXT = 192, 12
UNDETERMINED = "und"


def training_sample(docs: DataFrame, allowed: Column) -> DataFrame:
    """(lang, passage) of at most STRATA * PER_STRATUM documents of each language.

    The documents are those of the lowest hashes in each stratum, the passage starts at a
    hashed place. Rows with a null text or lang, or for which ``allowed`` is not true, stay out.
    """
    key = F.xxhash64(F.col("doc_id"), F.lit("language sample"))
    start = F.pmod(key, F.greatest(F.length("text") - PASSAGE, F.lit(1))).cast("int") + 1
    rows = docs.where(allowed & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "lang", F.substring("text", start, F.lit(PASSAGE)).alias("passage"), key.alias("key")
    )
    order = Window.partitionBy("lang", F.pmod(F.shiftright("key", 20), F.lit(STRATA))).orderBy("key", "passage")
    return rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= PER_STRATUM).drop("at")


def _one_hot_rows(labels: np.ndarray, k: int) -> np.ndarray:
    return np.eye(k, dtype=np.float32)[labels]


def fit(passages: list[str], langs: list[str], seed: int = 7) -> dict:
    """Train on labelled passages; every position of a passage is to be labelled with its language."""
    names = sorted(set(langs))
    model: dict = {"names": names}
    if not names:
        return model
    rng = np.random.default_rng(seed)
    data = np.zeros((len(passages), PASSAGE), np.uint8)
    for i, p in enumerate(passages):
        raw = np.frombuffer(p.encode()[:PASSAGE], np.uint8)
        data[i, : len(raw)] = _FOLD[raw]
    y = np.array([names.index(x) for x in langs])
    k, n = len(names), UNITS
    params = {"head": rn.scaled(rng, 2 * n, k), "bias": np.zeros(k, np.float32)}
    for side in "fb":
        params |= {f"E{side}": 0.3 * rn.scaled(rng, 1, PAIR * 256 * 3 * n).reshape(PAIR * 256, 3 * n), f"U{side}": rn.scaled(rng, n, 3 * n), f"c{side}": np.zeros(3 * n, np.float32)}
    # byte j of a step looks up its own part of the table
    data = data.reshape(len(data), PASSAGE // PAIR, PAIR) + (np.arange(PAIR) * 256)
    adam = rn.Adam(params, 0.03)
    by_lang = [np.flatnonzero(y == j) for j in range(k)]
    for step in range(STEPS):
        # languages take turns, so that a rare one counts as much as a common one
        pick = np.concatenate([rng.choice(x, -(-ROWS // k)) for x in by_lang])
        x = data[pick].transpose(1, 0, 2)
        used = (x[..., :1] > 0)
        out, kept = {}, {}
        for side in "fb":
            out[side], kept[side] = rn.forward(params[f"E{side}"][x].sum(axis=2), params[f"U{side}"], params[f"c{side}"], side == "b")
        both = np.concatenate((out["f"], out["b"]), axis=2)
        error = (rn.softmax(both @ params["head"] + params["bias"]) - _one_hot_rows(y[pick], k)) * used / max(1, used.sum())
        grads = {"head": np.einsum("tbh,tbk->hk", both, error), "bias": error.sum(axis=(0, 1))}
        d = error @ params["head"].T
        for side, part in (("f", d[..., :n]), ("b", d[..., n:])):
            dG, grads[f"U{side}"], grads[f"c{side}"] = rn.backward(part, kept[side], params[f"U{side}"])
            table = np.zeros((PAIR * 256, 3 * n), np.float32)
            for j in range(PAIR):
                np.add.at(table, x[..., j].ravel(), dG.reshape(-1, 3 * n))
            grads[f"E{side}"] = table
        adam.step(grads, 1.0 if step < 0.7 * STEPS else 0.2)
    return model | params


def pooled(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean over all byte positions of the label probabilities: a row for each text."""
    n_rows, k = len(offsets) - 1, len(model["names"])
    lengths = np.diff(offsets)
    windows = -(-lengths // WINDOW)
    row = np.repeat(np.arange(n_rows), windows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = offsets[:-1][row] + nth * WINDOW
    sums = np.zeros((n_rows, k))
    span = WINDOW + 2 * CONTEXT
    padded = np.concatenate((np.zeros(CONTEXT, np.uint8), _FOLD[data], np.zeros(span, np.uint8)))
    # row i: the bytes from CONTEXT before place i of the data
    views = np.lib.stride_tricks.sliding_window_view(padded, span)
    head = {"f": np.ascontiguousarray(model["head"][:UNITS].T), "b": np.ascontiguousarray(model["head"][UNITS:].T)}
    tables = {}
    for side in "fb":
        E = rn.halved(model[f"E{side}"])
        tables[side] = (E[256:, None, :] + E[None, :256, :]).reshape(65536, 3 * UNITS)
    inside = WINDOW // PAIR
    for a in range(0, len(row), 1024):
        r, s = row[a : a + 1024], start[a : a + 1024]
        left = (offsets[r + 1] - s).clip(max=WINDOW + CONTEXT)
        # all windows have equally many steps, so a text's labels do not depend on its neighbours
        x = views[s]
        edge = np.flatnonzero((s - CONTEXT < offsets[r]) | (left < WINDOW + CONTEXT))
        place = np.arange(-CONTEXT, WINDOW + CONTEXT)
        x[edge] *= (place >= (offsets[r] - s)[edge, None]) & (place < left[edge, None])
        x = np.ascontiguousarray(x.view("<u2").T).astype(np.intp)
        room = np.empty((len(r), 3 * UNITS), np.float32)
        p, inner = 0.0, slice(CONTEXT // PAIR, CONTEXT // PAIR + inside)
        for side in "fb":
            h = rn.states(
                lambda t, E=tables[side]: np.take(E, x[t], axis=0, out=room, mode="clip").T,
                len(x), len(r), model[f"U{side}"], model[f"c{side}"], side == "b",
            )
            p = p + np.matmul(head[side], h[inner])
        p += model["bias"][:, None]
        np.exp(p, out=p)
        # a step stands for the one or two bytes that it read of the text
        weight = (left - PAIR * np.arange(inside)[:, None]).clip(0, PAIR).astype(np.float32)
        p *= weight[:, None, :] / p.sum(axis=1, keepdims=True)
        total = p.sum(axis=0)
        for j in range(k):
            sums[:, j] += np.bincount(r, total[j], n_rows)
    return sums / np.maximum(lengths, 1)[:, None]


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text alone.

    A null text, an empty one and one without a letter get ``und`` and 0; so does every
    text if the model has learned no language. Columns called lang_pred or score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    schema = f"{_ddl(docs)}, lang_pred string, score double"
    if not model["names"]:
        return docs.select("*", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = np.array(model["names"], dtype=object)

    def label(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(batch.column("text"))
        p = pooled(model, data, offsets)
        best = p.argmax(axis=1)
        columns = [*batch.columns, pa.array(names[best], pa.string()), pa.array(np.clip(np.round(p.max(axis=1), 6), 0, 1))]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    found = map_arrow(docs, label, schema)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.withColumns(
        {
            "lang_pred": F.when(lettered, F.col("lang_pred")).otherwise(UNDETERMINED),
            "score": F.when(lettered, F.col("score")).otherwise(0.0),
        }
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def learn(docs: DataFrame, allowed: Column) -> dict:
    """Draw the bounded sample and fit the network on it."""
    rows = training_sample(docs, allowed).collect()
    rows.sort(key=lambda r: (r["lang"], r["key"], r["passage"]))
    return fit([r["passage"] for r in rows], [r["lang"] for r in rows])
