"""The rule ensemble: statistics against brute force, held-out accuracy, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from odd_rows import docs, edges, nothing  # noqa: F401

from lakespark.llm import quality, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def brute(text):
    """The statistics of one text, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    raw = re.findall(r"[^\x20\x09-\x0D]+", text)
    data, n = text.encode(), max(len(words), 1)
    letter = lambda b: b > 127 or chr(b).isalpha()
    same = [i > 0 and words[i] == words[i - 1] for i in range(len(words))]
    runs, run = [], 0
    for s in same:
        run = run + 1 if s else 1
        runs.append(run)
    marks = [w.encode()[-1] in b"#$%&*!|@~^_=<>\\{}[]`+/" for w in raw]
    upper = [len(w.encode()) > 1 and 65 <= w.encode()[1] <= 90 for w in raw]
    bare = [not any(letter(b) or chr(b).isdigit() for b in w.encode()) for w in raw]
    most = lambda flag: max((sum(flag[i : i + 32]) / max(16, len(flag[i : i + 32])) for i in range(0, len(flag), 32)), default=0)
    return [
        math.log1p(len(data)), sum(len(w.encode()) for w in raw) / n, sum(65 <= b <= 90 for b in data) / max(1, sum(map(letter, data))),
        sum(48 <= b <= 57 for b in data) / max(1, len(data)), sum(b in b"#$%&*!|@~^_=<>\\{}[]`+/" for b in data) / n, sum(b in b".,;:?'\"()-" for b in data) / n,
        sum(b > 127 for b in data) / max(1, len(data)), data.count(b"\n") / n, len(set(words)) / n, sum(same) / n,
        math.log(max(runs, default=1)), max(Counter(words).values(), default=0) / n, sum(bare) / n,
        1 - len(set(zip(words, words[1:]))) / (len(words) - 1) if len(words) > 1 else 0, most(marks), most(upper), most(same), most(bare),
    ]


def test_statistics_equal_brute_force(docs):
    texts = [r.text for r in docs.collect()] + [None, "", " \n", "a", "A!! B!! !! 12 | é", "x" * 70_000, "the the the " * 40]
    got = quality.statistics(pa.array(texts, pa.string()))
    assert np.allclose(got, [brute(t) for t in texts], atol=1e-12)


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op12_quality_rules"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    for label in (0, 1):
        of = [r.predicted == label for r in held if labels[r.doc_id] == label]
        assert sum(of) / len(of) > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    allowed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    turned = labels.withColumn("quality", F.when(allowed, F.col("quality")).otherwise(1 - F.col("quality")))
    assert quality.learn(docs, labels, allowed) == quality.learn(docs, turned, allowed)


def test_rules_are_sparse_and_compiled_as_fitted(spark):
    rng = np.random.default_rng(1)
    x = rng.random((1500, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.4) & (x[:, 5] <= 0.7)).astype(int)
    model = quality.fit(x, y)
    rules = list(model.rules)
    assert 0 < len(rules) < 60 and {j for r in rules for j, _, _ in r} >= {3, 5}
    expected = 1 / (1 + np.exp(-(quality.applies(rules, x) @ np.array(model.weights) + model.bias)))
    assert ((expected > 0.5) == y).mean() > 0.98
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:200])], "i int, s array<double>")
    got = [r.p for r in df.select("i", quality.compiled(model, F.col("s")).alias("p")).orderBy("i").collect()]
    assert np.allclose(got, expected[:200])


def test_lasso_meets_its_conditions():
    """At the optimum the gradient equals the penalty where a weight is kept, and does not pass it elsewhere."""
    rng = np.random.default_rng(2)
    a = (rng.random((800, 12)) < 0.4).astype(float)
    y = (rng.random(800) < 1 / (1 + np.exp(-(2 * a[:, 0] - 3 * a[:, 1] + 0.5)))).astype(float)
    weight = np.ones(800) / 800
    w, b = quality.lasso(a, y, weight, 0.02)
    spread = np.maximum(a.std(axis=0), 0.02)
    grad = (a / spread).T @ (weight * (1 / (1 + np.exp(-(a @ w + b))) - y))
    kept = w != 0
    assert kept[:2].all() and not kept.all()
    assert np.allclose(grad[kept], -0.02 * np.sign(w[kept]), atol=1e-4) and (np.abs(grad[~kept]) < 0.0201).all()


@pytest.mark.parametrize("kind", ["none", "one", "both"])
def test_odd_rows(spark, edges, nothing, docs, kind):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").withColumn("text", F.lit("clash"))
    odd = spark.createDataFrame([(None, 1, 0, "x"), (1, None, 0, "x"), (2, 7, 0, "x")], "doc_id long, quality int, toxic int, text string")
    labels = {"none": odd, "one": labels.where("quality = 1"), "both": labels.unionByName(odd)}[kind]
    model = quality.learn(docs, labels, F.lit(True))
    out = quality.score(edges.withColumns({"quality": F.lit("a"), "_stats": F.lit(1), "_text": F.lit(2)}), model)
    rows = out.collect()
    assert len(rows) == 10 and out.columns == [*edges.columns, "_stats", "_text", "quality"]
    assert all(0 <= r.quality <= 1 for r in rows)
    assert len({r.quality for r in rows if r.doc_id in (2, 3)}) == 1
    if kind == "none":
        assert {r.quality for r in rows} == {0.5}
    assert quality.score(nothing, model).count() == 0
