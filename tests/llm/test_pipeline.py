"""The pipeline as a whole, and its stages on odd rows."""

from odd_rows import edges, nothing  # noqa: F401

import corpus_pipeline as cp
from lakespark.llm import decontam, mixing, neardup, secrets

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    out = {r.doc_id: r for r in cp.run(spark, SF).collect()}
    ids = {r.doc_id for r in docs.collect()}
    groups = {r.doc_id: r for r in neardup.near_duplicates(docs, k=5).collect()}
    bad = {r.doc_id for r in decontam.contamination(docs, bench).collect()}
    # all documents here have a language
    want = {i for i in ids if groups[i].kept and i not in bad}
    assert set(out) == want
    clean = secrets.redact(docs.where(docs.doc_id.isin(*want)))
    mixed = mixing.mix(clean)
    again = {r.doc_id: (r.size, r.taken) for r in mixed.select("doc_id", "size", mixing.taken(mixed).alias("taken")).collect()}
    assert {i: (r["size"], r.taken) for i, r in out.items()} == again


def test_stages_keep_columns_and_odd_rows(spark, edges, nothing):
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, edges, SF)
        assert out.columns == edges.columns, name
        assert out.count() > 0
        assert stage(spark, nothing, SF).count() == 0
    assert sorted(str(r.doc_id) for r in cp.drop_near_duplicates(spark, edges, SF).collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, 9, None]))
    assert cp.redact_secrets(spark, edges, SF).count() == 10
    assert cp.mix_sources(spark, edges, SF).count() == 10
