"""Queries against their SQL on tables in which three lakes lie on each other."""

import pytest
from compare import TABLES, connect, differences
from pyspark.sql import functions as F
from test_queries import SF

from lakespark.queries import load

QUERIES, ORACLES = load()
#: Each copy has keys of its own; a thousand suppliers on, a lake has the same outline.
SHIFTS = {
    "supplier": {"s_suppkey": 1000},
    "part": {"p_partkey": 20000},
    "orders": {"o_orderkey": 150000},
    "lineitem": {"l_orderkey": 150000, "l_partkey": 20000, "l_suppkey": 1000},
}
NAMES = [
    "j01_assign_lake",
    "j02_inside_eroded",
    "q01_a01_from_geometry",
    "r07_ingest_native",
    "s07_reference_cells",
    "j15_regularize",
    "j16_complete_science_grid",
    "a11_pair_coverage",
    "a12_pair_metrics",
    "a13_pair_metrics_full",
    "a14_binned_medians",
    "j17_compare_native_first",
    "j17_compare_strict_basis",
    "j18_compare_qa_first",
    "j03_candidate_counts",
    "j07_lakes_for_window",
    "j10_inside_any_lake",
    "j12_same_lake_nearest",
    "j14_dedupe_targets",
    "s13_grid_roundtrip",
]


@pytest.fixture(scope="module")
def piled(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("piled"))
    for t in TABLES:
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t in SHIFTS:
            copies = df.withColumn("_k", F.explode(F.array(*map(F.lit, range(3)))))
            df = copies.withColumns({c: F.col(c) + F.col("_k") * by for c, by in SHIFTS[t].items()}).drop("_k")
        df.coalesce(1).write.parquet(f"{root}/{t}.parquet")
    return root


@pytest.mark.parametrize("name", NAMES)
def test_overlapping_lakes(spark, piled, name):
    con = connect(SF)
    for t in TABLES:
        con.execute(f"create or replace view {t} as select * from '{piled}/{t}.parquet/*.parquet'")
    assert differences(QUERIES[name](spark, piled), con, ORACLES[name]) is None


def test_windows_of_equal_footprints(spark):
    from lakespark import fixtures as fx
    from lakespark.operators.membership import scene_candidate_lakes
    from lakespark.plans.windows import plan_scene_windows, plan_windows

    root = SF
    scenes, lakes = fx.scenes(spark, root).where("scene_id < 400"), fx.lakes(spark, root)
    pairs = scene_candidate_lakes(scenes, lakes).join(lakes.select("Hylak_id", "polygons"), "Hylak_id")
    options = {"margin_km": 0.3, "full_fraction": 0.6}
    each = plan_windows(scenes, pairs, **options)
    once = plan_scene_windows(scenes, lakes, **options).select(each.columns)
    assert sorted(map(str, once.collect())) == sorted(map(str, each.collect()))


def test_scenes_meet_lakes_without_an_exchange_of_scenes(spark, two_lakes):
    """The step that gives shapes' pairs to scenes must copy the pairs, not exchange the scenes."""
    from lakespark.operators.membership import scene_candidate_lakes

    scenes = two_lakes.select(F.col("Hylak_id").alias("scene_id"), F.col("polygons").alias("footprint"))
    met = scene_candidate_lakes(scenes, two_lakes)
    assert "Exchange hashpartitioning" not in met._jdf.queryExecution().executedPlan().toString()
    assert met.count() == 4
