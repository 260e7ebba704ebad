"""The nearest join in home cubes: few exchanges, narrow ones, and the same pixels as a search of everything."""

import pytest
from pyspark.sql import functions as F
from test_queries import SF

from lakespark import fixtures as fx
from lakespark.operators import grids, nearest
from lakespark.queries import load

QUERIES, _ = load()


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("name", ["j12_same_lake_nearest", "j13_same_lake_nearest_mercator"])
def test_targets_are_not_exchanged(spark, name):
    """Target cells come into being where their pixels are; neither they nor coordinates of pixels on the sphere travel."""
    dealt = [e for e in exchanges(QUERIES[name](spark, SF)) if "_home" in e]
    assert len(dealt) == 2
    assert not [e for e in exchanges(QUERIES[name](spark, SF)) if "row#" in e or "_cx#" in e]


@pytest.mark.parametrize("cell", [0.003, 0.01, 0.08])
def test_targets_at_home_find_what_a_search_of_all_pixels_finds(spark, cell):
    p = fx.pixels(spark, SF).where("scene_id < 3").select("scene_id", "Hylak_id", "obs_id", "latitude", "longitude").cache()
    grid, lakes, pairs = grids.geographic_grid(p, 300.0), fx.lakes(spark, SF), grids.scene_lake_pairs(p)
    plain = grids.lake_target_cells(pairs, lakes, grid, cell=cell)
    homed = grids.lake_target_cells(pairs, lakes, grid, cell=cell, radius_m=600.0)
    off = grids.off_middle(grids.math.radians(cell))
    found = nearest.same_lake_nearest(homed, p, 600.0, grids.TARGET_ID, off).select(*grids.TARGET_ID, "obs_id")
    due = nearest.nearest_on_sphere(plain, p, 600.0, grids.TARGET_ID).select(*grids.TARGET_ID, "obs_id")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, due.collect()), key=str)


def test_nearest_over_the_dateline_and_at_a_pole(spark):
    rows = [(0, 7, 1, 10.0, 179.9995), (0, 7, 2, 10.0, -179.99), (0, 7, 3, 89.9999, 10.0), (0, 7, 4, 89.0, -170.0)]
    p = spark.createDataFrame(rows, "scene_id long, Hylak_id long, obs_id long, latitude double, longitude double")
    cells = [(0, 7, 0, 10.0, -179.9996), (0, 7, 1, 89.9999, -170.0), (0, 7, 2, 50.0, 0.0), (0, 7, 3, None, 0.0)]
    t = spark.createDataFrame(cells, "scene_id long, Hylak_id long, cell long, latitude double, longitude double")
    got = nearest.same_lake_nearest(t, p, 600.0, ["scene_id", "Hylak_id", "cell"])
    assert {r.cell: r.obs_id for r in got.collect()} == {0: 1, 1: 3, 2: None, 3: None}


def test_science_values_travel_narrow(spark):
    """One array and one number instead of a column for each of the values and masks."""
    plan = QUERIES["j16_complete_science_grid"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "_floats" in plan and "_bits" in plan


def test_lakes_without_a_scale_keep_their_targets(spark, two_lakes):
    rows = [(0, 1, 1, 40.003, -85.006), (0, 2, 2, None, None)]
    p = spark.createDataFrame(rows, "scene_id long, Hylak_id long, obs_id long, latitude double, longitude double")
    found = grids.mercator_matches(p, two_lakes, 300.0)
    seen = {r.Hylak_id: r.n for r in found.groupBy("Hylak_id").agg(F.count("obs_id").alias("n")).collect()}
    assert seen[1] > 0
