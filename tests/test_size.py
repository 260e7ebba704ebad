"""Steps that must not carry more rows or columns than their results need."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_queries import SF

from lakespark import fixtures
from lakespark.operators import dedupe, grids, nearest, quantiles, stats
from lakespark.queries import load
from lakespark.queries.base import native

QUERIES, _ = load()


def test_series_of_one_lake_reads_that_lake(spark, monkeypatch):
    seen, whole = [], stats.lake_window_stats
    monkeypatch.setattr(stats, "lake_window_stats", lambda df: seen.append(df) or whole(df))
    QUERIES["o04_lake_timeseries"](spark, SF)
    assert [r.Hylak_id for r in seen[0].select("Hylak_id").distinct().collect()] == [5]


def test_dedupe_carries_only_what_is_asked(spark):
    df = native(spark, SF)
    few = dedupe.dedupe_locations(df, ["CI"])
    assert len(few.columns) == 9
    assert few.exceptAll(dedupe.dedupe_locations(df).select(few.columns)).isEmpty()


def test_wide_stages_run_in_methods_that_the_jvm_compiles(spark):
    QUERIES["q01_q06_native_qa"](spark, SF)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_values_of_bounded_groups_are_not_counted_in_buckets(spark, monkeypatch):
    """Groups that fit one row need no passes over buckets."""
    monkeypatch.setattr(quantiles, "_quantiles", lambda *args: pytest.fail("counted in buckets"))
    assert stats.lake_window_stats(native(spark, SF)).count() > 0


@pytest.mark.parametrize("whole", [0, 40, 1 << 15])
@pytest.mark.parametrize("uses", [None, ["x", "y"]])
def test_groups_on_both_sides_of_the_bound_agree(spark, monkeypatch, whole, uses):
    monkeypatch.setattr(quantiles, "WHOLE", whole)
    rows = [(k if k else None, float(i * 37 % 101) if i % 7 else None, float("inf") if i == 3 else -i / 8) for k in range(4) for i in range(1 + 30 * k)]
    rows += [(9, None, float("nan"))] * 2
    df = spark.createDataFrame(rows, "g int, x double, y double")
    metrics = {"x": F.col("x"), "y": F.col("y")}
    wanted = {"x1": ("x", 0.1), "x5": ("x", 0.5), "y9": ("y", 0.9)}
    count = F.count(F.lit(1)).alias("rows")
    found = quantiles.summarize(df, ["g"], metrics, wanted, [count], quantiles.DOUBLE_LADDER, uses)
    assert found.columns == ["g", "rows", "x1", "x5", "y9"]
    due = {}
    for g in {r[0] for r in rows}:
        x = [r[1] for r in rows if r[0] == g and r[1] is not None]
        y = [r[2] for r in rows if r[0] == g and r[2] == r[2]]
        at = [np.quantile(v, p) if v else None for v, p in ((x, 0.1), (x, 0.5), (y, 0.9))]
        due[g] = (sum(r[0] == g for r in rows), *at)
    got = {r.g: tuple(r)[1:] for r in found.collect()}
    assert got.keys() == due.keys()
    for g in due:
        assert got[g] == pytest.approx(due[g], nan_ok=True)


def test_cells_with_a_pixel_close_to_their_centre_meet_no_others(spark, monkeypatch):
    """Only cells without one search the whole reach, and both ways choose the same pixel."""
    pixels = fixtures.pixels(spark, SF).where("scene_id < 2")
    few = pixels.where("latitude < 40.2").select("scene_id", "obs_id", "latitude", "longitude", "rhos_665")
    grid = grids.raster_grid(few, 300.0)
    cells = grids.raster_cells(grid)
    due = nearest.swath_to_grid(cells, few, ["rhos_665"])
    searched, whole = [], nearest.nearest_on_sphere
    monkeypatch.setattr(nearest, "nearest_on_sphere", lambda t, *args, **kw: searched.append(t) or whole(t, *args, **kw))
    found = nearest.swath_to_grid(cells, few, ["rhos_665"], grid=grid)
    assert searched[0].count() < cells.count() == found.count()
    names = ["scene_id", "row", "col", "obs_id", "rhos_665"]
    assert found.select(names).exceptAll(due.select(names)).isEmpty()


def test_pixels_of_another_turn_are_not_placed_in_cells(spark):
    """Longitudes over more than one turn: the nearest pixel may have a number 360 degrees away."""
    rows = [(0, 1, 40.0, -170.0, 1.0), (0, 2, 40.001, 190.0005, 2.0), (0, 3, 40.002, 191.0, 3.0)]
    df = spark.createDataFrame(rows, "scene_id long, obs_id long, latitude double, longitude double, v double")
    grid = grids.raster_grid(df, 50000.0)
    cells = grids.raster_cells(grid)
    a, b = (nearest.swath_to_grid(cells, df, ["v"], grid=g).select("row", "col", "obs_id") for g in (grid, None))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()
