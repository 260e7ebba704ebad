"""Covers of polygons against the plain even-odd rule over all edges."""

import math
import random

import pytest
from conftest import box
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespark.functions import geo
from lakespark.operators import cover, grids, membership
from lakespark.schema import MULTIPOLYGON


def polygons(spark, rows, kind="long"):
    schema = T.StructType([T.StructField("Hylak_id", T.LongType()), T.StructField("lake_order", T.LongType()), T.StructField("polygons", MULTIPOLYGON)])
    return spark.createDataFrame([(i, i, p) for i, p in rows], schema)


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def star(x, y, r, n, rng):
    """A ragged outline, with a hole."""
    at = [(x + rng.uniform(0.5, 1) * r * math.cos(2 * math.pi * k / n), y + rng.uniform(0.5, 1) * r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    hole = [(x + 0.2 * r * math.cos(a), y + 0.2 * r * math.sin(a)) for a in (0, 2, 4)]
    return [[ring(at), ring(hole)]]


def inside(polygon, x, y):
    odd = False
    for part in polygon:
        for r in part:
            for a, b in zip(r, [*r[1:], r[0]]):
                x1, y1, x2, y2 = a["x"], a["y"], b["x"], b["y"]
                if (x - x1) * (y2 - y1) == (x2 - x1) * (y - y1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    return False
                if (y1 > y) != (y2 > y) and ((x - x1) * (y2 - y1) < (x2 - x1) * (y - y1)) == (y2 > y1):
                    odd = not odd
    return odd


@pytest.mark.parametrize("cell", [0.01, 0.3, 5.0])
def test_points_in_ragged_and_round_polygons(spark, cell):
    """Points on round numbers lie on vertices, on level and on upright edges, and level with them."""
    rng = random.Random(4)
    lakes = [(1, box(0, 0, 1, 1)), (2, box(0.5, 0.5, 1.5, 1.0)), (3, [[ring([(2, 0), (3, 0), (3, 1), (2.5, 0.5), (2, 1)])]])]
    lakes += [(k, star(rng.uniform(0, 3), rng.uniform(0, 1), 0.4, 40, rng)) for k in range(4, 9)]
    lakes.append((9, [[ring([(0, 2), (1, 2), (1, 3)])], [ring([(1, 2), (2, 2), (1, 3)])]]))
    points = [(i / 8, j / 8) for i in range(-1, 26) for j in range(-1, 26)] + [(rng.uniform(0, 3), rng.uniform(-0.2, 3.2)) for _ in range(1500)]
    df = spark.createDataFrame([(k, y, x) for k, (x, y) in enumerate(points)], "k long, latitude double, longitude double")
    want = {k: next((i for i, p in lakes if inside(p, x, y)), 0) for k, (x, y) in enumerate(points)}
    assert {r.k: r.Hylak_id for r in membership.assign_lake(df, polygons(spark, lakes), cell=cell).collect()} == want
    some = df.where("k % 3 = 0").select("k", F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    got = {(r.k, r.Hylak_id) for r in cover.containing(some, polygons(spark, lakes), ["k"], ["Hylak_id"]).collect()}
    assert got == {(k, i) for k, (x, y) in enumerate(points) if k % 3 == 0 for i, p in lakes if inside(p, x, y)}


def test_cells_hold_their_own_edges_and_spans_the_rest(spark):
    """A large square: the cover grows with its outline and its rows."""
    df = polygons(spark, [(1, box(0.0, 0.0, 1.0, 1.0))])
    got = membership.polygon_pieces(df, 0.01).collect()
    edged, spans = [p for p in got if p.edges], [p for p in got if not p.edges]
    assert len(edged) <= 4 * 102 and len(spans) == 99
    assert all(p.x1 - p.x0 == 98 for p in spans)
    assert all(len(p.edges) <= 3 and p.x0 == p.x1 for p in edged)


def test_a_lake_of_very_many_vertices_against_a_country(spark):
    rng = random.Random(6)
    n = 100_000
    outline = [(1 + (0.5 + 0.001 * rng.random()) * math.cos(2 * math.pi * k / n), 1 + (0.5 + 0.001 * rng.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    lake = polygons(spark, [(1, [[ring(outline)]]), (2, box(20, 20, 21, 21))])
    country = polygons(spark, [(7, box(-5, -5, 5, 5)), (8, box(1.49, 0.9, 1.6, 1.1)), (9, box(0.9, 0.9, 1.1, 1.1)), (10, box(1.6, 1.6, 2, 2))]).withColumnRenamed("Hylak_id", "region_id")
    pairs = membership.intersecting_pairs(lake, country, ["Hylak_id"], ["region_id"])
    assert {tuple(r) for r in pairs.collect()} == {(1, 7), (1, 8), (1, 9)}
    assert "Exchange" in pairs._jdf.queryExecution().toString()


def test_pairs_equal_the_plain_test(spark):
    rng = random.Random(7)
    a = [(k, star(rng.uniform(0, 4), rng.uniform(0, 4), rng.choice((0.05, 0.3, 1.0)), 12, rng)) for k in range(40)] + [(100, box(0, 0, 4, 4)), (101, box(0, 0, 4, 4))]
    b = [(k, star(rng.uniform(0, 4), rng.uniform(0, 4), rng.choice((0.05, 0.3)), 9, rng)) for k in range(60)] + [(200, box(4, 4, 5, 5)), (201, box(1, 1, 2, 2))]
    left, right = polygons(spark, a), polygons(spark, b).withColumnRenamed("Hylak_id", "b")
    shaped = [membership._shaped(df, [k], side) for df, k, side in ((left, "Hylak_id", "l"), (right, "b", "r"))]
    meet = geo.polygons_intersect(*(F.col(c) for c in ("l_edges", "l_starts", "r_edges", "r_starts")))
    want = {tuple(r) for r in shaped[0].crossJoin(shaped[1]).where(meet).select("l_Hylak_id", "r_b").collect()}
    got = membership.intersecting_pairs(left, right, ["Hylak_id"], ["b"]).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_only_lakes_of_the_own_scene(spark):
    """Where lakes overlap, the first of the scene's candidates has the point; points in no candidate go."""
    lakes = polygons(spark, [(1, box(0, 0, 1, 1)), (2, box(0, 0, 1, 1)), (3, box(2, 2, 3, 3))])
    pairs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "scene_id string, Hylak_id long")
    points = spark.createDataFrame([(s, k, p, p) for s in "abc" for k, p in enumerate((0.5, 2.5, 9.0))], "scene_id string, k long, latitude double, longitude double")
    got = {(r.scene_id, r.k, r.Hylak_id) for r in membership.assign_lake(points, lakes, pairs=pairs).collect()}
    assert got == {("a", 0, 1), ("b", 0, 2)}


def test_target_cells_of_a_region(spark):
    lakes = polygons(spark, [(1, box(0, 0, 0.2, 0.2))])
    native = spark.createDataFrame([("s", 1, 0.0, 0.0), ("s", 1, 0.2, 0.2)], "scene_id string, Hylak_id long, latitude float, longitude float")
    grid = grids.geographic_grid(native, 1000.0)
    pairs = grids.scene_lake_pairs(native)
    every = grids.lake_target_cells(pairs, lakes, grid)
    region = polygons(spark, [(5, box(-1, -1, 0.1, 1)), (6, [[ring([(0.05, 0.0), (0.15, 0.0), (0.05, 0.1)])]])])
    got = sorted((r.row, r.col) for r in grids.lake_target_cells(pairs, lakes, grid, region=region).collect())
    shapes = [r.polygons for r in region.collect()]
    as_dict = [[[[{"x": v.x, "y": v.y} for v in ring_] for ring_ in part] for part in p] for p in shapes]
    want = sorted((r.row, r.col) for r in every.collect() if any(inside(p, r.longitude, r.latitude) for p in as_dict))
    assert got == want and 0 < len(got) < every.count()
