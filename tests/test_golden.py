"""Small hand-derived results."""

import math

import pytest
from conftest import box
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespark import fixtures as fx
from lakespark.functions import bands, flags, geo, indices, names
from lakespark.operators import dedupe, display, grids, membership, nearest, qa, quantiles, stats
from lakespark.plans import identity, ledger, windows
from lakespark.schema import MULTIPOLYGON

FLAGS = fx.FLAG_MAP
CORE = ["r620", "r665", "r681", "r709"]


def ci(spark, values, limit=indices.DETECTION_LIMIT):
    df = spark.createDataFrame([values], "r620 float, r665 float, r681 float, r709 float")
    return indices.ci_family(df, CORE, detection_limit=limit).head()


def test_ci_gates(spark):
    hit = ci(spark, (0.01, 0.03, 0.02, 0.04))
    assert hit.ci_detection and hit.CI_cyano == pytest.approx(0.01363636, rel=1e-5)
    negative = ci(spark, (-0.01, 0.03, 0.02, 0.04))
    assert negative.ci_finite and negative.ci_detection
    peak = ci(spark, (0.01, 0.03, 0.05, 0.04))
    assert not peak.ci_candidate and peak.CI_cyano is None
    unconfirmed = ci(spark, (0.04, 0.01, 0.005, 0.04))
    assert unconfirmed.ci_candidate and not unconfirmed.ci_detection
    # strictly above the limit
    assert not ci(spark, (0.01, 0.03, 0.02, 0.04), limit=hit.CI).ci_detection
    gap = ci(spark, (None, 0.03, 0.02, 0.04))
    assert not gap.ci_finite and gap.CI is None


def test_ndci(spark):
    df = spark.createDataFrame([(0.02, 0.04), (0.1, -0.1), (None, 0.2)], "a float, b float")
    got = [r[0] for r in df.select(indices.ndci(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1 / 3, rel=1e-6) and got[1:] == [None, None]


def test_line_heights(spark, small_swath):
    wl = {885: 884.0}
    r = {w: F.col(f"rhos_{w}") for w in (665, 681, 709, 754, 865, 884)}
    top, peak = indices.mph(r[665], r[681], r[709], r[754], r[884], wl)
    row = small_swath.select(indices.fai(r[665], r[754], r[865]).alias("fai"), peak.alias("nm")).head()
    assert row.fai == pytest.approx(0.02445, rel=1e-5) and row.nm == 754


def test_fill_and_nan(spark):
    df = spark.createDataFrame([(-32767.0,), (float("nan"),), (0.5,), (None,)], "v float")
    assert [r[0] for r in df.select(bands.decode_fill(F.col("v"))).collect()] == [None, None, 0.5, None]


def test_unsigned_flag_bit(spark):
    df = spark.createDataFrame([(1 << 31,), (1,), (None,)], "f long")
    test = flags.flag_is_set(F.col("f"), {"PRODFAIL": 1 << 31}, "prodfail")
    assert [r[0] for r in df.select(test).collect()] == [True, False, False]
    with pytest.raises(ValueError):
        flags.decode_flag_map("LAND CLDICE", [1])


def placed(small_swath, two_lakes):
    return membership.assign_lake(bands.decode_bands(small_swath, fx.BANDS), two_lakes)


def test_extraction(small_swath, two_lakes):
    native = qa.native_qa(placed(small_swath, two_lakes), FLAGS)
    rows = native.orderBy("source_row", "source_col").collect()
    assert len(rows) == 12
    first = rows[:6]
    assert [int(r.valid_water_mask) for r in first] == [1, 1, 0, 0, 0, 0]
    assert [int(r.bloom_rescue_mask) for r in first] == [0, 1, 0, 0, 0, 0]
    assert [int(r.cyan_strict_valid_mask) for r in first] == [1, 0, 0, 0, 0, 0]
    assert rows[6].valid_water_mask and rows[6].CI_cyano is None
    assert rows[7].rhos_620 < 0 and rows[7].ci_valid_mask
    assert all(r.CI_cyano is None for r in rows[2:6])
    assert [r.Hylak_id for r in first] == [1, 1, 1, 1, 2, 2]
    table = stats.lake_window_stats(native).orderBy("Hylak_id").collect()
    assert [r.Hylak_id for r in table] == [1, 2] and table[0].native_polygon_pixels == 8
    # nothing valid on the first line of lake 2, so fractions are over the second line
    assert table[1].retained_pixels == 2


def test_adjacency_stops_at_blocks(small_swath, two_lakes):
    full = placed(small_swath, two_lakes)
    whole = qa.land_adjacency(full, FLAGS, 1).where("adjacent").select("source_row", "source_col").collect()
    assert sorted(map(tuple, whole)) == [(0, 3), (0, 5), (1, 4)]
    blocks = qa.land_adjacency(full, FLAGS, 1, 1).where("adjacent").select("source_row", "source_col").collect()
    assert sorted(map(tuple, blocks)) == [(0, 3), (0, 5)]


def test_nearest_before_qa(spark):
    target = spark.createDataFrame([("s", 1, 0, 0, 40.001, -85.005)], "scene_id string, Hylak_id long, row long, col long, latitude double, longitude double")
    pixels = spark.createDataFrame(
        [
            ("s", 1, 10, 40.001, -85.005, False, None),
            ("s", 1, 11, 40.001, -85.003, True, 0.002),
            ("s", 2, 12, 40.001, -85.00501, True, 0.5),
        ],
        "scene_id string, Hylak_id long, obs_id long, latitude float, longitude float, valid_water_mask boolean, CI_cyano float",
    )
    got = nearest.same_lake_nearest(target, pixels, 600.0, grids.TARGET_ID).head()
    assert got.obs_id == 10 and got.match_distance_m < 1.0


@pytest.mark.parametrize("spread", [0.0004, 0.02])
def test_crowded_nearest_equals_brute_force(spark, spread):
    """Crowded cubes (many pixels per small cube) and copies of one place."""
    import random

    rng = random.Random(7)
    px = [("s", 1, k, 40 + rng.random() * spread, -85 + rng.random() * spread) for k in range(1500)]
    px += [("s", 1, 1500 + k, *px[3][3:]) for k in range(300)]
    pixels = spark.createDataFrame(px, "scene_id string, Hylak_id long, obs_id long, latitude double, longitude double")
    tg = [("s", 1, k, 0, 40 + rng.random() * spread * 1.4, -85 + rng.random() * spread * 1.4) for k in range(60)]
    targets = spark.createDataFrame(tg, "scene_id string, Hylak_id long, row long, col long, latitude double, longitude double")
    got = {r.row: r for r in nearest.same_lake_nearest(targets, pixels, 600.0, grids.TARGET_ID).collect()}

    def xyz(lat, lon):
        a, b = math.radians(lat), math.radians(lon)
        return (math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a))

    known = [(p[2], xyz(*p[3:])) for p in px]
    for t in tg:
        v = xyz(*t[4:])
        d, obs = min((math.dist(v, q), k) for k, q in known)
        metres = 12742000 * math.asin(d / 2)
        if metres <= 600:
            assert got[t[2]].match_distance_m == pytest.approx(metres, abs=1e-3)
            assert got[t[2]].obs_id == obs
        else:
            assert got[t[2]].obs_id is None


def test_points_on_edges_are_outside(spark, two_lakes):
    pts = [(0, 40.005, -85.0), (1, 39.999, -85.005), (2, 40.005, -85.006), (3, 40.005, -84.995), (4, 41.0, -85.0)]
    df = spark.createDataFrame(pts, "k long, latitude double, longitude double")
    for cell in (0.05, 0.01, 0.002):
        got = {r.k: r.Hylak_id for r in membership.assign_lake(df, two_lakes, cell=cell).collect()}
        assert got == {0: 0, 1: 0, 2: 1, 3: 2, 4: 0}


def test_many_overlapping_lakes(spark, two_lakes, monkeypatch):
    """First lake wins, also when a cell holds more lakes than one row takes."""
    monkeypatch.setattr(membership, "LAKES_PER_ROW", 2)
    rows = [(i, i, box(-85.0 - i * 0.001, 40.0, -84.99, 40.01)) for i in range(1, 8)]
    schema = two_lakes.select("Hylak_id", "lake_order", "polygons").schema
    lakes = spark.createDataFrame(rows, schema)
    pts = spark.createDataFrame([(k, 40.005, -85.0 - k * 0.001 + 0.0005) for k in range(1, 9)], "k long, latitude double, longitude double")
    got = {r.k: r.Hylak_id for r in membership.assign_lake(pts, lakes, cell=0.05).collect()}
    assert got == {k: (k if k < 8 else 0) for k in range(1, 9)}


def test_holes_and_erosion(spark):
    ring = lambda w, s, e, n: box(w, s, e, n)[0][0]
    lake = [(1, 1, [[ring(0, 0, 0.1, 0.1), ring(0.04, 0.04, 0.06, 0.06)]])]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("Hylak_id", T.LongType()), T.StructField("lake_order", T.LongType()), T.StructField("polygons", MULTIPOLYGON)])
    lakes = spark.createDataFrame(lake, schema)
    pts = spark.createDataFrame([(0, 0.02, 0.02), (1, 0.05, 0.05), (2, 0.002, 0.02), (3, 0.036, 0.05)], "k long, latitude double, longitude double")
    plain = {r.k: r.Hylak_id for r in membership.assign_lake(pts, lakes).collect()}
    assert plain == {0: 1, 1: 0, 2: 1, 3: 1}
    eroded = {r.k: r.Hylak_id for r in membership.inside_eroded(pts, lakes, 500.0).collect()}
    assert eroded == {0: 1, 1: 0, 2: 0, 3: 0}


@pytest.mark.parametrize("ladder", [quantiles.FLOAT_LADDER, quantiles.DOUBLE_LADDER])
def test_quantiles_of_groups_of_all_sizes(spark, ladder):
    """Sizes 0 to thousands, ties, NULL keys, NaN and infinities, against the sorted values."""
    import math

    rows = []
    for g, size in ((None, 4), (1, 1), (2, 2), (3, 37), (4, 4000), (5, 3)):
        for i in range(size):
            v = round(math.sin(i * 1.7) * 3, 1) if g == 3 else math.sin(i * 1.7) * 3
            rows.append((g, v, i))
    rows += [(6, None, 0), (7, float("inf"), 0), (7, 1.0, 0), (7, float("-inf"), 0), (7, float("nan"), 0), (8, float("inf"), 0), (8, float("inf"), 0)]
    df = spark.createDataFrame(rows, "g int, v double, i int")
    asked = {f"p{int(q * 100)}": ("v", q) for q in (0.0, 0.1, 0.5, 0.9, 1.0)}
    got = {r.g: r for r in quantiles.summarize(df, ["g"], {"v": F.col("v")}, asked, [F.count("*").alias("n")], ladder).collect()}
    assert set(got) == {r[0] for r in rows}
    for g, r in got.items():
        values = sorted(v for k, v, _ in rows if k == g and v is not None and v == v)
        assert r.n == sum(k == g for k, _, _ in rows)
        for name, (_, q) in asked.items():
            if not values:
                assert r[name] is None
                continue
            at = q * (len(values) - 1)
            lo, hi = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            want = lo if at == int(at) or lo == hi else lo + (hi - lo) * (at - int(at))
            assert r[name] == pytest.approx(want, rel=1e-12, abs=1e-15, nan_ok=True)
    empty = quantiles.summarize(df.where("false"), [], {"v": F.col("v")}, asked).collect()
    assert [tuple(r) for r in empty] == [(None,) * 5]


def test_average_ranks(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (-3.0,), (0.0,)], "v double")
    got = sorted((r.v, r.rk) for r in quantiles.average_ranks(df, [], "v", "rk").collect())
    assert got == [(-3.0, 1.0), (0.0, 2.0), (1.0, 3.0), (2.0, 4.5), (2.0, 4.5)]


def test_scene_name_and_grid_id(spark):
    name = "S3A_OL_1_EFR____20240101T120000_20240101T120300_20240102T120000_0180_108_012_2520_LN1_O_NT_002.SEN3"
    row = spark.range(1).select(names.parse_scene_name(F.lit(name)).alias("p"), names.grid_id_to_bbox(F.lit("g05_N40_W085")).alias("b"), names.parse_scene_name(F.lit("x")).alias("bad")).head()
    assert row.p.native_frame_id == "S3A_R012_F2520" and row.p.duration_s == 180 and row.p.cycle == 108
    assert tuple(row.b) == (-85.0, 40.0, -80.0, 45.0) and row.bad is None


def test_window_components(spark):
    from lakespark.operators.components import connected

    boxes = [(0, 0, 0, 1, 1), (1, 1, 0, 2, 1), (2, 2, 1, 3, 2), (3, 5, 5, 6, 6), (4, 5.5, 5.5, 7, 7)]
    df = spark.createDataFrame([(s, *map(float, b)) for s in "ab" for b in boxes], "scene_id string, node double, w double, s double, e double, n double")
    df = df.withColumn("node", F.col("node").cast("long"))
    found = {(r.scene_id, r.node): r.component for r in connected(windows.touching(df), ["scene_id"]).collect()}
    # sharing an edge connects, sharing a corner does not; a box that touches none is in no edge
    assert found == {(s, k): c for s in "ab" for k, c in ((0, 0), (1, 0), (3, 3), (4, 3))}


def test_windows_equal_brute_force(spark):
    """Random boxes and slanted footprints: places in common are those of clipping the outline to each box."""
    import random

    rng = random.Random(3)

    def clip(ring, w, s, e, n):
        for axis, limit, sign in ((0, w, 1), (0, e, -1), (1, s, 1), (1, n, -1)):
            out = []
            for p, q in zip(ring, ring[1:] + ring[:1]):
                a, b = sign * (p[axis] - limit) >= 0, sign * (q[axis] - limit) >= 0
                if a:
                    out.append(p)
                if a != b:
                    t = (limit - p[axis]) / (q[axis] - p[axis])
                    cut = [p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])]
                    cut[axis] = limit
                    out.append(tuple(cut))
            ring = out
        return ring

    outline = [(0.1, 0.0), (2.0, 0.3), (1.8, 2.0), (0.0, 1.7)]
    rows = []
    for scene in range(4):
        for node in range(12):
            x, y, a, b = rng.uniform(-0.2, 2), rng.uniform(-0.2, 2), rng.uniform(0.02, 0.5), rng.uniform(0.02, 0.5)
            rows.append((scene, node, x, y, x + a, y + b))
    boxes = spark.createDataFrame(rows, "scene_id long, node long, w double, s double, e double, n double")
    ring = [{"x": x, "y": y} for x, y in outline + outline[:1]]
    schema = T.StructType([T.StructField("scene_id", T.LongType()), T.StructField("polygons", MULTIPOLYGON)])
    footprints = spark.createDataFrame([(k, [[ring]]) for k in range(4)], schema)
    spans = windows.clipped_points(boxes, footprints).groupBy("scene_id", "node").agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).collect()
    got = {(r[0], r[1]): tuple(r)[2:] for r in spans}
    want = {}
    for scene, node, *box_ in rows:
        if left := clip(outline, *box_):
            xs, ys = zip(*left)
            want[scene, node] = (min(xs), min(ys), max(xs), max(ys))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_plan_windows(spark, two_lakes):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("scene_id", T.StringType()), T.StructField("footprint", MULTIPOLYGON)])
    s = spark.createDataFrame([("a", box(-86, 39, -84, 41)), ("tight", box(-85.02, 39.99, -84.98, 40.02)), ("none", None)], schema)
    pairs = membership.scene_candidate_lakes(s, two_lakes).join(two_lakes, "Hylak_id")
    got = {r.scene_id: r for r in windows.plan_windows(s, pairs).collect()}
    assert got["tight"].window_id == "FULL" and got["none"].window_id == "FULL"
    a = got["a"]
    assert a.window_id.startswith("W_") and a.s == pytest.approx(39.999 - 3 / 111.32, abs=1e-9)
    # a footprint that cuts the box shortens the window
    cut = spark.createDataFrame([("a", box(-86, 39, -85.001, 41))], schema)
    w = windows.plan_windows(cut, pairs.where("scene_id = 'a'")).head()
    assert w.e == pytest.approx(-85.001)


def test_share_grid(small_swath, two_lakes):
    native = qa.native_qa(placed(small_swath, two_lakes), FLAGS)
    g = grids.complete_science_grid(native, two_lakes, 300.0)
    assert "rhos_884" in g.columns and "rhos_885" not in g.columns
    bad = g.where("valid_water_mask = 0 and (CI_cyano is not null or rhos_884 is not null)").count()
    assert g.count() > 0 and bad == 0


def test_ledger_keeps_status(spark):
    from lakespark.schema import LEDGER

    empty = spark.createDataFrame([], LEDGER)
    new = spark.createDataFrame([("a", "c", "n1", 5)], "scene_id string, config_hash string, scene_name string, candidate_lakes long")
    first = ledger.ledger_upsert(empty, new)
    assert first.head().status == "queued" and first.head().attempts == 0
    done = ledger.ledger_update(first, spark.createDataFrame([("a", "c", "done")], "scene_id string, config_hash string, status string"))
    again = ledger.ledger_upsert(done, new.withColumn("candidate_lakes", F.lit(9).cast("long"))).head()
    assert again.status == "done" and again.candidate_lakes == 9
    assert ledger.plan_rows(done, new.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ledger.plan_rows(done, spark.createDataFrame([("zz",)], "scene_id string"))


def test_identity(spark, two_lakes):
    a = identity.lake_fingerprint(two_lakes).head()[0]
    assert a == identity.lake_fingerprint(two_lakes.orderBy(F.desc("Hylak_id"))).head()[0]
    assert a != identity.lake_fingerprint(two_lakes.where("Hylak_id = 1")).head()[0]
    assert identity.config_hash({}, a) != identity.config_hash({"detection_limit": 0.0002}, a)


def test_even_sample_matches_linspace(spark):
    import numpy as np

    n = 997
    df = spark.range(n).select(F.lit("s").alias("scene_id"), F.lit("FULL").alias("window_id"), (F.col("id") % 13).cast("int").alias("source_row"), (F.col("id") % 7).cast("int").alias("source_col"), F.col("id").alias("obs_id"))
    order = [r.obs_id for r in df.orderBy("source_row", "source_col", "obs_id").collect()]
    for k in (1, 2, 50, 300, 996, 997, 2000):
        want = sorted(order) if k >= n else sorted(order[p] for p in sorted(set(np.linspace(0, n - 1, k).astype(int))))
        assert sorted(r.obs_id for r in dedupe.even_sample(df, k).collect()) == want


def test_display_limits_small_samples(spark):
    df = spark.createDataFrame([(0.5,)] * 3, "CI float")
    r = display.display_limits(df, "CI").head()
    assert (r.lo, r.hi) == (0.5, pytest.approx(0.500001))
    r = display.display_limits(df.where("CI > 1"), "CI").head()
    assert (r.lo, r.hi) == (0.0, 1.0)


def test_bands():
    assert bands.nearest_band(["rhos_884", "rhos_865", "Rrs_885"], "rhos", 885, 30) == "rhos_884"
    with pytest.raises(KeyError):
        bands.nearest_band(["rhos_865"], "rhos", 885)
    assert geo.metres_to_chord(600.0) == pytest.approx(600 / 6371000, rel=1e-6)


def test_coarse_grid_is_searched_at_its_own_resolution(spark):
    """A grid that a cell limit coarsens to 3 km finds pixels 3 km apart, one for every cell."""
    step = 0.027
    pixels = spark.createDataFrame([("s", i * 40 + j, 10 + i * step, 20 + j * step, float(i)) for i in range(40) for j in range(40)], "scene_id string, obs_id long, latitude double, longitude double, v double")
    grid = grids.raster_grid(pixels, 300.0, 1600)
    assert grid.head().resolution_m > 2500
    found = nearest.swath_to_grid(grids.raster_cells(grid), pixels, ["v"])
    assert found.where("obs_id is null").count() == 0
    assert found.count() == grid.head().ncell


def test_nearest_takes_ids_of_either_sign(spark):
    pixels = spark.createDataFrame([(-5, 1.0, 1.0), (7, 1.0, 1.0), (-9, 1.001, 1.0)], "obs_id long, latitude double, longitude double").withColumn("scene_id", F.lit("s")).withColumn("Hylak_id", F.lit(1))
    targets = spark.createDataFrame([("t", 1.0, 1.0), ("u", 1.0009, 1.0), ("far", 5.0, 5.0)], "k string, latitude double, longitude double").withColumn("scene_id", F.lit("s")).withColumn("Hylak_id", F.lit(1))
    got = {r.k: r.obs_id for r in nearest.nearest_on_sphere(targets, pixels, 600.0, ["k"]).collect()}
    assert got == {"t": -5, "u": -9, "far": None}
