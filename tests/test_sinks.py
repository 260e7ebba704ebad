"""Share, CSV and manifest outputs."""

from pyspark.sql import functions as F

from lakespark import fixtures as fx
from lakespark.functions import bands
from lakespark.operators import grids, membership, qa, stats
from lakespark.sources import native as store


def test_share_csv_and_manifest(spark, small_swath, two_lakes, tmp_path):
    placed = membership.assign_lake(bands.decode_bands(small_swath, fx.BANDS), two_lakes)
    native = qa.native_qa(placed, fx.FLAG_MAP).withColumns(
        {"scene_name": F.lit("x"), "acquisition_start": F.lit("2024-01-01T12:00:00Z"), "config_hash": F.lit("c")}
    )
    grid = grids.geographic_grid(native, 300.0)
    cells = grids.complete_science_grid(native, two_lakes, 300.0)
    store.write_share(cells, grid, stats.scene_share_stats(native), f"{tmp_path}/share")
    assert spark.read.parquet(f"{tmp_path}/share/grid").count() == cells.count()
    assert spark.read.option("header", True).csv(f"{tmp_path}/share/statistics").count() == 2
    assert spark.read.json(f"{tmp_path}/share/metadata").head().resolution_m == 300.0

    path = f"{tmp_path}/native"
    store.write_native(native, path)
    sums = store.file_checksums(spark, path)
    windows = spark.createDataFrame([("scene", "FULL")], "scene_id string, window_id string")
    lakes = spark.createDataFrame([("scene", 2)], "scene_id string, candidate_lakes long")
    row = store.scene_manifest(spark.read.parquet(path), windows, lakes, sums).head()
    assert row.compact_rows == 12 and row.candidate_lakes == 2 and row.windows == ["FULL"]
    assert row.compact_bytes > 0 and len(row.files[0].sha256) == 64


def test_repeated_ingest_of_an_emptied_scene(spark, small_swath, two_lakes, tmp_path):
    """Rows and statistics of a scene go when its repeated run yields none; hashes of digits stay strings."""
    from conftest import box
    from lakespark.plans.ingest import ingest
    from lakespark.schema import MULTIPOLYGON
    from pyspark.sql import types as T

    fields = [T.StructField(n, T.StringType()) for n in ("scene_id", "name", "start")]
    schema = T.StructType([*fields, T.StructField("footprint", MULTIPOLYGON)])
    around = box(-86.0, 39.0, -84.0, 41.0)
    names = [(s, f"name {s}", "2024-01-01T12:00:00Z", around) for s in ("007", "scene")]
    scenes = spark.createDataFrame(names, schema)
    pixels = bands.decode_bands(small_swath, fx.BANDS)
    both = pixels.union(pixels.withColumn("scene_id", F.lit("007")))
    root = str(tmp_path)
    rows = {r.scene_id: r.stats_rows for r in ingest(spark, both, scenes, two_lakes, fx.FLAG_MAP, "0012", root).collect()}
    assert rows["007"] == rows["scene"] > 0
    rows = {r.scene_id: r.stats_rows for r in ingest(spark, pixels, scenes, two_lakes, fx.FLAG_MAP, "0012", root).collect()}
    assert rows == {"007": 0, "scene": rows["scene"]}
    assert {r.scene_id for r in store.read_native(spark, f"{root}/native", config_hash="0012").collect()} == {"scene"}
    assert {r.scene_id for r in store.read_stats(spark, f"{root}/stats", "0012").collect()} == {"scene"}


def test_comparison_mask_keeps_null_scopes(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 0, None), ("a", 1, 0), ("a", 1, 1)], "scene_id string, valid_water_mask int, cyan_strict_valid_mask int")
    got = sorted((r.scene_id or "", r.comparison_valid) for r in qa.comparison_valid(df).collect())
    assert got == [("", False), ("", True), ("a", False), ("a", True)]


def ledger_rows(spark, *rows):
    from lakespark.schema import LEDGER, with_missing_columns

    return with_missing_columns(spark.createDataFrame(list(rows), "scene_id string, config_hash string, status string"), LEDGER)


def test_ledger_versions_two_writers_and_a_failed_commit(spark, tmp_path):
    import os

    import pytest
    from lakespark.plans import ledger

    path = str(tmp_path / "ledger")
    assert ledger.read_ledger(spark, path).count() == 0
    assert ledger.write_ledger(ledger_rows(spark, ("s", "a", "queued"), ("s", "b", "queued")), path) == 1
    # both derive from version 1; the second commit is refused and leaves nothing behind
    assert ledger.write_ledger(ledger_rows(spark, ("s", "a", "done")), path, expected=1) == 2
    with pytest.raises(ledger.LedgerConflict):
        ledger.write_ledger(ledger_rows(spark, ("s", "a", "failed")), path, expected=1)
    state = lambda v=None: {(r.config_hash, r.status) for r in ledger.read_ledger(spark, path, v).collect()}
    assert state() == {("a", "done"), ("b", "queued")} and state(1) == {("a", "queued"), ("b", "queued")}
    # a writer that dies before or while it commits is not seen, and the next one goes on
    os.makedirs(f"{path}/snapshots/000000000003-lost")
    open(f"{path}/versions/000000000003", "w").close()
    assert state() == {("a", "done"), ("b", "queued")} and ledger.ledger_version(spark, path) == 2
    assert ledger.write_ledger(ledger_rows(spark, ("t", "c", "queued")), path) == 4
    assert state() == {("a", "done"), ("b", "queued"), ("c", "queued")}


def test_ledger_race_for_one_pointer(spark, tmp_path, monkeypatch):
    """The other writer commits while this one writes its snapshot."""
    import os

    import pytest
    from lakespark.plans import ledger

    path = str(tmp_path / "ledger")
    ledger.write_ledger(ledger_rows(spark, ("s", "a", "queued")), path)
    settle = ledger.settle

    def meanwhile(df):
        monkeypatch.setattr(ledger, "settle", settle)
        ledger.write_ledger(ledger_rows(spark, ("s", "a", "running")), path)
        return settle(df)

    monkeypatch.setattr(ledger, "settle", meanwhile)
    with pytest.raises(ledger.LedgerConflict):
        ledger.write_ledger(ledger_rows(spark, ("s", "a", "failed")), path)
    assert [r.status for r in ledger.read_ledger(spark, path).collect()] == ["running"]
    assert len(os.listdir(f"{path}/snapshots")) == 2


def test_ingest_writes_manifest_and_ledger(spark, small_swath, two_lakes, tmp_path):
    from conftest import box
    from lakespark.plans import ledger
    from lakespark.plans.ingest import ingest
    from lakespark.schema import MULTIPOLYGON
    from pyspark.sql import types as T

    fields = [T.StructField(n, T.StringType()) for n in ("scene_id", "name", "start")]
    schema = T.StructType([*fields, T.StructField("footprint", MULTIPOLYGON)])
    rows = [("scene", "n", "2024-01-01T12:00:00Z", box(-86.0, 39.0, -84.0, 41.0)), ("far", "f", "2024-01-01T12:00:00Z", box(0.0, 0.0, 1.0, 1.0))]
    scenes = spark.createDataFrame(rows, schema)
    pixels = bands.decode_bands(small_swath, fx.BANDS)
    root, book = str(tmp_path / "out"), str(tmp_path / "ledger")
    for attempt in (1, 2):
        ingest(spark, pixels, scenes, two_lakes, fx.FLAG_MAP, "c", root, ledger_path=book)
        assert ledger.ledger_version(spark, book) == attempt
        state = {r.scene_id: r for r in ledger.read_ledger(spark, book).collect()}
        assert state["far"].status == "skipped_no_lakes" and state["scene"].status == "done"
        assert state["scene"].candidate_lakes == 2 and state["scene"].stats_rows == 2 and state["scene"].compact_bytes > 0
        manifest = store.read_stats(spark, f"{root}/manifest", "c").collect()
        assert [(m.scene_id, m.compact_rows, m.windows) for m in manifest] == [("scene", 12, ["FULL"])]
    # the first run without any rows
    empty = ingest(spark, pixels.where("false"), scenes, two_lakes, fx.FLAG_MAP, "c", str(tmp_path / "none"))
    assert {r.scene_id: r.stats_rows for r in empty.collect()} == {"scene": 0, "far": None}


def test_rows_travel_narrow_and_come_back_whole(spark, tmp_path):
    """Floats as one array, truth values (NULL too) as bits; the exchange of a native write carries no column of theirs."""
    flags = ", ".join(f"m{i} boolean" for i in range(33))
    rows = [(k, float("nan") if k == 2 else None if k == 1 else k / 4, -0.0, *((True, False, None)[(k + i) % 3] for i in range(33))) for k in range(4)]
    df = spark.createDataFrame(rows, f"obs_id long, a float, b float, {flags}")
    packed = store.narrow(df)
    assert packed.columns == ["obs_id", "_floats", "_flags0", "_flags1"]
    back = store.widen(packed, df)
    assert back.dtypes == df.dtypes
    assert list(map(str, back.orderBy("obs_id").collect())) == list(map(str, df.orderBy("obs_id").collect()))


def test_first_of_a_key_carries_no_column_twice(spark):
    from lakespark.operators.dedupe import first_by

    df = spark.createDataFrame([(1, 2, "b", 0.5), (1, 1, "c", 0.5), (1, 1, "a", 1.5), (2, 9, None, None)], "k long, o int, t string, v double")
    found = first_by(df, {"k": F.col("k")}, ["o", F.col("v")])
    assert sorted(map(tuple, found.collect())) == [(1, 1, "c", 0.5), (2, 9, None, None)] and found.columns == df.columns
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_row" not in plan and "min(struct(o, o#" in plan
