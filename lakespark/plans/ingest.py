"""From swath pixels to stored native tables, statistics, manifest and ledger, all scenes in one plan."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakespark.functions.flags import FlagMap
from lakespark.functions.indices import DETECTION_LIMIT
from lakespark.operators.membership import assign_lake, for_each_lake, same_outline, scene_candidate_lakes
from lakespark.operators.qa import native_qa
from lakespark.operators.stats import lake_window_stats, with_lake_metadata
from lakespark.plans.ledger import ledger_update, ledger_upsert, ledger_version, read_ledger, write_ledger
from lakespark.schema import NATIVE, with_missing_columns
from lakespark.session import settle
from lakespark.sources.native import LAYOUT, clear_folders, scene_folder, scene_manifest, with_layout, write_native, write_stats


def native_observations(
    pixels: DataFrame,
    scenes: DataFrame,
    lakes: DataFrame,
    flag_map: FlagMap,
    config_hash: str,
    shore_buffer_m: float = 0.0,
    pairs: DataFrame | None = None,
    every: bool = False,
    **qa_options,
) -> DataFrame:
    """Native rows of every scene, in the candidate lakes of that scene (``pairs``, found here if not given).

    Where lakes overlap, the first one among the candidates of the pixel's scene has it; with ``every`` all outlines
    have it, each under its first lake in the scene.
    """
    pairs = scene_candidate_lakes(scenes, lakes) if pairs is None else pairs
    placed = assign_lake(pixels, lakes, erode_m=shore_buffer_m, pairs=pairs, every=every)
    meta = scenes.select(
        "scene_id", F.col("name").alias("scene_name"), F.col("start").alias("acquisition_start")
    )
    rows = native_qa(placed, flag_map, **qa_options)
    return rows.drop("scene_name", "acquisition_start").join(meta, "scene_id").withColumns(
        {
            "config_hash": F.lit(config_hash),
            "shore_buffer_m": F.lit(float(shore_buffer_m)),
            "ci_detection_limit": F.lit(float(qa_options.get("detection_limit", DETECTION_LIMIT))),
        }
    )


def _clear_emptied(scenes: DataFrame, filled: DataFrame, config_hash: str, root: str) -> None:
    """Remove earlier rows and statistics of scenes that yield nothing now."""
    named = scenes.select(F.col("scene_id").cast("string").alias("scene_id"), F.col("name").alias("scene_name"), F.col("start").alias("acquisition_start"))
    emptied = settle(with_layout(named.join(filled, "scene_id", "left_anti")).withColumn("config_hash", F.lit(config_hash)))
    clear_folders(emptied.select(scene_folder([*LAYOUT, "scene_id", "config_hash"]).alias("folder")), f"{root}/native")
    for kind in ("stats", "manifest", "outlines"):
        clear_folders(emptied.select(scene_folder(["config_hash", "scene_id"]).alias("folder")), f"{root}/{kind}")


def _rows(written: Observation) -> int:
    """Rows that the write counted; none where the optimizer saw beforehand that there are none, and so counted nothing."""
    try:
        return written.get["rows"]
    except Py4JJavaError:
        return 0


def ingest(
    spark: SparkSession,
    pixels: DataFrame,
    scenes: DataFrame,
    lakes: DataFrame,
    flag_map: FlagMap,
    config_hash: str,
    root: str,
    ledger_path: str | None = None,
    every: bool = False,
    **options,
) -> DataFrame:
    """Store native rows, statistics and manifest below ``root``; returns the ledger changes.

    Candidate pairs and native rows are computed once: everything that follows reads what this run
    stored, which its id marks. The rows that the write itself counted must all be found there. Scenes without
    candidate lakes become ``skipped_no_lakes``; scenes that yield no rows lose those of an earlier run. With
    ``ledger_path`` the changes are committed to the stored ledger as one version.

    With ``every`` a pixel counts in each lake that holds it. Native rows are stored once for an outline, however many lakes
    have it, under the first of them; ``root``/outlines names the lakes of each, and all of them have statistics.
    """
    version = ledger_version(spark, ledger_path) if ledger_path else 0
    run = uuid.uuid4().hex
    pairs = settle(scene_candidate_lakes(scenes, lakes))
    native = native_observations(pixels, scenes, lakes, flag_map, config_hash, pairs=pairs, every=every, **options).withColumn("ingest_id", F.lit(run))
    written = Observation("native rows")
    write_native(native.observe(written, F.count(F.lit(1)).alias("rows")), f"{root}/native")

    def mine_of_store() -> DataFrame:
        found = spark.read.schema(with_layout(native).schema).parquet(f"{root}/native")
        return found.where((F.col("config_hash") == config_hash) & (F.col("ingest_id") == run)).withColumn("scene_id", F.col("scene_id").cast("string"))

    rows = settle(
        mine_of_store().groupBy("scene_id").agg(
            F.count(F.lit(1)).alias("native_rows"),
            F.count_distinct("window_id", "Hylak_id").alias("stats_rows"),
        )
    )
    outlines = None
    if every:
        outlines = same_outline(lakes, pairs=pairs).withColumn("scene_id", F.col("scene_id").cast("string"))
        write_stats(outlines.withColumn("config_hash", F.lit(config_hash)), f"{root}/outlines")
        outlines = settle(outlines)
        found = mine_of_store().select("scene_id", "window_id", "Hylak_id").distinct()
        told = for_each_lake(found, outlines).groupBy("scene_id").agg(F.count(F.lit(1)).alias("stats_rows"))
        rows = settle(rows.drop("stats_rows").join(told, "scene_id"))
    there = rows.agg(F.coalesce(F.sum("native_rows"), F.lit(0))).head()[0]
    if there != (counted := _rows(written)):
        raise RuntimeError(f"{there} of {counted} native rows were found again")
    _clear_emptied(scenes, rows.select("scene_id"), config_hash, root)
    # listed anew, without the folders that went
    files = mine_of_store()
    stored = with_missing_columns(files, NATIVE)
    keys = ["scene_id", "config_hash", "window_id", "Hylak_id"]
    stats = lake_window_stats(stored, keys)
    write_stats(with_lake_metadata(stats if outlines is None else for_each_lake(stats, outlines), lakes), f"{root}/stats")

    of_scene = pairs.groupBy(F.col("scene_id").cast("string").alias("scene_id")).agg(F.count(F.lit(1)).alias("candidate_lakes"))
    manifest = settle(scene_manifest(files, stored.select("scene_id", "window_id").distinct(), of_scene))
    write_stats(manifest, f"{root}/manifest")
    mine = scenes.select(F.col("scene_id").cast("string").alias("scene_id"))
    done = F.coalesce("candidate_lakes", F.lit(0)) > 0
    changes = (
        mine.join(of_scene, "scene_id", "left")
        .join(rows, "scene_id", "left")
        .join(manifest.select("scene_id", "compact_bytes"), "scene_id", "left")
        .select(
            "scene_id",
            F.lit(config_hash).alias("config_hash"),
            F.when(done, "done").otherwise("skipped_no_lakes").alias("status"),
            F.coalesce("candidate_lakes", F.lit(0)).cast("long").alias("candidate_lakes"),
            F.when(done, F.coalesce("stats_rows", F.lit(0))).cast("long").alias("stats_rows"),
            F.when(done, F.coalesce("compact_bytes", F.lit(0))).cast("long").alias("compact_bytes"),
        )
    )
    if ledger_path:
        changes = settle(changes)
        met = scenes.select(
            F.col("scene_id").cast("string").alias("scene_id"),
            F.lit(config_hash).alias("config_hash"),
            F.col("name").alias("scene_name"),
            F.col("start").alias("acquisition_start"),
        ).join(changes.select("scene_id", "candidate_lakes"), "scene_id")
        known = ledger_upsert(read_ledger(spark, ledger_path, version), met)
        write_ledger(ledger_update(known, changes), ledger_path, version)
    return changes
