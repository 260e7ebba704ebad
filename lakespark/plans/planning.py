"""Planning shards and the archive index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.functions.names import parse_scene_name
from lakespark.operators.membership import (
    lakes_in_region,
    scene_candidate_lakes,
    scene_grid_ids,
    scenes_in_region,
)
from lakespark.plans.ledger import ledger_upsert


def plan_shard(
    scenes: DataFrame,
    lakes: DataFrame,
    region: DataFrame | None,
    label: str,
    config_hash: str,
) -> DataFrame:
    """Scenes that meet at least one target lake of the shard, with their lake count.

    The count is over the shard's lakes; processing later uses all lakes.
    """
    pool = lakes if region is None else lakes_in_region(lakes, region)
    here = scenes if region is None else scenes_in_region(scenes, region)
    counts = (
        scene_candidate_lakes(here, pool)
        .groupBy("scene_id")
        .agg(F.count(F.lit(1)).alias("candidate_lakes"))
    )
    return here.join(counts, "scene_id").withColumns(
        {"planning_shard": F.lit(label), "config_hash": F.lit(config_hash)}
    )


def remember_plan(ledger: DataFrame, plan: DataFrame) -> DataFrame:
    """Upsert a plan into the ledger."""
    rows = plan.select(
        F.col("scene_id").cast("string").alias("scene_id"),
        "config_hash",
        F.col("name").alias("scene_name"),
        F.col("start").alias("acquisition_start"),
        F.col("size_bytes").cast("long").alias("size_bytes"),
        F.col("candidate_lakes").cast("long").alias("candidate_lakes"),
        F.to_json(F.struct(F.col("scene_id").alias("id"), "name", "footprint", "planning_shard")).alias("scene_json"),
    )
    return ledger_upsert(ledger, rows)


def archive_index(ledger: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row per finished scene: name fields, grid ids and stored files.

    ``files``: scene_id, file, bytes.
    """
    done = ledger.where(F.col("status") == "done")
    shape = F.from_json("scene_json", "footprint array<array<array<struct<x:double,y:double>>>>")
    with_grid = scene_grid_ids(done.withColumn("footprint", shape["footprint"]))
    parsed = with_grid.withColumn("_p", parse_scene_name(F.col("scene_name")))
    out = parsed.select(
        "scene_id",
        "scene_name",
        "acquisition_start",
        F.coalesce("_p.platform", F.substring("scene_name", 1, 3)).alias("platform"),
        F.col("_p.relative_orbit").alias("relative_orbit"),
        F.col("_p.frame").alias("frame"),
        F.coalesce("_p.native_frame_id", F.lit("")).alias("native_frame_id"),
        F.concat_ws(";", "grid_ids").alias("grid_ids"),
        "config_hash",
        "candidate_lakes",
        "stats_rows",
        "compact_bytes",
    )
    if files is not None:
        stored = files.groupBy("scene_id").agg(
            (F.sum("bytes") / F.lit(1024.0**2)).alias("compact_MB"),
            F.concat_ws("|", F.array_sort(F.collect_list("file"))).alias("compact_files"),
        )
        out = out.join(stored, "scene_id", "left").fillna({"compact_MB": 0.0, "compact_files": ""})
    return out.orderBy("acquisition_start", "scene_name", "scene_id")


def search_archive(
    index: DataFrame, grid: str = "", orbit: int | None = None, n: int | None = 1000
) -> DataFrame:
    """Rows whose grid ids contain ``grid`` (any case) and whose orbit matches; first ``n``."""
    if grid.strip():
        index = index.where(F.contains(F.lower("grid_ids"), F.lit(grid.strip().lower())))
    if orbit is not None:
        index = index.where(F.col("relative_orbit") == int(orbit))
    rows = index.orderBy("acquisition_start", "scene_name", "scene_id")
    return rows.limit(n) if n else rows
