"""Work ledger: one row per scene and configuration, kept with joins and overwrites."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespark.schema import LEDGER, with_missing_columns
from lakespark.session import settle

KEY = ["scene_id", "config_hash"]
# refreshed by an upsert; everything else of an existing row stays
METADATA = (
    "scene_name",
    "acquisition_start",
    "acquisition_end",
    "s3_path",
    "size_bytes",
    "candidate_lakes",
    "scene_json",
)
OPEN = ("queued", "running")


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def ledger_upsert(ledger: DataFrame, scenes: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Insert scenes as queued, or refresh their metadata; status and results stay."""
    new = with_missing_columns(scenes, LEDGER).select(
        *KEY, *[F.col(c).alias(f"_new_{c}") for c in METADATA], F.lit(True).alias("_given")
    )
    joined = ledger.join(new, KEY, "full")
    given = F.coalesce("_given", F.lit(False))
    known = F.col("status").isNotNull()
    out = {c: F.when(given, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in METADATA}
    out["status"] = F.when(known, F.col("status")).otherwise("queued")
    out["attempts"] = F.coalesce("attempts", F.lit(0)).cast("long")
    out["updated_utc"] = F.when(given, stamp if stamp is not None else _now()).otherwise(F.col("updated_utc"))
    return joined.withColumns(out).select(*[f.name for f in LEDGER])


def ledger_update(ledger: DataFrame, changes: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Set the fields that ``changes`` carries for its keys.

    A change to ``running`` counts an attempt. A change to ``done`` clears the error.
    """
    fields = [c for c in changes.columns if c not in KEY]
    new = changes.select(*KEY, *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("_given"))
    joined = ledger.join(new, KEY, "left")
    given = F.coalesce("_given", F.lit(False))
    out = {c: F.coalesce(f"_new_{c}", c) for c in fields}
    if "status" in fields:
        started = given & (F.col("_new_status") == "running")
        out["attempts"] = F.col("attempts") + F.coalesce(started, F.lit(False)).cast("long")
        finished = F.coalesce(F.col("_new_status") == "done", F.lit(False))
        error = out.get("last_error", F.col("last_error"))
        out["last_error"] = F.when(~finished, error)
    out["updated_utc"] = F.when(given, stamp if stamp is not None else _now()).otherwise(F.col("updated_utc"))
    return joined.withColumns(out).select(*ledger.columns)


REPAIR = "Saved products are missing or invalid; queued for repair"


def requeue_invalid(ledger: DataFrame, products: DataFrame) -> DataFrame:
    """Queue finished scenes again whose products are missing or invalid.

    ``products``: scene_id, config_hash, valid (see `stats.check_native`).
    """
    checked = products.select(*KEY, F.col("valid").alias("_valid"))
    broken = (F.col("status") == "done") & ~F.coalesce("_valid", F.lit(False))
    return (
        ledger.join(checked, KEY, "left")
        .withColumns(
            {
                "last_error": F.when(broken, REPAIR).otherwise(F.col("last_error")),
                "status": F.when(broken, "queued").otherwise(F.col("status")),
            }
        )
        .drop("_valid")
    )


def take_queue(
    ledger: DataFrame, n: int, retry_failed: bool = False, plan_ids: DataFrame | None = None
) -> DataFrame:
    """The first ``n`` open scenes by start; with ``plan_ids`` only scenes of that plan."""
    statuses = [*OPEN, "failed"] if retry_failed else list(OPEN)
    rows = ledger.where(F.col("status").isin(statuses))
    if plan_ids is not None:
        rows = rows.join(plan_ids.select("scene_id").distinct(), "scene_id", "left_semi")
    return rows.orderBy("acquisition_start", "scene_name", "scene_id").limit(n)


def pending_windows(plan: DataFrame, native: DataFrame) -> DataFrame:
    """Planned (scene, window, configuration) rows that are not stored yet."""
    keys = ["scene_id", "window_id", "config_hash"]
    return plan.join(native.select(*keys).distinct(), keys, "left_anti")


SCENE_JSON = "id string, name string, footprint array<array<array<struct<x:double,y:double>>>>"


def ledger_view(ledger: DataFrame, config_hash: str | None = None) -> DataFrame:
    """Rows of one configuration by start, with the scene record expanded."""
    rows = ledger.where(F.col("config_hash") == config_hash) if config_hash else ledger
    return rows.withColumn("scene", F.from_json("scene_json", SCENE_JSON)).orderBy(
        "acquisition_start", "scene_name", "scene_id"
    )


def plan_rows(ledger: DataFrame, plan_ids: DataFrame) -> DataFrame:
    """Ledger rows of a saved plan; an empty plan selects nothing, an unknown id is an error."""
    absent = plan_ids.join(ledger, "scene_id", "left_anti")
    if not absent.isEmpty():
        raise ValueError("the plan names scenes that the ledger does not hold")
    return ledger.join(plan_ids.select("scene_id").distinct(), "scene_id", "left_semi")


def plan_summary(ledger: DataFrame, keys: Sequence[str] = ("config_hash",)) -> DataFrame:
    """Rows, statuses, catalogue size and what is left to do."""
    status = F.col("status")
    kinds = ("queued", "running", "done", "failed", "skipped_no_lakes")
    return ledger.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("scenes"),
        *[F.count_if(status == k).alias(k) for k in kinds],
        F.count_if(status.isin(*OPEN)).alias("todo"),
        (F.sum("size_bytes") / F.lit(1024.0**3)).alias("catalogue_GiB"),
    )


QUEUE_COLUMNS = (
    "scene_name",
    "acquisition_start",
    "candidate_lakes",
    "L1_size_GB",
    "status",
    "attempts",
    "processing_strategy",
    "window_count",
    "download_method",
    "compact_MB",
    "stats_rows",
    "last_error",
)


def queue_view(ledger: DataFrame) -> DataFrame:
    """Display projection with sizes in GB and MB; absent columns are left out."""
    sizes = {}
    if "size_bytes" in ledger.columns:
        sizes["L1_size_GB"] = F.col("size_bytes") / F.lit(1024.0**3)
    if "compact_bytes" in ledger.columns:
        sizes["compact_MB"] = F.col("compact_bytes") / F.lit(1024.0**2)
    view = ledger.withColumns(sizes) if sizes else ledger
    return view.select(*[c for c in QUEUE_COLUMNS if c in view.columns])


# --- the stored ledger: snapshots and a numbered pointer to each -----------------------------


class LedgerConflict(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and its path class."""
    kind = spark._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark._jsc.hadoopConfiguration()), kind


def _pointers(spark: SparkSession, path: str) -> dict[int, str]:
    """Snapshot of each version; empty for one whose writer died while it committed."""
    fs, kind = _files(spark, path)
    folder = kind(f"{path}/versions")
    if not fs.exists(folder):
        return {}
    found = {}
    for status in fs.listStatus(folder):
        stream = fs.open(status.getPath())
        try:
            found[int(status.getPath().getName())] = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
    return found


def ledger_version(spark: SparkSession, path: str) -> int:
    """Number of the newest committed version, 0 if there is none."""
    return max((v for v, name in _pointers(spark, path).items() if name), default=0)


def read_ledger(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The ledger as of a version (default: the newest). A snapshot never changes, so readers are safe from writers."""
    pointers = _pointers(spark, path)
    number = version if version is not None else max((v for v, name in pointers.items() if name), default=0)
    if not number:
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.parquet(f"{path}/snapshots/{pointers[number]}")
    return with_missing_columns(rows, LEDGER).select(*[f.name for f in LEDGER])


def write_ledger(ledger: DataFrame, path: str, expected: int | None = None) -> int:
    """Commit a new version in which the configurations present in ``ledger`` are replaced; returns its number.

    ``expected`` is the version that ``ledger`` was derived from (default: the newest now). The snapshot is written
    first; creating the next numbered pointer, which only one writer can do, commits it. If another writer was
    faster, LedgerConflict is raised, and the caller reads and derives again. A snapshot without pointer is never read.
    """
    spark = ledger.sparkSession
    pointers = _pointers(spark, path)
    newest = max((v for v, name in pointers.items() if name), default=0)
    base = newest if expected is None else expected
    if base != newest:
        raise LedgerConflict(f"version {newest} is newer than {base}")
    number = max(pointers, default=0) + 1
    # read by the kept rows' filter and by the snapshot: computed once
    rows = settle(ledger.select(*[f.name for f in LEDGER]))
    kept = read_ledger(spark, path, base).join(rows.select("config_hash").distinct(), "config_hash", "left_anti") if base else None
    name = f"{number:012d}-{uuid.uuid4().hex}"
    fs, kind = _files(spark, path)
    folder = f"{path}/snapshots/{name}"
    (rows if kept is None else rows.unionByName(kept.select(*rows.columns))).write.parquet(folder)
    try:
        # fails if the pointer exists
        stream = fs.create(kind(f"{path}/versions/{number:012d}"), False)
    except Exception as e:
        fs.delete(kind(folder), True)
        raise LedgerConflict(f"version {number} was committed by another writer") from e
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    return number
