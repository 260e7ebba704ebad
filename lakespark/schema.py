"""Table schemas and tolerant reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nominal wavelengths (nm) kept for every lake pixel.
NATIVE_WAVELENGTHS = (490, 560, 620, 665, 681, 709, 754, 865, 885)
NATIVE_BANDS = tuple(f"rhos_{w}" for w in NATIVE_WAVELENGTHS)

# Mask and index names of the native table, in stored order.
NATIVE_MASKS = (
    "valid_water_mask",
    "cyan_strict_valid_mask",
    "bloom_rescue_mask",
    "cldice_mask",
    "hisatzen_mask",
    "navfail_mask",
    "cloud_excluded_mask",
    "ci_valid_mask",
    "ci_candidate_mask",
    "ci_detection_mask",
    "ndci_valid_mask",
    "mph_valid_mask",
    "fai_valid_mask",
)
NATIVE_INDICES = ("SS_681", "SS_665", "CI", "CI_cyano", "NDCI", "MPH", "MPH_peak_nm", "FAI")

COORDINATE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
# multipolygon -> polygon -> ring -> vertex
MULTIPOLYGON = T.ArrayType(T.ArrayType(T.ArrayType(COORDINATE)))

_SCENE_KEYS = [
    T.StructField("scene_id", T.StringType(), False),
    T.StructField("window_id", T.StringType()),
]

SWATH = T.StructType(
    _SCENE_KEYS
    + [
        T.StructField("source_row", T.IntegerType()),
        T.StructField("source_col", T.IntegerType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        # unsigned 32-bit in the product, so a long here
        T.StructField("l2_flags", T.LongType()),
    ]
    + [
        T.StructField(f"rhos_{w}", T.FloatType())
        for w in (490, 560, 620, 665, 681, 709, 754, 865, 884)
    ]
)

NATIVE = T.StructType(
    _SCENE_KEYS
    + [
        T.StructField("obs_id", T.LongType()),
        T.StructField("Hylak_id", T.LongType()),
        T.StructField("source_row", T.IntegerType()),
        T.StructField("source_col", T.IntegerType()),
        T.StructField("l2_flags", T.LongType()),
    ]
    + [T.StructField(n, T.BooleanType()) for n in NATIVE_MASKS]
    + [T.StructField(n, T.FloatType()) for n in ("latitude", "longitude")]
    + [T.StructField(n, T.FloatType()) for n in NATIVE_BANDS]
    + [T.StructField(n, T.FloatType()) for n in NATIVE_INDICES]
)

# Columns that repeat per file in the product and are ordinary columns here.
PROVENANCE = T.StructType(
    [
        T.StructField("scene_name", T.StringType()),
        T.StructField("acquisition_start", T.StringType()),
        T.StructField("config_hash", T.StringType()),
        T.StructField("shore_buffer_m", T.DoubleType()),
        T.StructField("ci_detection_limit", T.DoubleType()),
    ]
)

SCENES = T.StructType(
    [
        T.StructField("scene_id", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("satellite", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("online", T.BooleanType()),
        T.StructField("s3_path", T.StringType()),
        T.StructField("footprint", MULTIPOLYGON),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("scene_id", T.StringType(), False),
        T.StructField("config_hash", T.StringType(), False),
        T.StructField("scene_name", T.StringType()),
        T.StructField("acquisition_start", T.StringType()),
        T.StructField("acquisition_end", T.StringType()),
        T.StructField("s3_path", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("candidate_lakes", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("processing_strategy", T.StringType()),
        T.StructField("window_count", T.LongType()),
        T.StructField("download_method", T.StringType()),
        T.StructField("compact_bytes", T.LongType()),
        T.StructField("stats_rows", T.LongType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("updated_utc", T.StringType()),
        T.StructField("scene_json", T.StringType()),
    ]
)


def with_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add every column of ``schema`` that ``df`` lacks as a typed NULL."""
    present = {c.lower() for c in df.columns}
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name.lower() not in present}
    return df.withColumns(absent) if absent else df
