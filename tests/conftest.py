import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from lakespark import configure

    return configure(session)


def box(w, s, e, n):
    ring = [(w, s), (e, s), (e, n), (w, n), (w, s)]
    return [[[{"x": float(x), "y": float(y)} for x, y in ring]]]


@pytest.fixture(scope="session")
def two_lakes(spark):
    from lakespark.schema import MULTIPOLYGON
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("Hylak_id", T.LongType()),
            T.StructField("lake_order", T.LongType()),
            T.StructField("Lake_name", T.StringType()),
            T.StructField("Lake_area", T.DoubleType()),
            T.StructField("Country", T.StringType()),
            T.StructField("Continent", T.StringType()),
            T.StructField("polygons", MULTIPOLYGON),
        ]
    )
    rows = [
        (1, 1, "Test A", 20.0, "US", "North America", box(-85.012, 39.999, -85.000, 40.010)),
        (2, 2, "Test B", 12.0, "US", "North America", box(-85.000, 39.999, -84.990, 40.010)),
    ]
    return spark.createDataFrame(rows, schema)


BASE = dict(zip((490, 560, 620, 665, 681, 709, 754, 865, 884), (0.01, 0.02, 0.01, 0.03, 0.02, 0.04, 0.05, 0.02, 0.01)))


@pytest.fixture(scope="session")
def small_swath(spark):
    """Two lines of six pixels over both lakes."""
    lons = (-85.009, -85.007, -85.005, -85.003, -84.997, -84.995)
    flags = ((0, 2, 2, 4, 1, 8), (0,) * 6)
    rows = []
    for line, lat in enumerate((40.001, 40.004)):
        for col, lon in enumerate(lons):
            b = dict(BASE)
            if (line, col) == (0, 2):
                b[754] = 0.001
            if (line, col) == (1, 0):
                b[681] = 0.05
            if (line, col) == (1, 1):
                b[620] = -0.01
            rows.append(("scene", "FULL", line * 6 + col, line, col, lat, lon, flags[line][col], *b.values()))
    names = ", ".join(f"rhos_{w} float" for w in BASE)
    return spark.createDataFrame(
        rows,
        "scene_id string, window_id string, obs_id long, source_row int, source_col int, latitude float, "
        f"longitude float, l2_flags long, {names}",
    )
