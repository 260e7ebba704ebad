"""Reference rasters as cell tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.operators.membership import assign_lake, every_lake

# geotransform: (x origin, x step, y origin, y step); y step is negative for north-up rasters
GeoTransform = Sequence[float]


def reference_cells(raster: DataFrame, geotransform: GeoTransform) -> DataFrame:
    """Add the centre of every cell: (row, col) plus half a step."""
    x0, dx, y0, dy = map(float, geotransform)
    return raster.withColumns(
        {
            "latitude": F.lit(y0) + (F.col("row") + 0.5) * F.lit(dy),
            "longitude": F.lit(x0) + (F.col("col") + 0.5) * F.lit(dx),
        }
    )


def lake_windows(bounds: DataFrame, geotransform: GeoTransform, width: int, height: int) -> DataFrame:
    """Raster window of each lake's bounds, rounded and clipped; no overlap, no row.

    ``bounds``: Hylak_id, west, south, east, north.
    """
    x0, dx, y0, dy = map(float, geotransform)
    ca, cb = (F.col("west") - x0) / dx, (F.col("east") - x0) / dx
    ra, rb = (F.col("north") - y0) / dy, (F.col("south") - y0) / dy
    left, top = F.rint(F.least(ca, cb)), F.rint(F.least(ra, rb))
    # offsets and lengths are rounded separately
    right = left + F.rint(F.abs(cb - ca))
    bottom = top + F.rint(F.abs(rb - ra))
    return bounds.select(
        "Hylak_id",
        F.greatest(left, F.lit(0.0)).cast("long").alias("col0"),
        F.least(right, F.lit(float(width))).cast("long").alias("col1"),
        F.greatest(top, F.lit(0.0)).cast("long").alias("row0"),
        F.least(bottom, F.lit(float(height))).cast("long").alias("row1"),
    ).where((F.col("col1") > F.col("col0")) & (F.col("row1") > F.col("row0")))


def cells_in_lakes(raster: DataFrame, geotransform: GeoTransform, lakes: DataFrame, every: bool = False) -> DataFrame:
    """Cells whose centre lies strictly inside a lake; with ``every`` once for each such lake."""
    assign = every_lake if every else assign_lake
    return assign(reference_cells(raster, geotransform), lakes).where(F.col("Hylak_id") > 0)
