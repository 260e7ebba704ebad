"""Grid definitions, target cells, binning and the complete science grid.

A grid is one row per scene. ``row0`` says where row 0 lies, because it differs:
south for the exact geographic grid, north for the others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespark.functions import geo
from lakespark.functions.bands import export_names
from lakespark.operators import cover
from lakespark.operators.membership import CELL_DEG, polygon_pieces
from lakespark.operators.nearest import (
    cell_latitude,
    cell_longitude,
    deal,
    dedupe_targets,
    home_of_point,
    mercator_scales,
    same_lake_nearest,
    same_lake_nearest_mercator,
    search_radius,
)
from lakespark.operators.qa import primary_valid
from lakespark.operators.quantiles import summarize
from lakespark.schema import NATIVE_BANDS
from lakespark.session import settle

M_PER_DEG = geo.METRES_PER_DEGREE
DISPLAY_CAP = 30_000_000
SCIENCE_CAP = 25_000_000
CHUNK = 128
#: Cell of the covers in which Mercator targets are found.
CELL_M = 1000.0

# Variables and masks of the complete grid, in order.
GRID_VARIABLES = (*NATIVE_BANDS, "CI", "CI_cyano", "NDCI", "MPH", "FAI")
GRID_MASKS = (
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
    "mph_valid_mask",
    "fai_valid_mask",
)


def _located(df: DataFrame) -> DataFrame:
    return df.where(geo.has_geolocation(F.col("latitude"), F.col("longitude")))


def _extent() -> list[Column]:
    return [
        F.min("longitude").cast("double").alias("lon_min"),
        F.max("longitude").cast("double").alias("lon_max"),
        F.min("latitude").cast("double").alias("lat_min"),
        F.max("latitude").cast("double").alias("lat_max"),
    ]


def _snapped(res: Column, ref_lat: Column) -> dict[str, Column]:
    """Bounds snapped outwards by one cell, and the cell counts."""
    dlat = res / F.lit(M_PER_DEG)
    dlon = res / F.greatest(F.lit(M_PER_DEG) * F.cos(F.radians(ref_lat)), F.lit(1000.0))
    west = F.floor(F.col("lon_min") / dlon) * dlon - dlon
    east = F.ceil(F.col("lon_max") / dlon) * dlon + dlon
    south = F.floor(F.col("lat_min") / dlat) * dlat - dlat
    north = F.ceil(F.col("lat_max") / dlat) * dlat + dlat
    nx = F.greatest(F.lit(2), F.rint((east - west) / dlon)).cast("long")
    ny = F.greatest(F.lit(2), F.rint((north - south) / dlat)).cast("long")
    return {
        "dlat": dlat,
        "dlon": dlon,
        "west": west,
        "south": south,
        "east": west + nx * dlon,
        "north": south + ny * dlat,
        "nx": nx,
        "ny": ny,
    }


def geographic_grid(
    df: DataFrame, resolution_m: float, keys: Sequence[str] = ("scene_id",)
) -> DataFrame:
    """Exact nominal grid around the median latitude; row 0 is south."""
    keys = list(keys)
    ext = summarize(
        _located(df), keys, {"lat": F.col("latitude")}, {"reference_latitude": ("lat", 0.5)}, _extent()
    )
    res = F.lit(float(resolution_m))
    g = _snapped(res, F.col("reference_latitude"))
    return ext.withColumns({**g, "resolution_m": res, "row0": F.lit("south")}).withColumn(
        "ncell", F.col("nx") * F.col("ny")
    )


def geographic_grid_capped(
    df: DataFrame,
    resolution_m: float,
    max_cells: int = SCIENCE_CAP,
    keys: Sequence[str] = ("scene_id",),
    rounds: int = 10,
) -> DataFrame:
    """Grid around the mean latitude that coarsens until it fits; row 0 is north."""
    ext = _located(df).groupBy(*keys).agg(
        F.avg(F.col("latitude").cast("double")).alias("mean_latitude"), *_extent()
    )

    def at(res: Column) -> Column:
        g = _snapped(res, F.col("mean_latitude"))
        n = (g["nx"] * g["ny"]).cast("double")
        grown = res * F.sqrt(n / F.lit(float(max_cells))) * F.lit(1.05)
        return F.struct(
            *[c.alias(k) for k, c in g.items()],
            res.alias("resolution_m"),
            (n <= max_cells).alias("fits"),
            # the loop leaves with the last grid and the resolution grown once more
            F.when(n <= max_cells, res).otherwise(grown).alias("next"),
        )

    rest = F.sequence(F.lit(2), F.lit(rounds))
    final = F.aggregate(
        rest,
        at(F.lit(float(resolution_m))),
        lambda acc, _: F.when(acc["fits"], acc).otherwise(at(acc["next"])),
    )
    return (
        ext.withColumn("g", final)
        .select(*keys, "mean_latitude", "g.*")
        .withColumns(
            {
                "resolution_m": F.when(F.col("fits"), F.col("resolution_m")).otherwise(F.col("next")),
                "ncell": F.col("nx") * F.col("ny"),
                "row0": F.lit("north"),
            }
        )
        .drop("fits", "next")
    )


def require_cells(grid: DataFrame, max_cells: int) -> DataFrame:
    """Raise when any grid is larger than ``max_cells``; resolution never changes silently."""
    worst = grid.agg(F.max("ncell")).head()[0]
    if worst is not None and worst > max_cells:
        raise ValueError(f"a grid of {worst} cells is above the limit of {max_cells}")
    return grid


def mercator_grid(
    df: DataFrame, resolution_m: float, keys: Sequence[str] = ("scene_id",)
) -> DataFrame:
    """Exact Web Mercator grid; row 0 is north. Check it with `require_cells`."""
    x, y = geo.to_webmercator(F.col("latitude"), F.col("longitude"))
    res = F.lit(float(resolution_m))
    ext = (
        df.withColumns({"_x": x, "_y": y})
        .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
        .groupBy(*keys)
        .agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"))
    )
    xmin = F.floor(F.col("x0") / res) * res - res
    ymin = F.floor(F.col("y0") / res) * res - res
    nx = F.greatest(F.lit(2), F.rint((F.ceil(F.col("x1") / res) * res + res - xmin) / res))
    ny = F.greatest(F.lit(2), F.rint((F.ceil(F.col("y1") / res) * res + res - ymin) / res))
    g = ext.select(
        *keys,
        xmin.alias("xmin"),
        ymin.alias("ymin"),
        nx.cast("long").alias("nx"),
        ny.cast("long").alias("ny"),
        res.alias("resolution_m"),
    ).withColumns(
        {
            "xmax": F.col("xmin") + F.col("nx") * F.col("resolution_m"),
            "ymax": F.col("ymin") + F.col("ny") * F.col("resolution_m"),
            "ncell": F.col("nx") * F.col("ny"),
            "row0": F.lit("north"),
        }
    )
    south, west = geo.from_webmercator(F.col("xmin"), F.col("ymin"))
    north, east = geo.from_webmercator(F.col("xmax"), F.col("ymax"))
    return g.withColumns({"south": south, "west": west, "north": north, "east": east})


def sinusoidal_cells(df: DataFrame, resolution_m: float) -> DataFrame:
    """Global row and column of every point on the sinusoidal grid."""
    res = max(1.0, float(resolution_m))
    x, y = geo.to_sinusoidal(F.col("latitude"), F.col("longitude"))
    left, top = -math.pi * geo.SINUSOIDAL_RADIUS_M, 0.5 * math.pi * geo.SINUSOIDAL_RADIUS_M
    return _located(df).withColumns(
        {
            "grow": F.floor((F.lit(top) - y) / F.lit(res)).cast("long"),
            "gcol": F.floor((x - F.lit(left)) / F.lit(res)).cast("long"),
        }
    )


def sinusoidal_grid(
    df: DataFrame, resolution_m: float, keys: Sequence[str] = ("scene_id",)
) -> DataFrame:
    """Globally aligned grid of each scene, with its offsets in the global grid."""
    res = max(1.0, float(resolution_m))
    left, top = -math.pi * geo.SINUSOIDAL_RADIUS_M, 0.5 * math.pi * geo.SINUSOIDAL_RADIUS_M
    g = (
        sinusoidal_cells(df, res)
        .groupBy(*keys)
        .agg(
            F.min("gcol").alias("global_col0"),
            F.max("gcol").alias("c1"),
            F.min("grow").alias("global_row0"),
            F.max("grow").alias("r1"),
        )
    )
    return g.select(
        *keys,
        "global_col0",
        "global_row0",
        (F.col("c1") - F.col("global_col0") + 1).alias("nx"),
        (F.col("r1") - F.col("global_row0") + 1).alias("ny"),
        F.lit(res).alias("resolution_m"),
        (F.lit(left) + F.col("global_col0") * F.lit(res)).alias("x_left"),
        (F.lit(top) - F.col("global_row0") * F.lit(res)).alias("y_top"),
        F.lit("north").alias("row0"),
    )


def raster_grid(
    df: DataFrame,
    resolution_m: float,
    max_cells: int | None = None,
    keys: Sequence[str] = ("scene_id",),
) -> DataFrame:
    """Plate-carree preview grid; row 0 is north.

    With ``max_cells`` a larger grid is coarsened once; ``resolution_m`` of the result is the
    resolution that the grid has.
    """
    ext = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy(*keys).agg(*_extent())
    mid = F.lit(0.5) * (F.col("lat_min") + F.col("lat_max"))
    dy = F.lit(float(resolution_m) / M_PER_DEG)
    dx = F.lit(float(resolution_m)) / F.greatest(F.lit(M_PER_DEG) * F.cos(F.radians(mid)), F.lit(1.0))

    def count(span, step):
        return F.greatest(F.lit(1), F.ceil(span / step)).cast("long")

    lon_span, lat_span = F.col("lon_max") - F.col("lon_min"), F.col("lat_max") - F.col("lat_min")
    first = (count(lon_span, dx) * count(lat_span, dy)).cast("double")
    factor = F.lit(1.0)
    if max_cells is not None:
        factor = F.when(first > max_cells, F.sqrt(first / F.lit(float(max_cells)))).otherwise(1.0)
    sized = ext.withColumns({"_f": factor, "_dx": dx, "_dy": dy}).withColumns(
        {"step_lon": F.col("_dx") * F.col("_f"), "step_lat": F.col("_dy") * F.col("_f")}
    )
    nx, ny = count(lon_span, F.col("step_lon")), count(lat_span, F.col("step_lat"))
    return sized.select(
        *keys,
        F.col("lon_min").alias("west"),
        F.col("lat_min").alias("south"),
        F.col("lon_max").alias("east"),
        F.col("lat_max").alias("north"),
        nx.alias("nx"),
        ny.alias("ny"),
        # cells fill the extent exactly
        (lon_span / nx).alias("dlon"),
        (lat_span / ny).alias("dlat"),
        (F.lit(float(resolution_m)) * F.col("_f")).alias("resolution_m"),
        (nx * ny).alias("ncell"),
        F.lit("north").alias("row0"),
    )


def raster_cells(grid: DataFrame) -> DataFrame:
    """Every cell centre of a `raster_grid`; check the size with `require_cells` first.

    Rows are generated first and spread over the tasks before columns are.
    """
    rows = grid.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ny") - 1)))
    tasks = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = rows.repartition(tasks, "scene_id", "row").withColumn(
        "col", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nx") - 1))
    )
    return cells.select(
        "scene_id",
        "row",
        "col",
        cell_latitude().alias("latitude"),
        cell_longitude().alias("longitude"),
        "resolution_m",
    )


# --- points to cells -----------------------------------------------------------------------


def cell_index(df: DataFrame, grid: DataFrame, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Row, column, flat index and chunk of every point; points off the grid are dropped."""
    g = grid.select(
        *keys,
        *[F.col(c).alias(f"_g_{c}") for c in ("west", "south", "north", "dlat", "dlon", "nx", "ny", "row0")],
    )
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    up = (lat - F.col("_g_south")) / F.col("_g_dlat")
    down = (F.col("_g_north") - lat) / F.col("_g_dlat")
    row = F.floor(F.when(F.col("_g_row0") == "south", up).otherwise(down)).cast("long")
    col = F.floor((lon - F.col("_g_west")) / F.col("_g_dlon")).cast("long")
    on_grid = (
        (F.col("row") >= 0)
        & (F.col("row") < F.col("_g_ny"))
        & (F.col("col") >= 0)
        & (F.col("col") < F.col("_g_nx"))
    )
    return (
        df.join(g, list(keys))
        .withColumns({"row": row, "col": col})
        .where(on_grid)
        .withColumns(
            {
                "flat": F.col("row") * F.col("_g_nx") + F.col("col"),
                "chunk_id": geo.chunk_id(F.col("row"), F.col("col"), F.col("_g_nx"), CHUNK),
            }
        )
        .drop(*[c for c in g.columns if c.startswith("_g_")])
    )


def mean_bin(
    df: DataFrame, value: str, cell: Sequence[str] = ("scene_id", "flat"), valid: str | None = None
) -> DataFrame:
    """Mean of the present (and valid) values of each cell, float32."""
    v = F.col(value).cast("double")
    if valid is not None:
        v = F.when(F.coalesce(F.col(valid).cast("int") > 0, F.lit(False)), v)
    return df.groupBy(*cell).agg(F.avg(v).cast("float").alias(value))


def any_bin(df: DataFrame, mask: str, cell: Sequence[str] = ("scene_id", "flat")) -> DataFrame:
    """1 where any value of the cell is positive, else 0."""
    hit = F.coalesce(F.col(mask).cast("int") > 0, F.lit(False))
    return df.groupBy(*cell).agg(F.max(hit.cast("int")).alias(mask))


def any_bin_on(cells: DataFrame, binned: DataFrame, mask: str, cell: Sequence[str]) -> DataFrame:
    """Mask of every listed cell, -1 where the cell holds no observation."""
    return cells.join(binned, list(cell), "left").withColumn(mask, F.coalesce(mask, F.lit(-1)))


def occupied_chunks(indexed: DataFrame, grid: DataFrame, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Chunks that hold points, and their eight neighbours inside the grid."""
    base = indexed.select(
        *keys,
        F.floor(F.col("row") / CHUNK).cast("long").alias("r"),
        F.floor(F.col("col") / CHUNK).cast("long").alias("c"),
    ).distinct()
    limits = grid.select(
        *keys,
        F.ceil(F.col("ny") / CHUNK).cast("long").alias("nr"),
        F.ceil(F.col("nx") / CHUNK).cast("long").alias("nc"),
    )
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    return (
        base.withColumn("dr", F.explode(around))
        .withColumn("dc", F.explode(around))
        .select(*keys, (F.col("r") + F.col("dr")).alias("chunk_row"), (F.col("c") + F.col("dc")).alias("chunk_col"))
        .distinct()
        .join(limits, list(keys))
        .where(
            (F.col("chunk_row") >= 0)
            & (F.col("chunk_row") < F.col("nr"))
            & (F.col("chunk_col") >= 0)
            & (F.col("chunk_col") < F.col("nc"))
        )
        .select(*keys, "chunk_row", "chunk_col")
    )


# --- target cells ---------------------------------------------------------------------------


#: Parts into which the pieces of one lake are dealt before they meet its scenes.
SALTS = 16


def _cut(pieces: DataFrame, region: DataFrame, cell: float) -> DataFrame:
    """Pieces reduced to the stretches of their rows that a region comes near, with its piece as ``clip``."""
    area = cover.pieces(cover.edge_rows(region.select("polygons").withColumn("_r", F.monotonically_increasing_id()), ["_r"]), ["_r"], cell)
    area = area.select("cy", F.struct(F.col("odd"), F.col("edges")).alias("clip"), F.col("x0").alias("r0"), F.col("x1").alias("r1"))
    met = pieces.join(area, "cy").where((F.col("r0") <= F.col("x1")) & (F.col("x0") <= F.col("r1")))
    return met.withColumns({"x0": F.greatest("x0", "r0"), "x1": F.least("x1", "r1")}).drop("r0", "r1")


def _single(pieces: DataFrame) -> DataFrame:
    """Pieces cut to single cells."""
    return pieces.withColumn("x0", F.explode(F.sequence("x0", "x1"))).withColumn("x1", F.col("x0"))


def _home_on_sphere(cell: float, radius_m: float | None):
    """For `_cells_in`: pieces cell by cell, each with the home cube of its middle, where its targets come into being."""
    if radius_m is None:
        return None
    reach = F.lit(geo.metres_to_chord(float(radius_m)))

    def homes(pieces: DataFrame) -> DataFrame:
        at = _single(pieces).withColumn("_v", geo.unit_sphere_xyz(cover.middle(F.col("cy"), cell), cover.middle(F.col("x0"), cell)))
        at = at.withColumns({f"_{a}": F.col(f"_v.{a}") for a in "xyz"})
        return at.withColumn("_home", home_of_point(("_x", "_y", "_z"), reach, True)).drop("_v", "_x", "_y", "_z")

    return homes


def _home_on_plane(cell: float, radius_m: float | None):
    """As `_home_on_sphere`, for pieces that carry the scale of their scene and lake."""
    if radius_m is None:
        return None
    reach = F.lit(float(radius_m)) * F.col("_scale")

    def homes(pieces: DataFrame) -> DataFrame:
        at = _single(pieces).withColumns({"_x": cover.middle(F.col("x0"), cell), "_y": cover.middle(F.col("cy"), cell)})
        return at.withColumn("_home", home_of_point(("_x", "_y"), reach, False)).drop("_x", "_y")

    return homes


def off_middle(cell: float) -> float:
    """How far a point of a cell lies from its middle at most."""
    return cell * math.sqrt(0.5) * (1.0 + 1e-9)


def _cells_in(scene_lakes, grid, pieces, cell, x_of, y_of, row_span, col_span, erode_m: float = 0.0, homes=None) -> DataFrame:
    """Grid cells whose centre lies strictly inside a lake, piece by piece.

    The pieces of a lake are dealt into parts, each of which meets all its scenes, so that neither a lake of very
    many pieces nor one of very many scenes is one task's work. With ``homes`` pieces travel to their home cubes
    of the nearest join, and grid cells, which are many more, come into being there.
    """
    # pieces are small but each becomes many cells: spread them by number, so that the
    # exchange is not coalesced by its size
    tasks = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumnRenamed("id", "Hylak_id").withColumn("_salt", F.pmod(F.hash("cy", "x0"), F.lit(SALTS)))
    wanted = scene_lakes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cx, cy = cover.cell_of(F.col("_x"), cell), F.col("cy")
    met = wanted.join(dealt, ["Hylak_id", "_salt"]).drop("ord", "_salt")
    if homes is None:
        met = met.repartition(tasks, "scene_id", "Hylak_id", "cy", "x0")
    else:
        met = deal(homes(met), ["scene_id", "Hylak_id"])
    rows = (
        met.join(grid, "scene_id")
        .withColumn("row", F.explode(row_span))
        .withColumn("_y", y_of)
        .where((F.col("row") >= 0) & (F.col("row") < F.col("ny")))
        .where(cover.cell_of(F.col("_y"), cell) == cy)
        .withColumn("col", F.explode(col_span))
        .withColumn("_x", x_of)
        .where((F.col("col") >= 0) & (F.col("col") < F.col("nx")))
        .where(cx.between(F.col("x0"), F.col("x1")))
    )

    def inside(piece, pad: float) -> Column:
        return (F.size(piece["edges"]) == 0) | cover.holds(piece, cx, cy, cell, F.col("_x"), F.col("_y"), pad)

    kept = rows.where(inside({"odd": F.col("odd"), "edges": F.col("edges")}, erode_m))
    return kept.where(inside(F.col("clip"), 0.0)) if "clip" in pieces.columns else kept


def lake_target_cells(
    scene_lakes: DataFrame,
    lakes: DataFrame,
    grid: DataFrame,
    erode_m: float = 0.0,
    cell: float = CELL_DEG,
    region: DataFrame | None = None,
    radius_m: float | None = None,
) -> DataFrame:
    """Cells of the geographic grid whose centre is strictly inside each lake, and inside ``region`` if there is one.

    ``scene_lakes`` lists (scene_id, Hylak_id). Cells are generated inside the
    pieces a lake is cut into, never over its whole bounding box. ``region``: rows with polygons, any of which counts.
    With ``radius_m`` cells come into being where `same_lake_nearest` of that radius looks for them, in a cube named ``_home``.
    """
    lo_r = F.floor((cover.low_side(F.col("cy"), cell) - F.col("south")) / F.col("dlat") - 0.5).cast("long")
    hi_r = F.ceil((cover.low_side(F.col("cy") + 1, cell) - F.col("south")) / F.col("dlat") - 0.5).cast("long")
    lo_c = F.floor((cover.low_side(F.col("x0"), cell) - F.col("west")) / F.col("dlon") - 0.5).cast("long")
    hi_c = F.ceil((cover.low_side(F.col("x1") + 1, cell) - F.col("west")) / F.col("dlon") - 0.5).cast("long")
    g = grid.select("scene_id", "west", "south", "dlat", "dlon", "nx", "ny")
    pieces = polygon_pieces(lakes, cell, erode_m)
    rows = _cells_in(
        scene_lakes,
        g,
        pieces if region is None else _cut(pieces, region, cell),
        cell,
        F.col("west") + (F.col("col") + 0.5) * F.col("dlon"),
        F.col("south") + (F.col("row") + 0.5) * F.col("dlat"),
        F.sequence(lo_r, hi_r),
        F.sequence(lo_c, hi_c),
        erode_m,
        _home_on_sphere(cell, radius_m),
    )
    at_home = [] if radius_m is None else ["_home"]
    found = rows.select("scene_id", "Hylak_id", "row", "col", F.col("_y").alias("latitude"), F.col("_x").alias("longitude"), *at_home)
    # overlapping polygons of a region give a cell more than once
    return found if region is None else found.distinct()


def mercator_polygons(lakes: DataFrame) -> DataFrame:
    """Lakes with their vertices projected to Web Mercator."""

    def vertex(v):
        x, y = geo.to_webmercator(v["y"], v["x"])
        return F.struct(x.alias("x"), y.alias("y"))

    moved = F.transform("polygons", lambda p: F.transform(p, lambda r: F.transform(r, vertex)))
    return lakes.withColumn("polygons", moved)


def lake_target_cells_mercator(
    scene_lakes: DataFrame, lakes: DataFrame, grid: DataFrame, cell: float = CELL_M, radius_m: float | None = None
) -> DataFrame:
    """As `lake_target_cells` on the Mercator grid; rows count from the north.

    With ``radius_m`` (for `same_lake_nearest_mercator`) ``scene_lakes`` have their ``_scale``, and so have the cells.
    """
    res = F.col("resolution_m")
    lo_r = F.floor((F.col("ymax") - cover.low_side(F.col("cy") + 1, cell)) / res - 0.5).cast("long")
    hi_r = F.ceil((F.col("ymax") - cover.low_side(F.col("cy"), cell)) / res - 0.5).cast("long")
    lo_c = F.floor((cover.low_side(F.col("x0"), cell) - F.col("xmin")) / res - 0.5).cast("long")
    hi_c = F.ceil((cover.low_side(F.col("x1") + 1, cell) - F.col("xmin")) / res - 0.5).cast("long")
    g = grid.select("scene_id", "xmin", "ymax", "resolution_m", "nx", "ny")
    rows = _cells_in(
        scene_lakes,
        g,
        polygon_pieces(mercator_polygons(lakes), cell),
        cell,
        F.col("xmin") + (F.col("col") + 0.5) * res,
        F.col("ymax") - (F.col("row") + 0.5) * res,
        F.sequence(lo_r, hi_r),
        F.sequence(lo_c, hi_c),
        0.0,
        _home_on_plane(cell, radius_m),
    )
    at_home = [] if radius_m is None else ["_scale", "_home"]
    return rows.select("scene_id", "Hylak_id", "row", "col", F.col("_x").alias("x"), F.col("_y").alias("y"), *at_home)


def scene_lake_pairs(native: DataFrame) -> DataFrame:
    return native.select("scene_id", "Hylak_id").where(F.col("Hylak_id") > 0).distinct()


TARGET_ID = ["scene_id", "Hylak_id", "row", "col"]


def grid_assignments(
    native: DataFrame, lakes: DataFrame, resolution_m: float, erode_m: float = 0.0, every: bool = False
) -> DataFrame:
    """Target cells of every lake with their nearest same-lake pixel, one per cell; with ``every`` one per cell and lake."""
    return geographic_matches(settle(_places(native)), lakes, resolution_m, erode_m, every)


_PLACE = ("scene_id", "Hylak_id", "obs_id", "latitude", "longitude")


def _places(native: DataFrame) -> DataFrame:
    return native.select(*_PLACE)


def geographic_matches(places: DataFrame, lakes: DataFrame, resolution_m: float, erode_m: float = 0.0, every: bool = False) -> DataFrame:
    """As `grid_assignments`, from the places of the pixels, which are read several times."""
    grid, radius = settle(geographic_grid(places, resolution_m)), search_radius(resolution_m)
    targets = lake_target_cells(scene_lake_pairs(places), lakes, grid, erode_m, radius_m=radius)
    matched = same_lake_nearest(targets, places, radius, TARGET_ID, off_middle(math.radians(CELL_DEG)))
    return matched if every else dedupe_targets(matched)


def mercator_matches(places: DataFrame, lakes: DataFrame, resolution_m: float) -> DataFrame:
    """Target cells of the Mercator grid with their nearest same-lake pixel, one per cell and lake; ``places`` as there."""
    grid, radius = settle(mercator_grid(places, resolution_m)), search_radius(resolution_m)
    scales = settle(mercator_scales(places))
    # a lake none of whose pixels has a place in the projection finds nothing at any scale
    pairs = scene_lake_pairs(places).join(scales, ["scene_id", "Hylak_id"], "left").fillna(1.0, subset=["_scale"])
    targets = lake_target_cells_mercator(pairs, lakes, grid, radius_m=radius)
    return same_lake_nearest_mercator(targets, places, radius, TARGET_ID, scales, off_middle(CELL_M))


def grid_assignments_mercator(native: DataFrame, lakes: DataFrame, resolution_m: float) -> DataFrame:
    return dedupe_targets(mercator_matches(settle(_places(native)), lakes, resolution_m))


def complete_science_grid(
    native: DataFrame, lakes: DataFrame, resolution_m: float = 300.0, erode_m: float = 0.0, every: bool = False
) -> DataFrame:
    """Every supported cell with 14 science variables, masks, support and match columns; ``every`` as in `grid_assignments`.

    Science values are NULL unless the chosen pixel is primary-valid; masks are those
    of the chosen pixel.
    """
    cells = grid_assignments(native, lakes, resolution_m, erode_m, every)
    masks = [m for m in GRID_MASKS if m in native.columns]
    variables = [v for v in GRID_VARIABLES if v in native.columns]
    # an array of floats and a number of bits are much narrower in an exchange than a column for each
    floats = [v for v in variables if native.schema[v].dataType == T.FloatType()]
    others = [v for v in variables if v not in floats]
    value = lambda v: F.when(F.col("_primary"), F.col(v))
    bits = sum((F.when(F.col(m).cast("int") != 0, 1 << i).otherwise(0) for i, m in enumerate(masks)), F.lit(0))
    source = primary_valid(native, "_primary").select(
        "scene_id", "obs_id", *[value(v).alias(v) for v in others], F.array(*map(value, floats)).alias("_floats"), bits.alias("_bits")
    )
    found = F.col("obs_id").isNotNull()
    unpacked = {v: F.get("_floats", F.lit(i)) for i, v in enumerate(floats)}
    unpacked |= {m: F.shiftright("_bits", i).bitwiseAND(1) for i, m in enumerate(masks)}
    grid = (
        cells.join(source, ["scene_id", "obs_id"], "left")
        .select(*cells.columns, *[unpacked.get(c, F.col(c)).alias(c) for c in (*variables, *masks)])
        .withColumns(
            {
                "lake_support_mask": F.lit(1),
                "native_source_match_mask": found.cast("int"),
                "native_match_distance_m": F.col("match_distance_m").cast("float"),
                "nearest_Hylak_id": F.when(found, F.col("Hylak_id")),
            }
        )
        .drop("match_distance_m")
    )
    return export_names(grid)
