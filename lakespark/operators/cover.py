"""Cover of polygons by grid cells: each cell on a boundary holds its own edges, the interior is row spans.

A cell that edges touch carries those edges and one bit, the parity of its reference point on
its west side. A point of the cell is inside if that bit, and the edges crossed on the way from the reference
point north or south along the west side and then east to the point, add up to an odd number. Cells between two
boundary cells of a row are all inside or all outside, and those inside are one span whatever its
length. The size of a cover grows with the outline of a polygon and its rows, not with its area.

Cell borders lie at an irrational part of the cell, so that they do not run through vertices on round coordinates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakespark.functions import geo
from lakespark.functions.geo import METRES_PER_DEGREE

OFFSET = 0.3819660112501051
#: Cells of a row that share a key, as a power of two.
STRIP_BITS = 5
_SLACK = 1e-9
_BOUNDARY = -(1 << 30)


def cell_of(value: Column, size: Column | float) -> Column:
    """Number of the cell that holds ``value``."""
    size = size if isinstance(size, Column) else F.lit(float(size))
    return F.floor(value.cast("double") / size + OFFSET).cast("long")


def low_side(number: Column, size: Column | float) -> Column:
    """West or south side of a cell."""
    return (number - F.lit(OFFSET)) * (size if isinstance(size, Column) else F.lit(float(size)))


def middle(number: Column, size: Column | float) -> Column:
    """The line through the middle of a row of cells, on which the reference points lie."""
    return (number + F.lit(0.5 - OFFSET)) * (size if isinstance(size, Column) else F.lit(float(size)))


def strip_of(number: Column) -> Column:
    return F.shiftright(number, STRIP_BITS)


def _cells(lo: Column, hi: Column, size) -> Column:
    return F.sequence(cell_of(lo, size), cell_of(hi, size))


def edge_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and x1, y1, x2, y2 of every edge of the column ``polygons``; rows without one give none."""
    edges = df.where(F.col("polygons").isNotNull()).select(*keys, F.explode(geo.polygon_edges(F.col("polygons"))).alias("_e"))
    return edges.select(*keys, *(F.col(f"_e.{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")))


def edge_cells(edges: DataFrame, size: Column | float, pad_y: float = 0.0) -> DataFrame:
    """``edges`` with every cell (cx, cy) that each comes near: within ``pad_y`` degrees of latitude, as far in longitude."""
    size = size if isinstance(size, Column) else F.lit(float(size))
    south, north = F.least("y1", "y2"), F.greatest("y1", "y2")
    west, east = F.least("x1", "x2"), F.greatest("x1", "x2")
    slack = size * _SLACK
    room = F.lit(pad_y) + slack
    rows = edges.withColumn("cy", F.explode(_cells(south - room, north + room, size)))
    lo = F.greatest(low_side(F.col("cy"), size) - room, south)
    hi = F.least(low_side(F.col("cy") + 1, size) + room, north)

    def x_at(y: Column) -> Column:
        along = F.col("x1") + (y - F.col("y1")) * F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
        return F.greatest(west, F.least(east, F.coalesce(along, west)))

    flat = F.col("y1") == F.col("y2")
    first, last = F.when(flat, west).otherwise(F.least(x_at(lo), x_at(hi))), F.when(flat, east).otherwise(F.greatest(x_at(lo), x_at(hi)))
    pad_x = slack
    if pad_y:
        highest = F.least(F.greatest(F.abs(low_side(F.col("cy"), size)), F.abs(low_side(F.col("cy") + 1, size))) + pad_y, F.lit(89.0))
        pad_x = slack + F.lit(pad_y) / F.greatest(F.cos(F.radians(highest)), F.lit(0.01))
    return rows.withColumn("cx", F.explode(_cells(first - pad_x, last + pad_x, size)))


def _turn(x1, y1, x2, y2, x, y) -> Column:
    """Positive where (x, y) lies to the left of the edge."""
    return (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)


def pieces(edges: DataFrame, keys: Sequence[str], size: Column | float, pad_m: float = 0.0) -> DataFrame:
    """The cover of the polygons: ``keys``, cy, x0, x1 (first and last cell of the row), odd and edges.

    Boundary cells have x0 = x1, their edges, and the parity of their reference point. Spans of the interior have no
    edges. With ``pad_m`` a boundary cell holds all edges that may lie within so many metres of its points.
    """
    keys = list(keys)
    of = size if isinstance(size, Column) else F.lit(float(size))
    near = edge_cells(edges, of, pad_m / METRES_PER_DEGREE * 1.01)
    y0 = middle(F.col("cy"), of)

    def right_of(number: Column) -> Column:
        """Does the edge cross the middle line east of the reference point of a cell?"""
        straddles = (F.col("y1") > y0) != (F.col("y2") > y0)
        turn = _turn(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), low_side(number, of), y0)
        return straddles & ((turn > 0) == (F.col("y2") > F.col("y1")))

    # crossings of this cell: east of its own reference point, but not of its neighbour's
    crossing = right_of(F.col("cx")) & ~right_of(F.col("cx") + 1)
    one = F.struct("x1", "y1", "x2", "y2")
    cells = near.groupBy(*keys, "cy", "cx").agg(F.collect_list(one).alias("edges"), F.sum(crossing.cast("long")).alias("_c"))
    east = Window.partitionBy(*keys, "cy").orderBy(F.col("cx").desc())
    marked = cells.withColumns(
        {
            "_east": F.sum("_c").over(east.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_next": F.lag("cx").over(east),
        }
    )
    own = F.struct(F.col("cx").alias("x0"), F.col("cx").alias("x1"), (F.col("_east") % 2 == 1).alias("odd"), F.col("edges").alias("edges"))
    gap = F.struct((F.col("cx") + 1).alias("x0"), (F.col("_next") - 1).alias("x1"), F.lit(True).alias("odd"), F.slice("edges", 1, 0).alias("edges"))
    inner = F.coalesce(((F.col("_east") - F.col("_c")) % 2 == 1) & (F.col("_next") > F.col("cx") + 1), F.lit(False))
    return marked.select(*keys, "cy", F.explode(F.when(inner, F.array(own, gap)).otherwise(F.array(own))).alias("_p")).select(*keys, "cy", "_p.*")


def holds(piece, cx: Column, cy: Column, size: Column | float, x: Column, y: Column, pad_m: float = 0.0) -> Column:
    """Is (x, y), a point of cell (cx, cy) of the piece, strictly inside, and at least ``pad_m`` metres from every edge?"""
    west, y0 = low_side(cx, size), middle(cy, size)

    def step(acc: Column, e: Column) -> Column:
        here, there, start = (_turn(e.x1, e.y1, e.x2, e.y2, px, py) for px, py in ((x, y), (west, y), (west, y0)))
        within = (x >= F.least(e.x1, e.x2)) & (x <= F.greatest(e.x1, e.x2)) & (y >= F.least(e.y1, e.y2)) & (y <= F.greatest(e.y1, e.y2))
        collinear = (x - e.x1) * (e.y2 - e.y1) == (e.x2 - e.x1) * (y - e.y1)
        # a point on the line of a level edge counts as just above it
        left = F.when(there == 0, e.x2 > e.x1).otherwise(there > 0)
        eastward = ((e.y1 > y) != (e.y2 > y)) & ((here > 0) != left)
        upward = ((e.x1 > west) != (e.x2 > west)) & (left != (start > 0))
        return F.when(collinear & within, F.lit(_BOUNDARY)).when(acc < 0, acc).otherwise(acc + eastward.cast("int") + upward.cast("int"))

    crossed = F.aggregate(piece["edges"], piece["odd"].cast("int"), step)
    inside = (crossed > 0) & (crossed % 2 == 1)
    if pad_m > 0:
        inside = inside & ~F.exists(piece["edges"], lambda e: geo.metres_to_edge(e, x, y) < F.lit(float(pad_m)))
    return inside


#: Sizes of cells for polygons of all kinds, in degrees (or any other unit): powers of four.
LEVELS = tuple(range(-7, 4))


def level_size(level: Column) -> Column:
    return F.pow(F.lit(4.0), level.cast("double"))


def own_level(df: DataFrame) -> Column:
    """Level of ``polygons`` with about as many cells along its extent as it has vertices, eight at least."""
    b = geo.polygon_bounds(F.col("polygons"))
    extent = F.greatest(b["e"] - b["w"], b["n"] - b["s"])
    vertices = F.size(F.flatten(F.flatten("polygons")))
    wanted = F.floor(F.log(4.0, F.greatest(extent, F.lit(1e-9)) / (8 + vertices / 8.0)) + 0.5)
    return F.greatest(F.lit(LEVELS[0]), F.least(F.lit(LEVELS[-1]), wanted)).cast("int")


def containing(points: DataFrame, polygons: DataFrame, point_keys: Sequence[str], polygon_keys: Sequence[str], on: Sequence[str] = ()) -> DataFrame:
    """(point keys, polygon keys) of every point (x, y) strictly inside a polygon, by equi-joins on cells.

    ``on``: columns among both keys that must agree.

    Every polygon is covered at a level of its own; a point has one key for each level.
    """
    pk, gk = list(point_keys), list(polygon_keys)
    edges = edge_rows(polygons.where(F.size(F.flatten("polygons")) > 0).withColumn("level", own_level(polygons)), [*gk, "level"])
    size = level_size(F.col("level"))
    cover = pieces(edges, [*gk, "level"], size).withColumnsRenamed({"x0": "c0", "x1": "c1"})
    strips = cover.withColumn("strip", F.explode(F.sequence(strip_of(F.col("c0")), strip_of(F.col("c1")))))
    placed = (
        points.select(*pk, F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y"), F.explode(F.array(*map(F.lit, LEVELS))).alias("level"))
        .withColumns({"cx": cell_of(F.col("_x"), size), "cy": cell_of(F.col("_y"), size)})
        .withColumn("strip", strip_of(F.col("cx")))
    )
    piece = {c: F.col(c) for c in ("edges", "odd")}
    found = placed.join(strips, ["level", "cy", "strip", *on]).where((F.col("c0") <= F.col("cx")) & (F.col("cx") <= F.col("c1")))
    return found.where(holds(piece, F.col("cx"), F.col("cy"), size, F.col("_x"), F.col("_y"))).select(*pk, *(k for k in gk if k not in on))
