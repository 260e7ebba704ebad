"""Geometry in column arithmetic: spheres, projections, cells, polygons."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0
SINUSOIDAL_RADIUS_M = 6371007.181
WEB_MERCATOR_RADIUS_M = 6378137.0
METRES_PER_DEGREE = 111320.0


def unit_sphere_xyz(lat: Column, lon: Column) -> Column:
    la, lo = F.radians(lat.cast("double")), F.radians(lon.cast("double"))
    return F.struct(
        (F.cos(la) * F.cos(lo)).alias("x"),
        (F.cos(la) * F.sin(lo)).alias("y"),
        F.sin(la).alias("z"),
    )


def chord_between(x1, y1, z1, x2, y2, z2) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2) + (z1 - z2) * (z1 - z2))


def chord_to_metres(chord: Column) -> Column:
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), chord / F.lit(2.0)))


def metres_to_chord(metres: float | Column) -> float | Column:
    if isinstance(metres, Column):
        return F.lit(2.0) * F.sin(F.least(metres / (2 * EARTH_RADIUS_M), F.lit(math.pi / 2)))
    return 2.0 * math.sin(min(metres / (2 * EARTH_RADIUS_M), math.pi / 2))


def has_geolocation(lat: Column, lon: Column) -> Column:
    ok = (F.abs(lat) <= 90) & (F.abs(lon) <= 180) & ~F.isnan(lat) & ~F.isnan(lon)
    return F.coalesce(ok, F.lit(False))


def to_webmercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(x, y) in metres; NULL poleward of 85 degrees."""
    la, lo = lat.cast("double"), lon.cast("double")
    usable = F.abs(la) < 85.0
    x = F.lit(WEB_MERCATOR_RADIUS_M) * F.radians(lo)
    y = F.lit(WEB_MERCATOR_RADIUS_M) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(la) / F.lit(2.0)))
    return F.when(usable, x), F.when(usable, y)


def from_webmercator(x: Column, y: Column) -> tuple[Column, Column]:
    """(lat, lon) in degrees."""
    lat = F.degrees(F.atan(F.sinh(y / F.lit(WEB_MERCATOR_RADIUS_M))))
    return lat, F.degrees(x / F.lit(WEB_MERCATOR_RADIUS_M))


def to_sinusoidal(lat: Column, lon: Column) -> tuple[Column, Column]:
    la, lo = F.radians(lat.cast("double")), F.radians(lon.cast("double"))
    r = F.lit(SINUSOIDAL_RADIUS_M)
    return r * lo * F.cos(la), r * la


def floor_cell(value: Column, size: Column | float) -> Column:
    """Index of the half-open cell of width ``size`` that holds ``value``."""
    size = size if isinstance(size, Column) else F.lit(float(size))
    return F.floor(value.cast("double") / size).cast("long")


def chunk_id(row: Column, col: Column, nx: Column, chunk: int = 128) -> Column:
    across = F.ceil(nx.cast("double") / F.lit(float(chunk))).cast("long")
    return F.floor(row / F.lit(chunk)).cast("long") * across + F.floor(col / F.lit(chunk)).cast("long")


def valid_bbox(w: Column, s: Column, e: Column, n: Column) -> Column:
    ok = (w >= -180) & (w < e) & (e <= 180) & (s >= -90) & (s < n) & (n <= 90)
    return F.coalesce(ok, F.lit(False))


def expand_box(w: Column, s: Column, e: Column, n: Column, margin_km: float) -> Column:
    """Box grown by ``margin_km`` on every side, kept on the globe."""
    lat0 = F.greatest(F.lit(-85.0), F.least(F.lit(85.0), (s + n) / F.lit(2.0)))
    dlat = F.lit(margin_km / 111.32)
    dlon = F.lit(float(margin_km)) / F.greatest(F.lit(111.32) * F.cos(F.radians(lat0)), F.lit(1.0))
    return F.struct(
        F.greatest(F.lit(-180.0), w - dlon).alias("w"),
        F.greatest(F.lit(-90.0), s - dlat).alias("s"),
        F.least(F.lit(180.0), e + dlon).alias("e"),
        F.least(F.lit(90.0), n + dlat).alias("n"),
    )


# --- polygons -----------------------------------------------------------------
# A polygon column is array<array<array<struct<x,y>>>>. An edge array is
# array<struct<x1,y1,x2,y2>> over all rings, so holes and parts need no care:
# membership is the even-odd rule.


def box_polygon(w: Column, s: Column, e: Column, n: Column) -> Column:
    corners = [(w, s), (e, s), (e, n), (w, n), (w, s)]
    ring = F.array(
        *[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners]
    )
    return F.array(F.array(ring))


def _ring_edges(ring: Column) -> Column:
    # A ring may or may not repeat its first vertex; closing it again adds an
    # edge of length zero, which crosses nothing.
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")),
    )


def polygon_edges(polygons: Column) -> Column:
    return F.flatten(F.transform(F.flatten(polygons), _ring_edges))


def ring_starts(polygons: Column) -> Column:
    """First vertex of every ring."""
    return F.transform(F.flatten(polygons), lambda ring: F.element_at(ring, 1))


def polygon_bounds(polygons: Column) -> Column:
    vertices = F.flatten(F.flatten(polygons))
    xs, ys = F.transform(vertices, lambda v: v.x), F.transform(vertices, lambda v: v.y)
    return F.struct(
        F.array_min(xs).alias("w"),
        F.array_min(ys).alias("s"),
        F.array_max(xs).alias("e"),
        F.array_max(ys).alias("n"),
    )


def _on_edge(e: Column, x: Column, y: Column) -> Column:
    collinear = (x - e.x1) * (e.y2 - e.y1) == (e.x2 - e.x1) * (y - e.y1)
    within = (
        (x >= F.least(e.x1, e.x2))
        & (x <= F.greatest(e.x1, e.x2))
        & (y >= F.least(e.y1, e.y2))
        & (y <= F.greatest(e.y1, e.y2))
    )
    return collinear & within


def _crosses_ray(e: Column, x: Column, y: Column) -> Column:
    """Does the ray from (x, y) to the east cross the edge? Division-free."""
    straddles = (e.y1 > y) != (e.y2 > y)
    east = ((x - e.x1) * (e.y2 - e.y1) < (e.x2 - e.x1) * (y - e.y1)) == (e.y2 > e.y1)
    return straddles & east


_BOUNDARY = -(1 << 30)


def strictly_inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd membership; a point exactly on an edge is outside."""
    crossings = F.aggregate(
        edges,
        F.lit(0),
        lambda acc, e: F.when(_on_edge(e, x, y), F.lit(_BOUNDARY))
        .when(acc < 0, acc)
        .when(_crosses_ray(e, x, y), acc + 1)
        .otherwise(acc),
    )
    return (crossings > 0) & (crossings % 2 == 1)


def covered(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd membership in which the boundary counts."""
    return strictly_inside(edges, x, y) | F.exists(edges, lambda e: _on_edge(e, x, y))


def _side(ax, ay, bx, by, px, py) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def segments_meet(a: Column, b: Column) -> Column:
    """Do two edges share a point (crossing, touching or overlapping)?"""
    boxes = (
        (F.greatest(a.x1, a.x2) >= F.least(b.x1, b.x2))
        & (F.greatest(b.x1, b.x2) >= F.least(a.x1, a.x2))
        & (F.greatest(a.y1, a.y2) >= F.least(b.y1, b.y2))
        & (F.greatest(b.y1, b.y2) >= F.least(a.y1, a.y2))
    )
    a_splits = _side(a.x1, a.y1, a.x2, a.y2, b.x1, b.y1) * _side(a.x1, a.y1, a.x2, a.y2, b.x2, b.y2)
    b_splits = _side(b.x1, b.y1, b.x2, b.y2, a.x1, a.y1) * _side(b.x1, b.y1, b.x2, b.y2, a.x2, a.y2)
    return boxes & (a_splits <= 0) & (b_splits <= 0)


def polygons_intersect(
    a_edges: Column, a_starts: Column, b_edges: Column, b_starts: Column
) -> Column:
    """Shared area or boundary: a ring starts inside the other, or two edges meet."""
    return (
        F.exists(b_starts, lambda v: strictly_inside(a_edges, v.x, v.y))
        | F.exists(a_starts, lambda v: strictly_inside(b_edges, v.x, v.y))
        | F.exists(a_edges, lambda e: F.exists(b_edges, lambda f: segments_meet(e, f)))
    )


def metres_to_edge(e: Column, x: Column, y: Column) -> Column:
    """Distance from (x, y) to an edge in the local equirectangular frame of the point."""
    ky = F.lit(METRES_PER_DEGREE)
    kx = ky * F.cos(F.radians(y))
    ax, ay = (e.x1 - x) * kx, (e.y1 - y) * ky
    dx, dy = (e.x2 - e.x1) * kx, (e.y2 - e.y1) * ky
    along = F.coalesce(F.try_divide(-(ax * dx + ay * dy), dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    px, py = ax + t * dx, ay + t * dy
    return F.sqrt(px * px + py * py)
