"""Lake catalogues: normalised columns, GeoJSON polygons, region filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespark.operators.membership import lakes_in_region

_VERTEX = "array<double>"


def geojson_polygons(geometry: Column) -> Column:
    """Polygon or MultiPolygon GeoJSON text to nested rings; anything else is NULL."""
    kind = F.get_json_object(geometry, "$.type")
    coordinates = F.get_json_object(geometry, "$.coordinates")

    def rings(polygon):
        return F.transform(
            polygon,
            lambda ring: F.transform(
                ring, lambda v: F.struct(F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("y"))
            ),
        )

    one = F.from_json(coordinates, f"array<array<{_VERTEX}>>")
    several = F.from_json(coordinates, f"array<array<array<{_VERTEX}>>>")
    return F.when(kind == "Polygon", F.array(rings(one))).when(
        kind == "MultiPolygon", F.transform(several, rings)
    )


def invalid_rings(polygons: Column) -> Column:
    """Rings with fewer than three distinct vertices; they enclose nothing."""
    return F.filter(F.flatten(polygons), lambda ring: F.size(F.array_distinct(ring)) < 3)


#: Canonical column -> how it is read; the other columns of a lake table are not used.
_READ = {
    "Hylak_id": lambda c, _: c.cast("long"),
    "Lake_area": lambda c, _: c.try_cast("double"),
    "geometry": lambda c, kind: geojson_polygons(c) if kind == "string" else c,
    "Lake_name": lambda c, _: c,
    "Country": lambda c, _: c,
    "Lake_type": lambda c, _: c,
    "Continent": lambda c, _: c,
}
_NEEDED = ("Hylak_id", "Lake_area", "geometry")


def normalize_lakes(df: DataFrame) -> DataFrame:
    """Canonical columns from any spelling; lakes without a geometry are dropped.

    The id must be a number (an error otherwise); an unreadable area becomes NULL.
    ``geometry`` holds GeoJSON text, or nested rings already.
    """
    canonical = {name.lower(): name for name in _READ}
    read = {}
    for field in df.schema.fields:
        name = canonical.get(field.name.lower())
        if name:
            read[name] = _READ[name](F.col(f"`{field.name}`"), field.dataType.simpleString())
    absent = [name for name in _NEEDED if name not in read]
    if absent:
        raise ValueError(f"lake table lacks {absent}")
    shape = read.pop("geometry")
    columns = {"Hylak_id": read.pop("Hylak_id")}
    columns["lake_order"] = columns["Hylak_id"]
    columns |= {name: read[name] for name in _READ if name in read}
    out = df.select(*(c.alias(name) for name, c in columns.items()), shape.alias("polygons"))
    return out.where(F.col("polygons").isNotNull() & (F.size(F.flatten("polygons")) > 0))


def filter_lakes(
    lakes: DataFrame, min_area_km2: float, region: str = "WORLD", nation: DataFrame | None = None
) -> DataFrame:
    """Lakes of a minimum area in a region.

    WORLD keeps all, USA keeps lakes that meet the national polygon (whole polygons),
    anything else is a continent name.
    """
    large = lakes.where(F.col("Lake_area") >= float(min_area_km2))
    region = region.upper()
    if region == "WORLD":
        return large
    if region == "USA":
        if nation is None:
            raise ValueError("region USA needs the national polygon")
        return lakes_in_region(large, nation)
    return large.where(F.upper("Continent") == region)
