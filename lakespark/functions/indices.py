"""Spectral indices.

Inputs are float32 columns in which every missing value is NULL (see
`bands.decode_fill`), so NaN never takes part in a comparison. The CI family and
NDCI keep float32 arithmetic; line heights are float64.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DETECTION_LIMIT = 0.0001
CORE_WAVELENGTHS = (620.0, 665.0, 681.0, 709.0)


def f32(value: float) -> Column:
    return F.lit(float(value)).cast("float")


def true_or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def all_present(*cols: Column) -> Column:
    return reduce(and_, [c.isNotNull() for c in cols])


def ci_family(
    df: DataFrame,
    bands: Sequence[str],
    wavelengths: Sequence[float] = CORE_WAVELENGTHS,
    detection_limit: float = DETECTION_LIMIT,
    ss681_max: float = 0.0,
    ss665_min: float = 0.0,
    prefix: str = "",
) -> DataFrame:
    """Add SS_681, SS_665, CI, CI_cyano, ci_finite, ci_candidate and ci_detection.

    ``bands`` names the 620, 665, 681 and 709 nm columns in that order.
    """
    r620, r665, r681, r709 = (F.col(b) for b in bands)
    w620, w665, w681, w709 = map(float, wavelengths)
    shape681 = r681 - r665 - (r709 - r665) * f32((w681 - w665) / (w709 - w665))
    shape665 = r665 - r620 - (r681 - r620) * f32((w665 - w620) / (w681 - w620))
    finite = all_present(r620, r665, r681, r709)
    p = prefix
    ss681, ss665, ci = F.col(p + "SS_681"), F.col(p + "SS_665"), F.col(p + "CI")
    return (
        df.withColumns(
            {
                p + "ci_finite": finite,
                p + "SS_681": F.when(finite, shape681),
                p + "SS_665": F.when(finite, shape665),
            }
        )
        .withColumn(p + "ci_candidate", true_or_false(ss681 < f32(ss681_max)))
        .withColumn(p + "CI", F.when(F.col(p + "ci_candidate"), -ss681))
        .withColumn(
            p + "ci_detection",
            true_or_false((ss665 > f32(ss665_min)) & (ci > f32(detection_limit))),
        )
        .withColumn(p + "CI_cyano", F.when(F.col(p + "ci_detection"), ci))
    )


def ndci_valid(red: Column, edge: Column) -> Column:
    return true_or_false(F.abs(edge + red) > f32(1e-8))


def ndci(red: Column, edge: Column) -> Column:
    """Normalised difference; NULL where the denominator is too small."""
    ratio = F.try_divide((edge - red).cast("double"), (edge + red).cast("double"))
    return F.when(ndci_valid(red, edge), ratio.cast("float"))


def line_height(
    center: Column, left: Column, right: Column, wl_center: float, wl_left: float, wl_right: float
) -> Column:
    """Height of ``center`` above the straight line through ``left`` and ``right``."""
    c, lo, hi = (x.cast("double") for x in (center, left, right))
    share = (float(wl_center) - float(wl_left)) / (float(wl_right) - float(wl_left))
    return c - (lo + (hi - lo) * F.lit(share))


def fai(r665: Column, r754: Column, r865: Column, wl: Mapping[int, float] | None = None) -> Column:
    """754 nm above the 665-865 nm line; NULL unless all three bands are present."""
    w = {k: float((wl or {}).get(k, k)) for k in (665, 754, 865)}
    return line_height(r754, r665, r865, w[754], w[665], w[865])


def mph(
    r665: Column,
    r681: Column,
    r709: Column,
    r754: Column,
    r885: Column,
    wl: Mapping[int, float] | None = None,
) -> tuple[Column, Column]:
    """Largest of the 681/709/754 nm heights over the 665-885 nm line, and its wavelength.

    A peak whose band is missing is skipped; the first of equal peaks wins.
    """
    w = {k: float((wl or {}).get(k, k)) for k in (665, 681, 709, 754, 885)}
    peaks = ((681, r681), (709, r709), (754, r754))
    heights = [line_height(c, r665, r885, w[k], w[665], w[885]) for k, c in peaks]
    top = F.greatest(*heights)
    where_top = reduce(
        lambda otherwise, pair: F.when(pair[1] == top, f32(w[pair[0]])).otherwise(otherwise),
        reversed([(k, h) for (k, _), h in zip(peaks, heights)]),
        F.lit(None).cast("float"),
    )
    return top, where_top


def dn_is_science(dn: Column, valid: Column) -> Column:
    return true_or_false(valid & (dn >= 0) & (dn <= 250))


def dn_to_ci(dn: Column, valid: Column) -> Column:
    """Reference raster digital number to CI, float32; NULL for non-science cells."""
    value = F.pow(F.lit(10.0), F.lit(3.0 / 250.0) * dn.cast("double") - F.lit(4.2))
    return F.when(dn_is_science(dn, valid), value.cast("float"))


def negative_band_count(bands: Sequence[str], ci_valid: Column) -> Column:
    """How many core bands are below zero; NULL unless the CI inputs are valid."""
    total = reduce(add, [F.coalesce((F.col(b) < 0).cast("int"), F.lit(0)) for b in bands])
    return F.when(ci_valid, total)
