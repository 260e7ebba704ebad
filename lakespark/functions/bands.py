"""Spectral band names: lookup, decoding, export spelling."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAND_PATTERN = r"^[A-Za-z]+_(\d+(?:\.\d+)?)$"
FILL_VALUE = -32767.0

# Wavelengths (nm) of the product modes.
ANALYSIS_WAVELENGTHS = (490, 560, 620, 665, 681, 709, 754, 865, 885)
FULL_WAVELENGTHS = (
    400, 412, 443, 490, 510, 560, 620, 665, 674, 681, 709, 754, 779, 865, 885, 900,
)
AQUATIC_WAVELENGTHS = (400, 412, 443, 490, 510, 560, 620, 665, 674, 681, 709)
# The band that is nominally 885 nm is delivered as 884.
DELIVERED_AS = {885: 884}


def wavelength(name: str) -> float:
    """The number that ends a band name; a KeyError for other names."""
    (nm,) = wavelengths([name], name.rpartition("_")[0]) or (None,)
    if nm is None:
        raise KeyError(f"{name!r} is no band")
    return nm


def wavelengths(columns: Iterable[str], prefix: str) -> dict[float, str]:
    """Columns of a band family by wavelength (nm); of equal ones the first name counts."""
    found: dict[float, str] = {}
    for name in sorted(columns, reverse=True):
        family, _, number = name.rpartition("_")
        if family == prefix and re.match(BAND_PATTERN, name):
            found[float(number)] = name
    return found


def nearest_band(
    columns: Iterable[str], prefix: str, target: float, tolerance: float = 12.0
) -> str:
    """Name of the ``prefix`` band nearest to ``target`` nm; ties go to the first name."""
    known = wavelengths(columns, prefix)
    within = {nm: name for nm, name in known.items() if abs(nm - target) <= tolerance}
    if not within:
        raise KeyError(f"no {prefix} band within {tolerance} nm of {target}")
    return within[min(within, key=lambda nm: (abs(nm - target), within[nm]))]


def nearest_band_rows(
    names: DataFrame,
    keys: Sequence[str],
    name_col: str,
    prefix: str,
    target: float,
    tolerance: float = 12.0,
) -> DataFrame:
    """`nearest_band` for a table of band names: one row per key, NULL beyond tolerance."""
    nm = F.regexp_extract(name_col, BAND_PATTERN, 1).try_cast("double")
    ranked = (
        names.where(F.startswith(name_col, F.lit(prefix + "_")))
        .withColumn("nm", nm)
        .where(F.col("nm").isNotNull())
    )
    best = F.min(F.struct(F.abs(F.col("nm") - target).alias("gap"), F.col(name_col).alias("band")))
    return (
        ranked.groupBy(*keys)
        .agg(best.alias("best"))
        .select(
            *keys,
            F.when(F.col("best.gap") <= tolerance, F.col("best.band")).alias("band"),
            F.col("best.gap").alias("gap_nm"),
        )
    )


def decode_fill(c: Column, fill: float = FILL_VALUE) -> Column:
    """Stored fill values and NaN become NULL; everything else is float32."""
    value = c.cast("float")
    is_missing = value.isNull() | F.isnan(value) | (value == F.lit(fill).cast("float"))
    return F.when(~is_missing, value)


def decode_bands(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: decode_fill(F.col(c)) for c in columns})


def export_names(df: DataFrame) -> DataFrame:
    """Spelling used by exported grids and tables."""
    return df.withColumnsRenamed(
        {
            "rhos_885": "rhos_884",
            "cyan_strict_valid_mask": "generic_flag_exclusion_sensitivity_mask",
        }
    )


# Product mode -> (family, wavelengths of the short list, of the full list); the short list is required.
_SURFACE = ("rhos", ANALYSIS_WAVELENGTHS, FULL_WAVELENGTHS)
_MODES = {
    "full_swath_rhos": (_SURFACE,),
    "rayleigh_ci": (_SURFACE,),
    "standard_dual": (_SURFACE, ("Rrs", (665, 709), AQUATIC_WAVELENGTHS)),
}


def mode_bands(mode: str, full: bool = False) -> tuple[list[str], set[str]]:
    """Ordered band columns of a product mode, and the ones it cannot do without."""
    families = _MODES.get(mode.lower())
    if families is None:
        raise ValueError(f"unknown product mode {mode!r}")
    wanted: list[str] = []
    required: set[str] = set()
    for family, short, long in families:
        names = {w: f"{family}_{DELIVERED_AS.get(w, w) if family == 'rhos' else w}" for w in (*short, *long)}
        wanted += [names[w] for w in (long if full else short)]
        required |= {names[w] for w in short}
    return wanted, required


def select_bands(
    df: DataFrame, mode: str, full: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Project the bands of ``mode``; optional ones may be absent, required ones may not."""
    wanted, required = mode_bands(mode, full)
    absent = sorted(required - set(df.columns))
    if absent:
        raise KeyError(f"required bands missing: {absent}")
    return df.select(*keep, *[b for b in wanted if b in df.columns])
