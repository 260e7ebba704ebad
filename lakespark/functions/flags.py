"""Bit flags: map decoding, bit tests, exclusion profiles."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

FlagMap = Mapping[str, int]

# Flags offered for exclusion and the named profiles.
FLAG_CHOICES = (
    "ATMFAIL",
    "NAVFAIL",
    "NAVWARN",
    "HILT",
    "CLDICE",
    "STRAYLIGHT",
    "HIGLINT",
    "HISATZEN",
    "HISOLZEN",
)
# profile -> (excluded flags, land adjacency in pixels)
PROFILES = {
    "bloom_retaining": (("NAVFAIL",), 0),
    "balanced_inland": (("ATMFAIL", "NAVFAIL", "HILT", "CLDICE", "STRAYLIGHT"), 0),
    "relaxed_inland": (("NAVFAIL", "HILT", "CLDICE"), 0),
    "diagnostic": ((), 0),
    "conservative": (FLAG_CHOICES, 1),
    "cyan_comparable": (("CLDICE", "HISATZEN"), 0),
    "bloom_aware_cyan": (("HISATZEN", "NAVFAIL"), 0),
}


def decode_flag_map(meanings: str, masks: Sequence[int]) -> dict[str, int]:
    """Flag name (upper-case) -> bit mask; names are words, parted by blanks or commas."""
    named = re.findall(r"[^\s,]+", meanings.upper())
    try:
        return dict(zip(named, map(int, masks), strict=True))
    except ValueError as unequal:
        raise ValueError(f"{len(named)} flag meanings for {len(masks)} masks") from unequal


def require_land(flag_map: FlagMap) -> FlagMap:
    """LAND is the one flag that no analysis can do without."""
    if "LAND" not in flag_map:
        raise ValueError("the flag map has no LAND entry")
    return flag_map


def flag_is_set(flags: Column, flag_map: FlagMap, name: str) -> Column:
    """Bit test; a flag the product does not define, or a NULL flag word, is not set."""
    mask = flag_map.get(name.upper())
    if mask is None:
        return F.lit(False)
    return F.coalesce(flags.cast("long").bitwiseAND(F.lit(mask).cast("long")) != 0, F.lit(False))


def requested_flags(profile_or_flags: str | Iterable[str]) -> list[str]:
    if isinstance(profile_or_flags, str):
        profile_or_flags = PROFILES[profile_or_flags][0]
    return list(dict.fromkeys(f.upper() for f in profile_or_flags))


def missing_flags(flag_map: FlagMap, profile_or_flags: str | Iterable[str]) -> list[str]:
    return [f for f in requested_flags(profile_or_flags) if f not in flag_map]


def flag_exclusion(
    flags: Column, flag_map: FlagMap, profile_or_flags: str | Iterable[str]
) -> Column:
    """True where any requested flag is set."""
    tests = [flag_is_set(flags, flag_map, f) for f in requested_flags(profile_or_flags)]
    return reduce(or_, tests, F.lit(False))


def flag_map_literal(flag_map: FlagMap) -> Column:
    """The map as an array of (flag, mask), sorted by flag."""
    return F.array(
        *[
            F.struct(F.lit(n).alias("flag"), F.lit(int(m)).cast("long").alias("mask"))
            for n, m in sorted(flag_map.items())
        ]
    )
