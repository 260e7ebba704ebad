"""Identity of a lake universe and of a science configuration."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Science settings whose change makes a new configuration.
DEFAULT_SETTINGS = {
    "ndci_source": "rhos",
    "analysis_wavelengths": [490, 560, 620, 665, 681, 709, 754, 865, 885],
    "indices": ["CI", "CI_cyano", "NDCI", "MPH", "FAI"],
    "primary_profile": "bloom_aware_cyan",
    "hard_flags": ["HISATZEN", "NAVFAIL"],
    "strict_flags": ["CLDICE", "HISATZEN", "NAVFAIL"],
    "rescue_fai_min": 0.0,
    "detection_limit": 0.0001,
    "bright_screen": False,
    "shore_buffer_m": 0.0,
    "strategy": "adaptive_lake_windows",
    "window_margin_km": 3.0,
    "max_windows": 6,
    "full_scene_fraction": 0.35,
    "min_lake_area_km2": 10.0,
    "region": "WORLD",
}
_GROUPS = 4096


def lake_digests(lakes: DataFrame) -> DataFrame:
    """(Hylak_id, digest) of every lake's id and geometry."""
    vertices = F.flatten(F.flatten("polygons"))
    text = F.concat_ws(
        ";",
        F.col("Hylak_id").cast("string"),
        F.transform(vertices, lambda v: F.format_string("%.9f,%.9f", v["x"], v["y"])),
    )
    return lakes.select("Hylak_id", F.sha2(text, 256).alias("digest"))


def lake_fingerprint(lakes: DataFrame) -> DataFrame:
    """One row: a digest that does not depend on row order, at two levels.

    Lakes are digested in a fixed number of groups by id, so no task and no row holds
    the whole catalogue.
    """
    grouped = (
        lake_digests(lakes)
        .groupBy(F.pmod("Hylak_id", F.lit(_GROUPS)).alias("g"))
        .agg(F.sha2(F.concat_ws("", F.sort_array(F.collect_list("digest"))), 256).alias("digest"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("g", "digest")))
    return grouped.agg(
        F.sha2(F.concat_ws("", F.transform(ordered, lambda s: s["digest"])), 256).alias("fingerprint")
    )


def config_hash(settings: Mapping[str, object], fingerprint: str) -> str:
    """Sixteen hex digits of all science settings and the lake fingerprint."""
    payload = {**DEFAULT_SETTINGS, **settings, "lakes": fingerprint}
    return hashlib.sha256(json.dumps(payload, sort_keys=True).encode()).hexdigest()[:16]


def select_configuration(lakes: DataFrame, settings: Mapping[str, object], expected: str | None = None) -> str:
    """Configuration id of these lakes and settings; an error when another was expected."""
    found = config_hash(settings, lake_fingerprint(lakes).head()["fingerprint"])
    if expected and expected != found:
        raise ValueError(f"configuration is {found}, expected {expected}")
    return found
