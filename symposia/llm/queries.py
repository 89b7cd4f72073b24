"""The queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from symposia.llm import components, cooccurrence, mixing, names, pii, reading, splitting, survivors, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": splitting.p1_found,
    "p1_pieces": splitting.p1_pieces,
    "p2_found": names.p2_found,
    "p2_groups": names.p2_groups,
    "p3_found": components.p3_found,
    "p3_groups": components.p3_groups,
    "p4_found": cooccurrence.p4_found,
    "p4_scores": cooccurrence.p4_scores,
    "p5_found": pii.p5_found,
    "p5_redacted": pii.p5_redacted,
    "p7_found": survivors.p7_found,
    "p7_survivors": survivors.p7_survivors,
    "p8_ids": tokens.p8_ids,
    "p8_roundtrip": tokens.p8_roundtrip,
    "p9_shares": mixing.p9_shares,
    "p9_mixture": mixing.p9_mixture,
    "p10_found": reading.p10_found,
    "p10_levels": reading.p10_levels,
}

ORACLE: dict[str, str] = {}
for module in (splitting, names, components, cooccurrence, survivors, tokens, mixing, pii, reading):
    ORACLE |= module.ORACLE
