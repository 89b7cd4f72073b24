"""The queries of the core library and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from symposia.operators import analytics, entities, extraction, graph, keys, linking, metrics, ontology, orphans, predicates, reasoning, resolve, segments, structure, triples
from symposia.sources import discourse
from symposia.streaming import ingest

_MODULES = (orphans, structure, analytics, graph, predicates, reasoning, ontology, resolve, segments, entities, extraction, triples, metrics, linking, keys, discourse, ingest)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
for _module in _MODULES:
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE
