"""Extraction behind an exchangeable extractor, and the cleaning of what extractors reply.

An extractor is a function from texts to replies (JSON). The one that comes with the package marks lexicon terms and
needs no service; a reply table can stand in for any other. Replies are repaired where they are cut or loosely
quoted, cleaned (confidence, known ends), mapped to canonical predicates and given stable identifiers."""

from __future__ import annotations

import hashlib
import json
import random
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.entities import MENTIONS, mentions
from symposia.operators.segments import chunks, texts
from symposia.rules import vocabulary as V
from symposia.runtime import salted

Extractor = Callable[[list[str]], list[str]]
ENTITIES = "struct<entities: array<struct<surface_form: string, entity_type: string, ontology_uri: string, confidence: string>>>"
RELATIONS = "struct<relations: array<struct<source_id: string, relation: string, target_id: string, confidence: string, evidence_quote: string>>>"


def repair_json(text: str | None, key: str = "relations") -> str:
    """Strict JSON out of a reply: as it is, its outermost braces, closed where it was cut, with proper quotes; else empty."""
    empty = json.dumps({key: []})
    if not text or "{" not in text:
        return empty
    body = text[text.index("{") :]
    whole = body[: body.rindex("}") + 1] if "}" in body else body
    tries = [text, whole]
    last = body.rfind("}")
    if last > 0:
        tries += [body[: last + 1] + "]}", body[: last + 1] + "}"]
    quoted = re.sub(r",\s*([\]}])", r"\1", re.sub(r"(?<![\w])'|'(?![\w])", '"', whole))
    tries += [quoted, quoted + "]}", quoted + "}"]
    for attempt in tries:
        try:
            found = json.loads(attempt)
        except ValueError:
            continue
        if isinstance(found, dict) and isinstance(found.get(key), list):
            return json.dumps(found)
    return empty


def repaired(replies: DataFrame, column: str, key: str) -> DataFrame:
    """``replies`` with ``column`` repaired; only replies that do not parse as they are go through Python."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf[column] = [repair_json(t, key) for t in pdf[column]]
            yield pdf

    good = F.coalesce(F.json_array_length(F.get_json_object(column, f"$.{key}")).isNotNull() & F.from_json(column, f"{key} array<string>").isNotNull(), F.lit(False))
    return replies.where(good).unionByName(replies.where(~good).mapInPandas(run, replies.schema))


def transient(error: Exception) -> bool:
    """Whether another try may help: the service was busy, failed within, or took too long."""
    text = f"{type(error).__name__} {error}".lower()
    return isinstance(error, TimeoutError) or bool(re.search(r"\b(429|5\d\d)\b|timeout|timed out|rate limit|temporarily", text))


def with_retries(extractor: Extractor, tries: int = 3, wait: float = 0.5, most: float = 4.0) -> Extractor:
    """An extractor that tries again after transient errors, waiting twice as long each time and a little at random."""

    def run(found: list[str]) -> list[str]:
        for k in range(tries):
            try:
                return extractor(found)
            except Exception as e:  # noqa: BLE001
                if k == tries - 1 or not transient(e):
                    raise
                time.sleep(min(most, wait * 2**k) * (1 + 0.1 * random.random()))
        return []

    return run


def extract(rows: DataFrame, extractor: Extractor) -> DataFrame:
    """(origin_key, chunk_index, start_offset, text, reply, error): the extractor's reply to every chunk long enough.

    A failing batch is tried again chunk by chunk; what still fails gives an empty reply and its error, not an abort."""
    able = rows.where(F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")) >= V.LEAST_WORDS).select("origin_key", "chunk_index", "start_offset", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            replies, errors = [], []
            try:
                replies, errors = extractor(list(pdf["text"])), [None] * len(pdf)
            except Exception:  # noqa: BLE001
                for text in pdf["text"]:
                    try:
                        replies.append(extractor([text])[0])
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001
                        replies.append("")
                        errors.append(f"{type(e).__name__}: {e}"[:200])
            yield pdf.assign(reply=replies, error=errors)

    return able.mapInPandas(run, "origin_key string, chunk_index int, start_offset int, text string, reply string, error string")


def lexicon_extractor(found: list[str]) -> list[str]:
    """Marks the lexicon's terms; the confidence grows with their length."""
    out = []
    for text in found:
        low = text.lower()
        items = [{"surface_form": t, "entity_type": "EthicalConcept", "ontology_uri": u, "confidence": min(0.95, 0.6 + 0.02 * len(t))} for t, u in V.TERMS.items() if t in low]
        out.append(json.dumps({"entities": items}))
    return out


def cleaned_entities(replies: DataFrame) -> DataFrame:
    """(origin_key, chunk_index, label, entity_type, ontology_uri, confidence, uri) of replies: one row per label, type and class."""
    parsed = replies.select("origin_key", "chunk_index", F.posexplode(F.from_json("reply", ENTITIES)["entities"]).alias("seq", "e"))
    rows = parsed.select("origin_key", "chunk_index", "seq", C.clean_text(F.col("e.surface_form")).alias("label"), C.entity_type(F.col("e.entity_type")).alias("entity_type"), C.blank_to_null(F.col("e.ontology_uri")).alias("ontology_uri"), C.clamp(F.col("e.confidence")).alias("confidence"))
    rows = rows.where((F.col("confidence") >= V.EXTRACTION_FLOOR) & (F.col("label") != ""))
    key = [F.col("origin_key"), F.col("chunk_index"), F.lower("label").alias("key"), F.col("entity_type"), F.coalesce("ontology_uri", F.lit("")).alias("ontology_uri")]
    best = rows.groupBy(*key).agg(F.min_by(F.struct("label", "confidence"), F.struct((-F.col("confidence")).alias("c"), "seq")).alias("b"))
    return best.select("origin_key", "chunk_index", "b.label", "entity_type", "ontology_uri", "b.confidence", F.concat(F.lit(V.KG), C.short_hash(F.concat_ws("|", "key", "entity_type", "ontology_uri"), 15)).alias("uri"))


def cleaned_relations(replies: DataFrame, allowed: DataFrame) -> DataFrame:
    """(origin_key, source, relation, target, confidence, evidence, uri): both ends must be entities of the record."""
    parsed = replies.select("origin_key", F.explode(F.from_json("reply", RELATIONS)["relations"]).alias("r"))
    rows = parsed.select("origin_key", F.col("r.source_id").alias("source"), C.normalize_predicate(F.col("r.relation")).alias("relation"), F.col("r.target_id").alias("target"), C.clamp(F.col("r.confidence")).alias("confidence"), C.evidence_text(F.col("r.evidence_quote"), F.lit(None).cast("string")).alias("evidence"))
    rows = rows.where((F.col("confidence") >= V.EXTRACTION_FLOOR) & ~((F.col("relation") == V.DEFAULT_PREDICATE) & (F.col("confidence") < V.RELATED_FLOOR)))
    for end in ("source", "target"):
        rows = rows.join(allowed.select("origin_key", F.col("uri").alias(end)).distinct(), ["origin_key", end], "left_semi")
    return rows.select("origin_key", "source", "relation", "target", "confidence", "evidence", C.relation_uri(F.substring_index("origin_key", "|", -1), F.col("source"), F.col("relation"), F.col("target")).alias("uri"))


def lexicon_entities(spark: SparkSession, base: str) -> DataFrame:
    return cleaned_entities(extract(chunks(texts(spark, base)), lexicon_extractor))


def cue_extractor(found: list[str]) -> list[str]:
    """Relations by cue: in a sentence that names two terms and a cue, the first term stands in the cue's relation to the second."""
    uri = lambda t: V.KG + hashlib.sha256(f"{t}|EthicalConcept|{V.TERMS[t]}".encode()).hexdigest()[:15]
    out = []
    for text in found:
        items = []
        for sentence in re.findall(r"[^.!?]+[.!?]?", text):
            low = sentence.lower()
            named = sorted((low.index(t), t) for t in V.TERMS if t in low)
            cue = next((p for pattern, p in V.EVIDENCE_CUES if re.search(pattern, low)), None)
            if len(named) > 1 and cue:
                items.append({"source_id": uri(named[0][1]), "relation": cue, "target_id": uri(named[1][1]), "confidence": 0.7, "evidence_quote": sentence.strip()})
        out.append(json.dumps({"relations": items}))
    return out


def extracted_relations(spark: SparkSession, base: str) -> DataFrame:
    """Relations by cue between the lexicon's entities of a record, cleaned: the least uri's row of each statement stands."""
    pieces = chunks(texts(spark, base))
    allowed = cleaned_entities(extract(pieces, lexicon_extractor)).select("origin_key", "uri")
    replies = repaired(extract(pieces, with_retries(cue_extractor)), "reply", "relations")
    rows = cleaned_relations(replies, allowed)
    return rows.groupBy("origin_key", "source", "relation", "target", "uri").agg(F.max("confidence").alias("confidence"), F.min("evidence").alias("evidence"))


def cooccurrence_edges(spark: SparkSession, base: str, first: int | None = None, most: int | None = None) -> DataFrame:
    """(origin_key, chunk_index, source, target, confidence): entities named in one chunk, in order of their first place there.

    ``first`` and ``most`` bound the entities and pairs of a chunk where a caller wants that; without them all count."""
    named = mentions(spark, base).groupBy("origin_key", "chunk_index", "uri").agg(F.min(F.coalesce("start_char", F.lit(2**62))).alias("at"))
    chunk = ["origin_key", "chunk_index"]
    if first:
        named = named.withColumn("rn", F.row_number().over(Window.partitionBy(*chunk).orderBy("at", "uri"))).where(F.col("rn") <= first).drop("rn")
    left, right = salted(named.select(*chunk, F.col("uri").alias("source"), F.col("at").alias("a")), named.select(*chunk, F.col("uri").alias("target"), F.col("at").alias("b")), chunk)
    pairs = left.join(right, [*chunk, "_salt"]).where((F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("source") < F.col("target"))))
    if most:
        pairs = pairs.withColumn("n", F.row_number().over(Window.partitionBy(*chunk).orderBy("a", "source", "b", "target"))).where(F.col("n") <= most)
    return pairs.select(*chunk, "source", "target", F.lit(V.CONFIDENCE["cooccurrence"]).alias("confidence"))


QUERIES = {"lexicon_entities": lexicon_entities, "cooccurrence_edges": cooccurrence_edges, "extracted_relations": extracted_relations}
ORACLE = {
    "cooccurrence_edges": f"""with {MENTIONS}, g as (select origin_key, chunk_index, uri, min(coalesce(start_char, 4611686018427387904)) at_ from men group by all)
select a.origin_key, a.chunk_index, a.uri as source, b.uri as target, cast(0.35 as double) as confidence from g a join g b on a.origin_key = b.origin_key and a.chunk_index = b.chunk_index and (a.at_ < b.at_ or (a.at_ = b.at_ and a.uri < b.uri))""",
}
