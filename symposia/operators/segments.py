"""Segmentation of texts and everything that hangs on offsets: chunks, term mentions, grounding of spans in chunks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.rules import vocabulary as V
from symposia.runtime import cut, read

_HEADER = re.compile("|".join(rf"(?:^|\n)\s*(?:{h})\s*:?" for h in V.TOPIC_HEADERS), re.I | re.M)
_SENTENCE = re.compile(r"[^.!?]+(?:[.!?]+|$)\s*", re.S)
_CHUNK_SCHEMA = "origin_key string, discourse_id string, chunk_index int, start_offset int, end_offset int, n_tokens int, text string"


def tokens(text: str) -> int:
    return max(1, int(len(text.split()) * V.TOKENS_A_WORD))


def _trim(text: str, start: int, end: int) -> tuple[int, int]:
    part = text[start:end]
    lead = len(part) - len(part.lstrip())
    return (start + lead, start + len(part.rstrip())) if part.strip() else (start, start)


def header_spans(text: str) -> list[tuple[int, int]]:
    """Pieces that begin at topic headers; a piece of ``LEAST_GAP`` characters or fewer before a header is left out."""
    starts = [m.start() + (m.start() > 0 and text[m.start()] == "\n") for m in _HEADER.finditer(text)]
    if not starts:
        return [(0, len(text))]
    out, before = [], 0
    for s in starts:
        if s - before > V.LEAST_GAP:
            out.append((before, s))
        before = s
    return [*out, (before, len(text))]


def _packed(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Sentences packed up to ``MOST_TOKENS``; a sentence over it comes in pieces and then once more whole."""
    s, e = _trim(text, start, end)
    if e <= s:
        return []
    if tokens(text[s:e]) <= V.MOST_TOKENS:
        return [(s, e)]
    sentences = [t for m in _SENTENCE.finditer(text[start:end]) if (t := _trim(text, start + m.start(), start + m.end()))[1] > t[0]]
    if not sentences:
        return [(s, e)]
    out, (a, b) = [], sentences[0]
    words_a_piece = max(1, int(V.MOST_TOKENS / V.TOKENS_A_WORD))
    # words of the running chunk are counted once, not again for every sentence
    count = lambda x, y: len(text[x:y].split())
    limit, have = V.MOST_TOKENS, count(a, b)
    for x, y in sentences[1:]:
        more = count(x, y)
        glued = not text[b - 1].isspace() and b == x
        total = have + more - (1 if glued else 0)
        if max(1, int(total * V.TOKENS_A_WORD)) <= limit:
            b, have = y, total
            continue
        out.append((a, b))
        if tokens(text[x:y]) > limit:
            words = list(re.finditer(r"\S+\s*", text[x:y]))
            for k in range(0, len(words), words_a_piece):
                last = words[min(len(words), k + words_a_piece) - 1]
                out.append(_trim(text, x + words[k].start(), x + last.end()))
        a, b, have = x, y, more
    return [*out, (a, b)]


def chunk_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(index, start, end) of a text's chunks; a short text is one, a blank one none."""
    if not text or not text.strip():
        return []
    if len(text.strip()) < V.SHORT_TEXT:
        return [(0, *_trim(text, 0, len(text)))]
    spans = [span for a, b in header_spans(text) for span in _packed(text, a, b)]
    if not spans:
        return []
    merged, (a, b) = [], spans[0]
    for x, y in spans[1:]:
        if tokens(text[a:b]) < V.FEW_TOKENS and tokens(text[a:y]) <= V.MOST_TOKENS:
            b = y
        else:
            merged.append((a, b))
            a, b = x, y
    merged.append((a, b))
    out = []
    for k, (a, b) in enumerate(merged):
        a, b = _trim(text, a, b)
        if b > a:
            out.append((k, a, b))
    return out


_CUES = "|".join(re.escape(c) for c in V.SOFT_CUES)


def cue_pieces(spark: SparkSession, base: str) -> DataFrame:
    """(origin_key, piece, n_chars): records cut at the phrases that open a new point, the phrases left out; blank pieces have no row."""
    cut_at = F.split(F.lower("text"), _CUES)
    rows = texts(spark, base).where("text is not null").select("origin_key", F.posexplode(cut_at).alias("piece", "part"))
    return rows.select("origin_key", "piece", F.length(F.trim("part")).alias("n_chars")).where("n_chars > 0")


Resolver = Callable[[DataFrame], DataFrame]


def resolved(rows: DataFrame, resolver: Resolver | None = None) -> DataFrame:
    """Texts after coreference resolution: the hook of a run; without a resolver texts stay as they are."""
    return resolver(rows) if resolver else rows


def texts(spark: SparkSession, base: str) -> DataFrame:
    """(origin_key, discourse_id, text) of every record that holds text: themes, questions, answers, experts, documents."""
    part = lambda t, field, c: read(spark, base, t).select(F.lit(field).alias("field"), F.col("id" if t != "documents" else "doc_id").cast("string").alias("discourse_id"), c.alias("text"))
    parts = [
        part("themes", "themes", F.col("description")),
        part("questions", "questions", F.coalesce("body", "title")),
        part("answers", "answers", F.col("body")),
        part("experts", "experts", F.col("bio")),
        part("documents", "documents", F.col("text")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(C.origin_key(F.col("field"), F.col("discourse_id")).alias("origin_key"), "discourse_id", "text")


def chunks(rows: DataFrame) -> DataFrame:
    """Chunks of (origin_key, discourse_id, text): a narrow, Arrow-batched step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
        names = [x.split()[0] for x in _CHUNK_SCHEMA.split(", ")]
        for batch in batches:
            out = []
            for key, did, value in zip(*[batch.column(k) for k in range(3)], strict=True):
                text = value.as_py()
                for k, a, b in chunk_spans(text):
                    out.append((key.as_py(), did.as_py(), k, a, b, tokens(text[a:b]), text[a:b]))
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return rows.where("text is not null").select("origin_key", "discourse_id", "text").mapInArrow(run, _CHUNK_SCHEMA)


def text_chunks(spark: SparkSession, base: str) -> DataFrame:
    return chunks(texts(spark, base)).select("origin_key", "chunk_index", "start_offset", "end_offset", "n_tokens")


def chunk_sizes(spark: SparkSession, base: str) -> DataFrame:
    rows = text_chunks(spark, base).withColumn("field", F.substring_index("origin_key", "|", 1))
    return rows.groupBy("field").agg(F.count(F.lit(1)).alias("chunks"), F.countDistinct("origin_key").alias("texts"), F.sum("n_tokens").alias("tokens"), F.count_if(F.col("n_tokens") * 10 >= V.LEAST_WORDS * 13).alias("long_enough"))


def occurrences(text, term: str):
    """Starts of every non-overlapping occurrence of a lower-case literal, inside the JVM."""
    lengths = F.transform(F.split(F.lower(text), "\\Q" + term + "\\E"), lambda p: F.length(p))
    n = F.size(lengths)
    starts = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.aggregate(F.slice(lengths, 1, i), F.lit(0), lambda a, x: a + x) + (i - 1) * len(term))
    return F.when(n > 1, starts).otherwise(F.array().cast("array<int>"))


def term_mentions(spark: SparkSession, base: str) -> DataFrame:
    """(origin_key, discourse_id, term, ontology_uri, start_char, end_char): every occurrence of a lexicon term."""
    rows = texts(spark, base).where("text is not null")
    parts = []
    for term, uri in V.TERMS.items():
        found = F.when(F.contains(F.lower(F.col("text")), F.lit(term)), occurrences(F.col("text"), term)).otherwise(F.array().cast("array<int>"))
        parts.append(F.struct(F.lit(term).alias("term"), F.lit(uri).alias("ontology_uri"), F.lit(len(term)).alias("size"), found.alias("starts")))
    terms = rows.select("origin_key", "discourse_id", F.explode(F.filter(F.array(*parts), lambda p: F.size(p["starts"]) > 0)).alias("t"))
    return terms.select("origin_key", "discourse_id", F.col("t.term").alias("term"), F.col("t.ontology_uri").alias("ontology_uri"), F.explode("t.starts").alias("start_char"), F.col("t.size").alias("size")).select(
        "origin_key", "discourse_id", "term", "ontology_uri", "start_char", (F.col("start_char") + F.col("size")).alias("end_char")
    )


def term_counts(spark: SparkSession, base: str) -> DataFrame:
    return term_mentions(spark, base).groupBy("term", "ontology_uri").agg(F.count(F.lit(1)).alias("mentions"), F.countDistinct("origin_key").alias("texts"), F.sum("start_char").alias("starts"))


def ground(spans: DataFrame, pieces: DataFrame) -> DataFrame:
    """Spans (key columns, origin_key, s, e) with the chunks they fall into.

    Both sides are partitioned by record once; within a record the overlap is a filter on a handful of chunks. One
    chunk hit: that chunk (``span_map``); several: index -1 and the segments in order; none, but the record has one
    chunk only: that chunk (``single_chunk_discourse``); else unknown."""
    keys = [c for c in spans.columns if c not in ("s", "e")]
    per_record = pieces.groupBy("origin_key").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "start_offset", "end_offset"))).alias("cs"))
    joined = spans.join(per_record, "origin_key", "left")
    hit = F.filter("cs", lambda c: (c["end_offset"] > F.col("s")) & (c["start_offset"] < F.col("e")))
    segments = F.transform(F.when(F.col("s").isNotNull() & F.col("cs").isNotNull(), hit).otherwise(F.array().cast("array<struct<chunk_index:int,start_offset:int,end_offset:int>>")), lambda c: F.struct(c["chunk_index"].alias("chunk"), F.greatest(c["start_offset"], F.col("s")).alias("start"), F.least(c["end_offset"], F.col("e")).alias("end")))
    rows = joined.withColumn("segs", segments)
    n, alone = F.size("segs"), F.size(F.coalesce("cs", F.array().cast("array<struct<chunk_index:int,start_offset:int,end_offset:int>>"))) == 1
    index = F.when(n == 1, F.col("segs")[0]["chunk"]).when(n > 1, F.lit(-1)).when(alone, F.col("cs")[0]["chunk_index"]).otherwise(F.lit(-1))
    method = F.when(n == 1, "span_map").when(n > 1, "span_segments").when(alone, "single_chunk_discourse").otherwise("unknown")
    return rows.select(*keys, "s", "e", index.alias("chunk_index"), method.alias("method"), n.alias("segments"), F.array_join(F.transform("segs", lambda x: F.concat_ws(":", x["chunk"], x["start"], x["end"])), ",").alias("spans"))


def entity_grounding(spark: SparkSession, base: str) -> DataFrame:
    """(uri, origin_key, s, e, chunk_index, method, ...) of every entity mention in its record's chunks."""
    rows = read(spark, base, "entities")
    m = F.col("metadata")
    section = F.lower(C.strip(m["section"]))
    key = F.coalesce(F.regexp_replace(F.lower(C.strip(m["origin_key"])), r"\s*\|\s*", "|"), F.concat(section, F.lit("|"), F.lower(C.strip(m["discourse_id"]))))
    start, end = F.when(F.col("start_char") >= 0, F.col("start_char")), F.when(F.col("end_char") >= 0, F.col("end_char"))
    spans = rows.select("uri", key.alias("origin_key"), start.cast("int").alias("s"), F.when(start.isNotNull() & end.isNotNull(), F.greatest(end, start + 1)).cast("int").alias("e")).where("origin_key is not null").distinct()
    spans = spans.withColumn("s", F.when(F.col("e").isNotNull(), F.col("s")))
    # a record that no entity names needs no chunks
    needed = texts(spark, base).join(spans.select("origin_key").distinct(), "origin_key", "left_semi")
    return ground(spans, cut(chunks(needed)))


def provenance_gate(spark: SparkSession, base: str) -> DataFrame:
    """Counts and rate of grounded and unknown mentions by field; a run's gate reads ``unknown_rate``."""
    rows = entity_grounding(spark, base).withColumn("field", F.substring_index("origin_key", "|", 1))
    return rows.groupBy("field").agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(F.col("method") == "span_map").alias("span_map"), F.count_if(F.col("method") == "span_segments").alias("span_segments"),
        F.count_if(F.col("method") == "single_chunk_discourse").alias("single_chunk"), F.count_if(F.col("method") == "unknown").alias("unknown"), F.round(F.avg((F.col("method") == "unknown").cast("int")), 6).alias("unknown_rate"),
    )


class GateError(RuntimeError):
    """Too many mentions could not be grounded."""


def enforce_gate(report: DataFrame, most: float = 0.0) -> None:
    row = report.agg(F.sum("checked").alias("c"), F.sum("unknown").alias("u")).first()
    if row["c"] and row["u"] / row["c"] > most:
        raise GateError(f"{row['u']} of {row['c']} mentions are not grounded")


QUERIES = {"cue_pieces": cue_pieces, "text_chunks": text_chunks, "chunk_sizes": chunk_sizes, "term_mentions": term_mentions, "term_counts": term_counts, "entity_grounding": entity_grounding, "provenance_gate": provenance_gate}
_TEXTS = "texts as (select 'themes|' || id k, description t from themes union all select 'questions|' || id, coalesce(body, title) from questions union all select 'answers|' || id, body from answers union all select 'experts|' || id, bio from experts union all select 'documents|' || doc_id, text from documents)"
_TERMS = "terms(term, uri) as (values " + ", ".join(f"('{k}', '{v}')" for k, v in V.TERMS.items()) + ")"
_FOUND = f"""{_TEXTS}, {_TERMS}, p as (select k, term, uri, string_split(lower(t), term) parts from texts, terms where t is not null and contains(lower(t), term)),
i as (select k, term, uri, parts, unnest(range(1, len(parts))) n from p), f as (select k, term, uri, list_sum(list_transform(list_slice(parts, 1, n), lambda x: length(x))) + (n - 1) * length(term) s from i)"""
ORACLE = {
    "cue_pieces": f"with {_TEXTS}, p as (select k, string_split_regex(lower(t), '{_CUES.replace(chr(92) + ' ', ' ').replace(chr(92) + '-', '-')}') ps from texts where t is not null), q as (select k, unnest(ps) part, generate_subscripts(ps, 1) - 1 piece from p) select k as origin_key, cast(piece as integer) as piece, cast(length(trim(part)) as integer) as n_chars from q where trim(part) <> ''",
    "term_mentions": f"with {_FOUND} select k as origin_key, split_part(k, '|', 2) as discourse_id, term, uri as ontology_uri, cast(s as integer) as start_char, cast(s + length(term) as integer) as end_char from f",
    "term_counts": f"with {_FOUND} select term, uri as ontology_uri, count(*) as mentions, count(distinct k) as texts, cast(sum(s) as bigint) as starts from f group by 1, 2",
}
