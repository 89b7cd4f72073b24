"""Splitting oversized items at natural boundaries (problem 1).

Candidate cuts are the ends of paragraphs, lines, sentences, clauses and words, each with a penalty; where a stretch
has none (a long URL, text without spaces) every position up to the limit becomes a candidate at the highest penalty.
A dynamic programme over the candidates picks the cuts that minimise the sum of penalties and of squared deviations
from even piece length, no piece being longer than the limit, its overlap included. Each piece after the first
begins ``overlap`` characters before the previous cut or, where a word starts within the quarter of them that follows,
there; so neighbours share between three quarters of ``overlap`` and all of it (less only where a piece is shorter).

Lengths are code points. Leading and trailing spaces, tabs, CR and LF are not part of an item. Offsets count from
the trimmed item's start; the pieces' own parts (``body_start`` to ``end``) concatenate to the whole item.

Defined results: null, blank and short items give no piece here (they need no cut); one item text repeated in many
rows is split once; ties fall to the earlier cut. Whole texts are processed, one at a time, in linear memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.runtime import read

BODY_LIMIT, BODY_OVERLAP = 1200, 100
META_LIMIT, META_OVERLAP = 600, 60
LIMITS = {"answers": (BODY_LIMIT, BODY_OVERLAP), "entities": (META_LIMIT, META_OVERLAP)}
_COST = {"paragraph": 0.0, "line": 0.05, "sentence": 0.1, "clause": 0.5, "word": 1.0, "none": 4.0}
SCHEMA = "origin string, item_key string, field string, piece int, pieces int, start int, body_start int, end int, boundary string, text string"


def _marks(chars: str) -> np.ndarray:
    return np.array(sorted(map(ord, chars)), dtype=np.uint32)


_ENDERS, _FULL_STOPS, _CLOSERS = _marks(".!?…。！？؟"), _marks("。！？"), _marks("\"'”’)]")
_CLAUSES, _FULL_COMMAS = _marks(",;:،、，；–—"), _marks("，；、")
_WHITE = _marks("".join(c for c in map(chr, range(0x3001)) if c.isspace()))


def boundaries(text: str, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cut positions of a text (its end last) and their penalties; gaps wider than ``room`` are filled up.

    Every run of white space ends in a cut, whose kind is read from the run (two line ends: paragraph, one: line) and from
    the character before it, closing quotes and brackets aside; full-width stops and commas cut without white space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    white = np.isin(codes, _WHITE)
    edge = np.diff(np.concatenate(([False], white, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lines = np.concatenate(([0], np.cumsum(codes == 10)))
    breaks = lines[ends] - lines[starts]
    before = starts - 1
    clause = (before >= 0) & np.isin(codes[before], _CLAUSES)
    while (closed := (before >= 0) & np.isin(codes[before], _CLOSERS)).any():
        before = before - closed
    sentence = (before >= 0) & np.isin(codes[before], _ENDERS)
    kinds = np.where(breaks > 1, _COST["paragraph"], np.where(breaks == 1, _COST["line"], np.where(sentence, _COST["sentence"], np.where(clause, _COST["clause"], _COST["word"]))))
    cost = np.full(n + 1, np.inf)
    for marks, kind in ((_FULL_COMMAS, "clause"), (_FULL_STOPS, "sentence")):
        cost[np.flatnonzero(np.isin(codes, marks)) + 1] = _COST[kind]
    # a full-width mark in front of white space cuts behind it, as others do
    cost[starts] = np.inf
    cost[ends] = kinds
    cost[0], cost[n] = np.inf, 0.0
    spots = np.flatnonzero(cost < np.inf)
    gaps = np.diff(spots, prepend=0)
    for at, gap in zip(spots[gaps > room], gaps[gaps > room], strict=True):
        cost[at - gap + 1 : at] = _COST["none"]
    spots = np.flatnonzero(cost < np.inf)
    return spots, cost[spots]


def _overlap_start(text: str, cut: int, overlap: int, floor: int) -> int:
    """Where the next piece begins: ``overlap`` before the cut, moved on to a word start if one is near."""
    at = max(floor, cut - overlap)
    for p in range(at, min(cut, at + overlap // 4)):
        if p == 0 or (text[p - 1].isspace() and not text[p].isspace()):
            return p
    return at


def split(text: str, limit: int, overlap: int) -> list[tuple[int, int, int, float]]:
    """(start, body_start, end, cut penalty) of the pieces of a text longer than ``limit``."""
    room = limit - overlap
    spots, cost = boundaries(text, room)
    n = len(text)
    count = -(-max(1, n - overlap) // room)
    even = n / count
    # ((x - y - even) / even) ** 2 in units of even is a square of each end and a product: one multiplication a candidate
    place = spots / even
    square = place * place
    best, back = np.full(len(spots), np.inf), np.full(len(spots), -1, dtype=np.int64)
    held = np.full(len(spots), np.inf)  # best plus the square of its place
    low = np.searchsorted(spots, spots - room)
    for j in range(len(spots)):
        x = place[j] - 1
        if spots[j] <= limit:  # the first piece has no overlap in front
            best[j] = cost[j] + x * x
        lo = low[j]
        if lo < j:
            ways = held[lo:j] - (2 * x) * place[lo:j]
            k = ways.argmin()
            found = ways[k] + x * x + cost[j]
            if found < best[j]:
                best[j], back[j] = found, lo + k
        held[j] = best[j] + square[j]
    cuts = []
    j = len(spots) - 1
    while j >= 0:
        cuts.append(j)
        j = int(back[j])
    out, start, body = [], 0, 0
    for j in reversed(cuts):
        end = int(spots[j])
        out.append((start, body, end, float(cost[j])))
        start, body = _overlap_start(text, end, overlap, body), end
    return out


def _count_rows(limit: dict[str, tuple[int, int]]):
    """Like ``_split_rows``, giving the number of pieces only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(split(text.as_py(), *limit[origin.as_py()])) for origin, text in zip(batch.column(0), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int32())], names=["origin", "item_key", "field", "pieces"])

    return run


def _split_rows(limit: dict[str, tuple[int, int]]):
    names = {v: k for k, v in _COST.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for origin, key, field, text in zip(*[batch.column(k) for k in range(4)], strict=True):
                origin, key, field, text = origin.as_py(), key.as_py(), field.as_py(), text.as_py()
                pieces = split(text, *limit[origin])
                last = len(pieces) - 1
                for k, (start, body, end, cost) in enumerate(pieces):
                    rows.append((origin, key, field, k, len(pieces), start, body, end, "end" if k == last else names[cost], text[start:end]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 10
            kinds = [pa.string()] * 3 + [pa.int32()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return run


def oversized(spark: SparkSession, base: str) -> DataFrame:
    """(origin, item_key, field, text) of every item over its limit; one row per distinct text of an item."""
    strip = lambda c: F.regexp_replace(c, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    bodies = read(spark, base, "answers").select(F.lit("answers").alias("origin"), F.col("id").cast("string").alias("item_key"), F.lit("body").alias("field"), strip(F.col("body")).alias("text"))
    # the length test on the map runs before values are exploded, so short metadata never becomes rows
    metadata = read(spark, base, "entities").select("uri", F.map_filter("metadata", lambda k, v: F.length(v) > META_LIMIT).alias("m")).where(F.size("m") > 0)
    values = metadata.select(F.lit("entities").alias("origin"), F.col("uri").alias("item_key"), F.explode("m").alias("field", "text")).withColumn("text", strip(F.col("text")))
    long = bodies.where(F.length("text") > BODY_LIMIT).unionByName(values.where(F.length("text") > META_LIMIT).distinct())
    return long


def pieces(spark: SparkSession, base: str) -> DataFrame:
    return oversized(spark, base).mapInArrow(_split_rows(LIMITS), SCHEMA)


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    """The items that the splitter cuts into more than one piece."""
    counted = oversized(spark, base).mapInArrow(_count_rows(LIMITS), "origin string, item_key string, field string, pieces int")
    return counted.where("pieces > 1").select("origin", "item_key", "field").distinct()


def p1_pieces(spark: SparkSession, base: str) -> DataFrame:
    """Ordered pieces with offsets, the boundary each ends at, and their text."""
    return pieces(spark, base)


ORACLE = {
    "p1_found": """
select distinct 'answers' origin, cast(id as varchar) item_key, 'body' field from answers where length(regexp_replace(body, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')) > 1200
union all
select distinct 'entities', uri, k, from (select uri, unnest(map_keys(metadata)) k, unnest(map_values(metadata)) v from entities)
where length(regexp_replace(v, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')) > 600
""",
}
