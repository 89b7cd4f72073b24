"""Further steps of linking: ordered absorption, knowledge-base candidates, quoted spans, priors of inferred edges."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.resolve import mergeable, registry
from symposia.operators.predicates import BASE, base_relations
from symposia.runtime import cut, lookup, read

CONSOLIDATE, LEAST_CONTAINED = 0.93, 4
#: Length of the grams by which keys meet; no more than LEAST_CONTAINED, nor than a segment of eight characters' key.
GRAM = 4


def greedy_absorption(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, into) of a greedy pass in order, without walking it: every node absorbs the later ones it is paired with,
    unless it was absorbed itself.

    ``nodes`` (node, ord), ``pairs`` (a, b) in any direction. In a round each undecided node that has no undecided
    earlier partner stays, and its later partners go to the earliest of those that stay; that equals the sequential
    pass, and takes as many rounds as the longest chain of undecided partners."""
    order = lambda s: nodes.select(F.col("node").alias(s), F.col("ord").alias(f"o{s}"))
    both = cut(pairs.join(order("a"), "a").join(order("b"), "b").select(F.when(F.col("oa") < F.col("ob"), F.col("a")).otherwise(F.col("b")).alias("first"), F.when(F.col("oa") < F.col("ob"), F.col("b")).otherwise(F.col("a")).alias("then"), F.least("oa", "ob").alias("ord")).distinct())
    open_pairs, absorbed = both, None
    while open_pairs.limit(1).count():
        waits = open_pairs.select(F.col("then").alias("node")).distinct()
        stays = open_pairs.select(F.col("first").alias("node")).distinct().join(waits, "node", "left_anti")
        taken = cut(open_pairs.join(stays.select(F.col("node").alias("first")), "first").groupBy(F.col("then").alias("node")).agg(F.min_by("first", "ord").alias("into")))
        absorbed = taken if absorbed is None else absorbed.unionByName(taken)
        gone = taken.select("node").unionByName(stays)
        # pairs of decided nodes are settled; a node absorbed absorbs nobody
        open_pairs = cut(open_pairs.join(gone.select(F.col("node").alias("first")), "first", "left_anti").join(taken.select(F.col("node").alias("then")), "then", "left_anti"))
    return absorbed if absorbed is not None else nodes.where("false").select("node", F.col("node").alias("into"))


def near_keys(keys: DataFrame) -> DataFrame:
    """(a, b) of nodes of one type, the shorter key first: every pair of keys of which one may contain the other or whose
    ratio may reach CONSOLIDATE.

    ``keys`` (node, entity_type, key), keys distinct in a type. The longer key offers all its grams of GRAM characters.
    Containment: a contained key has each of its grams in the longer one, so its rarest is looked up. Ratio: the longer
    key differs by at most ``slips`` dropped or added characters, each of which touches one of slips + 1 disjoint
    segments, so one segment is whole in both, moved by no more than the slips; the rarest gram of each is looked up
    among keys of each length that can reach the ratio. Nothing depends on the size of the table. Keys of seven
    characters, the shortest that can differ, have segments of three."""
    size = F.length("key")
    longest = F.floor(size * (2 / CONSOLIDATE - 1) + 1e-9).cast("int")
    slips = F.floor((1 - CONSOLIDATE) * (size + longest) + 1e-9).cast("int")
    rows = keys.where(size > 0).select("node", "entity_type", "key", size.alias("size"), longest.alias("longest"), slips.alias("slips"))
    grams = lambda q: F.transform(F.sequence(F.lit(0), F.col("size") - q), lambda i: F.struct(F.lit(q).alias("q"), i.alias("pos"), F.substr("key", i + 1, F.lit(q)).alias("gram")))
    none = grams(GRAM - 1)
    every = F.concat(F.when(F.col("size") >= GRAM, grams(GRAM)).otherwise(F.slice(none, 1, 0)), F.when(F.col("size").isin(2 * GRAM - 1, 2 * GRAM), none).otherwise(F.slice(none, 1, 0)))
    index = cut(rows.where(F.col("size") >= GRAM - 1).withColumn("g", F.explode(every)).select("node", "entity_type", "key", "size", "longest", "slips", "g.*"))
    counts = index.groupBy("entity_type", "gram").agg(F.count(F.lit(1)).alias("n"))
    known = cut(index.join(counts, ["entity_type", "gram"]))
    rare = F.struct("n", "gram", "pos")
    inner = known.where(F.col("q") == GRAM).groupBy("node").agg(F.first("entity_type").alias("entity_type"), F.first("key").alias("short"), F.min_by("gram", rare).alias("gram"))
    long = index.select(F.col("node").alias("b"), "entity_type", F.col("key").alias("long"), F.col("size").alias("long_size"), F.col("pos").alias("at"), "q", "gram")
    held = inner.withColumnRenamed("node", "a").join(long.where(F.col("q") == GRAM), ["entity_type", "gram"]).where((F.length("long") > F.length("short")) & F.contains("long", "short")).select("a", "b")
    segment = lambda pos: F.floor(pos * (F.col("slips") + 1) / F.col("size"))
    whole = known.where((F.col("slips") > 0) & (F.col("q") == F.when(F.col("size") < 2 * GRAM, GRAM - 1).otherwise(GRAM)))
    whole = whole.withColumn("segment", segment(F.col("pos"))).where(F.col("segment") == segment(F.col("pos") + F.col("q") - 1))
    parts = whole.groupBy("node", "segment").agg(*[F.first(c).alias(c) for c in ("entity_type", "key", "size", "longest", "q")], F.min_by(F.struct("gram", "pos"), rare).alias("g"))
    parts = parts.select(F.col("node").alias("a"), "entity_type", F.col("key").alias("short"), "size", "q", "g.*", F.explode(F.sequence("size", "longest")).alias("long_size"))
    alike = parts.join(long, ["entity_type", "q", "gram", "long_size"]).where("a <> b")
    # a bound on slips is one on typing errors, which are cheaper to count than the ratio
    most = (1 - CONSOLIDATE) * (F.col("size") + F.col("long_size")) + 1e-9
    alike = alike.where(F.abs(F.col("pos") - F.col("at")) <= most).select("a", "b", "short", "long", most.alias("most")).distinct()
    return held.unionByName(alike.where(F.levenshtein("short", "long") <= F.col("most")).select("a", "b")).distinct()


def absorbed_keys(rows: DataFrame) -> DataFrame:
    """(node, into) of ``consolidation`` for rows (uri, entity_type, confidence, key).

    Uris of one key have the same partners, so the first of them takes part for all: where it stays, the others go to
    it, and where it is absorbed, they go the same way."""
    # the order of a uri is a sortable text: falling confidence, then the uri
    order = F.concat(F.format_number(F.lit(10.0) - F.col("confidence"), 3), F.lit("|"), F.col("uri"))
    rows = rows.where("key <> ''").withColumn("ord", order)
    keys = cut(rows.groupBy("entity_type", "key").agg(F.min_by("uri", "ord").alias("node"), F.min("ord").alias("ord")))
    side = lambda s: keys.select(F.col("node").alias(s), F.col("key").alias(f"k{s}"), F.col("ord").alias(f"o{s}"))
    pairs = near_keys(keys.select("node", "entity_type", "key")).join(side("a"), "a").join(side("b"), "b")
    # the ratio depends on the order of its arguments: the earlier key comes first
    ahead = F.col("oa") < F.col("ob")
    pairs = pairs.select("a", "b", F.when(ahead, F.col("ka")).otherwise(F.col("kb")).alias("ka"), F.when(ahead, F.col("kb")).otherwise(F.col("ka")).alias("kb"))

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            keep = []
            for x, y in zip(pdf["ka"], pdf["kb"], strict=True):
                short, long = sorted((x, y), key=len)
                keep.append((len(short) >= LEAST_CONTAINED and short in long) or SequenceMatcher(None, x, y).ratio() >= CONSOLIDATE)
            yield pdf.loc[keep, ["a", "b"]]

    into = greedy_absorption(keys.select("node", "ord"), pairs.mapInPandas(near, "a string, b string"))
    heads = keys.select("entity_type", "key", "node").join(into, "node", "left").select("entity_type", "key", F.coalesce("into", "node").alias("into"))
    return rows.join(heads, ["entity_type", "key"]).where("uri <> into").select(F.col("uri").alias("node"), "into")


def consolidation(spark: SparkSession, base: str) -> DataFrame:
    """(node, into): entities of one type absorbed by an earlier one whose label key is nearly the same or contains it.

    Order is confidence, then uri. A label without letters a-z and digits has no key and is left alone."""
    rows = registry(spark, base).where(mergeable(F.col("entity_type"), F.col("label"))).withColumn("key", C.match_key(F.col("label")))
    return absorbed_keys(cut(rows.select("uri", "entity_type", "confidence", "key")))


def candidate_links(labels: DataFrame, candidates: DataFrame, least: float = 0.65) -> DataFrame:
    """(label_key, qid, score) of the best knowledge-base candidate per label: exact for short labels, else by ratio.

    ``candidates`` (label_key, rank, qid, label) stands for the search service; equal scores fall to the lower rank."""
    pairs = labels.select("label_key").distinct().join(candidates, "label_key")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for key, label in zip(pdf["label_key"], pdf["label"], strict=True):
                low = (label or "").lower()
                same = key == low
                out.append((1.0 if same else 0.0) if len(key) < 4 else SequenceMatcher(None, key, low).ratio() + (0.15 if same else 0.0))
            yield pdf.assign(score=out)[["label_key", "rank", "qid", "score"]]

    scored = pairs.select("label_key", F.col("rank").cast("int").alias("rank"), "qid", "label").mapInPandas(score, "label_key string, rank int, qid string, score double")
    best = scored.where(F.col("score") >= least).groupBy("label_key").agg(F.max_by(F.struct("qid", "score"), F.struct("score", (-F.col("rank")).alias("r"))).alias("b"))
    return best.select("label_key", "b.qid", "b.score")


def quote_starts(text: Column, quote: Column) -> Column:
    """Starts (from 0) of all occurrences of a quote, overlapping ones too, without regard to case."""
    low, q = F.lower(text), F.lower(quote)
    most = F.length(low) - F.length(q)
    every = F.when((F.length(q) > 0) & (most >= 0) & F.contains(low, q), F.sequence(F.lit(0), most)).otherwise(F.array().cast("array<int>"))
    return F.filter(every, lambda i: F.substr(low, i + 1, F.length(q)) == q)


def quote_span(text: Column, quote: Column, middle: Column) -> Column:
    """Start of the occurrence whose middle is nearest to ``middle`` (the first where that is null or equal); null if none."""
    starts = quote_starts(text, quote)
    ranked = F.transform(starts, lambda i: F.struct(F.coalesce(F.abs(i + F.length(quote) / 2 - middle), F.lit(0.0)).alias("d"), i.alias("i")))
    return F.array_min(ranked)["i"]


def quoted_relations(spark: SparkSession, base: str) -> DataFrame:
    """(uri, start_char, end_char): where a relation's quoted evidence stands in its context."""
    rows = read(spark, base, "relations").select("uri", "context", C.blank_to_null(F.col("metadata")["evidence_quote"]).alias("q")).where("q is not null and context is not null").distinct()
    start = quote_span(F.col("context"), F.col("q"), F.lit(None).cast("double"))
    return rows.withColumn("start_char", start).where("start_char is not null").select("uri", "start_char", (F.col("start_char") + F.length("q")).alias("end_char")).distinct()


def document_priors(spark: SparkSession, base: str) -> DataFrame:
    """(uri, doc_id, n): the document an entity is mentioned in most, the smallest among equals."""
    rows = read(spark, base, "entities").select("uri", C.blank_to_null(F.col("doc_id")).alias("doc_id")).where("uri is not null and doc_id is not null").groupBy("uri", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("uri").agg(F.min_by(F.struct("doc_id", "n"), F.struct((-F.col("n")).alias("n"), "doc_id")).alias("b")).select("uri", "b.doc_id", "b.n")


def relation_provenance(spark: SparkSession, base: str) -> DataFrame:
    """(uri, doc_id, origin): a relation's document: its own, else that of its source, else of its target."""
    rows = base_relations(spark, base).select("uri", "source", "target", C.blank_to_null(F.col("doc_id")).alias("own"))
    priors = cut(document_priors(spark, base))
    rows = lookup(rows, priors.select(F.col("uri").alias("source"), F.col("doc_id").alias("ds")), ["source"])
    rows = lookup(rows, priors.select(F.col("uri").alias("target"), F.col("doc_id").alias("dt")), ["target"])
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("ds").isNotNull(), "source").when(F.col("dt").isNotNull(), "target").otherwise("none")
    return rows.select("uri", F.coalesce("own", "ds", "dt").alias("doc_id"), origin.alias("origin"))


QUERIES = {"consolidation": consolidation, "quoted_relations": quoted_relations, "document_priors": document_priors, "relation_provenance": relation_provenance}
_PRIOR = "d0 as (select uri, nullif(regexp_replace(doc_id, '^\\s+|\\s+$', '', 'g'), '') doc_id, count(*) n from entities group by 1, 2), pri as (select * from (select *, row_number() over (partition by uri order by n desc, doc_id) rn from d0 where uri is not null and doc_id is not null) where rn = 1)"
ORACLE = {
    "quoted_relations": "select distinct uri, strpos(lower(context), lower(q)) - 1 as start_char, strpos(lower(context), lower(q)) - 1 + length(q) as end_char from (select uri, context, nullif(regexp_replace(map_extract_value(metadata, 'evidence_quote'), '^\\s+|\\s+$', '', 'g'), '') q from relations) where q is not null and strpos(lower(context), lower(q)) > 0",
    "document_priors": f"with {_PRIOR} select uri, doc_id, n from pri",
    "relation_provenance": f"with {BASE}, {_PRIOR}, j as (select r.uri, nullif(regexp_replace(r.doc_id, '^\\s+|\\s+$', '', 'g'), '') own, a.doc_id ds, b.doc_id dt from rel r left join pri a on a.uri = r.source left join pri b on b.uri = r.target) select uri, coalesce(own, ds, dt) as doc_id, case when own is not null then 'own' when ds is not null then 'source' when dt is not null then 'target' else 'none' end as origin from j",
}
