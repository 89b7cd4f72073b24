"""Entity resolution: exact keys, external identifiers, blocked fuzzy matching, canonical choice, redirects."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.graph import connected_components
from symposia.operators.predicates import ETYPE
from symposia.rules import vocabulary as V
from symposia.runtime import cut, drop, lookup, read, salted

FUZZY = 0.92


def registry(spark: SparkSession, base: str) -> DataFrame:
    """One row per uri: the merge of all its mentions (G1): greatest confidence, longest label, all sources and types."""
    rows = read(spark, base, "entities").where("uri is not null")
    confidence = F.when(F.isnan("confidence") | (F.col("confidence") < 0) | (F.col("confidence") > 1), F.lit(None)).otherwise(F.round("confidence", 3))
    return rows.groupBy("uri").agg(
        F.max_by("label", F.struct(F.length("label"), "label")).alias("label"),
        F.min(C.entity_type(F.col("entity_type"))).alias("entity_type"),
        F.coalesce(F.max(confidence), F.lit(0.0)).alias("confidence"),
        F.min(C.blank_to_null(F.col("ontology_uri"))).alias("ontology_uri"),
        F.count(F.lit(1)).alias("mentions"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
    )


def coarse_type(kind: Column, ontology: Column) -> Column:
    """Local name of the ontology class where its prefix names classes, else the entity type."""
    inside = F.substring_index(ontology, ":", 1).isin(*V.CLASS_PREFIXES)
    return F.when(inside, F.substring_index(ontology, ":", -1)).otherwise(kind)


def exact_groups(spark: SparkSession, base: str, entities: DataFrame | None = None) -> DataFrame:
    """(uri, canonical, size): entities of one type whose labels have the same key; the most confident one stands for them."""
    rows = (registry(spark, base) if entities is None else entities).withColumn("key", C.match_key(F.col("label"))).where("key <> ''")
    best = rows.groupBy("entity_type", "key").agg(F.min_by("uri", F.struct((-F.col("confidence")).alias("c"), "uri")).alias("canonical"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return lookup(rows.select("uri", "entity_type", "key"), best, ["entity_type", "key"], "inner").select("uri", "canonical", "size")


def mergeable(kind: Column, label: Column) -> Column:
    """Structural nodes, numbered labels and words too general to merge are left alone."""
    low = F.lower(C.strip(label))
    return ~kind.isin(*V.STRUCTURAL_TYPES) & ~low.isin(*V.DO_NOT_MERGE) & ~low.rlike(r"^(theme|question|answer|vote|expert|document|discourse unit) \d+$") & (F.length(low) >= 3)


def candidate_pairs(rows: DataFrame, least: float = 2 * FUZZY - 1) -> DataFrame:
    """(a, b) of uris of one type, each pair once, among which are all whose labels' words have a Jaccard index of ``least``.

    Words are ordered by rarity within the type. Two sets of n and m words with that index share at least
    ceil(least * max(n, m)) words, so one of the n - ceil(least * n) + 1 rarest words of the one is among the like of the
    other: these prefixes are what labels are joined on, whatever the size of a block. Hot words are spread."""
    words = cut(rows.select("uri", "entity_type", F.explode(C.label_tokens(F.col("label"))).alias("word")))
    rarity = words.groupBy("entity_type", "word").agg(F.count(F.lit(1)).alias("n"))
    ranked = lookup(words, cut(rarity), ["entity_type", "word"], "inner").groupBy("uri", "entity_type").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("ws"))
    size = F.size("ws")
    keyed = cut(ranked.select("uri", "entity_type", size.alias("size"), F.explode(F.slice("ws", F.lit(1), (size - F.ceil(size * least - 1e-9) + 1).cast("int"))).alias("w")).select("uri", "entity_type", "size", F.col("w.word").alias("word")))
    left, right = salted(keyed.withColumnRenamed("uri", "a"), keyed.select(F.col("uri").alias("b"), "entity_type", "word", F.col("size").alias("other")), ["entity_type", "word"])
    met = left.join(right, ["entity_type", "word", "_salt"]).where((F.col("a") < F.col("b")) & (F.least("size", "other") >= F.greatest("size", "other") * least - 1e-9))
    return met.select("a", "b").distinct()


def fuzzy_pairs(spark: SparkSession, base: str, threshold: float = FUZZY, entities: DataFrame | None = None) -> DataFrame:
    """(a, b, score): mean of word Jaccard and sequence ratio at least ``threshold``, over distinct labels of a type."""
    rows = cut((registry(spark, base) if entities is None else entities).where(mergeable(F.col("entity_type"), F.col("label"))))
    # equal keys are exact matches already: one uri stands for a key here
    firsts = cut(rows.withColumn("key", C.match_label(F.col("label"))).groupBy("entity_type", "key").agg(F.min("uri").alias("uri")).select("uri", "entity_type", F.col("key").alias("label")))
    side = lambda s: firsts.select(F.col("uri").alias(s), F.col("label").alias(f"l{s}"))
    pairs = candidate_pairs(firsts, 2 * threshold - 1).join(side("a"), "a").join(side("b"), "b")
    j = C.jaccard(C.label_tokens(F.col("la")), C.label_tokens(F.col("lb")))
    # the ratio is at most twice the shorter length by both lengths: what cannot reach the threshold needs no Python
    most = 2 * F.least(F.length("la"), F.length("lb")) / (F.length("la") + F.length("lb"))
    able = pairs.withColumn("jaccard", j).where((F.col("jaccard") + most) / 2 >= threshold - 1e-9)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            ratio = [SequenceMatcher(None, x, y).ratio() for x, y in zip(pdf["la"], pdf["lb"], strict=True)]
            pdf["score"] = (pdf["jaccard"] + pd.Series(ratio, index=pdf.index, dtype=float)) / 2
            yield pdf.loc[pdf["score"] >= threshold, ["a", "b", "score"]]

    return able.select("a", "b", "la", "lb", "jaccard").mapInPandas(score, "a string, b string, score double")


def external_ids(spark: SparkSession, base: str) -> DataFrame:
    """(uri, id): the external identifier of a uri, from the first of the metadata's fields that holds one; the least among equals."""
    field = lambda k: F.col("metadata")[k]
    nested = [F.get_json_object(field(k), f"$.{x}") for k in ("wikidata", "wikidata_match") for x in ("qid", "id", "uri")]
    every = [*[field(k) for k in ("external_id", "wikidata_uri", "doi", "url", "qid", "wikidata_id")], *nested]
    found = F.filter(F.array(*[F.struct(F.lit(i).alias("at"), C.external_id(C.blank_to_null(v)).alias("id")) for i, v in enumerate(every)]), lambda x: x["id"].isNotNull())
    rows = read(spark, base, "entities").where("uri is not null and metadata is not null").select("uri", F.array_min(found).alias("x")).where("x is not null")
    return rows.groupBy("uri").agg(F.min("x")["id"].alias("id"))


def to_first(rows: DataFrame, on: list[str]) -> DataFrame:
    """(a, b): every uri and the least one that is equal to it in ``on``."""
    firsts = rows.groupBy(*on).agg(F.min("uri").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return lookup(rows.select("uri", *on), firsts, on, "inner").where("uri <> b").select(F.col("uri").alias("a"), "b")


def same_identity(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(a, b) of one external identifier, whatever the type (E5), and of one match label and coarse type among uris without
    an identifier (E6); besides, each uri's tie to the one that stands for its label in ``fuzzy_pairs``."""
    keyed = cut(rows.select("uri", "entity_type", "label", coarse_type(F.col("entity_type"), F.col("ontology_uri")).alias("coarse"), C.match_label(F.col("label")).alias("key")).where("key <> ''"))
    stand = to_first(keyed.where(mergeable(F.col("entity_type"), F.col("label"))), ["entity_type", "key"])
    return to_first(ids, ["id"]).unionByName(to_first(keyed.join(ids, "uri", "left_anti"), ["coarse", "key"])).unionByName(stand)


def canonical_entities(spark: SparkSession, base: str, threshold: float = FUZZY) -> DataFrame:
    """(uri, canonical, rule): every entity with the one that stands for it, by exact key, external
    identifier, match label and fuzzy match, to the end."""
    rows = cut(registry(spark, base))
    exact = exact_groups(spark, base, rows).select(F.col("uri").alias("a"), F.col("canonical").alias("b"))
    fuzzy = fuzzy_pairs(spark, base, threshold, rows).select("a", "b")
    groups = connected_components(exact.unionByName(same_identity(rows, cut(external_ids(spark, base)))).unionByName(fuzzy)).withColumnRenamed("node", "uri")
    placed = cut(rows.join(groups, "uri"))
    best = placed.groupBy("component").agg(F.max_by("uri", F.struct("confidence", F.length("label"), "label", "uri")).alias("canonical"))
    out = lookup(placed.select("uri", "component"), best, ["component"], "inner").select("uri", "canonical")
    return rows.select("uri").join(out, "uri", "left").select("uri", F.coalesce("canonical", "uri").alias("canonical"), F.when(F.col("canonical").isNull(), "self").when(F.col("canonical") == F.col("uri"), "canonical").otherwise("merged").alias("rule"))


def redirect_closure(redirects: DataFrame) -> DataFrame:
    """(old, new): every redirect followed to its end by pointer jumping; a cycle ends at its least member.

    Jumps double in length, so a chain of n redirects takes log2(n) rounds; rounds end when nothing moves."""
    table = cut(redirects.where("old is not null and new is not null and old <> new").groupBy("old").agg(F.min("new").alias("new")))
    n, turn = table.count(), 0
    while True:
        nxt = table.select(F.col("old").alias("new"), F.col("new").alias("further"))
        jumped = table.join(nxt, "new", "left").select("old", F.when(F.col("further") == F.col("old"), F.least("old", "new")).otherwise(F.coalesce("further", "new")).alias("new"), "further")
        moved = cut(jumped.select("old", "new", (F.col("further").isNotNull() & (F.col("further") != F.col("old"))).alias("open")))
        drop(table)
        table, turn = moved.select("old", "new"), turn + 1
        left = moved.where("open").join(table.select(F.col("old").alias("new"), F.col("new").alias("next")).where("new <> next"), "new").limit(1).count()
        if not left:
            return table.where("old <> new")
        if 2**turn > 4 * n:
            # only cycles of three and more are left: every member goes to the least of its cycle
            rings = connected_components(redirects.where("old is not null and new is not null and old <> new").select(F.col("old").alias("a"), F.col("new").alias("b")))
            return _ring_ends(redirects, rings)


def _ring_ends(redirects: DataFrame, groups: DataFrame) -> DataFrame:
    """(old, new) where chains end in longer cycles: leaves are peeled off until only cycles stay, whose least member stands for a group."""
    first = cut(redirects.where("old is not null and new is not null and old <> new").groupBy("old").agg(F.min("new").alias("new")))
    ring = first
    while True:
        kept = cut(ring.join(ring.select(F.col("new").alias("old")).distinct(), "old", "left_semi"))
        if kept.count() == ring.count():
            break
        ring = kept
    inside = ring.select("old").unionByName(first.select(F.col("new").alias("old")).join(first.select("old"), "old", "left_anti")).distinct()
    ends = inside.join(groups.withColumnRenamed("node", "old"), "old").groupBy("component").agg(F.min("old").alias("new"))
    out = first.select("old").join(groups.withColumnRenamed("node", "old"), "old").join(ends, "component").select("old", "new")
    return out.where("old <> new")


def decision_redirects(spark: SparkSession, base: str) -> DataFrame:
    """Redirects of the linker's log, closed: source ids to the uri chosen for them."""
    rows = read(spark, base, "link_decisions").select(F.explode("source_ids").alias("old"), C.blank_to_null(F.col("chosen_canonical_uri")).alias("new"))
    rows = rows.select(C.blank_to_null(F.col("old")).alias("old"), "new").where("old is not null and new is not null and old <> new")
    return redirect_closure(rows)


def link_report(spark: SparkSession, base: str) -> DataFrame:
    """The twenty canonical entities with most uris merged into them (a top-k report)."""
    merged = canonical_entities(spark, base).groupBy("canonical").agg((F.count(F.lit(1)) - 1).alias("aliases")).where("aliases > 0")
    return merged.orderBy(F.desc("aliases"), "canonical").limit(20)


def label_keys(spark: SparkSession, base: str) -> DataFrame:
    rows = read(spark, base, "entities").select("label").where("label is not null").distinct()
    return rows.select("label", C.match_key(F.col("label")).alias("match_key"), F.array_join(F.array_sort(C.label_tokens(F.col("label"))), " ").alias("tokens"), C.is_acronym(F.col("label")).alias("acronym"), C.slug(F.col("label")).alias("slug"))


QUERIES = {
    "registry": registry,
    "exact_groups": exact_groups,
    "fuzzy_pairs": fuzzy_pairs,
    "canonical_entities": canonical_entities,
    "decision_redirects": decision_redirects,
    "link_report": link_report,
    "label_keys": label_keys,
}
_REG = f"""reg as (select uri, arg_max(label, (length(label), label)) label, min({ETYPE}) entity_type,
  coalesce(max(case when isnan(confidence) or confidence < 0 or confidence > 1 then null else round(confidence, 3) end), 0.0) confidence, min(nullif(regexp_replace(ontology_uri, '^\\s+|\\s+$', '', 'g'), '')) ontology_uri, count(*) mentions, array_to_string(list_sort(list_distinct(list(source) filter (source is not null))), ',') sources from entities where uri is not null group by 1)"""
_quote = lambda x: x.replace("'", "''")
_COMPAT = f"translate(label, '{_quote(C.WIDE)}', '{_quote(C.PLAIN)}')"
for _a, _b in C.LIGATURES:
    _COMPAT = f"replace({_COMPAT}, '{_a}', '{_b}')"
_KEY = f"trim(regexp_replace(lower({_COMPAT}), '[^a-z0-9]+', ' ', 'g'))"
_LKEY = "trim(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(@, '^\\s+|\\s+$', '', 'g')), '[–—−]', '-', 'g'), '[^\\p{L}\\p{M}\\p{N}_\\s:/.-]+', ' ', 'g'), '\\s+', ' ', 'g'))".replace("@", _COMPAT)
ORACLE = {
    "registry": f"with {_REG} select uri, label, entity_type, cast(confidence as double) as confidence, ontology_uri, mentions, sources from reg",
    "exact_groups": f"with {_REG}, k as (select *, {_KEY} k from reg), g as (select entity_type, k, count(*) n, arg_min(uri, (-confidence, uri)) canonical from k where k <> '' group by 1, 2 having count(*) > 1) select k.uri, g.canonical, g.n as size from k join g using (entity_type, k)",
    "decision_redirects": """with recursive r0 as (select nullif(regexp_replace(unnest(source_ids), '^\\s+|\\s+$', '', 'g'), '') old, nullif(regexp_replace(chosen_canonical_uri, '^\\s+|\\s+$', '', 'g'), '') new from link_decisions),
r as (select old, min(new) new from r0 where old is not null and new is not null and old <> new group by 1),
w(old, cur, path) as (select old, new, [old, new] from r union all select w.old, r.new, list_append(w.path, r.new) from w join r on r.old = w.cur where not list_contains(w.path, r.new)),
l as (select old, arg_max(cur, len(path)) new, arg_max(path, len(path)) path from w group by 1)
select old, new from (select l.old, case when r.new is null then l.new else (select min(x) from (select unnest(list_slice(l.path, list_position(l.path, r.new), len(l.path))) x)) end new from l left join r on r.old = l.new) where old <> new""",
    "label_keys": f"""with l as (select distinct label from entities where label is not null), w as (select label, list_filter(string_split_regex({_LKEY}, '[ _/:-]+'), lambda x: x <> '') ws from l),
t as (select label, list_sort(list_distinct(case when len(ws) > 1 and list_contains([{", ".join(f"'{x}'" for x in V.COMPANY_SUFFIXES)}], ws[-1]) then ws[:-2] else ws end)) ws from w)
select label, {_KEY} as match_key, array_to_string(ws, ' ') as tokens, regexp_full_match(label, '[A-Z0-9_-]{{2,}}') and regexp_matches(label, '[A-Z]') and regexp_full_match(regexp_replace(label, '[-_]', '', 'g'), '[A-Z0-9]+') as acronym,
  regexp_replace(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from t""",
}
