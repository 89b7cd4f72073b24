"""What follows from a decision that entities are one: merged rows, aliases, the log, rewritten relations; and what entities
and relations say of the records they come from: mentions, spans, units, evidence.

All of it is projections, partial aggregates and lookups by uri; a uri mentioned in a third of all rows is combined on the
map side. Null and blank uris are left out; rows that name no record have no mention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.predicates import BASE, base_relations
from symposia.operators.resolve import _LKEY, _REG, ORACLE as _RESOLVE, decision_redirects, exact_groups, registry
from symposia.operators.segments import _TEXTS, texts
from symposia.rules import vocabulary as V
from symposia.runtime import cut, lookup, read


def record(metadata: Column) -> Column:
    """``section|id`` of the record a row names, in lower case and without padding; null where it names none."""
    low = lambda k: F.lower(C.strip(metadata[k]))
    return F.coalesce(F.regexp_replace(low("origin_key"), r"\s*\|\s*", "|"), F.concat(low("section"), F.lit("|"), low("discourse_id")))


def valid_confidence(c: Column) -> Column:
    return F.when(~F.isnan(c) & (c >= 0) & (c <= 1), F.round(c, 3))


def mentions(spark: SparkSession, base: str) -> DataFrame:
    """(uri, label, confidence, origin_key, chunk_index, start_char, end_char) of every row that names a record; no chunk is -1."""
    rows = read(spark, base, "entities").where("uri is not null").select(
        "uri", "label", valid_confidence(F.col("confidence")).alias("confidence"), record(F.col("metadata")).alias("origin_key"),
        F.coalesce(C.coerce_nonneg(F.col("metadata")["chunk_index"]), F.lit(-1)).cast("int").alias("chunk_index"), *[F.when(F.col(c) >= 0, F.col(c)).alias(c) for c in ("start_char", "end_char")],
    )
    return rows.where("origin_key is not null")


def entity_mentions(spark: SparkSession, base: str) -> DataFrame:
    """The distinct mentions of every entity."""
    return mentions(spark, base).select("uri", "origin_key", "chunk_index", "start_char", "end_char").distinct()


def chunk_redirects(spark: SparkSession, base: str) -> DataFrame:
    """(origin_key, chunk_index, old, new): of entities with one label in one chunk the most confident stands for the others."""
    key = ["origin_key", "chunk_index", "name"]
    rows = mentions(spark, base).withColumn("name", C.normalize_text(F.col("label"))).where("name <> ''")
    rows = cut(rows.groupBy(*key, "uri").agg(F.coalesce(F.max("confidence"), F.lit(0.0)).alias("c")))
    best = rows.groupBy(*key).agg(F.min_by("uri", F.struct((-F.col("c")).alias("c"), "uri")).alias("new"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return lookup(rows.select(*key, F.col("uri").alias("old")), best, key, "inner").where("old <> new").select("origin_key", "chunk_index", "old", "new").distinct()


def unit(origin: Column, kg: str = V.KG) -> Column:
    return F.concat(F.lit(f"{kg}discourse_"), F.regexp_replace(origin, "[^A-Za-z0-9]+", "_"))


def discourse_units(spark: SparkSession, base: str) -> DataFrame:
    """(uri, origin_key, n_chars) of every record that holds text."""
    return texts(spark, base).where(C.strip(F.col("text")) != "").select(unit(F.col("origin_key")).alias("uri"), "origin_key", F.length("text").alias("n_chars"))


def mention_edges(spark: SparkSession, base: str) -> DataFrame:
    """(source, target, confidence, evidence): a record's unit mentions each entity named for it; the evidence is the text's first 500 characters."""
    named = mentions(spark, base).select("origin_key", F.col("uri").alias("target")).distinct()
    held = texts(spark, base).where(C.strip(F.col("text")) != "").select("origin_key", F.substring("text", 1, 500).alias("evidence"))
    rows = lookup(named, held, ["origin_key"], "inner")
    return rows.select(unit(F.col("origin_key")).alias("source"), "target", F.lit(V.CONFIDENCE["mentions"]).alias("confidence"), "evidence")


def alias_map(spark: SparkSession, base: str) -> DataFrame:
    """(normalised, raw, uri): every label of an entity merged by its key, and the uri that stands for it."""
    rows = registry(spark, base).select("uri", "label")
    merged = lookup(exact_groups(spark, base).select("uri", "canonical"), rows, ["uri"], "inner")
    return merged.select(C.label_key(F.col("label")).alias("normalised"), F.col("label").alias("raw"), F.col("canonical").alias("uri")).distinct()


def decision_log(spark: SparkSession, base: str) -> DataFrame:
    """(uri, rule, source_ids, members): one decision per group of equal keys, its other members sorted."""
    rows = exact_groups(spark, base).groupBy("canonical").agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("uri") != F.col("canonical"), F.col("uri")))), " ").alias("source_ids"), F.count(F.lit(1)).alias("members"))
    return rows.select(F.col("canonical").alias("uri"), F.lit("exact").alias("rule"), "source_ids", "members")


def merge(entities: DataFrame, canonical: DataFrame) -> DataFrame:
    """One row per canonical uri of (uri, canonical): the label of the most confident member, the others as aliases, the
    greatest confidence, a class where any has one, all mentions."""
    rows = lookup(entities, canonical, ["uri"]).withColumn("canonical", F.coalesce("canonical", "uri"))
    grouped = rows.groupBy("canonical").agg(
        F.max_by("label", F.struct("confidence", F.length("label"), "label")).alias("label"), F.array_sort(F.collect_set("label")).alias("labels"), F.max("confidence").alias("confidence"),
        F.coalesce(F.min(F.when(F.col("uri") == F.col("canonical"), F.col("ontology_uri"))), F.min("ontology_uri")).alias("ontology_uri"), F.sum("mentions").alias("mentions"), F.count(F.lit(1)).alias("members"),
    )
    return grouped.select(F.col("canonical").alias("uri"), "label", F.array_join(F.filter("labels", lambda x: x != F.col("label")), " | ").alias("aliases"), "confidence", "ontology_uri", "mentions", "members")


def merged_entities(spark: SparkSession, base: str) -> DataFrame:
    """The entities after the merge of equal keys."""
    return merge(cut(registry(spark, base)), exact_groups(spark, base).select("uri", "canonical"))


def replaced_entities(spark: SparkSession, base: str) -> DataFrame:
    """The entities after the redirects of the linker's log: a replaced uri is merged into its successor, or becomes it."""
    redirects = decision_redirects(spark, base).select(F.col("old").alias("uri"), F.col("new").alias("canonical"))
    return merge(cut(registry(spark, base)), redirects)


def rewrite(relations: DataFrame, redirects: DataFrame) -> DataFrame:
    """``relations`` with both ends led to where (old, new) sends them, and whether one moved."""
    for end in ("source", "target"):
        relations = lookup(relations, redirects.select(F.col("old").alias(end), F.col("new").alias(f"_{end}")), [end])
    return relations.withColumns({"source": F.coalesce("_source", "source"), "target": F.coalesce("_target", "target"), "moved": F.col("_source").isNotNull() | F.col("_target").isNotNull()}).drop("_source", "_target")


def rewritten_relations(spark: SparkSession, base: str) -> DataFrame:
    """(uri, source, relation, target, moved): relations after the redirects of the linker's log."""
    return rewrite(base_relations(spark, base), cut(decision_redirects(spark, base))).select("uri", "source", "relation", "target", "moved")


def entity_uris(spark: SparkSession, base: str) -> DataFrame:
    """(uri, canonical, minted): the identifiers made of an entity's label key, type and class."""
    rows = registry(spark, base).where("label is not null").withColumn("key", C.match_key(F.col("label")))
    return rows.select("uri", C.canonical_uri(F.col("key"), F.col("entity_type"), F.col("ontology_uri")).alias("canonical"), C.minted_uri(F.col("entity_type"), F.col("key")).alias("minted"))


def entity_spans(spark: SparkSession, base: str) -> DataFrame:
    """(uri, doc_id, start_char, end_char, chunks, chunk_index): the hull of an entity's spans in a document, how many chunks they
    fall into and the least of these (-1 for none). A span that ends before it begins is one character long."""
    start, end = F.when(F.col("start_char") >= 0, F.col("start_char")), F.when(F.col("end_char") >= 0, F.col("end_char"))
    chunk = C.coerce_nonneg(F.col("metadata")["chunk_index"])
    rows = read(spark, base, "entities").select("uri", C.blank_to_null(F.col("doc_id")).alias("doc_id"), start.alias("s"), F.greatest(end, start + 1).alias("e"), end.alias("_e"), chunk.alias("c")).where("uri is not null and doc_id is not null")
    whole = F.col("s").isNotNull() & F.col("_e").isNotNull()
    return rows.groupBy("uri", "doc_id").agg(F.min(F.when(whole, F.col("s"))).alias("start_char"), F.max(F.when(whole, F.col("e"))).alias("end_char"), F.countDistinct("c").cast("int").alias("chunks"), F.coalesce(F.min("c"), F.lit(-1)).cast("int").alias("chunk_index"))


def relation_spans(spark: SparkSession, base: str) -> DataFrame:
    """(uri, doc_id, start_char, end_char, reason, chunk_index, chunk_from) of every relation.

    The span is the hull of both ends' spans in the relation's document. ``reason`` tells why there is none: no document,
    one end only, neither. The chunk is that of the source, else of the target, where it is the only one there; else -1."""
    rows = base_relations(spark, base).select("uri", "source", "target", C.blank_to_null(F.col("doc_id")).alias("doc_id"))
    spans = cut(entity_spans(spark, base))
    for end, x in (("source", "s"), ("target", "t")):
        side = spans.select(F.col("uri").alias(end), "doc_id", F.col("start_char").alias(f"{x}_lo"), F.col("end_char").alias(f"{x}_hi"), F.when(F.col("chunks") == 1, F.col("chunk_index")).alias(f"{x}_c"))
        rows = lookup(rows, side, [end, "doc_id"])
    has = lambda x: F.col(f"{x}_lo").isNotNull()
    both = has("s") & has("t")
    reason = F.when(F.col("doc_id").isNull(), "no_document").when(both, "grounded").when(has("s") | has("t"), "one_end").otherwise("no_span")
    return rows.select(
        "uri", "doc_id", F.when(both, F.least("s_lo", "t_lo")).alias("start_char"), F.when(both, F.greatest("s_hi", "t_hi")).alias("end_char"), reason.alias("reason"),
        F.coalesce("s_c", "t_c", F.lit(-1)).alias("chunk_index"), F.when(F.col("s_c").isNotNull(), "source").when(F.col("t_c").isNotNull(), "target").otherwise("none").alias("chunk_from"),
    )


#: Extractors whose relations state no text, so no span is asked of them.
NOT_TEXTUAL = ("vote", "structural", "lightweight", "reasoner")


def provenance_breakdown(spark: SparkSession, base: str) -> DataFrame:
    """(extractor, relation, reason, n, share) of the relations that should be grounded in text: asserted, by a textual extractor."""
    rows = base_relations(spark, base).where(~F.col("is_inferred")).select("uri", F.coalesce(F.lower(C.strip(F.col("extractor"))), F.lit("unknown")).alias("extractor"), "relation").where(~F.col("extractor").isin(*NOT_TEXTUAL))
    found = lookup(rows, relation_spans(spark, base).select("uri", "reason"), ["uri"], "inner")
    counts = cut(found.groupBy("extractor", "relation", "reason").agg(F.count(F.lit(1)).alias("n")))
    return counts.join(counts.agg(F.sum("n").alias("every")), how="inner", on=F.lit(True)).select("extractor", "relation", "reason", "n", F.round(F.col("n") / F.col("every"), 6).alias("share"))


def evidence_nodes(spark: SparkSession, base: str) -> DataFrame:
    """(uri, evidence, text, confidence, discourse_id, chunk_index, start_char, end_char, quote_hash): the evidence of every relation.

    Its identifier is a hash of relation, number, chunk and span; its text the quote, else the context, else a sentence made
    of the statement."""
    rows = base_relations(spark, base)
    spans = relation_spans(spark, base).select("uri", "start_char", "end_char", "chunk_index")
    rows = rows.join(spans, "uri")
    none = F.lit("None")
    key = F.concat_ws("|", "uri", F.lit("0"), "chunk_index", F.coalesce(F.col("start_char").cast("string"), none), F.coalesce(F.col("end_char").cast("string"), none))
    made = F.concat_ws(" ", C.local_name(F.col("source")), "relation", C.local_name(F.col("target")))
    text = C.evidence_text(F.col("evidence"), made)
    return rows.select("uri", F.concat(F.lit(f"{V.KG}evidence_"), C.short_hash(key)).alias("evidence"), text.alias("text"), "confidence", C.coerce_int(F.col("doc_id")).alias("discourse_id"), "chunk_index", "start_char", "end_char", C.short_hash(text).alias("quote_hash"))


def entity_index(spark: SparkSession, base: str) -> DataFrame:
    """(key, uri): what an entity may be called by: its uri and its label in lower case; the greatest uri answers to a shared label."""
    rows = registry(spark, base)
    keys = rows.select(F.explode(F.array_compact(F.array("uri", F.lower(C.blank_to_null(F.col("label")))))).alias("key"), "uri")
    return keys.groupBy("key").agg(F.max("uri").alias("uri"))


def resolved_endpoints(spark: SparkSession, base: str) -> DataFrame:
    """(endpoint, node, kind): what each end of a relation stands for: an entity by uri or label, an absolute identifier, or a minted one."""
    rows = base_relations(spark, base).select(F.explode(F.array("source", "target")).alias("endpoint")).distinct()
    index = cut(entity_index(spark, base))
    rows = lookup(rows, index.select(F.col("key").alias("endpoint"), F.col("uri").alias("own")), ["endpoint"]).withColumn("low", F.lower("endpoint"))
    rows = lookup(rows, index.select(F.col("key").alias("low"), F.col("uri").alias("named")), ["low"])
    iri = C.is_iri(F.col("endpoint"))
    minted = F.concat(F.lit(f"{V.KG}entity_"), C.short_hash(F.col("endpoint")))
    return rows.select("endpoint", F.coalesce("own", "named", F.when(iri, F.col("endpoint")), minted).alias("node"), F.when(F.coalesce("own", "named").isNotNull(), "entity").when(iri, "iri").otherwise("minted").alias("kind"))


QUERIES = {f.__name__: f for f in (entity_mentions, chunk_redirects, discourse_units, mention_edges, alias_map, decision_log, merged_entities, replaced_entities, rewritten_relations, entity_uris, entity_spans, relation_spans, provenance_breakdown, evidence_nodes, entity_index, resolved_endpoints)}

_S = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_M = lambda k: f"map_extract_value(metadata, '{k}')"
ORIGIN = f"coalesce(regexp_replace(lower({_S(_M('origin_key'))}), '\\s*\\|\\s*', '|', 'g'), lower({_S(_M('section'))}) || '|' || lower({_S(_M('discourse_id'))}))"
CHUNK = f"case when try_cast(nullif(regexp_extract({_M('chunk_index')}, '-?\\d+'), '') as bigint) >= 0 then try_cast(nullif(regexp_extract({_M('chunk_index')}, '-?\\d+'), '') as bigint) end"
MENTIONS = f"""men as (select * from (select uri, label, case when isnan(confidence) or confidence < 0 or confidence > 1 then null else round(confidence, 3) end c, {ORIGIN} origin_key, cast(coalesce({CHUNK}, -1) as integer) chunk_index,
  case when start_char >= 0 then start_char end start_char, case when end_char >= 0 then end_char end end_char from entities where uri is not null) where origin_key is not null)"""
_GROUPS = _RESOLVE["exact_groups"].removeprefix("with ").rsplit(" select k.uri", 1)[0]
_EXACT = f"{_GROUPS}, ex as (select k.uri, g.canonical, g.n size from k join g using (entity_type, k))"
_REDIRECT = f"rd as ({_RESOLVE['decision_redirects'].removeprefix('with recursive ')})"
_RD = "with recursive " + _RESOLVE["decision_redirects"].removeprefix("with recursive ").rsplit("\nselect old, new from", 1)[0] + ", rd as (select old, new from" + _RESOLVE["decision_redirects"].rsplit("\nselect old, new from", 1)[1] + ")"
_UNIT = f"'{V.KG}discourse_' || regexp_replace(k, '[^A-Za-z0-9]+', '_', 'g')"


def _merge_sql(table: str) -> str:
    return f"""mm as (select coalesce(m.canonical, r.uri) canonical, r.* from reg r left join {table} m on m.uri = r.uri),
m2 as (select canonical, arg_max(label, (confidence, length(label), label)) label, list_sort(list_distinct(list(label) filter (label is not null))) labels, max(confidence) confidence, coalesce(min(ontology_uri) filter (uri = canonical), min(ontology_uri)) ontology_uri, sum(mentions) mentions, count(*) members from mm group by 1)
select canonical as uri, label, array_to_string(list_filter(labels, lambda x: x <> label), ' | ') as aliases, cast(confidence as double) as confidence, ontology_uri, cast(mentions as bigint) as mentions, members from m2"""


_SPANS = f"""es as (select uri, doc_id, min(case when s is not null and e is not null then s end) start_char, max(case when s is not null and e is not null then greatest(e, s + 1) end) end_char, count(distinct c) chunks, coalesce(min(c), -1) chunk_index
  from (select uri, nullif({_S('doc_id')}, '') doc_id, case when start_char >= 0 then start_char end s, case when end_char >= 0 then end_char end e, {CHUNK} c from entities) where uri is not null and doc_id is not null group by 1, 2)"""
_RSPANS = f"""{_SPANS}, rs as (select r.uri, d doc_id, case when a.start_char is not null and b.start_char is not null then least(a.start_char, b.start_char) end start_char, case when a.start_char is not null and b.start_char is not null then greatest(a.end_char, b.end_char) end end_char,
  case when d is null then 'no_document' when a.start_char is not null and b.start_char is not null then 'grounded' when a.start_char is not null or b.start_char is not null then 'one_end' else 'no_span' end reason,
  cast(coalesce(case when a.chunks = 1 then a.chunk_index end, case when b.chunks = 1 then b.chunk_index end, -1) as integer) chunk_index, case when a.chunks = 1 then 'source' when b.chunks = 1 then 'target' else 'none' end chunk_from
  from (select *, nullif({_S('doc_id')}, '') d from rel) r left join es a on a.uri = r.source and a.doc_id = d left join es b on b.uri = r.target and b.doc_id = d)"""
_LOCAL = lambda c: f"case when contains({c}, '#') then regexp_extract({c}, '[^#]*$') else regexp_extract({c}, '[^/]*$') end"
_TEXTUAL = ", ".join(f"'{x}'" for x in NOT_TEXTUAL)
ORACLE = {
    "entity_mentions": f"with {MENTIONS} select distinct uri, origin_key, chunk_index, start_char, end_char from men",
    "chunk_redirects": f"with {MENTIONS}, a as (select origin_key, chunk_index, {_S(chr(39).join(['regexp_replace(lower(label), ', chr(92) + 's+', ', ', ' ', ', ', 'g', ')']))} nm, uri, coalesce(max(c), 0.0) c from men group by all), w as (select *, first_value(uri) over (partition by origin_key, chunk_index, nm order by c desc, uri) nw from a where nm <> '') select distinct origin_key, chunk_index, uri as old, nw as new from w where uri <> nw",
    "discourse_units": f"with {_TEXTS} select {_UNIT} as uri, k as origin_key, cast(length(t) as integer) as n_chars from texts where {_S('t')} <> ''",
    "mention_edges": f"with {MENTIONS}, {_TEXTS} select distinct {_UNIT} as source, uri as target, cast(0.6 as double) as confidence, t[1:500] as evidence from men join texts on k = origin_key where {_S('t')} <> ''",
    "alias_map": f"with {_EXACT} select distinct {_LKEY} as normalised, reg.label as raw, canonical as uri from ex join reg using (uri)",
    "decision_log": f"with {_EXACT} select canonical as uri, 'exact' as rule, coalesce(string_agg(uri, ' ' order by uri) filter (uri <> canonical), '') as source_ids, count(*) as members from ex group by 1",
    "merged_entities": f"with {_EXACT}, {_merge_sql('ex')}",
    "replaced_entities": f"{_RD}, {_REG}, rn as (select old uri, new canonical from rd), {_merge_sql('rn')}",
    "rewritten_relations": f"{_RD}, {BASE} select r.uri, coalesce(a.new, r.source) as source, relation, coalesce(b.new, r.target) as target, a.new is not null or b.new is not null as moved from rel r left join rd a on a.old = r.source left join rd b on b.old = r.target",
    "entity_uris": f"with {_REG}, k as (select *, trim(regexp_replace(lower(@), '[^a-z0-9]+', ' ', 'g')) k from reg where label is not null) select uri, '{V.KG}' || lower(entity_type) || '_' || regexp_replace(regexp_replace(k, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') || '_' || substr(sha1(concat_ws('|', k, entity_type, coalesce(ontology_uri, ''))), 1, 10) as canonical, '{V.KG.rstrip('#')}/entity/' || regexp_replace(regexp_replace(lower(entity_type), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') || '/' || regexp_replace(regexp_replace(lower(k), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') || '-' || substr(sha1(concat_ws('|', entity_type, k)), 1, 8) as minted from k",
    "entity_spans": f"with {_SPANS} select uri, doc_id, start_char, end_char, cast(chunks as integer) as chunks, cast(chunk_index as integer) as chunk_index from es",
    "relation_spans": f"with {BASE}, {_RSPANS} select * from rs",
    "provenance_breakdown": f"with {BASE}, {_RSPANS}, f as (select coalesce(lower({_S('extractor')}), 'unknown') extractor, relation, reason from rel join rs using (uri) where not is_inferred), h as (select extractor, relation, reason, count(*) n from f where extractor not in ({_TEXTUAL}) group by all) select *, round(n / sum(n) over (), 6) as share from h",
    "evidence_nodes": f"with {BASE}, {_RSPANS}, q as (select r.uri, confidence, try_cast(nullif(regexp_extract(r.doc_id, '-?\\d+'), '') as bigint) discourse_id, chunk_index, start_char, end_char, coalesce(evidence, concat_ws(' ', {_LOCAL('source')}, relation, {_LOCAL('target')}))[1:500] t from rel r join rs using (uri)) select uri, '{V.KG}evidence_' || substr(sha256(concat_ws('|', uri, '0', chunk_index, coalesce(cast(start_char as varchar), 'None'), coalesce(cast(end_char as varchar), 'None'))), 1, 16) as evidence, t as text, cast(confidence as double) as confidence, discourse_id, chunk_index, start_char, end_char, substr(sha256(t), 1, 16) as quote_hash from q",
    "entity_index": f"with {_REG}, k as (select uri key, uri from reg union all select lower({_S('label')}), uri from reg where {_S('label')} <> '') select key, max(uri) as uri from k group by 1",
    "resolved_endpoints": f"with {BASE}, {_REG}, k as (select key, max(uri) uri from (select uri key, uri from reg union all select lower({_S('label')}), uri from reg where {_S('label')} <> '') group by 1), x as (select source endpoint from rel union select target from rel) select endpoint, coalesce(a.uri, b.uri, case when regexp_matches(endpoint, '^(https?://|urn:)[^\\s<>\"{{}}|\\\\^`]+$') then endpoint end, '{V.KG}entity_' || substr(sha256(endpoint), 1, 16)) as node, case when coalesce(a.uri, b.uri) is not null then 'entity' when regexp_matches(endpoint, '^(https?://|urn:)[^\\s<>\"{{}}|\\\\^`]+$') then 'iri' else 'minted' end as kind from x left join k a on a.key = endpoint left join k b on b.key = lower(endpoint)",
}
from symposia.operators.resolve import _COMPAT  # noqa: E402

ORACLE["entity_uris"] = ORACLE["entity_uris"].replace("@", _COMPAT)
