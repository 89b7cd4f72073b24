"""Predicates: canonical form, type guard, sharpening by evidence, removal of shadowed co-occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.rules import vocabulary as V
from symposia.runtime import lookup, read


def base_relations(spark: SparkSession, base: str) -> DataFrame:
    """Relations with canonical predicates and endpoints, one row per uri (its most confident delivery).

    Columns: uri, source, relation, target, confidence, is_inferred, evidence, extractor, section, doc_id."""
    rows = read(spark, base, "relations")
    confidence = F.when(F.isnan("confidence") | (F.col("confidence") < 0) | (F.col("confidence") > 1), F.lit(None)).otherwise(F.col("confidence"))
    picked = rows.select(
        "uri",
        C.blank_to_null(F.col("source")).alias("source"),
        C.normalize_predicate(F.col("relation")).alias("relation"),
        C.blank_to_null(F.col("target")).alias("target"),
        F.coalesce(F.round(confidence, 3), F.lit(0.0)).alias("confidence"),
        F.coalesce("is_inferred", F.lit(False)).alias("is_inferred"),
        F.coalesce(C.blank_to_null(F.col("metadata")["evidence"]), C.blank_to_null(F.col("metadata")["evidence_quote"]), C.blank_to_null(F.col("context"))).alias("evidence"),
        F.col("metadata")["extractor"].alias("extractor"),
        F.col("metadata")["section"].alias("section"),
        "doc_id",
    ).where("source is not null and target is not null")
    body = F.struct(*[F.col(c) for c in picked.columns if c != "uri"])
    order = F.struct("confidence", F.coalesce("evidence", F.lit("")).alias("e"), "relation", "source", "target", F.coalesce("doc_id", F.lit("")).alias("d"))
    return picked.groupBy("uri").agg(F.max_by(body, order).alias("b")).select("uri", "b.*")


def entity_types(spark: SparkSession, base: str) -> DataFrame:
    """(uri, entity_type): the commonest type of each uri, the smallest among equals."""
    rows = read(spark, base, "entities").select("uri", C.entity_type(F.col("entity_type")).alias("t")).groupBy("uri", "t").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("uri").agg(F.min_by("t", F.struct((-F.col("n")).alias("n"), "t")).alias("entity_type"))


def type_table(spark: SparkSession) -> DataFrame:
    """(name, domain, range) of every predicate that may be emitted: a fixed table of a few dozen rows."""
    return spark.createDataFrame([(p, list(d), list(r)) for p, (d, r) in V.PREDICATE_TYPES.items()], "name string, domain array<string>, range array<string>")


def fits(table: str, source_type: Column, target_type: Column) -> Column:
    """Whether the joined row of the type table allows the two types; false where there is none."""
    side = lambda types, t: F.array_contains(types, "*") | F.array_contains(types, t)
    return F.coalesce(side(F.col(f"{table}.domain"), source_type) & side(F.col(f"{table}.range"), target_type), F.lit(False))


def precise(relations: DataFrame) -> DataFrame:
    """Relations (with source_type and target_type) after synonyms, type guard and evidence; adds ``rule``.

    A weak predicate takes the first cue found in its evidence, if the types allow it (no second cue is tried); a
    predicate whose types do not fit becomes ``relatedTo`` (``mentions`` stays). A gain and a loss of confidence follow."""
    pred = C.aliased(F.col("relation"), V.PREDICATE_SYNONYMS)
    pred = F.when(pred.isin(*V.PREDICATE_TYPES), pred).otherwise(F.lit(V.DEFAULT_PREDICATE))
    cue = None
    for pattern, p in V.EVIDENCE_CUES:
        hit = F.col("evidence").rlike("(?i)" + pattern)
        cue = F.when(hit, p) if cue is None else cue.when(hit, p)
    rows = relations.withColumns({"_p": pred, "_cue": F.when(pred.isin(*V.WEAK_PREDICATES), cue)})
    table = F.broadcast(type_table(relations.sparkSession))
    rows = rows.join(table.alias("tp"), F.col("_p") == F.col("tp.name"), "left").join(table.alias("tc"), F.col("_cue") == F.col("tc.name"), "left")
    types = (F.col("source_type"), F.col("target_type"))
    up, ok, p = F.col("_up"), F.col("_ok"), F.col("_p")
    rows = rows.select(*relations.columns, "_p", "_cue", fits("tp", *types).alias("_ok"), (F.col("_cue").isNotNull() & fits("tc", *types)).alias("_up"))
    gain = F.when(up, F.lit(V.UPGRADE_GAIN)).otherwise(0.0)
    loss = F.when(ok, F.lit(0.0)).otherwise(V.GUARD_LOSS)
    confidence = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("confidence") + gain) - loss), 6)
    rule = F.when(up, "evidence").when(~ok, "guard").when(p != F.col("relation"), "synonym").otherwise("none")
    final = F.when(up, F.col("_cue")).when(ok | (p == "mentions"), p).otherwise(F.lit(V.DEFAULT_PREDICATE))
    return rows.select(*[c for c in relations.columns if c not in ("relation", "confidence")], rule.alias("rule"), final.alias("relation"), confidence.alias("confidence"), p.alias("before"))


def typed_relations(spark: SparkSession, base: str) -> DataFrame:
    rows, types = base_relations(spark, base), entity_types(spark, base)
    for end in ("source", "target"):
        rows = lookup(rows, types.select(F.col("uri").alias(end), F.col("entity_type").alias(f"{end}_type")), [end])
        rows = rows.withColumn(f"{end}_type", F.coalesce(f"{end}_type", F.lit("Entity")))
    return rows


def precise_relations(spark: SparkSession, base: str) -> DataFrame:
    """Sharpened relations without the co-occurrences that a stated predicate of the same record already covers."""
    rows = precise(typed_relations(spark, base))
    pair = [F.least("source", "target").alias("lo"), F.greatest("source", "target").alias("hi"), F.coalesce("doc_id", F.lit("")).alias("doc")]
    stated = rows.where(~F.col("before").isin(*V.WEAK_PREDICATES)).select(*pair).distinct()
    keyed = rows.withColumns({"lo": F.least("source", "target"), "hi": F.greatest("source", "target"), "doc": F.coalesce("doc_id", F.lit(""))})
    weak = (F.col("extractor") == "lightweight") & (F.col("relation") == V.DEFAULT_PREDICATE)
    weak = F.coalesce(weak, F.lit(False))
    kept = keyed.where(~weak).unionByName(keyed.where(weak).join(stated, ["lo", "hi", "doc"], "left_anti"))
    return kept.select("uri", "source", "relation", "target", "confidence", "is_inferred", "rule", "doc_id", "section", "extractor")


def predicate_summary(spark: SparkSession, base: str) -> DataFrame:
    return precise_relations(spark, base).groupBy("relation", "rule").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 4).alias("confidence"))


def predicate_spellings(spark: SparkSession, base: str) -> DataFrame:
    """Each spelling found and the canonical predicate it is read as."""
    return read(spark, base, "relations").groupBy(F.col("relation").alias("spelling")).agg(F.count(F.lit(1)).alias("n")).select("spelling", C.normalize_predicate(F.col("spelling")).alias("predicate"), "n")


def conflicts(relations: DataFrame) -> DataFrame:
    """(source, target, first, second, severity) of contradicting predicates between the same two nodes."""
    sets = relations.groupBy("source", "target").agg(F.collect_set("relation").alias("ps")).where(F.size("ps") > 1)
    pairs = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second")) for a, b in V.CONTRADICTIONS])
    found = sets.select("source", "target", F.explode(F.filter(pairs, lambda p: F.array_contains(F.col("ps"), p["first"]) & F.array_contains(F.col("ps"), p["second"]))).alias("p"))
    return found.select("source", "target", "p.first", "p.second", F.lit("high").alias("severity"))


def relation_conflicts(spark: SparkSession, base: str) -> DataFrame:
    return conflicts(base_relations(spark, base))


QUERIES = {"predicate_spellings": predicate_spellings, "precise_relations": precise_relations, "predicate_summary": predicate_summary, "relation_conflicts": relation_conflicts}

_T = lambda c: f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"
_MAP = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in V.PREDICATE_OF.items()) + "}"
_KEY = "trim(replace(regexp_replace(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), '[\\s-]+', ' ', 'g'), '_', ' '))"
CANON = f"coalesce(map_extract_value(m.m, {_KEY}), map_extract_value(m.m, replace({_KEY}, ' ', '')), 'relatedTo')"
_PRED_MAP = f"m as (select {_MAP} m)"
BASE = f"""{_PRED_MAP}, rel0 as (select uri, {_T("source")} source, {CANON.format(c="relation")} relation, {_T("target")} target,
    coalesce(case when isnan(confidence) or confidence < 0 or confidence > 1 then null else round(confidence, 3) end, 0.0) confidence, coalesce(is_inferred, false) is_inferred,
    coalesce({_T("map_extract_value(metadata, 'evidence')")}, {_T("map_extract_value(metadata, 'evidence_quote')")}, {_T("context")}) evidence, map_extract_value(metadata, 'extractor') extractor, map_extract_value(metadata, 'section') section, doc_id from relations, m),
rel as (select * from (select *, row_number() over (partition by uri order by confidence desc, coalesce(evidence, '') desc, relation desc, source desc, target desc, coalesce(doc_id, '') desc) rn from rel0 where source is not null and target is not null) where rn = 1)"""
_PLAIN = "regexp_replace(regexp_replace(entity_type, '^\\s+|\\s+$', '', 'g'), '^.*[:#/]', '')"
_KNOWN = {t.lower(): t for t in (*V.TYPE_CLASSES, "Entity", "PersonalData", "Organisation")} | {"organization": "Organisation"}
ETYPE = f"coalesce(map_extract_value(map {{{', '.join(f"'{k}': '{v}'" for k, v in _KNOWN.items())}}}, regexp_replace(lower({_PLAIN}), '[^a-z0-9]', '', 'g')), 'Entity')"
TYPES = f"types as (select uri, t entity_type from (select uri, t, row_number() over (partition by uri order by n desc, t) rn from (select uri, {ETYPE} t, count(*) n from entities group by 1, 2)) where rn = 1)"


def _guard_sql(p: str, s: str, t: str) -> str:
    lines = []
    for name, (domain, range_) in V.PREDICATE_TYPES.items():
        tests = [f"{c} in ({', '.join(repr(x) for x in xs)})" for c, xs in ((s, domain), (t, range_)) if xs != ("*",)]
        lines.append(f"when {p} = '{name}' then {' and '.join(tests) or 'true'}")
    return "coalesce(case " + " ".join(lines) + " end, false)"


_CUE = "case " + " ".join(f"when regexp_matches(evidence, '(?i){pat}') then '{p}'" for pat, p in V.EVIDENCE_CUES) + " end"
_WEAK = "('relatedTo', 'mentions')"
_SPECS = ", ".join(f"'{p}'" for p in V.PREDICATE_TYPES)
PRECISE = f"""{BASE}, {TYPES},
p0 as (select r.*, coalesce(a.entity_type, 'Entity') st, coalesce(b.entity_type, 'Entity') tt, case when r.relation = 'mitigates' then 'mitigatedBy' when r.relation in ({_SPECS}) then r.relation else 'relatedTo' end p from rel r left join types a on a.uri = r.source left join types b on b.uri = r.target),
p1 as (select *, case when p in {_WEAK} then {_CUE} end cue from p0),
p2 as (select *, {_guard_sql("p", "st", "tt")} ok, cue is not null and {_guard_sql("cue", "st", "tt")} up from p1),
p3 as (select uri, source, target, doc_id, section, extractor, is_inferred, p before, case when up then cue when ok then p when p = 'mentions' then 'mentions' else 'relatedTo' end relation,
  round(greatest(0.0, least(1.0, confidence + case when up then 0.05 else 0.0 end) - case when ok then 0.0 else 0.07 end), 6) confidence, case when up then 'evidence' when not ok then 'guard' when p <> relation then 'synonym' else 'none' end rule from p2),
stated as (select distinct least(source, target) lo, greatest(source, target) hi, coalesce(doc_id, '') doc from p3 where before not in {_WEAK}),
kept as (select * from p3 where not coalesce(extractor = 'lightweight' and relation = 'relatedTo', false) or not exists (select 1 from stated s where s.lo = least(p3.source, p3.target) and s.hi = greatest(p3.source, p3.target) and s.doc = coalesce(p3.doc_id, '')))"""
ORACLE = {
    "predicate_spellings": f"with {_PRED_MAP} select spelling, {CANON.format(c='spelling')} as predicate, n from (select relation spelling, count(*) n from relations group by 1), m",
    "precise_relations": f"with {PRECISE} select uri, source, relation, target, cast(confidence as double) as confidence, is_inferred, rule, doc_id, section, extractor from kept",
    "predicate_summary": f"with {PRECISE} select relation, rule, count(*) as n, round(avg(cast(confidence as double)), 4) as confidence from kept group by 1, 2",
    "relation_conflicts": f"with {BASE}, c as (select * from (values {', '.join(str(x) for x in V.CONTRADICTIONS)}) t(a, b)) select distinct x.source, x.target, c.a as first, c.b as second, 'high' as severity from rel x join rel y on x.source = y.source and x.target = y.target join c on c.a = x.relation and c.b = y.relation",
}
