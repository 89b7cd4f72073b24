"""Column functions at work on the tables: keys of labels, identifiers, web addresses, lenient values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.predicates import BASE, base_relations
from symposia.operators.resolve import _COMPAT, _KEY, _LKEY
from symposia.rules import vocabulary as V
from symposia.runtime import read


def text_keys(spark: SparkSession, base: str) -> DataFrame:
    """Each label with its normal forms, hashes and size."""
    rows, x = read(spark, base, "entities").select("label").where("label is not null").distinct(), F.col("label")
    return rows.select(
        "label", C.normalize_text(x).alias("normalised"), C.clean_text(x).alias("cleaned"), C.label_key(x).alias("link_key"), C.match_label(x).alias("match_label"), C.normalize_label(x).alias("canonical"), C.sanitized(x).alias("sanitised"), C.camel_case(x).alias("camel"),
        C.token_count(x).alias("tokens"), C.short_hash(x).alias("sha"), C.md5_hash(x).alias("md5"), C.single_value(x).alias("single"), C.uri_safe(x).alias("safe"), C.rdf_node(x).alias("node"),
    )


def identifier_keys(spark: SparkSession, base: str) -> DataFrame:
    """Each relation with the identifiers and local names made of its parts."""
    rows = base_relations(spark, base)
    did = C.blank_to_null(F.col("doc_id"))
    prefixes = {"kg": V.KG}
    return rows.select(
        "uri", C.relation_uri(did, F.col("source"), F.col("relation"), F.col("target")).alias("made"), C.local_name(F.col("source")).alias("source_name"), C.type_from_uri(F.col("target")).alias("target_kind"), C.origin_key(F.lower(C.strip(F.col("section"))), did).alias("origin"),
        C.evidence_text(F.col("evidence"), F.lit("none"), 40).alias("evidence"), C.is_iri(F.col("source")).alias("iri"), C.rdf_node(F.col("target")).alias("node"), C.expand_curie(F.concat(F.lit("kg:"), F.col("relation")), prefixes).alias("expanded"), C.clamp(F.col("confidence") * 3 - 1).alias("clamped"),
    )


def document_urls(spark: SparkSession, base: str) -> DataFrame:
    """(doc_id, normal, external): the web address of a document in normal form and as an identifier."""
    return read(spark, base, "documents").where("url is not null").select("doc_id", C.normalize_url(F.col("url")).alias("normal"), C.external_id(F.col("url")).alias("external"))


def value_coercions(spark: SparkSession, base: str) -> DataFrame:
    """Each spelling of a vote or a reference as number, natural number, truth value, rating and date."""
    votes = read(spark, base, "votes").select(F.explode(F.array("vote_value", "expert_id", F.col("created_at").cast("string"))).alias("value"))
    rows, x = votes.where("value is not null").distinct(), F.col("value")
    return rows.select("value", C.coerce_int(x).alias("number"), C.coerce_nonneg(x).alias("natural"), C.coerce_bool(x).alias("truth"), C.rating_concept(x).alias("rating"), C.reference(x).alias("reference"), C.is_iso_date(x).alias("iso"))


QUERIES = {f.__name__: f for f in (text_keys, identifier_keys, document_urls, value_coercions)}

_WS = r"[\s\x{b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_T = lambda c: f"regexp_replace({c}, '^{_WS}|{_WS}$', '', 'g')"
_Q = lambda x: "'" + x.replace("'", "''") + "'"
_MAP = lambda t: "map {" + ", ".join(f"{_Q(k)}: {_Q(v)}" for k, v in t.items()) + "}"
_IRI = "regexp_matches({c}, '^(https?://|urn:)[^\\s<>\"{{}}|\\\\^`]+$')"
_NODE = lambda c: f"case when {_IRI.format(c=c)} then '<' || {c} || '>' else '\"' || replace(replace({c}, '\\', '\\\\'), '\"', '\\\"') || '\"' end"
_CAP = lambda w: f"upper({w}[1]) || lower({w}[2:])"
_LOCAL = lambda c: f"case when contains({c}, '#') then regexp_extract({c}, '[^#]*$') else regexp_extract({c}, '[^/]*$') end"
_KIND = "case " + " ".join(f"when regexp_matches(lower(target), '[#/]{k.lower()}[_/]') then '{k}'" for k in ("Expert", "Answer", "Question", "Theme", "Vote", "Document")) + " when regexp_matches(lower(target), '[#/]discourse[_/]') then 'DiscourseUnit' else 'Entity' end"
_INT = "try_cast(nullif(regexp_extract(value, '-?\\d+'), '') as bigint)"
_URL = f"""u0 as (select doc_id, url, regexp_replace({_T('url')}, '#.*$', '') t from documents where url is not null), u1 as (select *, regexp_extract(t, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1) h from u0), u2 as (select *, t[length(h) + 1:] r from u1),
u3 as (select *, regexp_replace(regexp_replace(r, '\\?.*$', ''), '/+$', '') p, array_to_string(list_filter(string_split(regexp_extract(r, '\\?(.*)$', 1), '&'), lambda q: q <> '' and not starts_with(lower(q), 'utm_')), '&') q from u2),
u4 as (select *, case when h <> '' then lower(h) || p || case when q <> '' then '?' || q else '' end else t end n from u3)"""
ORACLE = {
    "text_keys": f"""with l as (select distinct label from entities where label is not null), k as (select label, {_T(f"regexp_replace(lower(label), '{_WS}', ' ', 'g')")} n, {_T(f"regexp_replace(replace(label, '**', ''), '{_WS}', ' ', 'g')")} c, {_LKEY} lk, {_T("label")} tr from l),
m as (select *, trim(regexp_replace(lower({_COMPAT.replace("label", "c", 1)}), '[^a-z0-9]+', ' ', 'g')) mk, regexp_replace(regexp_replace(tr, '[^A-Za-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') sa, list_filter(string_split(regexp_replace(lower(tr), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') cw from k)
select label, n as normalised, c as cleaned, lk as link_key, coalesce(map_extract_value({_MAP(V.MATCH_ALIASES)}, lk), lk) as match_label,
  coalesce(map_extract_value({_MAP(V.LABEL_ALIASES)}, mk), case when lower(c) = c then array_to_string(list_transform(string_split(c, ' '), lambda w: case when upper(w) in ({", ".join(map(_Q, V.ACRONYMS))}) then upper(w) else {_CAP("w")} end), ' ') else c end) as canonical,
  case when sa = '' then 'Resource' else sa end as sanitised, coalesce(cw[1], '') || array_to_string(list_transform(cw[2:], lambda w: {_CAP("w")}), '') as camel, cast(greatest(1, floor(len(list_filter(string_split_regex(label, '{_WS}'), lambda w: w <> '')) * 1.3)) as integer) as tokens,
  substr(sha256(label), 1, 16) as sha, substr(md5(label), 1, 16) as md5, list_min(list_filter(list_transform(string_split_regex(lower(label), '[;,]'), lambda x: trim(x)), lambda x: x <> '')) as single,
  replace(replace(replace(replace(url_encode(regexp_replace(tr, '{_WS}', '_', 'g')), '%3A', ':'), '%40', '@'), '%2F', '/'), '%2A', '*') as safe, {_NODE("label")} as node from m""",
    "identifier_keys": f"""with {BASE}, d as (select *, nullif({_T("doc_id")}, '') did, nullif(lower({_T("section")}), '') sec from rel)
select uri, 'rel_' || substr(sha256(concat_ws('|', coalesce(did, 'None'), source, relation, target)), 1, 16) as made, {_LOCAL("source")} as source_name, {_KIND} as target_kind, case when sec is not null and did is not null then sec || '|' || did else did end as origin, coalesce(evidence, 'none')[1:40] as evidence,
  {_IRI.format(c="source")} as iri, {_NODE("target")} as node, '{V.KG}' || relation as expanded, greatest(0.0, least(1.0, cast(confidence as double) * 3 - 1)) as clamped from d""",
    "document_urls": f"""with {_URL} select doc_id, n as normal, case when regexp_extract({_T("url")}, '(?i)(?:^|/|:)(q\\d+)$', 1) <> '' then 'wikidata:' || upper(regexp_extract({_T("url")}, '(?i)(?:^|/|:)(q\\d+)$', 1)) when regexp_extract(lower({_T("url")}), '(?:^doi:\\s*|doi\\.org/|^)(10\\..+)$', 1) <> '' then 'doi:' || regexp_extract(lower({_T("url")}), '(?:^doi:\\s*|doi\\.org/|^)(10\\..+)$', 1)
  when regexp_matches({_T("url")}, '(?i)^https?://') then nullif(n, '') else nullif(lower({_T("url")}), '') end as external from u4""",
    "value_coercions": f"""with v as (select distinct value from (select vote_value as value from votes union all select expert_id from votes union all select cast(created_at as varchar) from votes) where value is not null)
select value, {_INT} as number, case when {_INT} >= 0 then {_INT} end as natural, case when lower({_T("value")}) in ('true', '1', 'yes', 'y') then true when lower({_T("value")}) in ('false', '0', 'no', 'n') then false end as truth, map_extract_value({_MAP(V.RATINGS)}, regexp_replace(lower({_T("value")}), '[^a-z0-9]', '', 'g')) as rating,
  nullif(try_cast(nullif(regexp_extract({_T("value")}, '^([+-]?\\d+)(?:\\.0*)?$', 1), '') as bigint), 0) as reference, regexp_matches({_T("value")}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}(:\\d{{2}}(\\.\\d+)?)?(Z|[+-]\\d{{2}}:?\\d{{2}})?)?$') as iso from v""",
}
