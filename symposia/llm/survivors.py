"""Best representative of each duplicate group (problem 7).

Relations that state the same thing (source, target, predicate key) are one group. Fields are unpivoted into long
rows (group, field, value); each row votes with the trust of its source times a decay by age, votes are summed per
value, the winner of a field is taken by ``max_by``, and the winners are pivoted back into one row per group. The
survivor itself is the row of highest valid confidence, asserted before inferred, then of smallest uri; its filled
fields stay, its empty ones take the group's winners.

Groups of one uri are found by an aggregate of hashes (16 bytes a group) and take no further part. Every later step is
a partial aggregate on (group, field, value), so a group holding a third of all rows is combined on the map side and
never gathered; what is gathered of a group are its fields, one row each.

Defined results: null or empty source, target, predicate or uri leave a row out; null, NaN and out-of-range
confidences are equal and last; a null ``is_inferred`` is asserted; a uri delivered again is one record whose best
row counts and whose filled fields are all kept; equal votes fall to the greatest value by code points; repeated
rows change only votes, not who survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.runtime import cut, lookup, read

#: Trust by extractor named in metadata; anything else counts as UNKNOWN_TRUST.
TRUST = {"manual": 1.0, "llm": 0.8, "vote": 0.7, "reasoner": 0.5, "lightweight": 0.4}
UNKNOWN_TRUST = 0.3
HALF_LIFE_DAYS = 365.0
#: Ages are counted back from this fixed instant, so that a result does not depend on the day it is computed.
AGE_ORIGIN = "2025-01-01"
#: Votes are whole numbers of this fraction, so that their sums do not depend on the order of adding.
VOTE_SCALE = 1e6
#: Prefix of the fields that are keys of metadata.
META = "metadata."


def valid_confidence(c: Column) -> Column:
    """Confidence to three decimals, or null for null, NaN and values outside 0 to 1."""
    return F.when(c.isNotNull() & ~F.isnan(c) & (c >= 0) & (c <= 1), F.round(c, 3))


def keyed(relations: DataFrame) -> DataFrame:
    trim = lambda name: F.regexp_replace(F.col(name), r"^\s+|\s+$", "")
    rows = relations.withColumns(
        {"_s": trim("source"), "_t": trim("target"), "_k": F.regexp_replace(F.lower("relation"), "[^a-z]", "")}
    )
    return rows.where("_s <> '' and _t <> '' and _k <> '' and trim(uri) <> ''")


def survivors(relations: DataFrame) -> DataFrame:
    """(source, target, relation_key, survivor_uri, rivals, relation, <filled fields>, metadata), one row per group of two uris or more."""
    rows = keyed(relations)
    # a group travels as 128 bits; its texts are joined on at the end
    group = ["g1", "g2"]
    rows = rows.withColumns({"g1": F.xxhash64("_s", "_t", "_k"), "g2": F.xxhash64(F.lit(2), "_k", "_t", "_s"), "_u": F.xxhash64("uri")})
    # only groups of two uris or more have anything to decide: nothing else is moved
    rivals = cut(rows.groupBy(*group).agg(F.min("_u").alias("a"), F.max("_u").alias("b")).where("a < b").select(*group))
    rows = lookup(rows.drop("_u"), rivals, group, "inner")
    trust = F.lit(UNKNOWN_TRUST)
    for name, weight in TRUST.items():
        trust = F.when(F.lower(F.trim(F.col("metadata")["extractor"])) == name, F.lit(weight)).otherwise(trust)
    days = F.greatest(F.lit(0.0), F.datediff(F.lit(AGE_ORIGIN).cast("date"), F.col("extracted_at").cast("date")).cast("double"))
    vote = F.round(trust * F.pow(F.lit(0.5), F.coalesce(days, F.lit(10 * HALF_LIFE_DAYS)) / HALF_LIFE_DAYS) * VOTE_SCALE).cast("bigint")
    confidence = valid_confidence(F.col("confidence"))
    rank = F.struct(
        (-F.coalesce(confidence, F.lit(-1.0))).alias("c"), F.coalesce(F.col("is_inferred"), F.lit(False)).cast("int").alias("i"), F.col("uri").alias("u")
    )
    texts = {
        "relation": F.col("relation"),
        "ontology_uri": F.nullif(F.trim("ontology_uri"), F.lit("")),
        "context": F.when(F.trim("context") != "", F.col("context")),
        "doc_id": F.nullif(F.trim("doc_id"), F.lit("")),
        "extracted_at": F.col("extracted_at").cast("string"),
        "confidence": confidence.cast("string"),
        "is_inferred": F.col("is_inferred").cast("string"),
    }
    # unpivot: one row per filled field, every key of metadata being a field of its own
    own = F.array(F.struct(F.lit("uri").alias("field"), F.col("uri").alias("value")), *[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in texts.items()])
    more = F.transform(F.map_entries(F.coalesce("metadata", F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.concat(F.lit(META), e["key"]).alias("field"), F.when(F.trim(e["value"]) != "", e["value"]).alias("value")))
    # a uri delivered again is one record first: it stands where its best row stands, and has the value of its best row that has one
    standing = rows.groupBy(*group, "uri").agg(F.min(rank).alias("standing"))
    long = rows.join(standing, [*group, "uri"]).select(*group, "uri", "standing", rank.alias("rank"), vote.alias("vote"), F.explode(F.concat(own, more)).alias("f")).select(*group, "uri", "standing", "rank", "vote", "f.*").where("value is not null")
    records = long.groupBy(*group, "uri", "field").agg(F.min(F.struct("rank", "value"))["value"].alias("value"), F.max("vote").alias("vote"), F.min("standing").alias("rank"))
    # one row per value: its votes, the best rank it was seen with
    values = records.groupBy(*group, "field", "value").agg(F.sum("vote").alias("votes"), F.min("rank").alias("rank"), F.count(F.lit(1)).alias("uris"))
    fields = values.groupBy(*group, "field").agg(F.count(F.lit(1)).alias("n"), F.max_by("value", F.struct("votes", "value")).alias("winner"), F.min("rank").alias("best"), F.min_by("value", F.struct("rank", "value")).alias("of_best"))
    fields = fields.select(*group, "field", "n", "winner", F.col("best.u").alias("by"), "of_best")
    packed = F.struct("n", "winner", "by", "of_best")
    extra = F.when(F.startswith("field", F.lit(META)), F.struct(F.substring("field", len(META) + 1, 1 << 20).alias("key"), packed.alias("v")))
    wide = fields.groupBy(*group).agg(*[F.max(F.when(F.col("field") == name, packed)).alias(name) for name in ("uri", *texts)], F.array_sort(F.collect_list(extra)).alias("more"))
    survivor = F.col("uri")["by"]
    # a field stays the survivor's own where the survivor filled it, else it takes the group's winner
    kept = lambda v: F.when(v["by"] == survivor, v["of_best"]).otherwise(v["winner"])
    out = wide.select(*group, survivor.alias("survivor_uri"), F.col("uri")["n"].alias("rivals"), *[kept(F.col(name)).alias(name) for name in texts], F.map_from_entries(F.transform("more", lambda x: F.struct(x["key"].alias("key"), kept(x["v"]).alias("value")))).alias("metadata"))
    names = rows.groupBy(*group).agg(F.min("_s").alias("source"), F.min("_t").alias("target"), F.min("_k").alias("relation_key"))
    out = out.join(names, group).select("source", "target", "relation_key", "survivor_uri", "rivals", *texts, "metadata")
    return out.withColumns(
        {"confidence": F.col("confidence").try_cast("double"), "is_inferred": F.coalesce(F.col("is_inferred").try_cast("boolean"), F.lit(False)), "extracted_at": F.col("extracted_at").try_cast("timestamp_ntz")}
    )


def p7_found(spark: SparkSession, base: str) -> DataFrame:
    return survivors(read(spark, base, "relations")).select("source", "target", "relation_key", "survivor_uri")


def p7_survivors(spark: SparkSession, base: str) -> DataFrame:
    """The surviving relations with their filled fields; metadata as sorted ``key=value`` lines."""
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("metadata")), lambda e: F.concat_ws("=", e["key"], e["value"])), "\n")
    return survivors(read(spark, base, "relations")).withColumn("metadata", lines)


_TRUST = "case lower(trim(map_extract_value(metadata, 'extractor'))) " + " ".join(f"when '{k}' then {v}" for k, v in TRUST.items()) + f" else {UNKNOWN_TRUST} end"
_VOTES = f"""
with r as (select *, regexp_replace(source, '^\\s+|\\s+$', '', 'g') s, regexp_replace(target, '^\\s+|\\s+$', '', 'g') t, regexp_replace(lower(relation), '[^a-z]', '', 'g') k,
    case when confidence is null or isnan(confidence) or confidence < 0 or confidence > 1 then null else round(confidence, 3) end c from relations),
g as (select s, t, k from r where s <> '' and t <> '' and k <> '' and trim(uri) <> '' group by 1, 2, 3 having count(distinct uri) > 1),
b as (select r.*, struct_pack(c := -coalesce(c, -1.0), i := coalesce(is_inferred, false)::int, u := uri) rk,
    cast(round({_TRUST} * pow(0.5, coalesce(greatest(0.0, date_diff('day', cast(extracted_at as date), date '{AGE_ORIGIN}')), {10 * HALF_LIFE_DAYS}) / {HALF_LIFE_DAYS}) * {VOTE_SCALE}) as bigint) vote
    from r join g using (s, t, k) where trim(uri) <> ''),
e as (select s, t, k, uri, rk, vote, unnest(list_concat([struct_pack(f := 'uri', v := uri), struct_pack(f := 'relation', v := relation), struct_pack(f := 'ontology_uri', v := nullif(trim(ontology_uri), '')), struct_pack(f := 'context', v := case when trim(context) <> '' then context end),
    struct_pack(f := 'doc_id', v := nullif(trim(doc_id), '')), struct_pack(f := 'extracted_at', v := cast(extracted_at as varchar)), struct_pack(f := 'confidence', v := cast(c as varchar)), struct_pack(f := 'is_inferred', v := cast(is_inferred as varchar))],
    coalesce(list_transform(map_entries(metadata), lambda x: struct_pack(f := 'metadata.' || x.key, v := case when trim(x.value) <> '' then x.value end)), []))) x from b),
st as (select s, t, k, uri, min(rk) best from b group by all),
o as (select s, t, k, uri, x.f f, min(struct_pack(r := rk, v := x.v)) m, max(vote) vote from e where x.v is not null group by all),
v as (select s, t, k, f, m.v v, sum(vote) votes, min(best) rk from o join st using (s, t, k, uri) group by all),
w as (select s, t, k, f, count(*) n, arg_max(v, struct_pack(a := votes, b := v)) winner, arg_min(v, struct_pack(a := rk, b := v)) own, min(rk).u who from v group by all),
z as (select s, t, k, max(who) filter (f = 'uri') su, max(n) filter (f = 'uri') rivals from w group by all),
y as (select w.s, w.t, w.k, z.su, z.rivals, f, case when who = z.su then own else winner end val from w join z using (s, t, k))
select s as source, t as target, k as relation_key, su as survivor_uri, rivals, {", ".join(f"max(val) filter (f = '{x}') as {x}" for x in ("relation", "ontology_uri", "context", "doc_id"))},
    cast(max(val) filter (f = 'extracted_at') as timestamp) as extracted_at, cast(max(val) filter (f = 'confidence') as double) as confidence, coalesce(cast(max(val) filter (f = 'is_inferred') as boolean), false) as is_inferred,
    coalesce(string_agg(substr(f, 10) || '=' || val, chr(10) order by f) filter (starts_with(f, 'metadata.')), '') as metadata from y group by all"""
ORACLE = {
    "p7_survivors": _VOTES,
    "p7_found": """
with r as (select regexp_replace(source, '^\\s+|\\s+$', '', 'g') source, regexp_replace(target, '^\\s+|\\s+$', '', 'g') target,
    regexp_replace(lower(relation), '[^a-z]', '', 'g') relation_key, uri,
    case when confidence is null or isnan(confidence) or confidence < 0 or confidence > 1 then -1 else round(confidence, 3) end c,
    coalesce(is_inferred, false) i from relations),
k as (select *, row_number() over (partition by source, target, relation_key order by c desc, i, uri) rn from r where source <> '' and target <> '' and relation_key <> '' and trim(uri) <> '')
select source, target, relation_key, max(case when rn = 1 then uri end) survivor_uri from k group by 1, 2, 3 having count(distinct uri) > 1
""",
}
