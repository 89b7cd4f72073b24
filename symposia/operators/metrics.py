"""Quality metrics of the graph: counts, coverage, alignment and the composite score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.predicates import BASE, base_relations
from symposia.operators.resolve import _REG, registry
from symposia.rules import vocabulary as V
from symposia.runtime import read


def mean_thousandths(column: str):
    """Mean to three decimals of values with three decimals, halves up: summed as whole thousandths, so no order of adding shows."""
    whole = F.sum(F.round(F.col(column) * 1000).cast("bigint"))
    return F.floor((2 * whole + F.count(column)) / (2 * F.count(column))).cast("bigint") / 1000


#: Metadata fields that tie an entity to a knowledge base.
LINKS = ("wikidata_uri", "wikidata_id", "qid", "wikidata", "wikidata_match", "external_id")


def entity_metrics(spark: SparkSession, base: str) -> DataFrame:
    rows = registry(spark, base)
    return rows.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"), mean_thousandths("confidence").alias("confidence"), F.count_if(F.col("ontology_uri").isNotNull()).alias("aligned"), F.sum("mentions").alias("mentions"))


def relation_metrics(spark: SparkSession, base: str) -> DataFrame:
    rows = base_relations(spark, base)
    return rows.groupBy("relation").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_inferred")).alias("inferred"), F.count_if(F.col("relation").isin(*V.RELATION_PROPERTIES)).alias("aligned"))


def quality_metrics(spark: SparkSession, base: str) -> DataFrame:
    """One row: totals, rates to three decimals and the score from 0 to 10 built from them.

    An entity is linked when its metadata ties it to a knowledge base. A record is a question, an answer or a document; it is covered when an entity (or a relation's document) names its id."""
    entities, relations = registry(spark, base), base_relations(spark, base)
    e = entities.agg(F.count(F.lit(1)).alias("entities"), mean_thousandths("confidence").alias("confidence"), F.round(F.avg(F.col("ontology_uri").isNotNull().cast("int")), 3).alias("entity_alignment"), F.count(F.lit(1)).alias("_n"))
    tied = read(spark, base, "entities").where("uri is not null").where(F.exists(F.array(*[F.lit(k) for k in LINKS]), lambda k: F.coalesce(C.strip(F.try_element_at("metadata", k)) != "", F.lit(False)))).agg(F.countDistinct("uri").alias("_tied"))
    e = e.join(tied, how="inner", on=F.lit(True)).withColumn("linking", F.coalesce(F.round(F.col("_tied") / F.nullif("_n", F.lit(0)), 3), F.lit(0.0))).drop("_n", "_tied")
    r = relations.agg(F.count(F.lit(1)).alias("relations"), F.count_if("is_inferred").alias("inferred"), F.round(F.avg(F.col("relation").isin(*V.RELATION_PROPERTIES).cast("int")), 3).alias("relation_alignment"))
    records = read(spark, base, "answers").select(F.col("id").cast("string").alias("id")).unionByName(read(spark, base, "questions").select(F.col("id").cast("string").alias("id"))).unionByName(read(spark, base, "documents").select(F.col("doc_id").cast("string").alias("id"))).distinct()
    by_entity = read(spark, base, "entities").select(C.blank_to_null(F.col("doc_id")).alias("id"), F.lit(1).alias("e")).where("id is not null").distinct()
    by_relation = read(spark, base, "relations").select(C.blank_to_null(F.col("doc_id")).alias("id"), F.lit(1).alias("r")).where("id is not null").distinct()
    c = records.join(by_entity, "id", "left").join(by_relation, "id", "left").agg(F.count(F.lit(1)).alias("records"), F.round(F.avg(F.coalesce("e", F.lit(0))), 3).alias("entity_coverage"), F.round(F.avg(F.coalesce("r", F.lit(0))), 3).alias("relation_coverage"))
    one = e.join(r, how="inner", on=F.lit(True)).join(c, how="inner", on=F.lit(True))
    score = 10 * (0.27 * F.col("confidence") + 0.18 * F.col("linking") + 0.23 * F.col("entity_coverage") + 0.23 * F.col("relation_coverage") + 0.09 * (F.col("entity_alignment") + F.col("relation_alignment")) / 2)
    return one.withColumn("score", F.round(score, 2))


QUERIES = {"entity_metrics": entity_metrics, "relation_metrics": relation_metrics, "quality_metrics": quality_metrics}
_AL = ", ".join(f"'{p}'" for p in V.RELATION_PROPERTIES)
_MEAN = "floor((2 * sum(cast(round(cast(confidence as double) * 1000) as bigint)) + count(*)) / (2 * count(*))) / 1000"
_TIED = " or ".join(f"coalesce(regexp_replace(map_extract_value(metadata, '{k}'), '^\\s+|\\s+$', '', 'g'), '') <> ''" for k in LINKS)
ORACLE = {
    "entity_metrics": f"with {_REG} select entity_type, count(*) as n, {_MEAN} as confidence, count(ontology_uri) as aligned, cast(sum(mentions) as bigint) as mentions from reg group by 1",
    "relation_metrics": f"with {BASE} select relation, count(*) as n, count(*) filter (is_inferred) as inferred, count(*) filter (relation in ({_AL})) as aligned from rel group by 1",
    "quality_metrics": f"""with {BASE}, {_REG},
e as (select count(*) entities, {_MEAN} confidence, round(avg(case when ontology_uri is null then 0.0 else 1.0 end), 3) entity_alignment, round((select count(distinct uri) from entities where uri is not null and ({_TIED})) / count(*), 3) linking from reg),
r as (select count(*) relations, count(*) filter (is_inferred) inferred, round(avg(case when relation in ({_AL}) then 1.0 else 0.0 end), 3) relation_alignment from rel),
x as (select distinct id from (select cast(id as varchar) id from answers union all select cast(id as varchar) from questions union all select cast(doc_id as varchar) from documents)),
c as (select count(*) records, round(avg(case when exists (select 1 from entities t where trim(t.doc_id) = x.id) then 1.0 else 0.0 end), 3) entity_coverage, round(avg(case when exists (select 1 from relations t where trim(t.doc_id) = x.id) then 1.0 else 0.0 end), 3) relation_coverage from x)
select *, round(10 * (0.27 * confidence + 0.18 * linking + 0.23 * entity_coverage + 0.23 * relation_coverage + 0.09 * (entity_alignment + relation_alignment) / 2), 2) as score from e, r, c""",
}
