"""References to records that do not exist (problem 6).

References and parent keys are hash-partitioned and sorted alike and merged in one linear pass (the sort-merge
join of Spark, asked for by hint). A parent is described by the interval in which it was valid: loaded at
``valid_from``, gone at ``valid_to``. Hot parents, such as an expert who casts a third of the votes, are salted on
both sides by as many salts as their rows need, so that no merge task grows with the key.

Defined results: null, blank, non-numeric and zero references are no reference; spellings of the same whole number
are the same reference; a key with no row is ``deleted`` when a deletion is on record and ``missing`` otherwise; a
parent marked deleted is ``deleted`` even if it also came late; a child or parent without load time is never
``late``; repeated rows give one case each; an empty table gives no case, and an empty parent table makes every
reference missing or deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions.columns import reference
from symposia.runtime import ROWS_PER_TASK, read, salted


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str


REFERENCES = (
    Reference("questions", "theme_id", "themes"),
    Reference("answers", "question_id", "questions"),
    Reference("votes", "expert_id", "experts"),
)


def parent_intervals(spark: SparkSession, base: str, tables: list[str]) -> DataFrame:
    """(parent, key, valid_from, valid_to), one row per key that has a row or a deletion.

    A key without a row has no ``valid_from`` flag (``here`` is 0); its validity ended where a deletion is on record. A row
    that is marked deleted has ended, too; a deletion on record beside an unmarked row has not ended it."""
    always = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    side = lambda rows, parent, key, here, start, end, gone: rows.select(parent.alias("parent"), key.cast("bigint").alias("key"), F.lit(here).alias("here"), start.cast("timestamp_ntz").alias("valid_from"), end.cast("timestamp_ntz").alias("row_end"), gone.cast("timestamp_ntz").alias("gone"))
    none = F.lit(None)
    deletions = side(read(spark, base, "deletions"), F.lower(F.trim("table_name")), F.col("record_id"), 0, none, none, F.coalesce(F.col("deleted_at").cast("timestamp_ntz"), always))
    rows = deletions.where(F.col("parent").isin(tables))
    for name in tables:
        table = read(spark, base, name)
        end = F.when(F.col("is_deleted"), always) if "is_deleted" in table.columns else none
        rows = rows.unionByName(side(table, F.lit(name), F.col("id"), 1, F.col("ingested_at"), end, none))
    ends = rows.where("key is not null").groupBy("parent", "key").agg(F.max("here").alias("here"), F.min("valid_from").alias("valid_from"), F.min("row_end").alias("row_end"), F.min("gone").alias("gone"))
    return ends.select("parent", "key", "here", "valid_from", F.when(F.col("here") == 1, F.col("row_end")).otherwise(F.col("gone")).alias("valid_to"))


def references(spark: SparkSession, base: str, refs: tuple[Reference, ...] = REFERENCES) -> DataFrame:
    """(child_table, child_id, parent, key, seen_at, month) of every row that holds a reference."""
    out = None
    for ref in refs:
        rows = read(spark, base, ref.child)
        own = F.col("id").cast("string")
        if ref.child == "votes":
            own = F.coalesce(own, F.concat_ws("_", reference(F.col("expert_id")).cast("string"), F.col("answer_id").cast("string")))
        side = rows.select(
            F.lit(ref.child).alias("child_table"),
            own.alias("child_id"),
            F.lit(ref.parent).alias("parent"),
            reference(F.col(ref.column)).alias("key"),
            F.col("ingested_at").cast("timestamp_ntz").alias("seen_at"),
            F.date_format("created_at", "yyyy-MM").alias("month"),
        ).where("key is not null")
        out = side if out is None else out.unionByName(side)
    return out


def classify(refs: DataFrame, parents: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Merge references with parent intervals; returns ``refs`` plus ``status`` (null when the reference is sound)."""
    left, right = salted(refs, parents, ["parent", "key"], rows_per_task)
    merged = left.join(right.hint("merge"), ["parent", "key", "_salt"], "left")
    status = F.when(F.col("valid_to").isNotNull(), "deleted").when(F.col("here").isNull() | (F.col("here") == 0), "missing").when(F.col("valid_from") > F.col("seen_at"), "late")
    return merged.select("child_table", "child_id", "parent", "key", "seen_at", "month", status.alias("status"))


def orphans(spark: SparkSession, base: str) -> DataFrame:
    refs = references(spark, base)
    parents = parent_intervals(spark, base, sorted({r.parent for r in REFERENCES}))
    return classify(refs, parents).where("status is not null")


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    return orphans(spark, base).select("child_table", "child_id", "status").distinct()


def p6_report(spark: SparkSession, base: str) -> DataFrame:
    """Cases per child table, month of ``created_at`` (null where unknown) and status."""
    cases = orphans(spark, base).select("child_table", "child_id", "month", "status").distinct()
    return cases.groupBy("child_table", "month", "status").agg(F.count(F.lit(1)).alias("n"))


_KEY = r"nullif(try_cast(nullif(regexp_extract(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '^([+-]?\d+)(\.0*)?$', 1), '') as bigint), 0)"
_CASES = f"""
with refs as (
  select 'questions' child_table, cast(id as varchar) child_id, 'themes' parent, {_KEY.format(c="theme_id")} k, ingested_at, strftime(created_at, '%Y-%m') as month from questions
  union all select 'answers', cast(id as varchar), 'questions', nullif(question_id, 0), ingested_at, strftime(created_at, '%Y-%m') from answers
  union all select 'votes', coalesce(cast(id as varchar), concat_ws('_', cast({_KEY.format(c="expert_id")} as varchar), cast(answer_id as varchar))), 'experts', {_KEY.format(c="expert_id")}, ingested_at, strftime(created_at, '%Y-%m') from votes),
parents as (
  select 'themes' parent, id, false marked, ingested_at from themes
  union all select 'questions', id, false, ingested_at from questions
  union all select 'experts', id, coalesce(is_deleted, false), ingested_at from experts),
cases as (
  select r.child_table, r.child_id, r.month,
    case when p.id is not null and p.marked then 'deleted'
         when p.id is null and exists (select 1 from deletions d where d.table_name = r.parent and d.record_id = r.k) then 'deleted'
         when p.id is null then 'missing'
         when p.ingested_at > r.ingested_at then 'late' end status
  from refs r left join parents p on p.parent = r.parent and p.id = r.k where r.k is not null)
"""
QUERIES = {"p6_found": p6_found, "p6_report": p6_report}
ORACLE = {
    "p6_found": _CASES + "select distinct child_table, child_id, status from cases where status is not null",
    "p6_report": _CASES + "select child_table, month, status, count(*) as n from (select distinct child_table, child_id, month, status from cases where status is not null) group by 1, 2, 3",
}
