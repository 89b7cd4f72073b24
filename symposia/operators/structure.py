"""Nodes and edges that the records themselves state: questions to themes, answers to questions and experts, votes.

Edges are projections of the tables (no join); a reference that spells no whole number gives no edge. Repeated
deliveries of a vote are one vote, whose last delivery counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.rules import vocabulary as V
from symposia.runtime import read


def node(kind: str, key: Column, base: str = V.KG) -> Column:
    return F.concat(F.lit(f"{base}{kind}_"), key.cast("string"))


def latest_votes(spark: SparkSession, base: str) -> DataFrame:
    """(vote_key, expert, answer_id, value, created_at), one row per vote."""
    votes = read(spark, base, "votes")
    expert = C.reference(F.col("expert_id"))
    key = F.coalesce(F.col("id").cast("string"), F.concat_ws("_", expert.cast("string"), F.col("answer_id").cast("string")))
    last = F.struct(F.coalesce("updated_at", "created_at").alias("t"), F.col("ingested_at").alias("i"), F.lower(C.strip(F.col("vote_value"))).alias("v"))
    body = F.struct(expert.alias("expert"), "answer_id", F.lower(C.strip(F.col("vote_value"))).alias("value"), "created_at")
    return votes.select(key.alias("vote_key"), last.alias("last"), body.alias("body")).groupBy("vote_key").agg(F.max_by("body", "last").alias("body")).select("vote_key", "body.*")


def structural_edges(spark: SparkSession, base: str, kg: str = V.KG) -> DataFrame:
    """(source, predicate, target, confidence) of the backbone."""
    questions, answers, votes = read(spark, base, "questions"), read(spark, base, "answers"), latest_votes(spark, base)
    edge = lambda df, s, p, t, c: df.select(s.alias("source"), (F.lit(p) if isinstance(p, str) else p).alias("predicate"), t.alias("target"), F.lit(c).alias("confidence"))
    theme, question = C.reference(F.col("theme_id")), F.nullif(F.col("question_id"), F.lit(0).cast("bigint"))
    vote = node("vote", F.col("vote_key"), kg)
    able = votes.where("expert is not null and coalesce(answer_id, 0) <> 0")
    parts = [
        edge(questions.where(theme.isNotNull()), node("question", F.col("id"), kg), "belongsToTheme", node("theme", theme, kg), V.CONFIDENCE["belongsToTheme"]),
        edge(answers.where(question.isNotNull()), node("answer", F.col("id"), kg), "answersQuestion", node("question", question, kg), V.CONFIDENCE["answersQuestion"]),
        edge(answers.where("coalesce(expert_id, 0) <> 0"), node("answer", F.col("id"), kg), "authoredBy", node("expert", F.col("expert_id"), kg), V.CONFIDENCE["authoredBy"]),
        edge(answers.where("coalesce(parent_id, 0) <> 0"), node("answer", F.col("id"), kg), "repliesTo", node("answer", F.col("parent_id"), kg), V.CONFIDENCE["answersQuestion"]),
        edge(able, node("expert", F.col("expert"), kg), C.vote_bucket(F.col("value")), node("answer", F.col("answer_id"), kg), V.CONFIDENCE["vote"]),
        edge(able, vote, "castBy", node("expert", F.col("expert"), kg), V.CONFIDENCE["castBy"]),
        edge(able, vote, "receivesVote", node("answer", F.col("answer_id"), kg), V.CONFIDENCE["receivesVote"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def structural_nodes(spark: SparkSession, base: str, kg: str = V.KG) -> DataFrame:
    """(uri, entity_type, present) of every record and of every record referred to; present tells whether it has a row."""
    own = None
    for table, kind in (("themes", "Theme"), ("questions", "Question"), ("answers", "Answer"), ("experts", "Expert")):
        part = read(spark, base, table).select(node(kind.lower(), F.col("id"), kg).alias("uri"), F.lit(kind).alias("entity_type"), F.lit(True).alias("present"))
        own = part if own is None else own.unionByName(part)
    targets = structural_edges(spark, base, kg).where("predicate in ('belongsToTheme', 'answersQuestion', 'authoredBy', 'castBy', 'receivesVote')").select(
        F.col("target").alias("uri"), C.type_from_uri(F.col("target")).alias("entity_type"), F.lit(False).alias("present")
    )
    return own.unionByName(targets).groupBy("uri", "entity_type").agg(F.max("present").alias("present"))


def edge_counts(spark: SparkSession, base: str) -> DataFrame:
    edges = structural_edges(spark, base)
    return edges.groupBy("predicate").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("target").alias("targets"), F.round(F.avg("confidence"), 3).alias("confidence"))


def vote_buckets(spark: SparkSession, base: str) -> DataFrame:
    votes = latest_votes(spark, base)
    return votes.groupBy(C.vote_bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("expert").alias("experts"))


def question_kinds(spark: SparkSession, base: str) -> DataFrame:
    return read(spark, base, "questions").select("id", C.question_kind(F.coalesce("body", "title")).alias("kind"))


def node_counts(spark: SparkSession, base: str) -> DataFrame:
    return structural_nodes(spark, base).groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("present")).alias("present"))


QUERIES = {"structural_edges": structural_edges, "edge_counts": edge_counts, "vote_buckets": vote_buckets, "question_kinds": question_kinds, "node_counts": node_counts}

REF = r"nullif(try_cast(nullif(regexp_extract(regexp_replace(cast({c} as varchar), '^\s+|\s+$', '', 'g'), '^([+-]?\d+)(\.0*)?$', 1), '') as bigint), 0)"
_IN = lambda xs: ", ".join(f"'{x}'" for x in xs)
BUCKET = f"case when value in ({_IN(V.POSITIVE_VOTES)}) then 'endorses' when value in ({_IN(V.NEGATIVE_VOTES)}) then 'disagreesWith' when value in ({_IN(V.NEUTRAL_VOTES)}) then 'isNeutralOn' else 'interactsWith' end"
LATEST = f"""
votes_k as (select coalesce(cast(id as varchar), concat_ws('_', cast({REF.format(c="expert_id")} as varchar), cast(answer_id as varchar))) vote_key, {REF.format(c="expert_id")} expert, answer_id,
    lower(regexp_replace(vote_value, '^\\s+|\\s+$', '', 'g')) as value, created_at, coalesce(updated_at, created_at) t, ingested_at i from votes),
latest as (select vote_key, expert, answer_id, value, created_at from (select *, row_number() over (partition by vote_key order by t desc nulls last, i desc nulls last, value desc nulls last) rn from votes_k) where rn = 1)"""
_K = V.KG
EDGES = f"""
able as (select * from latest where expert is not null and coalesce(answer_id, 0) <> 0),
edges as (
  select '{_K}question_' || id source, 'belongsToTheme' predicate, '{_K}theme_' || {REF.format(c="theme_id")} target, 0.98 confidence from questions where {REF.format(c="theme_id")} is not null
  union all select '{_K}answer_' || id, 'answersQuestion', '{_K}question_' || question_id, 0.98 from answers where coalesce(question_id, 0) <> 0
  union all select '{_K}answer_' || id, 'authoredBy', '{_K}expert_' || expert_id, 0.96 from answers where coalesce(expert_id, 0) <> 0
  union all select '{_K}answer_' || id, 'repliesTo', '{_K}answer_' || parent_id, 0.98 from answers where coalesce(parent_id, 0) <> 0
  union all select '{_K}expert_' || expert, {BUCKET}, '{_K}answer_' || answer_id, 0.90 from able
  union all select '{_K}vote_' || vote_key, 'castBy', '{_K}expert_' || expert, 0.99 from able
  union all select '{_K}vote_' || vote_key, 'receivesVote', '{_K}answer_' || answer_id, 0.99 from able)"""
_HAS = lambda words, c: " or ".join(f"contains({c}, '{w}')" for w in words)
ORACLE = {
    "structural_edges": f"with {LATEST}, {EDGES} select source, predicate, target, cast(confidence as double) as confidence from edges",
    "edge_counts": f"with {LATEST}, {EDGES} select predicate, count(*) as n, count(distinct target) as targets, round(avg(cast(confidence as double)), 3) as confidence from edges group by 1",
    "vote_buckets": f"with {LATEST} select {BUCKET} as bucket, count(*) as n, count(distinct expert) as experts from latest group by 1",
    "question_kinds": "select id, case " + " ".join(f"when {_HAS(words, 't')} then '{kind}'" for kind, words in V.QUESTION_KINDS) + " else 'general' end as kind from (select id, lower(coalesce(body, title, '')) t from questions)",
    "node_counts": f"""with {LATEST}, {EDGES}, n as (
  select '{_K}theme_' || id uri, 'Theme' entity_type, true p from themes union all select '{_K}question_' || id, 'Question', true from questions
  union all select '{_K}answer_' || id, 'Answer', true from answers union all select '{_K}expert_' || id, 'Expert', true from experts
  union all select target, case when predicate = 'belongsToTheme' then 'Theme' when predicate = 'answersQuestion' then 'Question' when predicate = 'receivesVote' then 'Answer' else 'Expert' end, false
    from edges where predicate in ('belongsToTheme', 'answersQuestion', 'authoredBy', 'castBy', 'receivesVote')),
  g as (select uri, entity_type, bool_or(p) p from n group by 1, 2)
  select entity_type, count(*) as n, count(*) filter (p) as present from g group by 1""",
}
