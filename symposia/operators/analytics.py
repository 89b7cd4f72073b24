"""Discourse analytics: response times, trends, dispersion of votes, agreement of expertise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.structure import LATEST, REF, latest_votes
from symposia.rules import vocabulary as V
from symposia.runtime import read


def hours(start: str, end: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end})") / F.lit(3.6e9)


def _pairs(spark: SparkSession, base: str) -> DataFrame:
    """(question, theme, expert, hours) of every answer to a question, both dated."""
    questions = read(spark, base, "questions").select(F.col("id").alias("question"), C.reference(F.col("theme_id")).alias("theme"), F.col("created_at").alias("asked"))
    answers = read(spark, base, "answers").select(F.col("question_id").alias("question"), F.col("expert_id").alias("expert"), F.col("created_at").alias("answered"))
    both = answers.where("question is not null and answered is not null").join(questions.where("asked is not null"), "question")
    return both.select("question", "theme", "expert", hours("asked", "answered").alias("hours"))


def response_time_by_theme(spark: SparkSession, base: str) -> DataFrame:
    """Mean over questions of each question's mean response time, per theme."""
    means = _pairs(spark, base).groupBy("theme", "question").agg(F.avg("hours").alias("h"), F.count(F.lit(1)).alias("k"))
    return means.groupBy("theme").agg(F.round(F.avg("h"), 2).alias("hours"), F.count(F.lit(1)).alias("questions"), F.sum("k").alias("answers"))


def response_time_by_expert(spark: SparkSession, base: str) -> DataFrame:
    rows = _pairs(spark, base).where("expert is not null")
    return rows.groupBy("expert").agg(F.round(F.avg("hours"), 2).alias("hours"), F.count(F.lit(1)).alias("answers"))


def unanswered_questions(spark: SparkSession, base: str) -> DataFrame:
    answered = read(spark, base, "answers").select(F.col("question_id").alias("id"))
    return read(spark, base, "questions").select("id").join(answered, "id", "left_anti")


def question_trends(spark: SparkSession, base: str) -> DataFrame:
    """Questions per month, per theme and month, and per theme in all, by grouping sets over one scan."""
    rows = read(spark, base, "questions").select(F.date_format("created_at", "yyyy-MM").alias("month"), C.reference(F.col("theme_id")).alias("theme"))
    rows.createOrReplaceTempView("_question_months")
    return spark.sql(
        "select case grouping_id(month, theme) when 1 then 'month' when 2 then 'theme' else 'theme_month' end as level, month, theme, count(*) as n "
        "from _question_months group by grouping sets ((month), (month, theme), (theme))"
    )


def _votes_on_questions(spark: SparkSession, base: str) -> DataFrame:
    """(question, expert, sign) of every vote on an answer to a question."""
    answers = read(spark, base, "answers").select(F.col("id").alias("answer_id"), F.col("question_id").alias("question")).where("coalesce(question, 0) <> 0")
    votes = latest_votes(spark, base).where("answer_id is not null")
    return votes.join(answers, "answer_id").select("question", "expert", F.when(F.col("value").isin(*V.PLUS_VOTES), 1).otherwise(-1).alias("sign"))


def vote_dispersion(spark: SparkSession, base: str) -> DataFrame:
    """Per question: votes, experts, standard deviation and entropy (natural logarithm) of the votes' signs."""
    rows = _votes_on_questions(spark, base).groupBy("question").agg(F.count(F.lit(1)).alias("votes"), F.countDistinct("expert").alias("experts"), F.count_if(F.col("sign") > 0).alias("plus"), F.stddev_pop("sign").alias("sd"))
    part = lambda n: F.when(n > 0, -(n / F.col("votes")) * F.log(n / F.col("votes"))).otherwise(0.0)
    entropy = part(F.col("plus")) + part(F.col("votes") - F.col("plus"))
    return rows.select("question", "votes", "experts", F.round("sd", 3).alias("std_dev"), F.round(F.abs(entropy), 3).alias("entropy"))


def expertise_agreement(spark: SparkSession, base: str) -> DataFrame:
    """Per question: the share of its votes by experts of the commonest area, 0 where one vote or none has an area."""
    areas = read(spark, base, "experts").select(F.col("id").alias("expert"), F.lower(C.clean_text(F.col("area_of_expertise"))).alias("area"))
    rows = _votes_on_questions(spark, base).join(areas.where("area <> ''"), "expert").groupBy("question", "area").agg(F.count(F.lit(1)).alias("n"))
    out = rows.groupBy("question").agg(F.sum("n").alias("votes"), F.max("n").alias("most"))
    return out.select("question", "votes", F.when(F.col("votes") > 1, F.round(F.col("most") / F.col("votes"), 3)).otherwise(0.0).alias("agreement"))


def vote_conflicts(spark: SparkSession, base: str) -> DataFrame:
    """Experts and answers with votes of both signs, by latest delivery of each vote."""
    votes = latest_votes(spark, base).where("expert is not null and answer_id is not null")
    b = C.vote_bucket(F.col("value"))
    both = votes.groupBy("expert", "answer_id").agg(F.count_if(b == "endorses").alias("endorses"), F.count_if(b == "disagreesWith").alias("disagrees"))
    return both.where("endorses > 0 and disagrees > 0")


QUERIES = {
    "response_time_by_theme": response_time_by_theme,
    "response_time_by_expert": response_time_by_expert,
    "unanswered_questions": unanswered_questions,
    "question_trends": question_trends,
    "vote_dispersion": vote_dispersion,
    "expertise_agreement": expertise_agreement,
    "vote_conflicts": vote_conflicts,
}
_PAIRS = f"""pairs as (select q.id question, {REF.format(c="q.theme_id")} theme, a.expert_id expert, date_diff('microsecond', q.created_at, a.created_at) / 3.6e9 h
  from answers a join questions q on a.question_id = q.id where q.created_at is not null and a.created_at is not null)"""
_IN = ", ".join(f"'{x}'" for x in V.PLUS_VOTES)
_VOTES = f"{LATEST}, qv as (select a.question_id question, l.expert, case when l.value in ({_IN}) then 1 else -1 end sign from latest l join answers a on l.answer_id = a.id where coalesce(a.question_id, 0) <> 0)"
_POS, _NEG = ", ".join(f"'{x}'" for x in V.POSITIVE_VOTES), ", ".join(f"'{x}'" for x in V.NEGATIVE_VOTES)
ORACLE = {
    "response_time_by_theme": f"with {_PAIRS}, m as (select theme, question, avg(h) h, count(*) k from pairs group by 1, 2) select theme, round(avg(h), 2) as hours, count(*) as questions, cast(sum(k) as bigint) as answers from m group by 1",
    "response_time_by_expert": f"with {_PAIRS} select expert, round(avg(h), 2) as hours, count(*) as answers from pairs where expert is not null group by 1",
    "unanswered_questions": "select id from questions q where not exists (select 1 from answers a where a.question_id = q.id)",
    "question_trends": f"""with m as (select strftime(created_at, '%Y-%m') as month, {REF.format(c="theme_id")} theme from questions)
select case grouping_id(month, theme) when 1 then 'month' when 2 then 'theme' else 'theme_month' end as level, month, theme, count(*) as n from m group by grouping sets ((month), (month, theme), (theme))""",
    "vote_dispersion": f"""with {_VOTES}, d as (select question, count(*) votes, count(distinct expert) experts, count(*) filter (sign > 0) plus, stddev_pop(sign) sd from qv group by 1)
select question, votes, experts, round(sd, 3) as std_dev, round(abs((case when plus > 0 then -(plus / votes) * ln(plus / votes) else 0 end) + (case when votes - plus > 0 then -((votes - plus) / votes) * ln((votes - plus) / votes) else 0 end)), 3) as entropy from d""",
    "expertise_agreement": f"""with {_VOTES}, a as (select id expert, lower(trim(regexp_replace(replace(area_of_expertise, '**', ''), '\\s+', ' ', 'g'))) area from experts),
n as (select question, area, count(*) n from qv join a using (expert) where area <> '' group by 1, 2)
select question, cast(sum(n) as bigint) as votes, case when sum(n) > 1 then round(max(n) / sum(n), 3) else 0.0 end as agreement from n group by 1""",
    "vote_conflicts": f"with {LATEST} select expert, answer_id, count(*) filter (value in ({_POS})) as endorses, count(*) filter (value in ({_NEG})) as disagrees from latest where expert is not null and answer_id is not null group by 1, 2 having count(*) filter (value in ({_POS})) > 0 and count(*) filter (value in ({_NEG})) > 0",
}
