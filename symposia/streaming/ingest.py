"""Streams over arriving files: votes without their repeats, events per window, and an incremental entity registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from symposia.functions import columns as C


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_a_batch: int = 50) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def first_deliveries(votes: DataFrame, delay: str = "7 days") -> DataFrame:
    """Votes of a stream without repeated deliveries that arrive within ``delay`` of one another; state is bounded by it."""
    key = F.coalesce(F.col("id").cast("string"), F.concat_ws("_", C.reference(F.col("expert_id")).cast("string"), F.col("answer_id").cast("string")))
    timed = votes.withColumns({"vote_key": key, "seen_at": F.col("ingested_at").cast("timestamp")})
    return timed.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["vote_key"])


def windowed_counts(events: DataFrame, time: str = "ts", size: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events per window and type with their summed value; late rows beyond ``delay`` are left to the batch report."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", delay)
    window = F.window("_t", size, slide) if slide else F.window("_t", size)
    return timed.groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "value")


def sessions(events: DataFrame, time: str = "ts", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", delay)
    return timed.groupBy(F.session_window("_t", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def registry_batch(target: str):
    """A foreachBatch sink that folds entity rows into versions of the registry under ``target``.

    Each batch writes one new partition ``batch=<id>``; writing the same batch again replaces it, so a restart cannot
    count a row twice. ``registry_view`` reads all partitions as one registry."""

    def write(rows: DataFrame, batch: int) -> None:
        part = rows.where("uri is not null").groupBy("uri").agg(F.max("confidence").alias("confidence"), F.max_by("label", F.struct(F.length("label"), "label")).alias("label"), F.count(F.lit(1)).alias("mentions"))
        part.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    return write


def registry_view(spark: SparkSession, target: str) -> DataFrame:
    rows = spark.read.parquet(target)
    return rows.groupBy("uri").agg(F.max("confidence").alias("confidence"), F.max_by("label", F.struct(F.length("label"), "label")).alias("label"), F.sum("mentions").alias("mentions"))


def event_windows(spark: SparkSession, base: str) -> DataFrame:
    """The windowed counts over the events table as a batch: the same operator that runs on the stream."""
    return windowed_counts(spark.read.parquet(f"{base}/events.parquet"), size="1 day").withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz"), "value": F.round("value", 4)})


def event_sessions(spark: SparkSession, base: str) -> DataFrame:
    return sessions(spark.read.parquet(f"{base}/events.parquet")).groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.max("n").alias("longest"))


QUERIES = {"event_windows": event_windows, "event_sessions": event_sessions}
ORACLE = {
    "event_windows": "select time_bucket(interval 1 day, ts, timestamp '1970-01-01') as start, time_bucket(interval 1 day, ts, timestamp '1970-01-01') + interval 1 day as end, event_type, count(*) as n, round(sum(value), 4) as value from events group by 1, 2, 3",
    "event_sessions": """with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end b from events where ts is not null),
s as (select user_id, sum(b) over (partition by user_id order by ts rows unbounded preceding) k from g), n as (select user_id, k, count(*) n from s group by 1, 2)
select user_id, count(*) as sessions, max(n) as longest from n group by 1""",
}
