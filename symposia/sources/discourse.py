"""Reading discourse: one JSON document with six sections, or the Parquet tables."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from symposia.functions import columns as C
from symposia.runtime import shared_dir

#: Fields by section; every value is read as text and coerced, because exports differ.
SECTIONS = {
    "themes": "id name description domain_category problem_category model_category views expert_id created_at",
    "questions": "id theme_id title body views expert_id created_at",
    "answers": "id question_id theme_id expert_id parent_id description body created_at",
    "votes": "id expert_id answer_id vote_value created_at updated_at",
    "experts": "id user_id display_name area_of_expertise bio is_deleted date_joined profile_picture",
    "documents": "id title description url created_at",
}
ALIASES = {"themes": "Theme", "questions": "Question", "answers": "Answer", "votes": "Vote", "experts": "Expert", "documents": "Document"}
NEEDED = ("themes", "questions", "answers")
LONGS = {"id", "views", "user_id", "question_id", "answer_id", "parent_id"}
TIMES = {"created_at", "updated_at", "date_joined"}


def json_schema() -> T.StructType:
    parts = []
    for section, fields in SECTIONS.items():
        row = T.StructType([T.StructField(f, T.StringType()) for f in fields.split()])
        parts += [T.StructField(name, T.ArrayType(row)) for name in (section, ALIASES[section])]
    return T.StructType(parts)


def read_json(spark: SparkSession, path: str, lines: bool = False) -> dict[str, DataFrame]:
    """The six sections of a discourse document (or of many, one per file, or with ``lines`` one per line) as tables with typed columns.

    Sections may bear the plural or the singular name. A missing one of themes, questions and answers only warns."""
    whole = spark.read.schema(json_schema()).option("multiLine", not lines).option("caseSensitive", True).json(path)
    out = {}
    for section, fields in SECTIONS.items():
        rows = whole.select(F.explode(F.coalesce(section, ALIASES[section])).alias("r")).select("r.*")
        cols = {}
        for f in fields.split():
            c = F.col(f)
            if f in LONGS and not (section == "documents" and f == "id"):
                c = C.coerce_int(c)
            elif f in TIMES:
                c = C.coerce_timestamp(c)
            elif f == "is_deleted":
                c = C.coerce_bool(c)
            cols[f] = c
        out[section] = rows.withColumns(cols)
    out["answers"] = out["answers"].withColumn("body", F.coalesce("body", "description")).drop("description")
    present = whole.select(*[F.max(F.coalesce(F.size(F.coalesce(s, ALIASES[s])), F.lit(-1)) >= 0).alias(s) for s in NEEDED]).first()
    for s in NEEDED:
        if not present[s]:
            warnings.warn(f"section {s} is missing", stacklevel=2)
    return out


def records(tables: dict[str, DataFrame]) -> DataFrame:
    """(section, record_id, text) of all sections, with the text each one is known by."""
    text = {"themes": F.col("description"), "questions": F.coalesce("body", "title"), "answers": F.col("body"), "votes": F.col("vote_value"), "experts": F.coalesce("bio", F.concat(F.lit("Expert "), F.col("id"))), "documents": F.coalesce("description", "title")}
    out = None
    for section, rows in tables.items():
        own = F.col("id").cast("string")
        if section == "votes":
            own = F.coalesce(own, F.concat_ws("_", "expert_id", F.col("answer_id").cast("string")))
        part = rows.select(F.lit(section).alias("section"), own.alias("record_id"), text[section].alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


def read_tables(spark: SparkSession, base: str, tables: tuple[str, ...]) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{base}/{t}.parquet") for t in tables}


def validate_entities(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with reason): confidence from 0 to 1, an absolute uri, a label and a type."""
    reason = (
        F.when(~F.coalesce(F.col("uri").rlike("^(https?://|urn:)"), F.lit(False)), "uri")
        .when(C.blank_to_null(F.col("label")).isNull(), "label")
        .when(C.blank_to_null(F.col("entity_type")).isNull(), "entity_type")
        .when(~F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(False)) | F.isnan("confidence"), "confidence")
    )
    marked = entities.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def as_documents(spark: SparkSession, base: str, path: str, rows_a_file: int = 5000) -> None:
    """The tables as discourse documents, one JSON file per some thousand records of a section; ids and times as text."""
    first = True
    for section, fields in SECTIONS.items():
        rows = spark.read.parquet(f"{base}/{section}.parquet")
        own = "doc_id" if section == "documents" else "id"
        cols = [F.col(own if f == "id" else f).cast("string").alias(f) for f in fields.split() if f in rows.columns or f == "id"]
        parts = F.greatest(F.lit(1), F.lit(-(-rows.count() // rows_a_file)))
        whole = rows.select(F.pmod(F.xxhash64(own), parts).alias("_part"), F.struct(*cols).alias("r")).groupBy("_part").agg(F.collect_list("r").alias(section)).drop("_part")
        whole.write.mode("overwrite" if first else "append").json(path)
        first = False


def discourse_sections(spark: SparkSession, base: str) -> DataFrame:
    """(section, record_id, text) of the tables written as JSON documents and read back: what every section's reader makes of them."""
    path = f"{shared_dir(spark)}/symposia/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}-json"
    as_documents(spark, base, path)
    return records(read_json(spark, path, lines=True)).where("record_id is not null").distinct()


def quarantined_entities(spark: SparkSession, base: str) -> DataFrame:
    """(reason, n) of entity rows that are set aside when tables are read, and of those that are kept."""
    valid, rejected = validate_entities(spark.read.parquet(f"{base}/entities.parquet"))
    rows = rejected.select("reason").unionByName(valid.select(F.lit("valid").alias("reason")))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {"discourse_sections": discourse_sections, "quarantined_entities": quarantined_entities}
_REF = r"nullif(try_cast(nullif(regexp_extract(regexp_replace(expert_id, '^\s+|\s+$', '', 'g'), '^([+-]?\d+)(\.0*)?$', 1), '') as bigint), 0)"
ORACLE = {
    "discourse_sections": """select distinct section, record_id, text from (select 'themes' section, cast(id as varchar) record_id, description text from themes union all select 'questions', cast(id as varchar), coalesce(body, title) from questions
union all select 'answers', cast(id as varchar), body from answers union all select 'votes', coalesce(cast(id as varchar), concat_ws('_', expert_id, cast(answer_id as varchar))), vote_value from votes
union all select 'experts', cast(id as varchar), coalesce(bio, 'Expert ' || cast(id as varchar)) from experts union all select 'documents', cast(doc_id as varchar), title from documents) where record_id is not null""",
    "quarantined_entities": """select case when not coalesce(regexp_matches(uri, '^(https?://|urn:)'), false) then 'uri' when coalesce(regexp_replace(label, '^\\s+|\\s+$', '', 'g'), '') = '' then 'label' when coalesce(regexp_replace(entity_type, '^\\s+|\\s+$', '', 'g'), '') = '' then 'entity_type'
when not coalesce(confidence between 0.0 and 1.0, false) or isnan(confidence) then 'confidence' else 'valid' end as reason, count(*) as n from entities group by 1""",
}
