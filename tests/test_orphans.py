from datetime import datetime as D

import pytest

from symposia.operators import orphans

T1, T2, T3 = D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)


def found(spark, base):
    return {(r.child_table, r.child_id, r.status) for r in orphans.p6_found(spark, base).collect()}


def test_statuses_and_spellings(spark, tables):
    base = tables(
        themes=[{"id": 1, "ingested_at": T1}, {"id": 2, "ingested_at": T3}],
        questions=[
            {"id": 10, "theme_id": "\t1.0 ", "ingested_at": T2},
            {"id": 11, "theme_id": "2", "ingested_at": T2, "created_at": T2},
            {"id": 12, "theme_id": "99", "ingested_at": T2},
            {"id": 13, "theme_id": " ", "ingested_at": T2},
            {"id": 14, "theme_id": "0", "ingested_at": T2},
            {"id": 15, "theme_id": "77", "ingested_at": T2},
            {"id": 16, "theme_id": "n/a"},
        ],
        deletions=[{"table_name": "themes", "record_id": 77, "deleted_at": T1}],
        experts=[{"id": 5, "is_deleted": True, "ingested_at": T3}, {"id": 6, "is_deleted": None, "ingested_at": T1}],
        votes=[
            {"id": None, "expert_id": "5", "answer_id": 3, "ingested_at": T1},
            {"id": 8, "expert_id": "6", "answer_id": 3, "ingested_at": T2},
            {"id": 9, "expert_id": " 7.0", "answer_id": None, "ingested_at": T2},
            {"id": 9, "expert_id": "7", "answer_id": None, "ingested_at": T2},
        ],
    )
    assert found(spark, base) == {
        ("questions", "11", "late"), ("questions", "12", "missing"), ("questions", "15", "deleted"), ("votes", "5_3", "deleted"), ("votes", "9", "missing"),
    }
    months = {(r.child_table, r.month, r.status): r.n for r in orphans.p6_report(spark, base).collect()}
    assert months[("questions", "2024-02", "late")] == 1


def test_nulls_and_empty_tables(spark, tables):
    assert found(spark, tables()) == set()
    assert found(spark, tables(questions=[{}], answers=[{}], votes=[{}], experts=[{}], deletions=[{}], themes=[{}])) == set()


def test_hot_parent_is_salted_not_lost(spark):
    refs = spark.range(6000).selectExpr("'votes' child_table", "cast(id as string) child_id", "'experts' parent", "if(id < 5000, 1L, id) key", "timestamp_ntz'2024-01-01' seen_at", "'2024-01' month")
    parents = spark.range(1, 2).selectExpr("'experts' parent", "id key", "1 here", "timestamp_ntz'2023-01-01' valid_from", "timestamp_ntz'2023-02-01' valid_to")
    out = orphans.classify(refs, parents, rows_per_task=50).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in out} == {"deleted": 5000, "missing": 1000}


@pytest.mark.parametrize("text,value", [("7", 7), (" 7", 7), ("7.0", 7), ("+7", 7), ("007", 7), ("", None), ("0", None), ("7.5", None), ("x7", None), (None, None)])
def test_reference(spark, text, value):
    from pyspark.sql import functions as F

    from symposia.functions.columns import reference

    assert spark.createDataFrame([(text,)], "c string").select(reference(F.col("c")).alias("r")).first().r == value
