import json
import warnings

from symposia.sources import discourse, sinks
from symposia.streaming import ingest


def test_json_with_either_name(spark, tmp_path):
    doc = {"Theme": [{"id": 1, "name": "x"}], "questions": [{"id": "2", "theme_id": "1", "body": "Why?", "created_at": "2024-01-01T00:00:00Z"}], "votes": [{"expert_id": 3, "answer_id": 4, "vote_value": 1}]}
    path = tmp_path / "d.json"
    path.write_text(json.dumps(doc))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        tables = discourse.read_json(spark, str(path))
    assert any("answers" in str(w.message) for w in caught)
    assert tables["themes"].first().id == 1 and tables["questions"].first().created_at is not None
    got = {(r.section, r.record_id): r.text for r in discourse.records(tables).collect()}
    assert got[("votes", "3_4")] == "1" and got[("questions", "2")] == "Why?"


def test_entity_quarantine(spark):
    rows = [("http://a", "x", "Risk", 0.5), ("a", "x", "Risk", 0.5), ("urn:b", " ", "Risk", 0.5), ("urn:c", "x", None, 0.5), ("urn:d", "x", "Risk", float("nan")), ("urn:e", "x", "Risk", None)]
    good, bad = discourse.validate_entities(spark.createDataFrame(rows, "uri string, label string, entity_type string, confidence double"))
    assert [r.uri for r in good.collect()] == ["http://a"]
    assert sorted(r.reason for r in bad.collect()) == ["confidence", "confidence", "entity_type", "label", "uri"]


def test_writers(spark, tmp_path):
    g = spark.createDataFrame([("urn:s", "type", "Risk", "iri", None, None), ("urn:s", "label", 'a "b"\n', "literal", "langString", "en"), ("urn:s", "confidence", "0.5", "literal", "float", None), ("urn:s", "confidence", "0.5", "literal", "float", None)], "s string, p string, o string, o_kind string, o_datatype string, o_lang string")
    lines = sorted(r.value for r in sinks.n_triples(g).collect())
    assert len(lines) == 3 and any(x.endswith('"a \\"b\\"\\n"@en .') for x in lines)
    sinks.write_n_triples(g, str(tmp_path / "nt"))
    assert spark.read.text(str(tmp_path / "nt")).count() == 3
    assert sinks.turtle(g).count() == 1
    node = json.loads(sinks.json_ld(g).first().value)
    assert node["@id"] == "urn:s" and node["@type"][0].endswith("Risk")
    assert sinks.rdf_xml(g).count() == 3
    sinks.write_sorted_lines(g.select("p"), str(tmp_path / "l"), "p")


def test_streams(spark, tmp_path):
    votes = spark.createDataFrame([(1, "2", 3, "2024-01-01 00:00:00"), (1, "2", 3, "2024-01-01 01:00:00"), (None, "2.0", 3, "2024-01-01 00:00:00"), (None, " 2", 3, "2024-01-02 00:00:00")], "id long, expert_id string, answer_id long, t string")
    votes = votes.selectExpr("id", "expert_id", "answer_id", "cast(t as timestamp_ntz) ingested_at")
    votes.write.parquet(str(tmp_path / "v"))
    q = ingest.first_deliveries(ingest.file_stream(spark, str(tmp_path / "v"), votes.schema)).select("vote_key").writeStream.format("memory").queryName("first_votes").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.vote_key for r in spark.table("first_votes").collect()) == ["1", "2_3"]

    entities = spark.createDataFrame([("u", 0.5, "a"), ("u", 0.7, "abc")], "uri string, confidence double, label string")
    entities.write.parquet(str(tmp_path / "e"))
    write = ingest.registry_batch(str(tmp_path / "r"))
    q = ingest.file_stream(spark, str(tmp_path / "e"), entities.schema).writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    row = ingest.registry_view(spark, str(tmp_path / "r")).first()
    assert (row.confidence, row.label, row.mentions) == (0.7, "abc", 2)
