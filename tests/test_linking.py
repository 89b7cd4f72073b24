import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from symposia import config
from symposia.operators import linking, resolve
from symposia.plans import build


def test_absorption_equals_the_sequential_pass(spark):
    r = random.Random(8)
    names = [f"n{k:02}" for k in range(40)]
    pairs = {tuple(sorted(r.sample(names, 2))) for _ in range(70)}
    want, gone = {}, set()
    for a in names:
        if a not in gone:
            for b in names:
                if b > a and b not in gone and (a, b) in pairs:
                    gone.add(b)
                    want[b] = a
    nodes = spark.createDataFrame([(n, n) for n in names], "node string, ord string")
    got = linking.greedy_absorption(nodes, spark.createDataFrame(sorted(pairs), "a string, b string"))
    assert {x.node: x.into for x in got.collect()} == want
    assert linking.greedy_absorption(nodes, spark.createDataFrame([], "a string, b string")).count() == 0


def test_candidates(spark):
    labels = spark.createDataFrame([("ai",), ("fairness",), ("zzzz",)], "label_key string")
    found = spark.createDataFrame([("ai", 1, "Q1", "AIs"), ("ai", 2, "Q2", "AI"), ("fairness", 1, "Q3", "fairnes"), ("fairness", 2, "Q4", "fairness"), ("zzzz", 1, "Q5", "abc")], "label_key string, rank int, qid string, label string")
    assert {x.label_key: x.qid for x in linking.candidate_links(labels, found).collect()} == {"ai": "Q2", "fairness": "Q4"}


@pytest.mark.parametrize("middle,want", [(None, 0), (49.0, 50), (2.0, 0), (27.0, 0)])
def test_quote_nearest_to_the_pair(spark, middle, want):
    text = "bias" + "." * 46 + "bias"
    df = spark.createDataFrame([(text, "Bias", middle)], "t string, q string, m double")
    assert df.select(linking.quote_span(F.col("t"), F.col("q"), F.col("m")).alias("x")).first().x == want
    assert df.select(linking.quote_starts(F.lit("aaa"), F.lit("aa")).alias("x")).first().x == [0, 1]


def jaccard(a, b):
    x, y = set(a.split()), set(b.split())
    return len(x & y) / len(x | y)


def test_candidates_are_complete_at_every_size_of_block(spark):
    """One word in a third of all labels, labels of one to thirty words: against all pairs."""
    r = random.Random(3)
    words = [f"w{k:02}" for k in range(40)]
    labels = set()
    for _ in range(400):
        own = r.sample(words, r.choice([1, 2, 3, 5, 8, 20, 22, 30]))
        labels.add(" ".join(sorted(own)))
        near = list(own)
        for _ in range(r.randint(0, 2)):
            near[r.randrange(len(near))] = r.choice(words)
        labels.add(" ".join(sorted(set(near))))
        if r.random() < 0.33:
            labels.add(" ".join(sorted({"general", *own})))
    labels.add("ac bc cc dc ec fc gc hc ic jc kc lc mc nc oc pc qc rc sc tc")
    labels.add("ac ad bc bd cc dc ec fc gc hc ic jc kc lc mc nc oc pc qc rc sc tc")
    rows = [(f"u{k:04}", "Risk", x) for k, x in enumerate(sorted(labels))]
    found = {(x.a, x.b) for x in resolve.candidate_pairs(spark.createDataFrame(rows, "uri string, entity_type string, label string")).collect()}
    want = {(a, b) for k, (a, _, x) in enumerate(rows) for b, _, y in rows[k + 1 :] if jaccard(x, y) >= 0.84}
    assert len(want) > 50 and want <= found


def test_consolidation_misses_no_pair(spark):
    """Containment and ratio, in words and characters, equal the pass over all pairs of a type."""
    r = random.Random(5)
    words = ["privacy", "data", "fairness", "bias", "explainability", "policy", "risk", "governance", "algorithmic", "x", "audit7"]
    keys = {" ".join(r.sample(words, r.randint(1, 6))) for _ in range(70)} | {"privacy", "differential data privacy", "fairness", "algorithmic fairness policy", "model", "modelss", "modxelss"}
    for key in sorted(keys):
        for _ in range(2):
            k = r.randrange(len(key))
            keys |= {key[:k] + key[k + 1 :], key[:k] + r.choice("aeqz ") + key[k:], key[:k] + key[k + 1 : k + 2] + key[k : k + 1] + key[k + 2 :]}
    keys = sorted({" ".join(k.split()) for k in keys} - {""})
    rows = [(f"u{i:03}", r.choice("AB") if i % 7 == 0 else "A", round(r.random(), 3), k) for i, k in enumerate([*keys, *keys[:20]])]
    order = sorted(rows, key=lambda x: (f"{10 - x[2]:.3f}", x[0]))
    want, gone = {}, set()
    for i, (a, kind, _, x) in enumerate(order):
        for b, other, _, y in order[i + 1 :] if a not in gone else []:
            if b not in gone and kind == other:
                short, long = sorted((x, y), key=len)
                if (len(short) >= 4 and short in long) or SequenceMatcher(None, x, y).ratio() >= 0.93:
                    gone.add(b)
                    want[b] = a
    got = linking.absorbed_keys(spark.createDataFrame([*rows, ("n1", "A", 0.5, ""), ("n2", "A", 0.5, "")], "uri string, entity_type string, confidence double, key string"))
    assert {x.node: x.into for x in got.collect()} == want


def test_consolidation_meets_beyond_the_first_words(spark, tables):
    labels = ["privacy", "differential data privacy", "explainability", "explainabilty", "\u6570\u636e \u9690\u79c1", "\u6570\u636e \u5b89\u5168"]
    base = tables(entities=[{"uri": f"u{i}", "label": x, "entity_type": "Risk", "confidence": 0.9} for i, x in enumerate(labels)])
    assert {x.node: x.into for x in linking.consolidation(spark, base).collect()} == {"u1": "u0", "u3": "u2"}


def test_one_match_label_is_one_entity(spark, tables):
    """Aliases and labels of other scripts have no common match key; another type stays apart."""
    rows = [("u0", "GDPR", "Regulation"), ("u1", "General Data Protection Regulation", "Regulation"), ("u2", "\u6570\u636e\u9690\u79c1", "Risk"), ("u3", "\u6570\u636e\u9690\u79c1", "Risk"), ("u4", "GDPR", "Model"), ("u5", "\u6570\u636e\u5b89\u5168", "Risk")]
    base = tables(entities=[{"uri": u, "label": x, "entity_type": k, "confidence": 0.9} for u, x, k in rows])
    got = {x.uri: x.canonical for x in resolve.canonical_entities(spark, base).collect()}
    assert got["u0"] == got["u1"] and got["u2"] == got["u3"]
    assert len(set(got.values())) == 4


def test_external_identifiers_and_classes(spark, tables):
    rows = [("u0", "Acme Risk", "Risk", None, {"qid": "q42"}), ("u1", "Something else", "Model", None, {"doi": " ", "wikidata": '{"id": "Q42"}'}), ("u2", "HMDA", "Law", "airo:Rule", None), ("u3", "Home Mortgage Disclosure Act", "Rule", None, {"url": " "})]
    base = tables(entities=[{"uri": u, "label": x, "entity_type": k, "ontology_uri": o, "metadata": m, "confidence": 0.9} for u, x, k, o, m in rows])
    got = {x.uri: x.canonical for x in resolve.canonical_entities(spark, base).collect()}
    assert got["u0"] == got["u1"] and got["u2"] == got["u3"] and got["u0"] != got["u2"]


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"fuzzy_threshold": 0.9, "unknown": 1}))
    assert config.load(str(path)).fuzzy_threshold == 0.9
    path.write_text(json.dumps({"fuzzy_threshold": 9}))
    with pytest.raises(ValueError):
        config.load(str(path))
    config.save(config.EngineConfig(), str(path))
    assert config.load(str(path)) == config.EngineConfig()


def test_whole_run(spark, tables, tmp_path):
    base = tables(
        themes=[{"id": 1, "name": "Fair lending"}], questions=[{"id": 1, "theme_id": "1", "body": "Why bias?"}], answers=[{"id": 1, "question_id": 1, "expert_id": 1, "body": "The model must not use personal data."}], experts=[{"id": 1, "display_name": "A B"}],
        entities=[{"uri": "http://e/a", "label": "model", "entity_type": "Model", "confidence": 0.9, "start_char": 4, "end_char": 9, "metadata": {"origin_key": "answers|1"}}, {"uri": "http://e/b", "label": "risk", "entity_type": "Risk", "confidence": 0.9}],
        relations=[{"uri": "r1", "source": "http://e/a", "relation": "has risk", "target": "http://e/b", "confidence": 0.8, "context": "a risk"}],
    )
    results = build.build(spark, base, config.EngineConfig())
    build.write(results, str(tmp_path / "out"), config.EngineConfig())
    assert spark.read.parquet(str(tmp_path / "out/relations")).first().relation == "hasRisk"
    assert spark.read.text(str(tmp_path / "out/graph.nt")).count() == results["triples"].distinct().count()
    assert results["shapes"].where("severity = 'Violation'").count() == 0
