"""Operators on hand-made rows; expected values follow from the rules."""

from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators import analytics, extraction, graph, predicates, reasoning, resolve, segments, structure, triples
from symposia.operators.ontology import entity_classes, semantic_types


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize("given,want", [("Leads-To", "causes"), ("charged_higher_fares", "affectedBy"), ("frobnicates", "relatedTo"), ("", "relatedTo"), (None, "relatedTo"), ("opposes", "opposes"), ("oppose", "disagreesWith"), ("mitigate", "mitigatedBy")])
def test_predicate_spelling(spark, given, want):
    assert one(spark, C.normalize_predicate(F.col("p")), p=given) == want


@pytest.mark.parametrize("given,want", [("1", "endorses"), (" No ", "disagreesWith"), ("skip", "isNeutralOn"), ("-1", "interactsWith"), (None, "interactsWith")])
def test_vote_bucket(spark, given, want):
    assert one(spark, C.vote_bucket(F.col("v")), v=given) == want


def test_text_columns(spark):
    assert one(spark, C.external_id(F.col("c")), c="https://www.wikidata.org/wiki/q42") == "wikidata:Q42"
    assert one(spark, C.external_id(F.col("c")), c="doi:10.1/AB") == "doi:10.1/ab"
    assert one(spark, C.match_key(F.col("c")), c="  MIMIC-CXR (v2) ") == "mimic cxr v2"
    assert one(spark, C.coerce_int(F.col("c")), c="[12, 3]") == 12
    assert one(spark, C.coerce_bool(F.col("c")), c=" Yes") is True
    assert one(spark, C.clamp(F.col("c")), c="7") == 1.0
    assert one(spark, C.token_count(F.col("c")), c="one two three") == 3
    assert one(spark, C.question_kind(F.col("c")), c="The show must go on") == "explanatory"
    assert one(spark, C.normalize_label(F.col("c")), c="ai model **audit**") == "AI Model Audit"
    assert one(spark, C.is_acronym(F.col("c")), c="GDPR") is True
    assert one(spark, C.origin_key(F.col("c"), F.lit("7")), c="answers") == "answers|7"
    assert one(spark, C.entity_type(F.col("c")), c="schema:Person") == "Person"


def test_ontology(spark):
    assert one(spark, entity_classes(F.lit("Dataset"), F.col("c")), c="Racial bias records") == ["dcat:Dataset", "airo:BiasRisk", "airo:RacialBiasRisk"]
    assert one(spark, semantic_types(F.col("c")), c="AI audit") == ["AISystem", "Action", "Evaluation", "Process", "SystemComponent"]


REL = "uri string, source string, relation string, target string, confidence double, is_inferred boolean, evidence string, extractor string, section string, doc_id string, source_type string, target_type string"


def rel(*rows):
    return [(u, s, p, t, c, False, e, None, None, None, st, tt) for u, s, p, t, c, e, st, tt in rows]


def test_precision(spark):
    rows = rel(
        ("1", "q", "answersQuestion", "a", 0.98, None, "Question", "Answer"),
        ("2", "d", "mentions", "x", 0.60, "this causes harm", "DiscourseUnit", "Entity"),
        ("3", "a", "relatedTo", "b", 0.50, "it violates and causes", "Entity", "Entity"),
        ("4", "a", "mitigates", "b", 0.50, None, "Entity", "Entity"),
    )
    got = {r.uri: (r.relation, r.confidence, r.rule) for r in predicates.precise(spark.createDataFrame(rows, REL)).collect()}
    assert got == {"1": ("relatedTo", 0.91, "guard"), "2": ("causes", 0.65, "evidence"), "3": ("relatedTo", 0.5, "none"), "4": ("mitigatedBy", 0.5, "synonym")}


def infer(spark, rows, rounds=3):
    facts = spark.createDataFrame([(s, p, o, c, f"k{i}") for i, (s, p, o, c) in enumerate(rows)], "s string, p string, o string, confidence double, key string")
    return {(r.s, r.p, r.o): (r.confidence, r.rule, r.iteration) for r in reasoning.infer(facts, rounds).collect()}


def test_inference_rules(spark):
    assert infer(spark, [("a", "uses", "b", 0.9), ("b", "uses", "c", 0.7)]) == {("a", "uses", "c"): (0.7, "transitive", 1)}
    assert infer(spark, [("a", "causes", "b", 0.9), ("b", "affects", "c", 0.9)])[("a", "affects", "c")] == (0.65, "composition", 1)
    assert infer(spark, [("a", "violates", "b", 0.52), ("b", "relatedTo", "c", 0.51)], 1)[("a", "violates", "c")] == (0.51, "composition", 1)
    assert infer(spark, [("a", "supports", "b", 0.9), ("a", "opposes", "b", 0.9)])[("a", "disagreesWith", "b")] == (0.6, "polarity", 1)
    assert infer(spark, [("x", "hasRisk", "r", 0.9), ("x", "mitigates", "m", 0.9)])[("r", "mitigatedBy", "m")] == (0.75, "schema", 1)
    assert infer(spark, [("e", "exhibitsRisk", "r", 0.9), ("r", "particularlyAffects", "g", 0.9)])[("g", "affectedBy", "r")] == (0.8, "schema", 1)
    chain = infer(spark, [(f"n{k}", "includes", f"n{k + 1}", 0.8) for k in range(8)])
    assert ("n0", "includes", "n8") in chain and chain[("n0", "includes", "n8")][2] == 3


def test_conflicts(spark):
    rows = spark.createDataFrame([("a", "supports", "b"), ("a", "opposes", "b"), ("a", "supports", "c")], "source string, relation string, target string")
    assert [(r.source, r.target, r.first, r.second) for r in predicates.conflicts(rows).collect()] == [("a", "b", "supports", "opposes")]


def test_chunks():
    assert segments.chunk_spans("  short text. ") == [(0, 2, 13)]
    assert segments.chunk_spans(None) == [] and segments.chunk_spans(" \n") == []
    long = "Some words here. " * 400
    spans = segments.chunk_spans(long)
    assert spans[0][1] == 0 and spans[-1][2] == len(long.rstrip())
    assert all(segments.tokens(long[a:b]) <= 450 for _, a, b in spans)
    text = "x" * 31 + " intro\nFairness: " + "words " * 30 + "\nRisk: " + "more " * 30
    assert len(segments.header_spans(text)) == 3


def test_grounding(spark):
    pieces = spark.createDataFrame([("r", 0, 0, 100), ("r", 1, 101, 200), ("q", 0, 5, 50)], "origin_key string, chunk_index int, start_offset int, end_offset int")
    spans = spark.createDataFrame([("a", "r", 10, 20), ("b", "r", 90, 120), ("c", "q", None, None), ("d", "none", 1, 2)], "uri string, origin_key string, s int, e int")
    got = {r.uri: (r.chunk_index, r.method, r.spans) for r in segments.ground(spans, pieces).collect()}
    assert got == {"a": (0, "span_map", "0:10:20"), "b": (-1, "span_segments", "0:90:100,1:101:120"), "c": (0, "single_chunk_discourse", ""), "d": (-1, "unknown", "")}


def test_json_repair():
    import json

    fix = lambda t: len(json.loads(extraction.repair_json(t))["relations"])
    assert fix('{"relations": [{"a": 1}]}') == 1
    assert fix('noise {"relations": [{"a": 1},]} more') == 1
    assert fix('{"relations": [{"a": 1}, {"b": 2}, {"c"') == 2
    assert fix("{'relations': [{'a': 'x'}]}") == 1
    assert fix(None) == fix("") == fix("nothing") == 0


def test_failing_extractor_gives_errors_not_an_abort(spark):
    rows = spark.createDataFrame([("k", 0, 0, "one two three four five six seven eight nine ten")], "origin_key string, chunk_index int, start_offset int, text string")

    def broken(texts):
        raise ValueError("no")

    assert extraction.extract(rows, broken).first().error == "ValueError: no"
    assert extraction.extract(rows, extraction.lexicon_extractor).first().error is None


def test_redirects(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), (None, "z")], "old string, new string")
    assert {(r.old, r.new) for r in resolve.redirect_closure(pairs).collect()} == {("a", "c"), ("b", "c"), ("y", "x")}


def test_components_and_graph(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "d"), ("f", "e"), ("e", "g")], "a string, b string")
    assert {(r.node, r.component) for r in graph.connected_components(pairs).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e"), ("f", "e"), ("g", "e")}
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, tgt string")
    assert {r.node: (r.triangles, r.coefficient) for r in graph.clustering(edges).collect()} == {"a": (1, 1.0), "b": (1, 1.0), "c": (1, 0.333333), "d": (0, 0.0)}
    ranks = {r.node: r["rank"] for r in graph.pagerank(edges).collect()}
    assert abs(sum(ranks.values()) - 1) < 1e-9 and ranks["c"] > ranks["d"]
    path = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, tgt string")
    assert {r.node: r.betweenness for r in graph.betweenness(path).collect()} == {"a": 0.0, "b": 0.5, "c": 0.0}
    two = spark.createDataFrame([(x, y) for g in ("abc", "xyz") for x in g for y in g if x < y] + [("c", "x")], "src string, tgt string")
    groups = {r.node: r.community for r in graph.greedy_modularity(two).collect()}
    assert groups["a"] == groups["b"] == groups["c"] != groups["x"] == groups["y"] == groups["z"]


def test_large_graphs_are_refused_by_whole_graph_operators(spark, monkeypatch):
    monkeypatch.setattr(graph, "WHOLE_GRAPH_EDGES", 2)
    with pytest.raises(ValueError):
        graph.betweenness(spark.range(5).selectExpr("cast(id as string) src", "cast(id + 1 as string) tgt"))


def test_shares_of_paths_of_many_sources_at_once(spark):
    """Against all shortest paths listed one by one."""
    import random

    import numpy as np

    r = random.Random(3)
    near = {x: sorted({r.randrange(25) for _ in range(3)} - {x}) for x in range(25)}
    want = dict.fromkeys(near, 0.0)
    for s in near:
        paths, front, seen = {}, [(s,)], {s}
        while front:
            front = [(*p, w) for p in front for w in near[p[-1]] if w not in seen]
            seen |= {p[-1] for p in front}
            for p in front:
                paths.setdefault(p[-1], []).append(p)
        for ways in paths.values():
            for p in ways:
                for v in p[1:-1]:
                    want[v] += 1 / len(ways)
    start = np.cumsum([0] + [len(near[x]) for x in range(25)])
    got = graph._dependencies(start, np.array([y for x in range(25) for y in near[x]]), np.arange(25), 25)
    assert np.allclose(got, [want[x] for x in range(25)])
    edges = spark.createDataFrame([(f"{x:02}", f"{y:02}") for x in near for y in near[x]], "src string, tgt string")
    assert all(abs(x.betweenness - want[int(x.node)] / (24 * 23)) < 1e-8 for x in graph.betweenness(edges).collect())


def test_whole_graphs_beyond_200000_edges(spark):
    """A hub of 200,100 edges, numbered by Spark: nothing of it comes to the driver."""
    star = spark.range(200_100).selectExpr("if(id = 0, 'x', 'hub') src", "if(id = 0, 'hub', cast(id as string)) tgt")
    rows = graph.betweenness(star).where("betweenness > 0").collect()
    assert [(r.node, r.betweenness) for r in rows] == [("hub", round(200_099 / (200_100 * 200_099), 9))]


def test_greedy_merging_beyond_200000_edges(spark):
    pairs = spark.range(200_100).selectExpr("concat('a', id) src", "concat('b', id) tgt")
    assert graph.greedy_modularity(pairs).where("substring(node, 2) = substring(community, 2) and community like 'a%'").count() == 400_200


def test_greedy_merging_keeps_no_outdated_pairs(spark):
    """Hubs push all their pairs again with each merger: 27 MB on this graph before those out of date were dropped."""
    import random
    import tracemalloc

    r = random.Random(1)
    pairs = sorted({(f"n{r.randrange(1200):05}", f"n{int(1200 * r.random() ** 3):05}") for _ in range(6000)})
    edges = spark.createDataFrame(pairs, "src string, tgt string")
    tracemalloc.start()
    out = graph.greedy_modularity(edges)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10e6 and out.count() == len({x for p in pairs if p[0] != p[1] for x in p})


def test_votes_and_dispersion(spark, tables):
    t = D(2024, 1, 1)
    base = tables(
        questions=[{"id": 1, "theme_id": "3", "created_at": D(2024, 1, 1)}],
        answers=[{"id": 7, "question_id": 1, "expert_id": 2, "created_at": D(2024, 1, 1, 6)}, {"id": 8, "question_id": 0, "body": None}],
        votes=[
            {"id": 1, "expert_id": "2", "answer_id": 7, "vote_value": " Upvote", "created_at": t},
            {"id": 1, "expert_id": "2", "answer_id": 7, "vote_value": "downvote", "created_at": t, "updated_at": D(2024, 1, 2)},
            {"id": 2, "expert_id": "3", "answer_id": 7, "vote_value": "like", "created_at": t},
            {"id": None, "expert_id": "4", "answer_id": 7, "vote_value": None, "created_at": t},
            {},
        ],
    )
    row = analytics.vote_dispersion(spark, base).first()
    assert (row.votes, row.std_dev, row.entropy) == (3, 0.943, 0.637)
    assert analytics.response_time_by_theme(spark, base).first().hours == 6.0
    edges = {(r.predicate, r.target.rsplit("_", 1)[1]) for r in structure.structural_edges(spark, base).collect()}
    assert ("disagreesWith", "7") in edges and ("belongsToTheme", "3") in edges


def test_spine_and_shapes(spark):
    rows = [("r", "type", "Relation", "iri"), ("r", "subject", "a", "iri"), ("r", "predicate", "p", "iri"), ("r", "object", "b", "iri"), ("a", "type", "Entity", "iri"), ("s", "type", "Relation", "iri"), ("s", "confidence", "1.5", "literal"), ("s", "subject", "a", "iri"), ("s", "subject", "b", "iri")]
    g = spark.createDataFrame([(*x, "float" if x[1] == "confidence" else None, None) for x in rows], "s string, p string, o string, o_kind string, o_datatype string, o_lang string")
    assert [(r.s, r.subject, r.object) for r in triples.spine_violations(g).collect()] == [("s", 2, 0)]
    found = {(r.node, r.path, r.constraint) for r in triples.check_shapes(g).where("shape = 'Relation'").collect()}
    assert {("r", "object", "or"), ("s", "subject", "maxCount"), ("s", "object", "minCount"), ("s", "confidence", "range"), ("r", "hasEvidence", "minCount")} <= found
    closed = triples.with_closure(g)
    assert closed.where("s = 'b' and p = 'type'").count() == 1


def test_partition_count_does_not_matter(spark):
    rows = [(f"n{i % 7}", p, f"n{(i * 3 + 1) % 7}", 0.5 + (i % 5) / 10, f"k{i:03}") for i, p in enumerate(["uses", "causes", "affects", "relatedTo", "hasRisk", "trainedOn"] * 5)]
    base = spark.createDataFrame(rows, "s string, p string, o string, confidence double, key string").dropDuplicates(["s", "p", "o"])
    base = spark.createDataFrame(sorted(base.collect()), base.schema)
    a = sorted(map(tuple, reasoning.infer(base.repartition(1), 2).collect()))
    b = sorted(map(tuple, reasoning.infer(base.repartition(7), 2).collect()))
    assert a == b
