"""Merging, redirects, spans, shapes and hot keys on planted rows."""

import hashlib
import warnings

import pytest
from pyspark.sql import functions as F

from symposia import runtime
from symposia.functions import columns as C
from symposia.operators import entities, extraction, graph, ontology, predicates, reasoning, resolve, structure, triples
from symposia.sources import sinks


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "c string").select(column(F.col("c")).alias("v")).first().v


@pytest.mark.parametrize(
    "call,given,want",
    [
        (C.normalize_url, "HTTPS://Ex.Org/A/?utm_source=x&b=1#top", "https://ex.org/A?b=1"), (C.external_id, "https://www.wikidata.org/wiki/Q42", "wikidata:Q42"), (C.external_id, "https://doi.org/10.1/AbC", "doi:10.1/abc"),
        (C.sanitized, " a b-c ", "a_b_c"), (C.sanitized, "??", "Resource"), (C.camel_case, "has Risk level", "hasRiskLevel"), (C.uri_safe, "a b/é", "a_b/%C3%A9"), (C.rdf_node, "http://x/y", "<http://x/y>"), (C.rdf_node, 'a"b', '"a\\"b"'),
        (C.match_key, "ＧＤＰＲ ﬁt", "gdpr fit"), (C.rating_concept, "Very High", "VeryHigh"), (C.single_value, "B; a", "a"), (C.exact_predicate, "HASRISK", "hasRisk"), (C.exact_predicate, "has risk", None),
    ],
)
def test_columns(spark, call, given, want):
    assert one(spark, given, call) == want


def test_merge_keeps_the_most_confident_label_and_every_alias(spark):
    rows = spark.createDataFrame([("a", "GDPR", 0.5, None, 2), ("b", "Gdpr law", 0.9, "x:Y", 1), ("c", "other", 0.1, None, 1)], "uri string, label string, confidence double, ontology_uri string, mentions long")
    same = spark.createDataFrame([("b", "a"), ("a", "a")], "uri string, canonical string")
    got = {r.uri: (r.label, r.aliases, r.confidence, r.ontology_uri, r.mentions, r.members) for r in entities.merge(rows, same).collect()}
    assert got == {"a": ("Gdpr law", "GDPR", 0.9, "x:Y", 3, 2), "c": ("other", "", 0.1, None, 1, 1)}


def test_redirects_end_at_the_least_of_a_cycle(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("p", "q"), ("q", "p")] + [(f"n{k:03}", f"n{k + 1:03}") for k in range(100)]
    got = dict(map(tuple, resolve.redirect_closure(spark.createDataFrame(edges, "old string, new string")).collect()))
    assert {k: got[k] for k in "abc"} == {"a": "d", "b": "d", "c": "d"} and got["n000"] == got["n099"] == "n100"
    assert got["w"] == got["y"] == got["z"] == "x" and got["q"] == "p" and "x" not in got and "p" not in got


def test_contradictions_of_asserted_and_inferred_relations(spark, tables):
    both = lambda p, u: {"uri": u, "source": "a", "target": "b", "relation": p, "confidence": 0.9}
    base = tables(relations=[both("endorses", "1"), both("opposes", "2"), both("supports", "3")])
    assert {(r.first, r.second) for r in predicates.relation_conflicts(spark, base).collect()} == {("supports", "opposes")}
    found = {(r.source, r.target, r.first, r.second) for r in reasoning.stated_conflicts(spark, base).collect()}
    assert ("a", "b", "endorses", "disagreesWith") in found


def test_votes_of_one_expert_and_lone_entities(spark, tables):
    vote = lambda k, v: {"id": k, "expert_id": "1", "answer_id": 5, "vote_value": v}
    base = tables(votes=[vote(1, "upvote"), vote(2, "reject"), vote(3, "very high")], entities=[{"uri": "a", "label": "x"}, {"uri": "b", "label": "y"}], relations=[{"uri": "r", "source": "a", "target": "a", "relation": "uses"}])
    assert [r.uri for r in triples.isolated_entities(spark, base).collect()] == ["b"]
    from symposia.operators import analytics

    assert analytics.vote_conflicts(spark, base).count() == 1
    said = {(r.s[-1], r.p): r.o for r in triples.vote_triples(spark, base).collect()}
    assert said[("1", "polarity")] == "positive" and said[("2", "voteValue")] == "Negative" and said[("3", "voteValue")] == "VeryHigh"
    edges = structure.structural_edges(spark, base)
    assert triples.cast_by(edges).count() == 3


def test_shapes_of_votes_languages_and_names(spark):
    t = lambda s, p, o, k="iri", d=None, lang=None: (s, p, o, k, d, lang)
    kg = triples.V.KG
    rows = [t("v", "type", "Vote"), t("v", "castBy", "e"), t("v", "castBy", "f"), t("e", "type", "Expert"), t("f", "type", "Theme"), t("e", "label", "x", "literal", "langString", "de"), t(f"{kg}evidence_1", "source", "x", "literal", "string")]
    found = {(r.node, r.path, r.constraint) for r in triples.check_shapes(spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_datatype string, o_lang string")).collect()}
    assert {("v", "castBy", "maxCount"), ("v", "castBy", "class"), ("v", "receivesVote", "minCount"), ("e", "label", "languageIn"), (f"{kg}evidence_1", "evidenceText", "minCount")} <= found
    with pytest.raises(triples.ShapeError):
        triples.enforce_shapes(spark.createDataFrame([("Vote", "castBy", "maxCount", "Violation")], "shape string, path string, constraint string, severity string"))


def test_unregistered_predicates(spark):
    rows = spark.createDataFrame([("uses",), ("inventedBy",)], "relation string")
    with pytest.raises(ontology.InventoryError):
        ontology.registered_only(rows)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert [r.relation for r in ontology.registered_only(rows, strict=False).collect()] == ["uses"]


def test_retries_only_after_transient_errors():
    calls = []

    def busy(texts):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("429 too many")
        return texts

    assert extraction.with_retries(busy, wait=0.001)(["x"]) == ["x"] and len(calls) == 3
    with pytest.raises(ValueError):
        extraction.with_retries(lambda _: (_ for _ in ()).throw(ValueError("bad")), wait=0.001)(["x"])


def test_extracted_relations_join_entities_of_their_record(spark, tables):
    text = "The old triage model of the city uses personal data without the consent of the people concerned."
    base = tables(answers=[{"id": 1, "body": text}, {"id": 2, "body": None}])
    rows = extraction.extracted_relations(spark, base).collect()
    assert [(r.origin_key, r.relation) for r in rows] == [("answers|1", "uses")]


def test_hot_keys_are_spread_and_nothing_is_lost(spark):
    """A key with a third of the rows: no task gets more rows than asked for by much."""
    facts = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) key", "id v").unionByName(spark.range(5).selectExpr("cast(null as string) key", "id v"))
    table = spark.range(9000).selectExpr("concat('k', id) key", "id t").unionByName(spark.range(1).selectExpr("'hot' key", "-1L t"))
    left, right = runtime.salted(facts, table, ["key"], rows_per_task=300)
    assert left.groupBy("key", "_salt").count().where("key is not null").agg(F.max("count")).first()[0] < 450
    joined = left.join(right, ["key", "_salt"], "left")
    assert joined.count() == 9005 and joined.where("key = 'hot' and t = -1").count() == 3000


def test_subjects_of_many_triples_are_written_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sinks, "SUBJECT_ROWS", 10)
    rows = [("hub", "mentions", f"o{k}", "iri", None, None) for k in range(100)] + [("a", "label", "x", "literal", "langString", "en")]
    df = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_datatype string, o_lang string")
    blocks = [r.value for r in sinks.turtle(df).collect()]
    assert sum(b.count("mentions") for b in blocks) == 100 and max(b.count("mentions") for b in blocks) < 40
    assert sum(len(r.value) > 0 for r in sinks.json_ld(df).collect()) == len(blocks)


def test_page_ranks_sum_to_one_and_do_not_move(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "src string, tgt string")
    got = {r.node: r.rank for r in graph.pagerank(e, tolerance=1e-12).collect()}
    assert sum(got.values()) == pytest.approx(1.0) and got["a"] == pytest.approx(0.0375 + 0.85 * (got["c"] + got["d"]))


def test_semi_naive_rounds_equal_naive_ones(spark):
    import random

    r = random.Random(2)
    ps = ["relatedTo", "uses", "causes", "affects", "supports", "criticizes", "hasRisk", "mitigatedBy"]
    rows = list({(f"n{r.randrange(12)}", r.choice(ps), f"n{r.randrange(12)}"): 0 for _ in range(60)})
    base = spark.createDataFrame([(*x, 0.8, f"k{k:03}") for k, x in enumerate(rows)], "s string, p string, o string, confidence double, key string")
    got = {(x.s, x.p, x.o, x.confidence, x.iteration) for x in reasoning.infer(base, 3).collect()}
    known, want = base, set()
    for turn in (1, 2, 3):
        best = reasoning.derive(known).groupBy("s", "p", "o").agg(F.min_by(F.struct("confidence", "rule", "k1", "k2"), F.struct("rule_ord", "k1", "k2")).alias("b"))
        new = best.join(known.select("s", "p", "o"), ["s", "p", "o"], "left_anti").select("s", "p", "o", F.round("b.confidence", 6).alias("confidence"), "b.rule")
        name = C.short_hash(F.concat_ws("|", "s", "p", "o", F.lit(f"it={turn}"), F.concat(F.lit("rule="), F.col("rule"))))
        new = runtime.cut(new.withColumn("key", F.concat(F.lit(f"~{turn}_"), name)))
        want |= {(x.s, x.p, x.o, x.confidence, turn) for x in new.collect()}
        known = runtime.cut(known.unionByName(new.drop("rule")))
    assert got == want


def test_every_rule_in_slices_and_blocks_equals_the_joins(spark, monkeypatch):
    import random

    from symposia.operators import rounds

    monkeypatch.setattr(rounds, "SLICE", 3)
    r = random.Random(5)
    rows = list({(r.randrange(14), r.choice([*rounds.NAMES, "other"]), r.randrange(14)): 0 for _ in range(500)})
    base = spark.createDataFrame([(*x, r.choice([0.3, 0.5, 0.62, 0.9]), k, k % 3 == 0) for k, x in enumerate(rows)], "s bigint, p string, o bigint, confidence double, key bigint, fresh boolean")
    known = runtime.cut(base.withColumns({"c": F.col("confidence"), "k": F.col("key"), "p": F.create_map(*[F.lit(x) for kv in (rounds.CODE | {"other": -1}).items() for x in kv])[F.col("p")]}))
    held = rounds.Known(runtime.located(known))
    got = [(held.ids[s], rounds.NAMES[p], held.ids[o], c, order) for b in range(3) for s, p, os, cs, order in rounds.derived(held, b, 3) for o, c in zip(os, cs, strict=True)]
    facts = base.drop("fresh").withColumn("key", F.format_string("%05d", "key"))
    new, old = (facts.join(base.where(which).select("s", "p", "o"), ["s", "p", "o"], "left_semi") for which in ("fresh", "not fresh"))
    best = reasoning.derive(facts, new, old).groupBy("s", "p", "o").agg(F.min_by(F.struct("confidence", "rule_ord"), F.struct("rule_ord", "k1", "k2")).alias("b")).join(facts.select("s", "p", "o"), ["s", "p", "o"], "left_anti")
    want = {(x.s, x.p, x.o, x.b.confidence, x.b.rule_ord) for x in best.collect()}
    assert len(got) == len(set(got)) and set(got) == want and len({x[4] for x in want}) > 10


def test_the_last_round_is_not_stored(spark, tmp_path, monkeypatch):
    """A hub of 300 by 300 gives 90,000 relations; what is kept on disk is the 600 facts."""
    monkeypatch.setattr(runtime, "shared_dir", lambda spark: str(tmp_path))
    hub = [(f"in{k}", "uses", "hub", 0.9, f"a{k}") for k in range(300)] + [("hub", "uses", f"out{k}", 0.9, f"b{k}") for k in range(300)]
    out = reasoning.infer(spark.createDataFrame(hub, "s string, p string, o string, confidence double, key string"), 1)
    assert out.count() == 90_000
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 200_000


def test_flat_counts_name_no_inferred_relation(spark, tables, monkeypatch):
    def named(*_):
        raise AssertionError("counts need no names")

    monkeypatch.setattr(triples, "inferred_relations", named)
    pairs = [("a", "b"), ("b", "c"), ("c", "d")]
    base = tables(relations=[{"uri": f"u{k}", "source": s, "target": t, "relation": "uses", "confidence": 0.9} for k, (s, t) in enumerate(pairs)])
    assert ("inferred", "uses", 3) in {tuple(r) for r in triples.flat_relations(spark, base).collect()}


def test_counts_and_labels_of_the_graph_in_parts_equal_those_of_the_whole(spark, tables, monkeypatch):
    """Inferred statements that are asserted too, lone entities, and no layout of the inferred part."""
    pairs = [("http://x/a", "uses", "http://x/b", 0.9), ("http://x/b", "uses", "http://x/c", 0.9), ("http://x/a", "uses", "http://x/c", 0.3), ("http://x/c", "relatedTo", "http://x/d", 0.9)]
    relations = [{"uri": f"u{k}", "source": s, "target": t, "relation": p, "confidence": c} for k, (s, p, t, c) in enumerate(pairs)]
    base = tables(relations=relations, entities=[{"uri": f"http://x/{x}", "label": x, "entity_type": "AISystem", "confidence": 0.5} for x in "abz"])
    whole = runtime.cut(triples.graph_triples(spark, base))
    want = [
        whole.groupBy("p", "o_kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("s").alias("subjects")),
        triples.pruned(whole).groupBy("p").agg(F.count(F.lit(1)).alias("n")),
        triples.single_labels(whole),
        triples.spine_violations(whole),
    ]
    want = [sorted(map(tuple, w.collect())) for w in want]
    laid = triples.graph_triples

    def without_inferred(spark, base, relations=None, inferred=None):
        assert inferred is not None, "the whole graph was laid out"
        return laid(spark, base, relations, inferred)

    monkeypatch.setattr(triples, "graph_triples", without_inferred)
    for name, rows in zip(("triple_counts", "pruned_counts", "node_labels", "relation_spine"), want, strict=True):
        assert sorted(map(tuple, triples.QUERIES[name](spark, base).collect())) == rows, name


def test_names_given_twice_are_found_and_laid_out(spark, tables):
    """A stated relation that bears the name of an inferred one."""
    key = hashlib.sha256(b"http://x/a|uses|http://x/c").hexdigest()[:16]
    pairs = [("u0", "http://x/a", "http://x/b"), ("u1", "http://x/b", "http://x/c"), (f"inferred_{key}", "http://x/c", "http://x/d")]
    base = tables(relations=[{"uri": u, "source": s, "target": t, "relation": "uses", "confidence": 0.9} for u, s, t in pairs])
    assert not triples.Parts(spark, base).apart()
    whole = triples.graph_triples(spark, base)
    for query, want in ((triples.relation_spine, triples.spine_violations(whole)), (triples.node_labels, triples.single_labels(whole)), (triples.pruned_counts, triples.pruned(whole).groupBy("p").agg(F.count(F.lit(1))))):
        got = sorted(map(tuple, query(spark, base).collect()))
        assert got == sorted(map(tuple, want.collect())) and got, query


def test_repeated_numbers_are_found_exactly(spark):
    rows = [bytes([k % 256, k // 256, 0, 0, 0, 0, 0, j]) for k in range(3000) for j in (0, 1)]
    found = lambda xs: runtime.repeats(runtime.packed(spark.createDataFrame([(bytearray(x),) for x in xs], "x binary").repartition(3)))
    assert not found(rows) and found([*rows, rows[777]])


def test_only_the_triples_that_are_read_are_stored(spark, tables, monkeypatch):
    kept, cut = [], runtime.cut
    monkeypatch.setattr(triples, "cut", lambda df: (kept.append(out := cut(df)), out)[1])
    base = tables(relations=[{"uri": "u", "source": "a", "target": "b", "relation": "uses", "confidence": 0.9}], answers=[{"id": 1, "body": "text"}])
    triples.relation_spine(spark, base)
    triples.node_labels(spark, base)
    assert {r.p for df in kept if "p" in df.columns for r in df.select("p").collect()} == {"type", "subject", "predicate", "object"}


def test_shapes_of_inferred_relations_are_counted_by_their_ends(spark, tables, monkeypatch):
    """Ends that are entities, ends without class, ends with no triple but an inferred one; no layout of the inferred part."""
    pairs = [("http://x/a", "relatedTo", "http://x/b"), ("http://x/b", "relatedTo", "http://x/c"), ("http://x/c", "uses", "http://x/d"), ("http://x/d", "uses", "http://x/a")]
    base = tables(relations=[{"uri": f"u{k}", "source": s, "target": t, "relation": p, "confidence": 0.9} for k, (s, p, t) in enumerate(pairs)], entities=[{"uri": f"http://x/{x}", "label": x, "entity_type": "AISystem", "confidence": 0.5} for x in "ab"], answers=[{"id": 1, "body": "text"}])
    want = sorted(map(tuple, triples._whole_report(spark, base).collect()))
    monkeypatch.setattr(triples, "_whole_report", lambda *_: pytest.fail("the whole graph was laid out"))
    assert sorted(map(tuple, triples.shape_report(spark, base).collect())) == want
    assert {x[2] for x in want} >= {"class", "or", "minCount"}


def test_facts_are_stored_once_and_names_are_not_moved(spark, tmp_path, monkeypatch):
    """Three rounds over a chain: each fact is written once, without text, and no row is shuffled for its names, however many they are."""
    monkeypatch.setattr(runtime, "shared_dir", lambda spark: str(tmp_path))
    chain = [(f"n{k:02}", "uses", f"n{k + 1:02}", 0.9, f"k{k:02}") for k in range(20)]
    base = spark.createDataFrame(chain, "s string, p string, o string, confidence double, key string")
    want = sorted(map(tuple, reasoning.infer(base, 3).collect()))
    monkeypatch.setattr(reasoning, "NAMED", (0, 0))
    found = reasoning._rounds(base, 3)
    got = found.spelled()
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert all(dict(x.dtypes) == {"s": "bigint", "p": "int", "o": "bigint", "c": "double", "r": "int", "k": "bigint"} for x in found.stored)
    assert sum(x.count() for x in found.stored) == sum(x[5] < 3 for x in want)


def test_keys_behind_those_of_derived_facts_keep_their_order(spark):
    """Base facts whose uris begin with ~ or beyond, by the naive joins."""
    import random

    r = random.Random(8)
    rows = list({(f"n{r.randrange(9)}", r.choice(["relatedTo", "uses", "causes"]), f"n{r.randrange(9)}"): 0 for _ in range(24)})
    base = spark.createDataFrame([(*x, r.choice([0.5, 0.6, 0.7, 0.8, 0.9]), r.choice(["k", "~", "~1_8", "~2_", "é"]) + f"{k:03}") for k, x in enumerate(rows)], "s string, p string, o string, confidence double, key string")
    got = {(x.s, x.p, x.o, x.confidence, x.iteration) for x in reasoning.infer(base, 3).collect()}
    known, want = base, set()
    for turn in (1, 2, 3):
        best = reasoning.derive(known).groupBy("s", "p", "o").agg(F.min_by(F.struct("confidence", "rule"), F.struct("rule_ord", "k1", "k2")).alias("b"))
        new = best.join(known.select("s", "p", "o"), ["s", "p", "o"], "left_anti").select("s", "p", "o", F.round("b.confidence", 6).alias("confidence"), "b.rule")
        name = C.short_hash(F.concat_ws("|", "s", "p", "o", F.lit(f"it={turn}"), F.concat(F.lit("rule="), F.col("rule"))))
        new = runtime.cut(new.withColumn("key", F.concat(F.lit(f"~{turn}_"), name)))
        want |= {(x.s, x.p, x.o, x.confidence, turn) for x in new.collect()}
        known = runtime.cut(known.unionByName(new.drop("rule")))
    assert got == want and any(x[4] > 1 for x in want)


def test_names_are_labelled_once_in_one_pass(spark, tables, monkeypatch):
    """An entity with a label and one without bear names of inferred relations, a stated relation that of a third; nothing is laid out or made twice."""
    names = [hashlib.sha256(f"http://x/{a}|uses|http://x/{b}".encode()).hexdigest()[:16] for a, b in ("ac", "bd", "ad")]
    pairs = [("u0", "http://x/a", "http://x/b"), ("u1", "http://x/b", "http://x/c"), ("u2", "http://x/c", "http://x/d"), (f"inferred_{names[0]}", "http://x/d", "http://x/e")]
    entities = [{"uri": f"{triples.V.KG}inferred_{names[k]}", "label": label, "entity_type": "Technology", "confidence": 0.5} for k, label in ((1, "Told"), (2, None))]
    base = tables(relations=[{"uri": u, "source": s, "target": t, "relation": "uses", "confidence": 0.9} for u, s, t in pairs], entities=entities)
    want = sorted(map(tuple, triples.single_labels(triples.graph_triples(spark, base)).collect()))
    assert sum(x[0].rpartition("_")[2] in names for x in want) == 3
    monkeypatch.setattr(triples.Parts, "apart", lambda *_: pytest.fail("inferred relations were made twice"))
    assert sorted(map(tuple, triples.node_labels(spark, base).collect())) == want


def test_pruned_counts_make_inferred_relations_once(spark, tables, monkeypatch):
    pairs = [("http://x/a", "http://x/b"), ("http://x/b", "http://x/c"), ("http://x/c", "http://x/d")]
    base = tables(relations=[{"uri": f"u{k}", "source": s, "target": t, "relation": "uses", "confidence": 0.9} for k, (s, t) in enumerate(pairs)], entities=[{"uri": f"http://x/{x}", "label": x, "entity_type": "AISystem", "confidence": 0.5} for x in "az"])
    want = sorted(map(tuple, triples.pruned(triples.graph_triples(spark, base)).groupBy("p").agg(F.count(F.lit(1))).collect()))
    reads, read = [], reasoning.Inferred.read
    monkeypatch.setattr(reasoning.Inferred, "read", lambda *x: (reads.append(x), read(*x))[1])
    assert sorted(map(tuple, triples.pruned_counts(spark, base).collect())) == want and len(reads) == 1


def test_known_facts_are_mapped_and_counts_are_made_in_the_workers(spark, tables, tmp_path, monkeypatch):
    """Arrays written in small pieces say the same as facts held in memory; a worker maps them. Statistics take no rows out of the workers."""
    import random

    import numpy as np

    from symposia.operators import rounds

    r = random.Random(4)
    rows = sorted({(r.randrange(16), r.choice(rounds.NAMES), r.randrange(16)) for _ in range(400)})
    facts = spark.createDataFrame([(s, rounds.CODE[p], o, r.choice([0.5, 0.62, 0.9]), k, None, True) for k, (s, p, o) in enumerate(rows)], "s bigint, p int, o bigint, c double, k bigint, late string, fresh boolean")
    base, ids = runtime.cut(facts), runtime.cut(spark.createDataFrame([(k, f"n{k}") for k in range(16)], "id bigint, name string"))
    work, made = spark.range(0, 2, 1, 2), "s bigint, p int, o bigint, c double, r int, k bigint"
    new = runtime.cut(work.mapInArrow(rounds.run((runtime.located(base),), 2, rounds.keyed(runtime.located(ids), 1)), made))
    tables_of = runtime.located(base), runtime.located(new)
    monkeypatch.setattr(rounds, "READ", 7)
    rounds.lay(f"file://{tmp_path}/laid", runtime.located(ids), *tables_of)
    held, mapped = rounds.Known(*tables_of), rounds.Laid(f"file://{tmp_path}/laid")
    told = lambda known: [(s, p, known.ids[o].tolist(), c.tolist(), order) for s, p, o, c, order in rounds.derived(known, 0, 1)]
    assert new.count() and told(mapped) == told(held) and len(told(held)) > 20
    assert isinstance(mapped.list("relatedTo", "out").other.base, np.memmap) and mapped.list("relatedTo", "out").other.itemsize + mapped.list("relatedTo", "out").c.itemsize < 7
    base = tables(relations=[{"uri": f"u{k}", "source": f"http://x/{k}", "target": f"http://x/{k + 1}", "relation": "uses", "confidence": 0.9} for k in range(4)])
    monkeypatch.setattr(reasoning.Inferred, "_told", lambda *_: pytest.fail("counts need no rows"))
    assert {tuple(x) for x in reasoning.inference_stats(spark, base).collect()} == {("transitive", "uses", 1, 3), ("transitive", "uses", 2, 3)}


def test_contradictions_are_told_by_number(spark, tables, monkeypatch):
    """``b`` is said to violate what it complies with by inference only, ``x`` violates ``y`` alone; nothing else is named."""
    said = [("a", "violates", "b"), ("b", "relatedTo", "c"), ("a", "compliesWith", "c"), ("b", "relatedTo", "d"), ("x", "violates", "y"), ("a", "supports", "b"), ("a", "opposes", "b")]
    base = tables(relations=[{"uri": f"u{k}", "source": f"http://x/{s}", "target": f"http://x/{t}", "relation": p, "confidence": 0.9} for k, (s, p, t) in enumerate(said)])
    want = reasoning.conflicts(reasoning.base_relations(spark, base).select("source", "relation", "target").unionByName(reasoning.inferred_relations(spark, base).select("source", "relation", "target"))).collect()
    monkeypatch.setattr(reasoning.Inferred, "_told", lambda *_: pytest.fail("all relations were named"))
    got = reasoning.stated_conflicts(spark, base).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and ("http://x/a", "http://x/c", "compliesWith", "violates", "high") in {tuple(x) for x in got}
