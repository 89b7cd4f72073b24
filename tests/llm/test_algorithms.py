"""Problems 1, 2, 3, 4, 7 and 9 on small tables, with nulls, repeats, ties, empty tables and clashing columns."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from symposia import runtime
from symposia.llm import components, cooccurrence, mixing, names, queries, splitting, survivors


def test_every_query_runs_on_empty_tables_and_null_rows(spark, tables):
    empty = tables()
    nulls = tables(**{t: [{}, {}] for t in ("themes", "questions", "answers", "votes", "experts", "deletions", "entities", "relations", "link_decisions", "documents", "reading_labels", "mix_targets")})
    for name, run in queries.QUERIES.items():
        assert run(spark, empty).count() == 0, name
        rows = run(spark, nulls).collect()
        if not name.startswith(("p5_redacted", "p8")):
            assert rows == [], name


# --- 1: splitting


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .,\n!é漢", min_size=50, max_size=400), st.integers(20, 60))
def test_pieces_cover_the_text_within_the_limit(text, limit):
    overlap = limit // 6
    pieces = splitting.split(text, limit, overlap)
    if len(text) > limit:
        assert len(pieces) > 1
    assert pieces[0][1] == 0 and pieces[-1][2] == len(text)
    for (s, b, e, _), nxt in zip(pieces, [*pieces[1:], None], strict=True):
        assert 0 < e - s <= limit and s <= b < e
        if nxt:
            assert nxt[1] == e and e - nxt[0] <= overlap


def test_cuts_fall_on_paragraphs_where_there_are_any():
    text = "\n\n".join("Sentence one here. Sentence two here." for _ in range(60))
    pieces = splitting.split(text, 600, 60)
    assert all(text[:e].endswith("\n\n") for _, _, e, _ in pieces[:-1])
    assert all(40 <= prev[2] - nxt[0] <= 60 for prev, nxt in zip(pieces, pieces[1:], strict=False))


def brute(text, limit, overlap):
    spots, cost = splitting.boundaries(text, limit - overlap)
    n, even = len(text), len(text) / -(-max(1, len(text) - overlap) // (limit - overlap))
    best = {0: 0.0}
    for j, at in enumerate(spots):
        ways = [best[p] + cost[j] + ((at - p - even) / even) ** 2 for p in best if p < at and (at - p <= limit - overlap or (p == 0 and at <= limit))]
        if ways:
            best[int(at)] = min(ways)
    return best[n]


def test_programme_is_optimal():
    r = random.Random(4)
    for _ in range(40):
        text = "".join(r.choice(["word ", "sentence. ", "clause, ", "long" * 9, "\n", "\n\n"]) for _ in range(60))
        pieces = splitting.split(text, 120, 20)
        even = len(text) / -(-(len(text) - 20) // 100)
        got = sum(c + ((e - b - even) / even) ** 2 for _, b, e, c in pieces)
        assert got == pytest.approx(brute(text, 120, 20))


def test_oversized_items(spark, tables):
    base = tables(
        answers=[{"id": 1, "body": " " * 40 + "a" * 1200 + "\n"}, {"id": 2, "body": "a" * 1201}, {"id": 2, "body": "a" * 1201}, {"id": 3, "body": "w " * 200_000}, {"id": 4, "body": ""}],
        entities=[{"uri": "u", "metadata": {"x": "b c " * 200, "y": "short", "z": None}}, {"uri": "u", "metadata": {"x": "b c " * 200}}],
    )
    got = {tuple(r) for r in splitting.p1_found(spark, base).collect()}
    assert got == {("answers", "2", "body"), ("answers", "3", "body"), ("entities", "u", "x")}
    long = [r for r in splitting.p1_pieces(spark, base).collect() if r.item_key == "3"]
    assert max(len(r.text) for r in long) <= 1200 and max(r.end for r in long) == 399_999


# --- 2: names


def links(spark, tables, labels, kind="Person"):
    rows = [{"uri": f"u{i:03}", "label": x, "entity_type": kind} for i, x in enumerate(labels)]
    found = names.p2_found(spark, tables(entities=rows)).collect()
    return {tuple(sorted((labels[int(r.left_id[1:])], labels[int(r.right_id[1:])]))) for r in found}


def test_people(spark, tables):
    same = ["Margaret Bolitrund", "Bolitrund, Margaret", "BOLITRUND, M.", "Dr. Peggy Bolitrund", "Margaret K. Bolitrund", "M.K. Bolitrund", "Margaret Bolitrudn", "Margret  Bolítrund *", "MargaretBolitrund", "Ｍargaret Bolitrund"]
    other = ["Anthony Bolitrund", "Margaret Vesokal", None, "", "  ", "Dr."]
    got = links(spark, tables, same + other)
    assert got == {tuple(sorted((a, b))) for a in same for b in same if a < b}


def test_organisations(spark, tables):
    same = ["Vukuhub Centre for Child Safety", "The Vukuhub Ctr f. Child Safety", "Child Safety Center Vukuhub", "Vukuhub-Centre (CS)", "Vukuhub Child Safety", "Vukuhbu Centre for Child Safety Ltd.", "Centre for Child Safety, Vukuhub"]
    other = ["Vukuhub Institute for Risk Assessment", "Mipume Centre for Child Safety"]
    got = links(spark, tables, same + other, "org:Organization")
    assert got == {tuple(sorted((a, b))) for a in same for b in same if a < b}


def test_typing_errors():
    assert [names.typing_errors(*x) for x in (("abc", "abc"), ("abcd", "abdc"), ("abc", "abcx"), ("abc", "axc"), ("abc", "xyz"))] == [0, 1, 1, 1, 3]


def test_a_frequent_spelling_is_nobodys_slip(spark, tables):
    labels = ["Robert Zamunoka"] * 5 + ["Robert Zamunoko"] * 5
    rows = [{"uri": f"u{i}", "label": x, "entity_type": "person"} for i, x in enumerate(labels)]
    found = names.p2_found(spark, tables(entities=rows)).collect()
    assert len(found) == 20


@pytest.mark.parametrize("slips,copies,linked", [(5, 300, True), (3, 60, True), (20, 60, False)])
def test_a_slip_of_a_far_more_frequent_name_may_recur(spark, tables, slips, copies, linked):
    labels = ["Robert Zamunoka"] * copies + ["Robert Zamunoko"] * slips
    rows = [{"uri": f"u{i}", "label": x, "entity_type": "person"} for i, x in enumerate(labels)]
    sizes = {r.records for r in names.p2_groups(spark, tables(entities=rows)).collect()}
    assert sizes == ({slips + copies} if linked else {slips, copies})


# --- 3: components


@pytest.mark.parametrize("rows_per_task", [1_000_000, 4])
def test_components_match_brute_force(spark, rows_per_task):
    r = random.Random(7)
    edges = [(f"n{r.randrange(150):03}", f"n{r.randrange(150):03}") for _ in range(110)] + [("n000", "n001"), ("n000", "n001"), ("z", "z")]
    up = {}
    for a, b in edges:
        up.setdefault(a, {a}), up.setdefault(b, {b})
        if up[a] is not up[b]:
            merged = up[a] | up[b]
            for x in merged:
                up[x] = merged
    df = spark.createDataFrame(edges, "a string, b string").repartition(9)
    got = {x.node: x.component for x in components.components(df, rows_per_task).collect()}
    assert got == {x: min(g) for x, g in up.items()}


def test_long_chain(spark):
    df = spark.range(3000).selectExpr("lpad(id, 5, '0') a", "lpad(id + 1, 5, '0') b").repartition(13)
    assert {x.component for x in components.components(df, 50).select("component").distinct().collect()} == {"00000"}


def test_groups_of_decisions(spark, tables):
    base = tables(
        link_decisions=[
            {"decision_id": "1", "chosen_canonical_uri": " b ", "source_ids": ["c", None, ""], "rule": "fuzzy"}, {"decision_id": "1", "chosen_canonical_uri": "b", "source_ids": ["c"], "rule": "fuzzy"},
            {"decision_id": "2", "chosen_canonical_uri": None, "source_ids": ["c", "a"]}, {"decision_id": "3", "chosen_canonical_uri": "x", "source_ids": []}, {"decision_id": "4"},
        ],
        entities=[{"uri": "x"}, {"uri": "c"}, {"uri": "q"}, {"uri": "q"}],
    )
    assert {tuple(r) for r in components.p3_found(spark, base).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
    assert {tuple(r) for r in components.p3_groups(spark, base).collect()} == {("x", "x"), ("c", "a"), ("q", "q")}


# --- 4: co-occurrence


@pytest.mark.parametrize("block", [2, 256])
def test_pairs_match_brute_force(spark, block):
    r = random.Random(3)
    rows = [(f"r{r.randrange(60)}", f"i{min(int(r.expovariate(0.3)), 12)}") for _ in range(700)] + [(None, "i1"), ("r1", None)]
    records = {}
    for rec, item in rows:
        if rec and item:
            records.setdefault(rec, set()).add(item)
    n = len(records)
    count = lambda *xs: sum(all(x in s for x in xs) for s in records.values())
    every = sorted({x for s in records.values() for x in s})
    want = {(a, b, count(a, b)) for a in every for b in every if a < b and count(a, b) >= 2 and count(a, b) * n >= 1 * count(a) * count(b)}
    out = cooccurrence.pair_scores(spark.createDataFrame(rows, "record string, item string"), 2, 1, block)
    assert {(x.item_a, x.item_b, x.n_ab) for x in out.collect()} == want


def test_record_keys(spark, tables):
    meta = [{"origin_key": " Answers|7 "}, {"section": "ANSWERS", "discourse_id": " 7"}, {"origin_key": "x"}, None]
    base = tables(entities=[{"uri": "u", "metadata": m} for m in meta] + [{"uri": " ", "metadata": meta[0]}])
    assert {(r.record, r.item) for r in cooccurrence.entity_baskets(spark, base).collect()} == {("answers|7", "u"), (None, "u")}


# --- 7: survivors


def test_survivor_choice_and_filling(spark, tables):
    nan = float("nan")
    rows = [
        {"uri": "b", "source": " s", "target": "t", "relation": "has_Risk", "confidence": 0.9001, "is_inferred": None, "context": None, "doc_id": "", "metadata": {"extractor": "llm"}},
        {"uri": "c", "source": "s", "target": "t ", "relation": "hasRisk", "confidence": 0.9, "is_inferred": False, "context": "from c", "doc_id": "9", "metadata": {"extractor": "lightweight"}},
        {"uri": "a", "source": "s", "target": "t", "relation": "HAS RISK", "confidence": 0.9, "is_inferred": True, "context": "from a", "metadata": {"extractor": "manual"}},
        {"uri": "z", "source": "s", "target": "t", "relation": "hasRisk", "confidence": 87.0}, {"uri": "y", "source": "s", "target": "t", "relation": "hasRisk", "confidence": nan},
        {"uri": "m", "source": "m", "target": "t", "relation": "x", "confidence": nan, "is_inferred": True}, {"uri": "n", "source": "m", "target": "t", "relation": "x", "confidence": 1.2}, {"uri": "o", "source": "m", "target": "t", "relation": "x"},
        {"uri": "d", "source": "d", "target": "t", "relation": "x"}, {"uri": "d", "source": "d", "target": "t", "relation": "x", "confidence": 0.5}, {"uri": "e", "source": "", "target": "t", "relation": "x"},
    ]
    base = tables(relations=rows)
    assert {tuple(r) for r in survivors.p7_found(spark, base).collect()} == {("s", "t", "hasrisk", "b"), ("m", "t", "x", "n")}
    kept = {r.survivor_uri: r for r in survivors.p7_survivors(spark, base).collect()}
    assert kept["b"].context == "from a" and kept["b"].doc_id == "9" and kept["b"].rivals == 5 and kept["n"].confidence is None


def test_fields_of_a_redelivered_survivor_stay(spark, tables):
    rows = [{"uri": "a", "source": "s", "target": "t", "relation": "r", "confidence": 0.9}, {"uri": "a", "source": "s", "target": "t", "relation": "r", "confidence": 0.8, "context": "own"}, {"uri": "b", "source": "s", "target": "t", "relation": "r", "confidence": 0.85, "context": "other", "metadata": {"extractor": "manual"}}]
    assert survivors.p7_survivors(spark, tables(relations=rows)).first().context == "own"


def test_more_groups_than_a_broadcast_holds(spark, tables, monkeypatch):
    """The spread join hashes whole rows, metadata among them."""
    rows = [{"uri": f"{g}{k}", "source": f"s{g}", "target": "t", "relation": "r", "confidence": k / 10, "metadata": {"extractor": "llm"}} for g in range(5) for k in range(3)]
    base = tables(relations=rows)
    monkeypatch.setattr(survivors, "lookup", lambda facts, table, on, how: runtime.salted_join(facts, table, on, how, rows_per_task=1))
    assert {tuple(r) for r in survivors.p7_found(spark, base).collect()} == {(f"s{g}", "t", "r", f"{g}2") for g in range(5)}


# --- 9: mixing


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=60), st.floats(0.01, 0.99))
def test_flight_and_landing_keep_totals(sizes, share):
    size = np.array(sizes, float)
    chance = np.full(len(size), share)
    p = mixing.flight(chance, size)
    assert p.sum() == pytest.approx(chance.sum(), abs=1e-6) and (p * size).sum() == pytest.approx((chance * size).sum(), rel=1e-6)
    assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2
    done = mixing.landing(p, size)
    assert set(done) <= {0.0, 1.0} and abs((done * size).sum() - (chance * size).sum()) <= size.max()


def test_mixture(spark):
    docs = spark.createDataFrame([(i, "big", 50 + i % 7) for i in range(900)] + [(1000 + i, "small ", 40 + i) for i in range(20)] + [(2000, None, 5), (2001, "other", 9), (2002, "big", 0)], "unit long, source string, tokens long")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("none", 0.2, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats long")
    for block in (mixing.BLOCK_ROWS, 50):
        mixture, plan = mixing.mix(docs, targets)
        units = {r.unit: (r.source, r.tokens, r.copies) for r in mixture.collect()}
        got = {s: sum(t * c for x, t, c in units.values() if x == s) for s in ("big", "small")}
        assert set(x for x, _, _ in units.values()) == {"big", "small"}
        assert got["big"] / sum(got.values()) == pytest.approx(0.625, abs=0.01) and max(c for _, _, c in units.values()) <= 3
        assert {r.source: round(r.share, 3) for r in plan.collect()} == {"big": 0.625, "small": 0.375, "none": 0.0}
        fractional = docs.where("source = 'big'").selectExpr("unit", "source", "tokens", "0L certain", "0.37 chance")
        picked = mixing.balanced_copies(fractional, block)
        assert picked.count() == 901 and abs(picked.selectExpr("sum(copies)").first()[0] - 0.37 * 901) <= 1.5
