"""Problems 5, 8 and 10: round trips, brute force and held-out accuracy."""

import random

import numpy as np
import pytest

from symposia.llm import pii, pii_model, pii_training, reading, tokens

SHORT = ["", " ", "Hello world", "<|endoftext|> is text", "naïve café 漢字 🙂​\n\n\t x", "a" * 3000, "don't  stop\r\n", "﻿1,234.56", "ab" * 500]


def merges_one_by_one(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        best = min(((ranks.get(parts[k] + parts[k + 1], 1 << 60), k) for k in range(len(parts) - 1)), default=(1 << 60, 0))
        if best[0] == 1 << 60:
            return [ranks[p] for p in parts]
        k = best[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_encoding_equals_merging_one_by_one_and_decodes_back():
    e = tokens.encoder(tokens.vocabulary_path())
    ranks = {e.blob[e.offsets[i] : e.offsets[i + 1]]: i for i in range(e.size)}
    r = random.Random(2)
    texts = SHORT[:5] + ["".join(r.choice("abcdeinorst hÑé漢🙂 \n0123.,'-") for _ in range(r.randint(1, 60))) for _ in range(300)] + ["".join(r.choice("aeinrst") for _ in range(90)) for _ in range(60)]
    for text in texts:
        want = [i for piece in e.pieces(text) for i in merges_one_by_one(piece.encode(), ranks)]
        assert e.encode(text) == want
    for text in SHORT:
        assert e.decode(e.encode(text)) == text
    assert e.encode(None) == e.encode("") == []


def test_encoding_equals_the_public_library():
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    import public_tokenizers as p

    with open(tokens.vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ref = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    e = tokens.encoder(tokens.vocabulary_path())
    assert all(e.encode(t) == ref.encode_ordinary(t) for t in SHORT)


def test_ids_query(spark, tables):
    base = tables(documents=[{"doc_id": 1, "text": None}, {"doc_id": 2, "text": ""}, {"doc_id": 3, "text": "<|endoftext|>"}, {"doc_id": 4, "text": "Hi"}, {"doc_id": 5, "text": "Hi"}])
    got = {r.doc_id: r.ids for r in tokens.p8_ids(spark, base).collect()}
    assert got[1] == got[2] == [] and 50256 not in got[3] and got[4] == got[5] != []
    assert dict(tokens.p8_ids(spark, base).dtypes) == {"doc_id": "bigint", "ids": "array<int>"}
    assert all(r.exact for r in tokens.p8_roundtrip(spark, base).collect())


def test_gradients():
    r = np.random.default_rng(0)
    w = pii_model.start_weights(hidden=6)
    x = r.integers(0, 100, (12, 3)).astype(np.uint8)
    y = np.zeros((12, 3), np.uint8)
    y[3, 0], y[4:7, 0] = 1, 2
    _, g = pii_model.loss_and_gradients(x, y, w)
    for k in w:
        at = np.unravel_index(np.argmax(abs(g[k])), g[k].shape)
        keep, step = w[k][at], 1e-2
        w[k][at] = keep + step
        up, _ = pii_model.loss_and_gradients(x, y, w)
        w[k][at] = keep - step
        down, _ = pii_model.loss_and_gradients(x, y, w)
        w[k][at] = keep
        assert g[k][at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=1e-3)


PLAIN = ["The team looked at the old tool again.", "No one told us about the change.", "Large gaps remain between groups.", "Trust is lost when a rule nobody saw is applied."]


def spans_of(tags):
    starts = [k for k in range(len(tags)) if tags[k] and pii_model.TAGS[tags[k]][0] == "B"]
    ends = [next((e for e in range(k + 1, len(tags)) if tags[e] != tags[k] + 1), len(tags)) for k in starts]
    return {(k, e, pii_model.TAGS[tags[k]][2:]) for k, e in zip(starts, ends, strict=True)}


@pytest.mark.parametrize("side,least", [(0, 0.95), (1, 0.9)])
def test_held_out_accuracy(side, least):
    """Side 1: sentences, given names, streets, towns and hosts that training never uses; side 0: seeds it never uses."""
    r = pii_training.Source(987_654_321)
    r.side = side
    hits = wrong = missed = 0
    for _ in range(150):
        text, tags = pii_training.labelled_text(r, PLAIN, 400)
        want, got = spans_of(tags), set(pii.find_items([text])[0])
        hits, wrong, missed = hits + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert hits / (hits + wrong) > least and hits / (hits + missed) > least


def test_training_texts_do_not_stand_in_the_tables():
    import ast
    import inspect
    import os
    import re

    import pyarrow.parquet as pq

    base = "/root/testdata/sf0.1"
    if not os.path.exists(base):
        pytest.skip("the tables are not here")
    listed = [x for pair in (pii_training.GIVEN, pii_training.STREETS, pii_training.TOWNS, pii_training.HOSTS) for side in pair for x in side]
    found = [n.value for n in ast.walk(ast.parse(inspect.getsource(pii_training))) if isinstance(n, ast.Constant) and isinstance(n.value, str) and n.value.count(" ") < 20]
    parts = {p.strip() for x in [*found, *listed] for p in re.split(r"\{\}|\n", x)}
    parts = {p for p in parts if len(p) >= 12 and not re.fullmatch(r"[\w.]+", p)}
    tables = "\n".join(x for t, c in (("answers", "body"), ("experts", "bio")) for x in pq.read_table(f"{base}/{t}.parquet", columns=[c]).column(0).to_pylist() if x)
    assert [p for p in parts if p in tables] == []


def test_windows_do_not_depend_on_their_batch_nor_on_blocks(monkeypatch):
    r = pii_training.Source(5)
    texts = [pii_training.labelled_text(r, PLAIN, n)[0] for n in (5, 300, 700, 2900)]
    together = pii.find_items(texts)
    assert [pii.find_items([t])[0] for t in texts] == together
    monkeypatch.setattr(pii, "LONG_CHARS", 100)
    assert pii.find_items(texts) == together


def test_windows_and_redaction():
    mail = "Contact: rosa.tibolund@mail.example now. "
    for pad in (0, 100, 190, 215, 240, 255, 400):
        text = ("The team looked at the old tool again. " * 20)[:pad] + " " + mail + "We saw it twice. " * 40
        at = text.index("rosa")
        assert (at, at + 26, "email") in pii.find_items([text])[0]
    text = "Call 212-555-0142 before noon. " + "word " * 5000
    items = pii.find_items([text, "", "  "])
    assert pii.redact(text, items[0]) == text.replace("212-555-0142", "[PHONE]") and items[1] == items[2] == []


def test_pii_query(spark, tables):
    base = tables(experts=[{"id": 1, "bio": "Thanks to Margaret Bolitrund for the notes."}, {"id": 2, "bio": None}], answers=[{"id": 1, "body": "Letters for 33, Mallowby Road, Pellingsea HZ10 4QQ came back."}, {"id": 2, "body": " "}])
    got = {tuple(r) for r in pii.p5_found(spark, base).collect()}
    assert got == {("experts", 1, 10, 28, "name"), ("answers", 1, 12, 12 + len("33, Mallowby Road, Pellingsea HZ10 4QQ"), "address")}
    new = {(r.origin, r.record_id): r.text for r in pii.p5_redacted(spark, base).collect()}
    assert new[("experts", 1)] == "Thanks to [NAME] for the notes." and new[("answers", 2)] == " " and new[("experts", 2)] is None


def test_english():
    assert reading.english("It was the first time that we had seen this.")
    assert not reading.english("Der Ausschuss hat das Verfahren untersucht und empfiehlt es nicht.")
    assert not reading.english("使用评分模型之前应当说明数据来源。 the of and")
    assert not reading.english(None) and not reading.english("") and not reading.english("12 34")


def graded(spark, n=120):
    r = random.Random(5)
    words = {"basic": "cat dog sun run play ball tree home", "intermediate": "policy review report sample result process", "advanced": "epistemic normative hermeneutic jurisprudence taxonomy proportionality"}
    docs, labels = [], []
    for i in range(n):
        band = r.choice(list(words))
        text = "the of and to a in " + " ".join(r.choice(words[band if r.random() < 0.9 else r.choice(list(words))].split()) for _ in range(70))
        docs.append((i, text, 400, band))
        if i % 3 == 0:
            labels += [(i, r.choice([band, band.title() + " "])), (i, band)]
    labels += [(0, None), (1, "unknown"), (None, "basic"), (99999, "basic")]
    return spark.createDataFrame(docs, "doc_id long, text string, n_chars long, truth string"), spark.createDataFrame(labels, "doc_id long, band string")


def test_levels_on_held_out_documents(spark):
    docs, labels = graded(spark)
    found = reading.reading_levels(docs, labels).join(docs, "doc_id").collect()
    held = [r for r in found if r.doc_id % 3]
    assert len(found) == 120 and sum(r.band == r.truth for r in held) / len(held) > 0.95


def test_difficulty_is_harmonic(spark, monkeypatch):
    """Against plain rounds until nothing moves, on a small graph in one process."""
    monkeypatch.setattr(reading, "TOLERANCE", 1e-7)
    docs, labels = graded(spark, 60)
    got = {r.doc_id: r.difficulty for r in reading.reading_levels(docs, labels).collect()}
    places, grade = reading.Places(), {r.doc_id: r.grade for r in reading.grades(labels).collect()}
    lists = {r.doc_id: reading.terms(r.text, places) for r in docs.collect()}
    df = np.zeros(reading.WORD_BUCKETS)
    for ids, _ in lists.values():
        df[ids] += 1
    weight = np.where(df > 1, np.log(len(lists) / np.maximum(df, 1)), 0.0)
    mean = float(np.mean([g for d, g in grade.items() if d in lists]))
    score, own = np.full(len(df), mean), {}
    for _ in range(3000):
        total, hits = np.zeros(len(df)), np.zeros(len(df))
        for d, (ids, n) in lists.items():
            w = weight[ids] * np.sqrt(n)
            own[d] = float((w * score[ids]).sum() / w.sum())
            total[ids] += np.sqrt(n) * grade.get(d, own[d])
            hits[ids] += np.sqrt(n)
        score = np.where(hits > 0, total / np.maximum(hits, 1e-9), mean)
    assert all(got[d] == pytest.approx(own[d], abs=5e-4) for d in lists)


def test_level_query_edges(spark, tables):
    text = "the of and to a in " + "cat dog sun " * 40
    base = tables(
        documents=[{"doc_id": 1, "text": text, "n_chars": len(text)}, {"doc_id": 2, "text": text, "n_chars": len(text)}, {"doc_id": 3, "text": "the cat and the dog", "n_chars": 19}, {"doc_id": 4, "text": None, "n_chars": None}, {"doc_id": 5, "text": "der die das " * 40, "n_chars": 480}],
        reading_labels=[{"doc_id": 1, "band": "Basic"}, {"doc_id": 1, "band": "basic"}],
    )
    assert {r.doc_id for r in reading.p10_found(spark, base).collect()} == {1, 2}
