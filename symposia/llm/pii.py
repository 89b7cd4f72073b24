"""Personal information inside free text (problem 5).

A character-level bidirectional LSTM scores the tags of every character; a CRF over all characters of a text decides.
Texts are read in windows of ``WINDOW`` characters that overlap by ``OVERLAP``; each character takes its scores from
the window in which it lies farther from the edge, and one Viterbi pass over the whole text reconciles the windows,
so an item across a border is found once and whole. Items are then trimmed of white space and punctuation that is not
theirs and end at word borders; what cannot be an item of its kind is dropped: an e-mail address without an at-sign, a
phone number of fewer than 7 or more than 16 digits, an identity number of fewer than 5 digits, an address without a
digit, a word and ``ADDRESS_PARTS`` parts (street and town, set apart by a comma or a line end), a name of one word or with a digit. The model is trained in ``pii_training``; its weights come with the package.

The step is narrow (only a scan of few splits is spread first), batches are bounded by characters, not by rows, and
whole texts are read however long: beyond ``LONG_CHARS`` a text is scored and decoded block by block, with the same
result. Windows are computed in batches of one fixed width, each from its own first character, so that an item does not
depend on what is read beside it. Defined results: null, empty and blank texts have no items; equal texts have equal
items; offsets count code points of the text as stored. ``redact`` replaces each item by its placeholder and leaves
every other character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.llm.pii_model import N_TAGS, PAD, TAGS, encode, scores, viterbi, viterbi_blocks, weights
from symposia.runtime import read, spread

WINDOW, OVERLAP, BATCH = 512, 64, 128
CHUNK_CHARS = 300_000
#: A text longer than this is scored and decoded in blocks, which gives the same tags.
LONG_CHARS = 2_000_000
ADDRESS_PARTS = 2
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}
_TRIM_LEFT = " \t\r\n\"'“”‘’<>([{,;:.!?|—–-=*/ "
_TRIM_RIGHT = " \t\r\n\"'“”‘’<>([{,;:!?|—–-=*/ "
_TITLE = re.compile(r"(?:(?:dr|prof|mr|mrs|ms|mx|miss|professor|doctor|sir)\b\.?\s+)+", re.I)
_INITIAL_END = re.compile(r"(?:^|[\s.])[^\W\d_]$")


def _windows(n: int) -> list[tuple[int, int]]:
    """(start, length) of the windows of a text of ``n`` characters."""
    out, at = [], 0
    while at + WINDOW < n:
        out.append((at, WINDOW))
        at += WINDOW - OVERLAP
    return [*out, (at, n - at)]


def _fill(windows: list[tuple[int, int, int]], codes: list[np.ndarray], out: list[np.ndarray], base: int, w: dict[str, np.ndarray]) -> None:
    """Write the scores of (length, text, start) windows, each in its part of the text, into ``out`` from ``base`` on.

    Every batch has BATCH columns, filled or not, and each direction starts at the window's own first character, so the
    sums of a window do not depend on what is read beside it."""
    windows.sort()
    for b in range(0, len(windows), BATCH):
        part = windows[b : b + BATCH]
        steps = part[-1][0] + part[-1][0] % 2
        x, y = np.full((steps, BATCH), PAD, np.uint8), np.full((steps, BATCH), PAD, np.uint8)
        for j, (n, k, at) in enumerate(part):
            m = n + n % 2
            x[:n, j] = codes[k][at : at + n]
            y[:m, j] = x[:m, j].reshape(-1, 2)[::-1].reshape(-1)
        forward, backward = scores(x, y, w)
        for j, (n, k, at) in enumerate(part):
            m = (n + n % 2) // 2
            e = (forward[:m, j] + backward[:m, j][::-1]).reshape(-1, N_TAGS)
            head = OVERLAP // 2 if at else 0
            tail = n if at + n == len(codes[k]) else n - OVERLAP // 2
            out[k][at + head - base : at + tail - base] = e[head:tail]


def _tags(codes: list[np.ndarray], w: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Tags of every character of every text; scores are stitched from overlapping windows, then decoded as one sequence."""
    tags: list[np.ndarray] = [np.empty(0, np.uint8)] * len(codes)
    short = [k for k, c in enumerate(codes) if 0 < len(c) <= LONG_CHARS]
    out = {k: np.empty((len(codes[k]), N_TAGS), np.float32) for k in short}
    _fill([(n, k, at) for k in short for at, n in _windows(len(codes[k]))], codes, out, 0, w)
    order, b = sorted(short, key=lambda k: len(codes[k])), 0
    while b < len(order):
        # neighbours of like length together; long texts in smaller company
        part = order[b : b + max(1, min(128, CHUNK_CHARS // len(codes[order[b]])))]
        b += len(part)
        lengths = np.array([len(codes[k]) for k in part])
        e = np.zeros((lengths[-1], N_TAGS, len(part)), np.float32)
        for j, k in enumerate(part):
            e[: lengths[j], :, j] = out[k]
        best = viterbi(e, lengths, w)
        for j, k in enumerate(part):
            tags[k] = best[: lengths[j], j]
    for k, c in enumerate(codes):
        if len(c) > LONG_CHARS:
            tags[k] = viterbi_blocks(_score_blocks(c, w), w)
    return tags


def _score_blocks(code: np.ndarray, w: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
    """The scores of one very long text, a few batches of windows at a time."""
    windows = _windows(len(code))
    for b in range(0, len(windows), 4 * BATCH):
        part = windows[b : b + 4 * BATCH]
        first = part[0][0] + (OVERLAP // 2 if part[0][0] else 0)
        last = len(code) if b + 4 * BATCH >= len(windows) else part[-1][0] + part[-1][1] - OVERLAP // 2
        block = np.empty((last - first, N_TAGS), np.float32)
        _fill([(n, 0, at) for at, n in part], [code], [block], first, w)
        yield block


def _checked(text: str, start: int, end: int, kind: str) -> tuple[int, int, str] | None:
    """The exact extent of a found item, or None where it cannot be one."""
    # out to the borders of the words it begins and ends in
    while start > 0 and text[start].isalnum() and text[start - 1].isalnum():
        start -= 1
    while end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
        end += 1
    left = _TRIM_LEFT if kind != "phone" else _TRIM_LEFT.replace("(", "")
    while start < end and text[start] in left:
        start += 1
    if kind == "name" and (title := _TITLE.match(text, start, end)) and title.end() < end:
        start = title.end()
    while end > start:
        last = text[end - 1]
        body = text[start:end]
        if last == ".":
            if kind == "name" and _INITIAL_END.search(body[:-1]):
                break
            end -= 1
        elif last in ")]}":
            if body.count("([{"[")]}".index(last)]) >= body.count(last):
                break
            end -= 1
        elif last in _TRIM_RIGHT:
            end -= 1
        else:
            break
    if kind == "name" and end < len(text) and text[end] == "." and _INITIAL_END.search(text[start:end]):
        end += 1
    if start >= end:
        return None
    body = text[start:end]
    n_digits = sum(c.isdigit() for c in body)
    if kind == "email":
        good = bool(re.search(r"\S\s?(?:@|\(at\)|\[at\])\s?\S", body, re.I)) and len(body) > 5
    elif kind == "phone":
        good = 7 <= n_digits <= 16
        if body.startswith("(") and ")" not in body:
            start += 1
    elif kind == "id_number":
        good = n_digits >= 5 and len(body) >= 7
    elif kind == "address":
        good = n_digits >= 1 and len(body) >= 8 and len(re.findall(r"[^\W\d_]{3,}", body)) >= 1 and body.count(",") + body.count("\n") + 1 >= ADDRESS_PARTS
    else:
        words = re.findall(r"[^\W\d_]+", body)
        good = len(words) >= 2 and n_digits == 0 and max(map(len, words)) >= 3 and "@" not in body
    return (start, end, kind) if good else None


def find_items(texts: list[str], w: dict[str, np.ndarray] | None = None) -> list[list[tuple[int, int, str]]]:
    """Per text: (start, end, kind) of its personal items, in order, not overlapping."""
    w = w or weights()
    codes = [encode(t) for t in texts]
    tags = _tags(codes, w)
    out = []
    for text, seq in zip(texts, tags, strict=True):
        items: list[tuple[int, int, str]] = []
        marked = np.flatnonzero(seq)
        if len(marked):
            begins = [int(i) for i in marked if TAGS[seq[i]][0] == "B"]
            for s in begins:
                e = s + 1
                while e < len(seq) and seq[e] and TAGS[seq[e]][0] == "I":
                    e += 1
                item = _checked(text, s, e, TAGS[seq[s]][2:])
                if item and (not items or item[0] >= items[-1][1]):
                    items.append(item)
        out.append(items)
    return out


def redact(text: str, items: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for start, end, kind in items:
        parts += [text[at:start], PLACEHOLDER[kind]]
        at = end
    return "".join([*parts, text[at:]])


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts of a batch, at most ``CHUNK_CHARS`` characters (or one text) at a time."""
    rows, texts, chars = [], [], 0
    for k, value in enumerate(batch.column(column)):
        text = value.as_py()
        if not text or text.isspace():
            continue
        if rows and chars + len(text) > CHUNK_CHARS:
            yield rows, texts
            rows, texts, chars = [], [], 0
        rows.append(k)
        texts.append(text)
        chars += len(text)
    if rows:
        yield rows, texts


def items(texts: DataFrame) -> DataFrame:
    """(origin, record_id, start_char, end_char, pii_type) of (origin, record_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in _chunks(batch, 2):
                found = [(row, *item) for row, spans in zip(rows, find_items(part), strict=True) for item in spans]
                at = pa.array([x[0] for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()), pa.array([x[3] for x in found], pa.string())],
                    names=["origin", "record_id", "start_char", "end_char", "pii_type"],
                )

    schema = "origin string, record_id bigint, start_char bigint, end_char bigint, pii_type string"
    return texts.select("origin", F.col("record_id").cast("bigint").alias("record_id"), "text").mapInArrow(run, schema)


def redacted(texts: DataFrame) -> DataFrame:
    """(origin, record_id, text, items): every text with its items replaced; texts without items as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, counts = batch.column(2).to_pylist(), [0] * batch.num_rows
            for rows, part in _chunks(batch, 2):
                for row, text, spans in zip(rows, part, find_items(part), strict=True):
                    new[row], counts[row] = redact(text, spans), len(spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(new, pa.string()), pa.array(counts, pa.int32())], names=["origin", "record_id", "text", "items"])

    return texts.select("origin", F.col("record_id").cast("bigint").alias("record_id"), "text").mapInArrow(run, "origin string, record_id bigint, text string, items int")


def free_text(spark: SparkSession, base: str) -> DataFrame:
    bios = read(spark, base, "experts").select(F.lit("experts").alias("origin"), F.col("id").alias("record_id"), F.col("bio").alias("text"))
    bodies = read(spark, base, "answers").select(F.lit("answers").alias("origin"), F.col("id").alias("record_id"), F.col("body").alias("text"))
    return spread(bios.unionByName(bodies), "origin", "record_id")


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return items(free_text(spark, base)).distinct()


def p5_redacted(spark: SparkSession, base: str) -> DataFrame:
    return redacted(free_text(spark, base))


ORACLE: dict[str, str] = {}
