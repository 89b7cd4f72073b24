"""Reading level of each document (problem 10).

Documents and the words they use are the two sides of a graph. Documents that people graded are clamped to their
grade (basic 0, intermediate 1, advanced 2; the median of several raters), and difficulty spreads over the edges until
it is harmonic: a word is as difficult as the mean of the documents that use it, a document as the mean of its words,
rarer words weighing more and repeated ones by the root of their number, so that a long text counts by what fills it. The two cuts between the bands are then put where they agree best with all graded
documents, judged by what their words alone say of them.

Words are numbered by a hash into ``WORD_BUCKETS`` places, so a document needs no shuffle to find its words' numbers and
what travels between two rounds is one array of fixed size, however large the corpus and its vocabulary are; the few
words that share a place share a difficulty. One round is one pass over the documents' word lists: scores of words go out,
partial sums per word come back. Rounds end when no difficulty moves by ``TOLERANCE`` any more (root mean square over
all uses of words); should that not come about in ``MOST_ROUNDS``, an error says what is left.

Which documents are English is told from their words, not from ``lang``: every line or sentence is given to the
language whose function words it holds most of, letters of other scripts count against English, and more than half
of the letters that could be told must be English.

Defined results: null and blank texts are in no language and get no band; a document without a word known from
another one gets the mean difficulty; unknown bands are left out; without any grade there are no bands (no rows);
ties between languages fall to English, equally good cuts to the middle of the lowest such stretch.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.runtime import cut, drop, lookup, read, spread

GRADES = {"basic": 0.0, "intermediate": 1.0, "advanced": 2.0}
LEAST_CHARS = 300
WORD_BUCKETS = 1 << 20
MOST_ROUNDS, TOLERANCE = 200, 1e-4
#: Earlier points that a round is mixed from.
MEMORY = 4
BINS = 2000

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to a in is it that for was on are with as be by this not or have from at which but they you we he she an their his her its who if when what so no can will do all there has had were been my our your me us them than then must may such these those how why more several between following every during throughout under additional alongside concerning whereas insofar both better against through while within without however moreover some many most other into about after before over only also any each since because although therefore thus notwithstanding itself rather where here very well last first",
    "de": "der die das und ist nicht ein eine einen einer von zu den mit sich des auf für dem im als auch es an werden aus er hat dass sie nach wird bei um am sind noch wie oder über ihre durch wer wenn muss ohne oft weil vor bleibt kann keine wir ich zur zum nur haben wurde",
    "fr": "le la les de des du et un une est que qui dans en pour pas au aux ce sur par avec il elle sont ne se ou son ses cette plus nous vous ils mais leur été l d qu s n lorsque avant chaque faut doit peut sans comme être très tout quand je tu",
    "es": "el la los las de del y un una es que en por para con no se al lo como más su sus fue pero son o si cuando quién nadie sobre entre este esta hay ha muy sin todo ya cada vez antes debe puede nos les ser yo tu",
    "it": "il lo gli di del della e un una è che in per con non si al come più su sono ma o se quando nel dei alle questo questa anche ha sul dal",
    "pt": "o os as de do da dos das e um uma é que em por para com não se ao como mais seu sua foi mas são ou quando no na nos sobre este esta há ser muito sem",
    "nl": "de het een en van is dat in te op met niet zijn voor aan er als ook door naar om bij uit dan maar hij zij wordt over of worden geen kan heeft was",
}
#: The languages of each function word as a number: one field of 16 bits a language, so that sums count all at once.
_FIELD = 16
_LANGUAGES = list(FUNCTION_WORDS)
_MARK: dict[str, int] = {}
for _k, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in set(_words.split()):
        _MARK[_w] = _MARK.get(_w, 0) + (1 << (_FIELD * _k))
_SEGMENT = re.compile(r"[\n\r.!?。！？؟|]+")
_WORD = re.compile(r"[^\W\d_]+")
_TERM = re.compile(r"[^\W\d_][^\W\d_'’]+")


def english(text: str | None) -> bool:
    """Whether a text is mainly English."""
    if not text:
        return False
    own = other = 0
    plain, mark, mask = text.isascii(), _MARK, (1 << _FIELD) - 1
    for segment in _SEGMENT.split(text.lower()):
        words = _WORD.findall(segment)
        if not words:
            continue
        letters = sum(map(len, words))
        if not plain:
            foreign = sum([len(w) for w in words if w[0] >= "ɐ"])
            other += foreign
            letters -= foreign
        # a field overflows only where one segment holds 65,536 function words of a language: such a one is read in parts
        for at in range(0, len(words), 60_000):
            part = words if len(words) <= 60_000 else words[at : at + 60_000]
            hits = sum([mark[w] for w in part if w in mark])
            if hits:
                counts = [(hits >> (_FIELD * k)) & mask for k in range(len(_LANGUAGES))]
                if counts[0] >= max(counts):
                    own += letters * len(part) // len(words)
                else:
                    other += letters * len(part) // len(words)
    return own > other


class Places(dict):
    """The place of each word, remembered; words are taken without apostrophes at their ends."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        place = self[word] = zlib.crc32(word.strip("'").encode()) & (WORD_BUCKETS - 1)
        return place


def terms(text: str, places: Places) -> tuple[np.ndarray, np.ndarray]:
    """The places of the words of two letters or more in a text, and how often each is taken."""
    words = _TERM.findall(text.lower().replace("’", "'"))
    return np.unique(np.fromiter(map(places.__getitem__, words), dtype=np.int32, count=len(words)), return_counts=True)


def english_terms(docs: DataFrame) -> DataFrame:
    """(doc_id, ids, times) of the documents written mainly in English."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places()
        for batch in batches:
            keys, ids, times = [], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                text = value.as_py()
                if english(text):
                    found, counts = terms(text, places)
                    keys.append(key.as_py())
                    ids.append(found)
                    times.append(counts.astype(np.int32))
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids[1:]], dtype=np.int64))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), pa.int32())) for x in (ids, times)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *lists], names=["doc_id", "ids", "times"])

    return spread(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id").mapInArrow(run, "doc_id bigint, ids array<int>, times array<int>")


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): median grade of each document's raters."""
    band = F.lower(F.trim("band"))
    value = F.coalesce(*[F.when(band == k, F.lit(v)) for k, v in GRADES.items()])
    rows = labels.select("doc_id", value.alias("grade")).where("grade is not null and doc_id is not null")
    return rows.groupBy("doc_id").agg(F.percentile("grade", F.lit(0.5)).alias("grade"))


def _by_place(rows: DataFrame, names: list[str]) -> list[np.ndarray]:
    """Arrays over all places of the sums of (id, names) rows; at most WORD_BUCKETS rows come to the driver."""
    found = rows.groupBy("id").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    out = []
    for name in names:
        full = np.zeros(WORD_BUCKETS)
        full[found.column("id").to_numpy()] = found.column(name).to_numpy()
        out.append(full)
    return out


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def document_frequencies(graph: DataFrame) -> np.ndarray:
    """In how many documents each place is taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(WORD_BUCKETS, np.int64)
        for batch in batches:
            counts += np.bincount(_flat(batch.column(0)), minlength=WORD_BUCKETS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["id", "n"])

    return _by_place(graph.select("ids").mapInArrow(run, "id int, n bigint"), ["n"])[0]


def harmonic(graph: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(doc_id, grade, score) of documents (doc_id, ids, times, grade): the score its words give a document when difficulty is harmonic."""
    sc = graph.sparkSession.sparkContext
    # a task sends at most one row a place, so a few tasks a core keep what a round moves small
    graph = graph.coalesce(sc.defaultParallelism)
    df, total = document_frequencies(graph), graph.count()
    # words of one document only, and of all, tell nothing
    weight = np.where(df > 1, np.log(total / np.maximum(df, 1)), 0.0)
    mean = graph.where("grade is not null").agg(F.avg("grade")).first()[0]

    def pass_over(score: np.ndarray, graded_only: bool, out: str):
        some = np.flatnonzero(weight).astype(np.int32)
        shared = sc.broadcast((some, score[some], weight[some]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score, weight = np.zeros(WORD_BUCKETS), np.zeros(WORD_BUCKETS)
            places, *values = shared.value
            score[places], weight[places] = values
            sums, hits = (np.zeros(len(weight)), np.zeros(len(weight))) if out == "words" else (None, None)
            for batch in batches:
                ids, lengths = _flat(batch.column(1)), np.diff(batch.column(1).offsets.to_numpy())
                rows = np.repeat(np.arange(len(lengths)), lengths)
                grade = batch.column(3).to_numpy(zero_copy_only=False).astype(float)
                tf = np.sqrt(_flat(batch.column(2)).astype(float))
                w = weight[ids] * tf
                den = np.bincount(rows, w, len(lengths))
                own = np.where(den > 0, np.bincount(rows, w * score[ids], len(lengths)) / np.where(den > 0, den, 1), mean)
                if out == "docs":
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(own)], names=["doc_id", "grade", "score"])
                    continue
                told = np.where(np.isnan(grade), own, grade)
                if graded_only:
                    tf = tf * ~np.isnan(grade)[rows]
                    told = np.where(np.isnan(grade), 0.0, grade)
                sums += np.bincount(ids, tf * told[rows], len(weight))
                hits += np.bincount(ids, tf, len(weight))
            if out == "words":
                some = np.flatnonzero(hits)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some]), pa.array(hits[some])], names=["id", "total", "hits"])

        schema = "doc_id bigint, grade double, score double" if out == "docs" else "id int, total double, hits double"
        return shared, graph.select("doc_id", "ids", "times", "grade").mapInArrow(run, schema)

    def step(score: np.ndarray, graded_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
        shared, part = pass_over(score, graded_only, "words")
        sums, hits = _by_place(part, ["total", "hits"])
        shared.destroy()
        prior = 1.0 if graded_only else 0.0
        return np.where(hits + prior > 0, np.round((sums + prior * mean) / np.maximum(hits + prior, 1e-300), 12), mean), hits

    # the first round hears graded documents only; the later ones are sped up by what the last moves have in common
    score, _ = step(np.full(WORD_BUCKETS, float(mean)), True)
    points: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(most_rounds):
        new, hits = step(score)
        move = new - score
        left = float(np.sqrt((hits * move * move).sum() / max(hits.sum(), 1e-300)))
        if left < TOLERANCE:
            return pass_over(new, False, "docs")[1]
        points = [*points[-MEMORY:], (new, move)]
        score = _mixed(points, hits)
    raise RuntimeError(f"difficulty still moves by {left:.2e} after {most_rounds} rounds")


def _mixed(points: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray) -> np.ndarray:
    """The mixture of the last points whose moves cancel best (Anderson's method); the fixed point is the same."""
    new, move = points[-1]
    if len(points) < 2:
        return new
    root = np.sqrt(weight)
    moves = np.stack([(move - m) * root for _, m in points[:-1]], axis=1)
    share, *_ = np.linalg.lstsq(moves, move * root, rcond=1e-8)
    return np.clip(new - sum(s * (new - n) for s, (n, _) in zip(share, points[:-1], strict=True)), *(min(GRADES.values()), max(GRADES.values())))


def best_cuts(scored: DataFrame, bins: int = BINS) -> tuple[float, float] | None:
    """The two cuts that agree with most graded documents; from a histogram over all of them."""
    graded = scored.where("grade is not null")
    span = graded.agg(F.min("score"), F.max("score")).first()
    if span[0] is None:
        return None
    low, step = span[0], max((span[1] - span[0]) / bins, 1e-12)
    rows = graded.groupBy(F.floor((F.col("score") - low) / step).cast("int").alias("bin"), F.floor(F.col("grade") + 0.5).cast("int").alias("band")).count().collect()
    counts = np.zeros((3, bins + 2))
    for r in rows:
        counts[r["band"], r["bin"] + 1] += r["count"]
    below = counts.cumsum(axis=1)  # graded documents under the upper edge of each bin
    # hits of cuts (i, j), i <= j: basic under i + intermediate between + advanced over j
    first = below[0] - below[1]
    best_first, at, best = -np.inf, 0, (-np.inf, 0, 0)
    for j in range(bins + 2):
        if first[j] > best_first:
            best_first, at = first[j], j
        total = best_first + below[1][j] - below[2][j]
        if total > best[0]:
            best = (total, at, j)
    # equally good cuts form a plateau (an empty stretch between the bands): its middle is taken
    def middle(values: np.ndarray, k: int, end: int) -> float:
        last = k
        while last < end and values[last + 1] == values[k]:
            last += 1
        return (k + last) / 2

    return low + middle(first, best[1], best[2]) * step, low + middle(below[1] - below[2], best[2], bins + 1) * step


def reading_levels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, difficulty, band) of every document written mainly in English."""
    spark = docs.sparkSession
    graph = cut(lookup(english_terms(docs), cut(grades(labels)), ["doc_id"]))
    if not graph.where("grade is not null").limit(1).count():
        return spark.createDataFrame([], "doc_id bigint, difficulty double, band string")
    scored = cut(harmonic(graph))
    drop(graph)
    low, high = best_cuts(scored)
    band = F.when(F.col("score") < low, "basic").when(F.col("score") < high, "intermediate").otherwise("advanced")
    return scored.select("doc_id", F.round("score", 6).alias("difficulty"), band.alias("band"))


def p10_levels(spark: SparkSession, base: str) -> DataFrame:
    return reading_levels(read(spark, base, "documents"), read(spark, base, "reading_labels"))


def p10_found(spark: SparkSession, base: str) -> DataFrame:
    long = read(spark, base, "documents").where(F.col("n_chars") >= LEAST_CHARS).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return p10_levels(spark, base).join(long, "doc_id", "left_semi").select("doc_id", "band")


ORACLE: dict[str, str] = {}
