"""Encoding of the whole corpus with a public byte-level BPE tokenizer (problem 8).

A text is split by the tokenizer's pattern, and every piece is encoded by a backtracking encoder: one Aho-Corasick
pass over the piece gives the longest vocabulary match at each start; matches are taken greedily, and a match that
could not stand next to its predecessor in a true merge sequence is shortened or, failing that, the predecessor is
taken back. Whether two tokens may stand together is read from a pair table: unwinding both by the merges that made
them must never meet a merge of higher priority across their border. Each position is given up at most once, so a
piece of any length takes linear time, and the result is exactly that of applying the merges one by one. Decoding
cuts one byte string by an offset table.

Defined results: empty and null texts have the empty list; the strings of special tokens are ordinary text; unpaired
surrogates cannot occur in a Parquet string. The vocabulary is read by path inside the workers and never shipped.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.runtime import read

BYTE_BPE = "byte_bpe_50k.tiktoken"
CACHE_PIECES = 500_000


def vocabulary_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class BacktrackingEncoder:
    """Exact byte-level BPE of whole texts; ids are merge ranks, single bytes come first."""

    def __init__(self, path: str, pattern: str | None = None):
        import ahocorasick
        import regex

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}
        self.pieces = regex.compile(pattern).findall
        self.rank_of = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.size = max(ranks.values()) + 1
        tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.offsets = array("Q", [0])
        for token in tokens:
            self.offsets.append(self.offsets[-1] + len(token))
        self.blob = b"".join(tokens)
        self.matches = ahocorasick.Automaton()
        for token, rank in self.rank_of.items():
            self.matches.add_word(token, (len(token), rank))
        self.matches.make_automaton()
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = [(rank, rank) for rank in range(self.size)]
        self.fits_known: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int | None] = {}
        self.cache: dict[str, tuple[int, ...]] = {}
        for rank in range(self.size):
            if len(tokens[rank]) > 1:
                self._unmerge(rank, tokens[rank].decode("latin-1"))

    def _unmerge(self, rank: int, token: str) -> None:
        """Find the merge that makes a token: the split whose halves exist earlier and may stand together."""
        known = self.rank_of
        for cut in range(1, len(token)):
            left, right = known.get(token[:cut]), known.get(token[cut:])
            if left is not None and right is not None and left < rank and right < rank and self._fits(left, right, rank):
                self.halves[rank] = (left, right)
                self.pair_rank[left, right] = rank
                return
        # a token no earlier merge can reach is never produced; it stays unsplit

    def _fits(self, left: int, right: int, ceiling: int) -> bool:
        """Whether no merge ranked under ``ceiling`` or under those that made the inner tokens joins across the border."""
        pair_rank, halves = self.pair_rank, self.halves
        bound = ceiling
        while True:
            joined = pair_rank.get((left, right))
            if joined is not None and joined < bound:
                return False
            # undo the later of the two merges that touch the border: the younger token is opened first
            opened_left = left > right
            for _ in range(2):
                if opened_left:
                    inner = halves[left][1]
                    if inner != left:
                        bound, left = left, inner
                        break
                else:
                    inner = halves[right][0]
                    if inner != right:
                        bound, right = right + 1, inner
                        break
                opened_left = not opened_left
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.fits_known.get(key)
        if known is None:
            if len(self.fits_known) > 4_000_000:
                self.fits_known.clear()
            known = self.fits_known[key] = self._fits(left, right, self.size + 1)
        return known

    def _prefix(self, rank: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if rank not in self.shorter:
            token = self.blob[self.offsets[rank] : self.offsets[rank + 1]].decode("latin-1")
            self.shorter[rank] = next((self.rank_of[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.rank_of), None)
        return self.shorter[rank]

    def encode_piece(self, text: str) -> tuple[int, ...]:
        piece = text.encode("utf-8").decode("latin-1")
        n, offsets = len(piece), self.offsets
        longest = [-1] * n
        reach = [0] * n
        for end, (length, rank) in self.matches.iter(piece):
            start = end - length + 1
            if length > reach[start]:
                reach[start], longest[start] = length, rank
        # iter() names the longest token ending at each place; shorter ones that start later are its suffixes
        for start in range(n):
            if longest[start] < 0:
                longest[start] = self.rank_of[piece[start]]
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0] if n else None
        while at < n:
            last = out[-1] if out else None
            taken = False
            while token is not None:
                end = at + offsets[token + 1] - offsets[token]
                if not dead[end] and (last is None or self.fits(last, token)):
                    out.append(token)
                    at = end
                    taken = True
                    break
                token = self._prefix(token)
            if taken:
                token = longest[at] if at < n else None
            else:
                dead[at] = 1
                if last is None:
                    raise ValueError("a byte is missing from the vocabulary")
                out.pop()
                at -= offsets[last + 1] - offsets[last]
                token = self._prefix(last)
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if text:
            cache = self.cache
            for piece in self.pieces(text):
                known = cache.get(piece)
                if known is None:
                    known = self.encode_piece(piece)
                    if len(piece) <= 64:
                        if len(cache) >= CACHE_PIECES:
                            cache.clear()
                        cache[piece] = known
                ids.extend(known)
        return ids

    def decode(self, ids) -> str:
        blob, offsets = self.blob, self.offsets
        return b"".join([blob[offsets[i] : offsets[i + 1]] for i in ids]).decode("utf-8", errors="replace")


_ENCODERS: dict[str, BacktrackingEncoder] = {}


def encoder(path: str) -> BacktrackingEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BacktrackingEncoder(path)
    return _ENCODERS[path]


def encode_column(df: DataFrame, key: str, text: str, path: str | None = None, counts_only: bool = False) -> DataFrame:
    """(key, ids) or, with ``counts_only``, (key, tokens: long). A narrow step: no shuffle, whole texts, Arrow batches."""
    path = path or vocabulary_path()
    kind = "tokens bigint" if counts_only else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            # a text is turned into Python and encoded alone, so a batch of long texts never lies there twice
            if counts_only:
                out = pa.array([len(own.encode(t.as_py())) for t in texts], pa.int64())
            else:
                out = pa.array((array("i", own.encode(t.as_py())) for t in texts), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=[key, "tokens" if counts_only else "ids"])

    kind_of_key = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind_of_key}, {kind}")


def p8_ids(spark: SparkSession, base: str) -> DataFrame:
    return encode_column(read(spark, base, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id", "text")


def p8_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """(doc_id, tokens, exact): token count and whether decoding gives the text back."""
    path = vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            n, same = [], []
            for t in batch.column(1):
                text = t.as_py()
                ids = own.encode(text)
                n.append(len(ids))
                same.append(own.decode(ids) == (text or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(same)], names=["doc_id", "tokens", "exact"])

    return read(spark, base, "documents").select("doc_id", "text").mapInArrow(run, "doc_id bigint, tokens bigint, exact boolean")


ORACLE: dict[str, str] = {}
