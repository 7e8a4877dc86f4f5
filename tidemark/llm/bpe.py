"""Byte-pair encoding and decoding with a public vocabulary.

A word becomes a doubly linked list of symbols.  A priority queue holds the merges that
neighbours allow, by rank and then by place; a popped entry whose two symbols have changed
since it was queued is stale and skipped.  Decoding joins the strings of the vocabulary.

Nulls encode as the empty text, and so to no tokens.  Texts of any length are encoded
whole; repeated rows give repeated results; an empty table gives an empty one.  Only the
key and the text are read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_worker

# Bounds of the caches of one worker, which only save time.
CACHED_WORDS = 150_000
CACHED_PIECES = 300_000
CACHED_LENGTH = 64
ROWS_OUT = 512

# Characters whose normalisation, lower case and class follow the rules below without
# Unicode tables: printable ASCII, Latin letters with marks, common dashes and quotes.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-įı-ſ–—‘’“”…]*")
_LETTERS = "a-zß-öø-ſ"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s0-9{_LETTERS}]+")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordBpe:
    """The vocabulary of one tokenizer file whose words end in a suffix."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocabulary | self.added).items()}
        # By rank: the two symbols of a merge and what they become.
        self.left, self.right, self.merged = array("I"), array("I"), array("I")
        self.ranks: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = self.vocabulary[left], self.vocabulary[right]
            self.left.append(a)
            self.right.append(b)
            self.merged.append(self.vocabulary[left + right])
            self.ranks[a << 32 | b] = rank
        self.alphabet = byte_alphabet()
        self.special = re.compile("|".join(
            map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self._library = None

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours, lowest rank first and leftmost among equals."""
        ranks, lefts, rights = self.ranks.get, self.left, self.right
        size = len(symbols)
        before, after = list(range(-1, size - 1)), [*range(1, size), -1]
        queue = [rank << 32 | at for at in range(size - 1)
                 if (rank := ranks(symbols[at] << 32 | symbols[at + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            rank, at = entry >> 32, entry & 0xFFFFFFFF
            gone = after[at]
            if gone < 0 or symbols[at] != lefts[rank] or symbols[gone] != rights[rank]:
                continue  # stale: one of the two has been merged since
            symbols[at], symbols[gone] = self.merged[rank], -1
            follower = after[at] = after[gone]
            if follower >= 0:
                before[follower] = at
                rank = ranks(symbols[at] << 32 | symbols[follower])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | at)
            first = before[at]
            if first >= 0:
                rank = ranks(symbols[first] << 32 | symbols[at])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | first)
        return [s for s in symbols if s >= 0]

    def shown_ids(self, shown: str) -> bytes:
        """Packed ids of one piece, given in the characters that stand for its bytes."""
        if not shown:
            return b""
        symbols = [*map(self.vocabulary.__getitem__, shown)]
        symbols[-1] = self.vocabulary[shown[-1] + self.suffix]
        return array("I", self.merge(symbols)).tobytes()

    def piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(
            map(self.alphabet.__getitem__, piece.encode()))
        packed = self.shown_ids(shown)
        if len(piece) <= CACHED_LENGTH:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            self.pieces[piece] = packed
        return packed

    def word(self, word: str) -> bytes:
        """Packed ids of a lower-case word without white space."""
        known = self.pieces.get
        packed = b"".join([known(p) or self.piece(p) for p in PIECES.findall(word)])
        if len(word) <= CACHED_LENGTH:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            self.words[word] = packed
        return packed

    def ordinary(self, text: str) -> bytes:
        if PLAIN.fullmatch(text):
            known = self.words.get
            return b"".join([known(w) or self.word(w) for w in text.lower().split()])
        return self.elsewhere(text)

    def elsewhere(self, text: str) -> bytes:
        """Other scripts: normalised and cut by the library's rules, merged by ours."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        plain = self._library.normalizer.normalize_str(text)
        return b"".join([self.shown_ids(shown) for shown, _
                         in self._library.pre_tokenizer.pre_tokenize_str(plain)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self.ordinary(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [self.ordinary(text[at:found.start()]),
                    array("I", [self.added[found[0]]]).tobytes()]
            at = found.end()
        return b"".join([*out, self.ordinary(text[at:])])

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, array("I", ids)))


def _bpe(path: str) -> WordBpe:
    return per_worker(f"bpe {path}", lambda: WordBpe(path))


def encode(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, number of tokens and packed ids of each row's whole text."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizer)
        for batch in batches:
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary())], names=[key, "n_tokens", "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids binary")


def decode(df: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key, number of tokens, packed ids and decoded text; null ids decode to the empty text."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizer)
        for batch in batches:
            packed = [i or b"" for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in packed], pa.int64()),
                 pa.array(packed, pa.binary()),
                 pa.array([bpe.decode(i) for i in packed], pa.string())],
                names=[key, "n_tokens", "ids", "decoded"])

    return df.select(key, ids).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids binary, decoded string")


def round_trip(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
               ) -> DataFrame:
    """What ``decode(encode(df))`` gives, with one Python worker for both."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(at, ROWS_OUT)
                ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array(ids, pa.binary()),
                     pa.array(map(bpe.decode, ids), pa.string())],
                    names=[key, "n_tokens", "ids", "decoded"])

    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids binary, decoded string")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return decoded.select(
        key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
