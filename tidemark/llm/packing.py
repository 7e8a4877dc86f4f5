"""Hierarchical packing of tokenised documents into windows of several sizes.

Whole windows of the largest size are cut from a document first.  What remains is routed to
the smallest tier that holds it.  Each tier is packed from the longest rests; the gap of a
window is filled with the longest fitting rests of the same or shorter tiers and closed by
cutting one more, so a window leaves nothing to pad.  When a task ends, its last rests are
cut into windows of the shorter tiers; only less than the shortest tier is left to be padded.
Windows of a tier join step groups of equal numbers of tokens.

A task packs the rows it scans as they come, holding at most ``POOL`` rests, so nothing is
shuffled and no group of documents meets anywhere.  Null and empty texts are the end id
alone; long texts are packed whole; repeated rows are packed once each; an empty table gives
an empty result.  Only the key and the text are read, so other columns play no part.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_portions, per_worker

TIERS = (1024, 512, 256, 128, 64)
STEP_TOKENS = 65_536
POOL = 2048
ROWS_OUT = 4096
LONG_RUN = 4000  # characters; the fast encoder takes time by the square of a word's length


class Packer:
    """Packs the documents of one task."""

    def __init__(self, tiers: Sequence[int], step_tokens: int, part: int) -> None:
        self.tiers = sorted(tiers, reverse=True)
        self.step_tokens, self.base = step_tokens, part << 33
        self.rests: list[tuple[int, int]] = []  # (length, number), ordered
        self.held: dict[int, tuple] = {}  # number: (key, start, ids, document's tokens)
        self.sequences = self.number = 0
        self.windows = dict.fromkeys(self.tiers, 0)
        self.groups: dict[tuple[int, int], int] = {}
        self.out: list[tuple] = []

    def add(self, key: object, ids: np.ndarray) -> None:
        top, size = self.tiers[0], len(ids)
        whole = size - size % top
        for start in range(0, whole, top):
            self.close(top, [(key, start, ids[start:start + top], size)])
        if whole < size:
            self.hold(key, whole, ids[whole:].copy(), size)
        if len(self.rests) >= POOL:
            self.pack(last=False)

    def hold(self, key: object, start: int, ids: np.ndarray, size: int) -> None:
        self.number += 1
        self.held[self.number] = (key, start, ids, size)
        insort(self.rests, (len(ids), self.number))

    def close(self, tier: int, pieces: list[tuple]) -> None:
        """Write a window; its step group is the next of its tier with room."""
        place = self.windows[tier] * tier // self.step_tokens
        self.windows[tier] += 1
        group = self.groups.setdefault((tier, place), len(self.groups))
        at = 0
        for key, start, ids, size in pieces:
            self.out.append((key, start, len(ids), ids.tobytes(), size,
                             self.base | self.sequences, at, tier, self.base | group))
            at += len(ids)
        self.sequences += 1

    def take(self, room: int) -> tuple | None:
        """The longest rest that fits, else a cut of the shortest one that does not."""
        at = bisect_right(self.rests, (room, self.number + 1))
        if at:
            return self.held.pop(self.rests.pop(at - 1)[1])
        if not self.rests:
            return None
        key, start, ids, size = self.held.pop(self.rests.pop(0)[1])
        self.hold(key, start + room, ids[room:], size)
        return key, start, ids[:room], size

    def fill(self, tier: int) -> None:
        pieces, room = [], tier
        while room and (piece := self.take(room)):
            pieces.append(piece)
            room -= len(piece[2])
        self.close(tier, pieces)

    def pack(self, last: bool) -> None:
        total = sum(length for length, _ in self.rests)
        for tier, below in zip(self.tiers, [*self.tiers[1:], 0], strict=True):
            # Windows of this tier while a rest is routed to it, or at the end while they fill.
            while total >= tier and (
                    last or bisect_left(self.rests, (below + 1, 0)) < len(self.rests)):
                self.fill(tier)
                total -= tier
        if last and total:
            self.fill(self.tiers[-1])

    def batches(self, least: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if len(self.out) >= least:
            out, self.out = self.out, []
            for at in range(0, len(out), ROWS_OUT):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in
                     zip(zip(*out[at:at + ROWS_OUT], strict=True), schema.types, strict=True)],
                    schema=schema)


def encoding(path: str, special: dict[str, int], pattern: str):
    """A byte-level vocabulary given as ranks, with its special strings."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens=special)


def has_long_run(text: str, size: int = LONG_RUN) -> bool:
    """True if ``size`` characters in a row are all white space or all none: they then cover a
    stretch of half that size that starts at a multiple of it, and holds one word at most."""
    half = size // 2
    return any(len(text[at:at + half].split(None, 2)) <= 1
               for at in range(0, len(text) - half + 1, half))


def encoder(vocabulary: str, pattern: str, special: dict[str, int], slow: str):
    """The ids of a text.  Long runs overflow the fast encoder's matcher or take it too long, so
    texts that hold one are encoded by the library whose file ``slow`` is, to the same ids; it is
    loaded when the first such text comes."""
    fast, loaded = encoding(vocabulary, special, pattern), []

    def encode(text: str) -> np.ndarray:
        if not has_long_run(text):
            return fast.encode_to_numpy(text, allowed_special="all")
        if not loaded:
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_file(slow))
            loaded[0].no_truncation()
            loaded[0].no_padding()
        return np.array(loaded[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def pack(df: DataFrame, vocabulary: str, pattern: str, special: dict[str, int], slow: str,
         end_id: int = 0,
         tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row for each piece, with its ids, window and step group."""
    kind = dict(df.dtypes)[key]
    schema = pa.schema([
        (key, df.select(key).limit(0).toArrow().schema.field(0).type),
        ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("tier", pa.int32()), ("step_group", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker(f"ranks {vocabulary}", lambda: encoder(
            vocabulary, pattern, special, slow))
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId())
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for name, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encode(body) if body else end[:0]
                packer.add(name, np.concatenate([ids, end]))
                yield from packer.batches(ROWS_OUT, schema)
        packer.pack(last=True)
        yield from packer.batches(1, schema)

    return df.select(key, text).mapInArrow(
        in_portions(run), f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, "
             "sequence_id long, offset long, tier int, step_group long")


def digests(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    return pieces.select(key, "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "tier", "step_group")
