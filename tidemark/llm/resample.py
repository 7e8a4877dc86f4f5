"""Resampling a corpus towards a target distribution by importance weights of hashed n-grams.

A text's features are its words and pairs of neighbouring words; each falls into a bucket by
its CRC-32.  The gain of a bucket is the logarithm of its share in the target over its share in
the corpus, a text's weight the mean gain of its features.  Adding a Gumbel variate, drawn from
a hash of the key, and taking the highest sums draws texts without replacement in proportion to
the exponential of their weights.

The texts of a batch are joined with separators, one pass of a regular expression finds the
words of all, and the texts' offsets tell which text a word belongs to, so that pairs across a
border are masked before the buckets are counted.  The checksum of a pair follows from those of
its words by the linear map that appending bytes is, taken from a table for short words.

A task counts its buckets before anything is shuffled, and what reaches the driver and goes out
again is one number for each bucket, however large the corpus.  Every text is read whole, in
both passes.  Null and empty texts have no feature and weight 0.  A null key draws as the word
``null``; rows of a repeated key draw the same variate and are ranked on their own, equal rows
in any order.  An empty corpus gives no rows, an empty target the gains of no occurrence.  Words
are runs of letters A to Z in lower case, digits and characters beyond ASCII.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, numbered, per_worker, shared
from tidemark.sources.scratch import materialise

BUCKETS = 10_000
SEED = 7
TEXT_BYTES = 1 << 20  # texts are joined until they hold this many bytes
SHORT = 64  # bytes of a word whose checksums are combined by tables

# UTF-8 bytes beyond ASCII are 0x80 and above, so the classes hold for bytes as for characters.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BETWEEN = np.array([WORD.match(bytes([c])) is None for c in range(256)])


def appending_tables() -> np.ndarray:
    """``tables[n, k, v]``: what byte ``k`` of value ``v`` of a checksum becomes when ``n``
    bytes follow, up to the checksum of those bytes."""
    out = np.zeros((SHORT + 2, 4, 256), np.uint32)
    for n in range(SHORT + 2):
        zeros = bytes(n)
        none = zlib.crc32(zeros)
        out[n] = [[zlib.crc32(zeros, v << 8 * k) ^ none for v in range(256)] for k in range(4)]
    return out


def appended(tables: np.ndarray, checksums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    parts = [tables[lengths, k, checksums >> np.uint32(8 * k) & np.uint32(255)] for k in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


def joined(texts: list[str | None], size: int = TEXT_BYTES) -> Iterator[tuple[bytes, np.ndarray]]:
    """Texts in lower case, each behind a separator, and where each begins."""
    held, starts, at = [], [], 0
    for text in texts:
        body = b"" if text is None else text.encode()
        held.append(body)
        starts.append(at)
        at += len(body) + 1
        if at >= size:
            yield b"\0".join([*held, b""]).translate(LOWER), np.array(starts)
            held, starts, at = [], [], 0
    if held:
        yield b"\0".join([*held, b""]).translate(LOWER), np.array(starts)


def features(buffer: bytes, starts: np.ndarray, buckets: int = BUCKETS,
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature, and the number of words of each text."""
    tables = per_worker("crc-tables", appending_tables)
    crc = zlib.crc32
    found = np.fromiter((m.start() << 32 | crc(m[0]) for m in WORD.finditer(buffer)), np.uint64)
    begins, sums = (found >> np.uint64(32)).astype(np.int64), found.astype(np.uint32)
    gaps = np.flatnonzero(BETWEEN[np.frombuffer(buffer, np.uint8)])
    ends = gaps[np.searchsorted(gaps, begins)]
    text = np.searchsorted(starts, begins, side="right") - 1

    first = np.flatnonzero(text[1:] == text[:-1])  # of a pair within one text
    second = first + 1
    lengths = ends[second] - begins[second]
    fits = lengths <= SHORT
    pairs = np.zeros(len(first), np.uint32)
    a, b, n = sums[first[fits]], sums[second[fits]], lengths[fits]
    blank = appended(tables, np.full(len(n), crc(b" "), np.uint32), n)
    pairs[fits] = appended(tables, a, n + 1) ^ blank ^ b
    for i in np.flatnonzero(~fits):
        word = buffer[begins[second[i]]:ends[second[i]]]
        pairs[i] = crc(word, crc(b" ", int(sums[first[i]])))
    return (np.concatenate([sums, pairs]) % np.uint32(buckets), np.concatenate([text, text[first]]),
            np.bincount(text, minlength=len(starts)))


def count_buckets(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for buffer, starts in joined(batch.column(0).to_pylist()):
                counts += np.bincount(features(buffer, starts, buckets)[0], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some])], names=["bucket", "n"])

    counted = df.select(text).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # a row a bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, floored."""
    all_source, all_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log(
        (int(t) + 1) * all_source / ((int(s) + 1) * all_target)))
        for s, t in zip(source, target, strict=True)], np.int64)


def with_weight(df: DataFrame, table: np.ndarray, text: str = "text") -> DataFrame:
    """All columns but the text, the numbers of words and features, and the weight."""
    sent = shared(df.sparkSession, table)

    def start():
        gain = sent()

        def work(texts: list) -> tuple[list, ...]:
            words, sums = [], []
            for buffer, starts in joined(texts):
                bucket, place, n_words = features(buffer, starts, len(gain))
                words.append(n_words)
                # Whole numbers far below 2 ** 53, so sums of doubles are exact.
                sums.append(np.bincount(place, gain[bucket], len(starts)).astype(np.int64))
            n_words = np.concatenate(words or [np.zeros(0, np.int64)])
            total = np.concatenate(sums or [np.zeros(0, np.int64)])
            n = n_words + np.maximum(n_words - 1, 0)
            return [None] * len(texts), n_words, n, total // np.maximum(n, 1)
        return work

    at = df.columns.index(text)
    made = add_columns(df, text, [("n_words", "long", pa.int64()), ("n_features", "long", pa.int64()),
                                  ("weight", "long", pa.int64())], start, replaced=True)
    names = [f"c{i}" for i in range(len(made.columns))]
    kept = [(new, old) for i, (new, old) in enumerate(zip(names, made.columns, strict=True))
            if i != at]
    return made.toDF(*names).select(*[F.col(new).alias(old) for new, old in kept])


def gumbel(key: str, seed: int = SEED) -> Column:
    """Thousandths of a standard Gumbel variate of the key, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(df: DataFrame, target: DataFrame, percent: int, least_words: int = 20,
             key: str = "doc_id", text: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and, for rows drawn, ``rank``.

    Of the rows with at least ``least_words`` words the ``percent`` in a hundred with the
    highest scores are drawn, ties to the smaller key, null keys last.
    """
    table = gains(count_buckets(df, text, buckets), count_buckets(target, target_text, buckets))
    weighed = with_weight(df.select(F.col(key).alias("key"), F.col(text).alias("text")), table)
    scored = materialise(weighed.withColumn("score", F.col("weight") + gumbel("key", seed)),
                         "resample-scores")
    enough = F.col("n_words") >= least_words
    eligible = scored.where(enough)
    drawn = percent * eligible.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("n_features"), F.asc("weight")]
    placed = numbered(eligible, order, "place", "resample-order")
    ranked = placed.select(*scored.columns, F.when(
        F.col("place") < drawn, F.col("place") + 1).alias("rank"))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.union(rest).withColumnRenamed("key", key)


def drawn_rows(df: DataFrame, ranked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``df``, whole, whose key was drawn."""
    return df.join(ranked.where(F.col("rank").isNotNull()).select(key).distinct(), key,
                   "left_semi")
