"""Language identification with bit-sliced Bloom filters of character n-grams.

Each position of one shared table holds a mask with a bit for every language; an n-gram sets
its language's bit at several positions.  The masks at an n-gram's positions, and-ed, name
all languages that contain it.  A text's hits are counted per language, corrected for the
share that the filter reports by chance, and the largest count decides.

A language's n-grams are those that make up at least ``LEAST_SHARE`` of its n-grams in the
learned texts, hence no more than 1 / LEAST_SHARE per language and size.

A null or empty text, or one without a letter, is ``und`` with score 0.  Texts are read
whole; equal texts get equal results; ties go to the language first by name.  With no
learned language every text is ``und``.  Rows without a language or a text teach nothing.
Only the named columns are read, so other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    add_columns, hash_below, held_out, in_portions, per_worker, share, shared,
)

SIZES = (3, 4)
LEAST_SHARE = 2e-5
POSITIONS = 1 << 20
HASHES = 3
SAMPLE_PER_LANGUAGE = 10_000
FLUSH = 2_000_000
UNKNOWN = "und"


@dataclass
class Filters:
    languages: list[str]
    masks: np.ndarray  # POSITIONS x words of 64 languages
    by_chance: np.ndarray  # for each language, the share of foreign n-grams it reports


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    points = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            points[point] = ord(low) if len(low) == 1 else point
    return points


def grams(text: str) -> np.ndarray:
    """Hashes of all n-grams of the text's words; empty without a letter."""
    table = per_worker("letters", _letters)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.concatenate([[32], table[raw], [32]]).astype(np.uint64)
    gap = chars == 32
    chars = chars[np.concatenate([[True], ~(gap[1:] & gap[:-1])])]
    if len(chars) < 3:
        return np.zeros(0, np.uint64)
    out = []
    for size in SIZES:
        count = len(chars) - size + 1
        if count < 1:
            continue
        mixed = np.full(count, size, np.uint64)
        for i in range(size):
            mixed = (mixed ^ chars[i:i + count]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        out.append(mixed)
    return np.concatenate(out)


def places(hashes: np.ndarray) -> Iterator[np.ndarray]:
    for i in range(HASHES):
        yield (hashes >> np.uint64(21 * i)) & np.uint64(POSITIONS - 1)


def learn(df: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang",
          per_language: int = SAMPLE_PER_LANGUAGE) -> Filters:
    """Filters from rows that are not held out: about ``per_language`` texts of each language,
    chosen by a hash of the key; all of them where there are fewer."""
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(language).alias("l")
                     ).where(F.col("l").isNotNull() & ~held_out("k"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n"))
              .collect()}  # a row for each language
    if not counts:
        return Filters([], np.zeros((POSITIONS, 1), np.uint64), np.zeros(0))
    wanted = F.lit(False)
    for name, n in counts.items():
        wanted |= (F.col("l") == name) & hash_below(share(per_language, n), "k")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()),
                     pa.array(found.view(np.int64)), pa.array(n, pa.int64())],
                    names=["l", "gram", "n"])
            held.clear()

        for batch in batches:
            for body, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(name, []).append(found := grams(body))
                waiting += len(found)
                if waiting >= FLUSH:
                    yield from flush()
                    waiting = 0
        yield from flush()

    counted = (rows.where(wanted & F.col("t").isNotNull()).select("t", "l")
               .mapInArrow(in_portions(count), "l string, gram long, n long")
               .groupBy("l", "gram").agg(F.sum("n").alias("n")))
    totals = counted.groupBy("l").agg(F.sum("n").alias("total"))
    chosen = (counted.join(F.broadcast(totals), "l")  # a row for each language
              .where(F.col("n") >= F.col("total") * LEAST_SHARE).select("l", "gram").toArrow())
    languages = sorted(counts)
    masks = np.zeros((POSITIONS, (len(languages) + 63) // 64), np.uint64)
    names, found = np.array(chosen.column("l").to_pylist()), chosen.column("gram").to_numpy()
    by_chance = np.zeros(len(languages))
    for i, name in enumerate(languages):
        own = found[names == name].view(np.uint64) if len(found) else found.view(np.uint64)
        word, bit = i // 64, np.uint64(1) << np.uint64(i % 64)
        for at in places(own):
            masks[at, word] |= bit
        by_chance[i] = np.count_nonzero(masks[:, word] & bit) / POSITIONS
    return Filters(languages, masks, by_chance ** HASHES)


def decide(text: str | None, filters: Filters) -> tuple[str, float]:
    found = grams(text) if text else np.zeros(0, np.uint64)
    if not len(found) or not filters.languages:
        return UNKNOWN, 0.0
    inside = None
    for at in places(found):
        masks = filters.masks[at]
        inside = masks if inside is None else inside & masks
    hits = np.array([
        np.count_nonzero(inside[:, i // 64] & (np.uint64(1) << np.uint64(i % 64)))
        for i in range(len(filters.languages))], float)
    total = len(found)
    hits = np.clip((hits - total * filters.by_chance) / (1 - filters.by_chance), 0, total)
    best = int(hits.argmax())
    return filters.languages[best], float(hits[best] / total)


def with_language(df: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """All columns, then the language and the share of the text's n-grams it contains, as
    ``lang_pred`` and ``score``, which replace columns of those names."""
    sent = shared(df.sparkSession, filters)  # 8 MB for each 64 languages

    def start():
        known = sent()

        def work(texts: list[str | None]) -> tuple[list, list]:
            said = [decide(t, known) for t in texts]
            return [s[0] for s in said], [s[1] for s in said]

        return work

    return add_columns(df, text, [("lang_pred", "string", pa.string()),
                                  ("score", "double", pa.float64())], start)
