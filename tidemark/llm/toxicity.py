"""Toxicity scores from a weighted lexicon.

Text is folded first: lower case, marks and look-alike letters to plain Latin ones, digits
and signs that stand for letters to those, everything else to spaces.  An Aho-Corasick
automaton then finds all entries in one pass: whole words and word stems.  An entry counts
its weight, except inside an exception phrase (an entry with a neighbouring word that makes
it harmless).  The sum is normalised by length, and a logistic curve turns it into a score.

Entries, weights, exceptions and the curve are learned from labelled rows that are not held
out.  The sample is bounded: about ``SAMPLE`` rows of either label, chosen by a hash.

A null or empty text scores what a text without entries scores.  Texts are read whole; equal
texts get equal scores.  Without labelled rows of both kinds every score is 0.  A document
with several labels counts as toxic if one says so, and one with several texts is learned from
by the smallest; the model is the same for any order and dealing of the rows.  Only the named columns are read, so
other columns play no part.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    add_columns, hash_below, held_out, in_portions, per_worker, share, shared,
)
from tidemark.sources.scratch import materialise

SAMPLE = 10_000  # labelled rows of either label that are learned from
STEMS = range(4, 9)  # lengths of stems that may become entries
LEAST_SHARE = 0.004  # of the toxic texts must hold an entry
LEAST_DOCS = 5
LEAST_RATIO = 20.0  # how much more frequent an entry is in toxic texts
SAME = 0.9  # an ending with this share of a stem's texts replaces the stem
EXCEPTION_DOCS = 3  # harmless texts with a phrase that make it an exception

# Characters read as a Latin letter.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ɡ": "g", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l",
    "đ": "d", "ı": "i",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
               "@": "a", "$": "s", "!": "i", "|": "l"}
INVISIBLE = {0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF}


class Folding(dict):
    """For ``str.translate``: the folded form of each code point, found when first met."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        if point in INVISIBLE:
            folded = ""
        elif char in SUBSTITUTES:
            folded = char  # decided by its neighbours
        else:
            folded = "".join(
                LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFKD", char.lower())
                if not unicodedata.combining(c))
            folded = "".join(LOOKALIKES.get(c, c) for c in folded)
            if not folded.isalpha():
                folded = "".join(c if c.isalnum() else " " for c in folded) or " "
        self[point] = folded
        return folded


def word(raw: str) -> str:
    """A word with its substitutes read as letters; none if it holds no letter."""
    if raw.isalpha():
        return raw
    body = raw.strip("!|@$")
    if not any(c.isalpha() for c in body):
        return ""
    return "".join(c for c in (SUBSTITUTES.get(c, c) for c in body) if c.isalpha())


def words(text: str | None) -> list[str]:
    if not text:
        return []
    folding = per_worker("folding", Folding)
    return [w for w in map(word, text.translate(folding).split()) if w]


@dataclass
class Lexicon:
    """Entries are ``" word "`` or a stem ``" wor"``; exceptions are pairs of words."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[tuple[str, str]] = frozenset()
    curve: tuple[float, ...] = ()

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for entry in self.weights:
            made.add_word(entry, entry)
        made.make_automaton()
        return made


def evidence(said: list[str], lexicon: Lexicon, automaton) -> tuple[float, float]:
    """The sum of weights, and the sum for each hundred words."""
    if not said or not lexicon.weights:
        return 0.0, 0.0
    joined = f" {' '.join(said)} "
    best: dict[int, float] = {}  # a word counts its heaviest entry
    for end, entry in automaton.iter(joined):
        start = end - len(entry) + 1
        best[start] = max(best.get(start, 0.0), lexicon.weights[entry])
    if best and lexicon.exceptions:
        for start in list(best):
            close = joined.index(" ", start + 1)
            before = joined[joined.rfind(" ", 0, start) + 1:start] if start else ""
            here = joined[start + 1:close]
            after = joined[close + 1:].split(" ", 1)[0] if close + 1 < len(joined) else ""
            if (before, here) in lexicon.exceptions or (here, after) in lexicon.exceptions:
                del best[start]
    total = sum(best.values())
    return total, 100 * total / max(len(said), 1)


def features(total: float, density: float) -> list[float]:
    return [1.0, math.log1p(total), math.log1p(density), float(total > 0)]


def curve_of(rows: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps."""
    beta = np.zeros(rows.shape[1])
    ridge = np.diag([1e-3] * rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (labels - p) - ridge @ beta
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + ridge, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def score(said: list[str], lexicon: Lexicon, automaton) -> float:
    if not lexicon.curve:
        return 0.0
    z = float(np.dot(lexicon.curve, features(*evidence(said, lexicon, automaton))))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def choose(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries among counted stems and words: the most general ones that are telling.

    ``counts`` has the toxic and the clean texts of each candidate.
    """
    least = max(LEAST_DOCS, LEAST_SHARE * toxic)
    ratio = {c: (t / toxic) / ((n + 0.5) / (clean + 1))
             for c, (t, n) in counts.items() if t >= least}
    below: dict[str, list[str]] = {}
    for entry in ratio:
        body = entry.strip()
        sizes = [s for s in STEMS if s < len(body) or (s == len(body) and entry[-1] == " ")]
        parents = [" " + body[:s] for s in sizes if " " + body[:s] in ratio]
        below.setdefault(parents[-1] if parents else "", []).append(entry)
    chosen: dict[str, float] = {}
    waiting = below.get("", [])
    while waiting:
        entry = waiting.pop()
        children = below.get(entry, [])
        same = [c for c in children if counts[c][0] >= SAME * counts[entry][0]]
        if ratio[entry] < LEAST_RATIO:
            waiting += children
        elif same:
            waiting += same
        else:
            chosen[entry] = math.log(ratio[entry])
    return chosen


def learn(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    known = (labels.select(F.col(key).alias("k"), F.col(label).alias("y"))
             .where(F.col("y").isin(0, 1) & F.col("k").isNotNull() & ~held_out("k"))
             .groupBy("k").agg(F.max("y").cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
              .collect()}  # two rows
    if len(counts) < 2:
        return Lexicon()
    wanted = F.lit(False)
    for y, n in counts.items():
        wanted |= (F.col("y") == y) & hash_below(share(sample, n), "k")
    # About 2 x sample rows of a key and a label.  Read and reduced once, so that all parts of the
    # model come from the same texts.
    rows = materialise(
        df.select(F.col(key).alias("k"), F.col(text).alias("t"))
        .join(F.broadcast(known.where(wanted)), "k").groupBy("k").agg(
            F.min("t").alias("t"), F.max("y").alias("y")).select("t", "y"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        texts = Counter()
        for batch in batches:
            for body, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                said = set(words(body))
                seen = {f" {w} " for w in said}
                seen.update(" " + w[:s] for w in said for s in STEMS if s <= len(w))
                found[y].update(seen)
                texts[y] += 1
        for y, held in found.items():
            held[""] = texts[y]
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array([y] * len(held), pa.int32()),
                 pa.array(held.values(), pa.int64())], names=["entry", "y", "n"])

    seen = (rows.dropDuplicates(["t", "y"])
            .mapInArrow(in_portions(count), "entry string, y int, n long")
            .groupBy("entry").agg(
                F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("clean"))
            .where((F.col("toxic") >= LEAST_DOCS) | (F.col("entry") == "")))
    counted = {r["entry"]: (r["toxic"], r["clean"])
               for r in sorted(seen.toArrow().to_pylist(), key=lambda r: r["entry"])}
    toxic, clean = counted.pop("", (0, 0))
    if not toxic or not clean:
        return Lexicon()
    lexicon = Lexicon(choose(counted, toxic, clean))
    sent = shared(df.sparkSession, lexicon)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases around entries, and each text's evidence: (before, here, sums, label)."""
        known = sent()
        automaton = known.automaton()
        for batch in batches:
            out = []
            for body, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                said = words(body)
                total, density = evidence(said, known, automaton)
                out.append((None, None, total, density, y))
                if total:
                    for a, b in zip(["", *said], [*said, ""], strict=True):
                        if any(any(True for _ in automaton.iter(f" {w} ")) for w in (a, b)):
                            out.append((a, b, 0.0, 0.0, y))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    columns, (pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()),
                    strict=True)], names=["a", "b", "total", "density", "y"])

    held = rows.mapInArrow(
        in_portions(neighbours), "a string, b string, total double, density double, y int")
    phrases = (held.where("a IS NOT NULL").groupBy("a", "b").agg(
        F.sum(F.col("y")).alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
        .where((F.col("clean") >= EXCEPTION_DOCS) & (F.col("clean") > 4 * F.col("toxic"))))
    lexicon.exceptions = frozenset(
        (r["a"], r["b"]) for r in phrases.toArrow().to_pylist())
    fit = held.where("a IS NULL").select("total", "density", "y").toArrow()  # 2 x sample rows
    fit = fit.sort_by([(c, "ascending") for c in fit.column_names])
    lexicon.curve = curve_of(
        np.array([features(t, d) for t, d in zip(
            fit.column(0).to_pylist(), fit.column(1).to_pylist(), strict=True)]),
        fit.column(2).to_numpy().astype(float))
    return lexicon


def with_score(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All columns, then ``tox_score``, which replaces a column of that name."""
    sent = shared(df.sparkSession, lexicon)

    def start():
        known = sent()
        automaton = known.automaton()
        return lambda texts: ([score(words(t), known, automaton) for t in texts],)

    return add_columns(df, text, [("tox_score", "double", pa.float64())], start)
