"""Fingerprints against a plain version of the sampling and of the edits."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, queries

SMALL = "/root/testdata/sf0.001"


def edits(rows):
    """(key, text) to (key, n_chars, digest of the edited text, edited text, next text)."""
    order = sorted({(k, t or "") for k, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for (key, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        cut = len(text) // 4
        made = text[:len(text) - cut] + after[:cut]
        out[key, text] = (key, len(text), hashlib.sha256(made.encode()).hexdigest(), made, after)
    return [out[k, t or ""] for k, t in rows]


def weights(text):
    found = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return Counter(found or [text])


def jaccard(a, b):
    a, b = weights(a), weights(b)
    return sum((a & b).values()) / sum((a | b).values())


def compared(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).selectExpr(
        "*", "1 AS name", "2 AS side", "3 AS copies", "4 AS term")
    return fingerprints.compare_edits(frame).collect()


def test_edits_and_likeness(spark):
    rows = [(None, "first of all"), (1, None), (2, ""), (3, "漢字 und straße " * 9), (4, "..."),
            (5, "One TWO three"), (7, "one two THREE"), (8, "word " * 60_000), (9, "x" * 50_000),
            (6, "abc"), (10, "a"), (11, "the end of it all, the end")] + [(12, "copy " * 4)] * 30
    got = {(r.doc_id, r.n_chars): r for r in compared(spark, rows)}
    assert len(compared(spark, rows)) == len(rows)
    want = edits(rows)
    assert {(k, n): d for k, n, d, *_ in want} == {k: r.edited_sha256 for k, r in got.items()}
    for key, n, _, made, after in want:
        row, text = got[key, n], dict(rows)[key] or ""
        assert len(row.fingerprint) == len(row.edited_fingerprint) == 4 * fingerprints.SAMPLES
        assert abs(row.near_edited - jaccard(text, made)) < .3
        assert abs(row.near_next - jaccard(text, after)) < .3
    assert got[5, 13].fingerprint == got[7, 13].fingerprint
    assert got[2, 0].fingerprint == got[1, 0].fingerprint != got[4, 3].fingerprint


def test_small_tables(spark):
    assert compared(spark, []) == []
    row, = compared(spark, [(4, "a b c d")])
    assert row.near_next == 1.0
    assert row.edited_sha256 == hashlib.sha256(b"a b c a").hexdigest()


def sampled(weighted, by, samples):
    draws = [F.col(f"s{i}") for i in range(samples)]
    return fingerprints.least_draws(weighted, by, samples).select(
        *by, fingerprints.fingerprint(draws).alias("fingerprint"))


def test_samples_agree_as_often_as_generalised_jaccard(spark):
    rng, rows, pairs = np.random.default_rng(3), [], []
    for pair in range(60):
        terms = rng.integers(0, 1 << 40, 40).tolist()
        a, b = (np.maximum(rng.geometric(.3, 40) - rng.integers(0, 3, 40), 0) for _ in range(2))
        pairs.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        for side, counts in enumerate((a, b)):
            rows += [(pair, side, t, int(n)) for t, n in zip(terms, counts, strict=True) if n]
    weighted = spark.createDataFrame(rows, "pair int, side int, term long, weight long")
    made = sampled(weighted, ["pair", "side"], 64).groupBy("pair").pivot("side", [0, 1]).agg(
        F.first("fingerprint"))
    got = {r.pair: r.near for r in made.select("pair", fingerprints.likeness(
        F.col("0"), F.col("1"), 64).alias("near")).collect()}
    error = np.array([got[p] for p in range(60)]) - np.array(pairs)
    assert abs(error.mean()) < .025 and error.std() < .1


def plain_draw(drawn, weight):
    """The published scheme, in doubles: a term's draw and the digest of its sample."""
    unit = lambda low, width: ((drawn >> low & (1 << width) - 1) + .5) / (1 << width)
    r = -np.log(unit(0, 11) * unit(11, 11))
    b, c = unit(22, 10), -np.log(unit(32, 16) * unit(48, 16))
    t = np.floor(np.log(weight) / r + b)
    y = np.exp(r * (t - b))
    return c / (y * np.exp(r)), (drawn ^ int(t)) & 0xFFFF


def test_samples_equal_the_plain_scheme(spark):
    rows = [(g, t, 1 + (g * t) % 9) for g in range(4) for t in range(g, 40, g + 1)]
    weighted = spark.createDataFrame(rows, "g int, term long, weight long")
    got = {r.g: r.fingerprint for r in sampled(weighted, ["g"], 20).collect()}
    hashed = {(r.term, r.i): r.h % (1 << 64) for r in spark.range(40).select(
        F.col("id").alias("term"), F.explode(F.sequence(F.lit(0), F.lit(19))).alias("i")).select(
        "term", "i", F.xxhash64("term", F.col("i").cast("int")).alias("h")).collect()}
    for group in range(4):
        own = [(t, n) for g, t, n in rows if g == group]
        want = b"".join(min(plain_draw(hashed[t, i], n) for t, n in own)[1].to_bytes(2, "big")
                        for i in range(20))
        assert bytes(got[group]) == want


def test_shared_words_are_those_of_both_texts(spark):
    rows = [(0, "", "", ""), (1, "a b", "c d", "e"), (2, "a b ", "c", ""), (3, "...", "", "x"),
            (4, "One", " two", ""), (5, "?", "!", "!!"), (6, "x y x ", "y y", "X")]
    texts = spark.createDataFrame(rows, "name long, kept string, own string, other string")
    got = {}
    for r in fingerprints.shared_words(texts).collect():
        for side in (r.of,) if r.of != fingerprints.BOTH else (0, 1):
            got.setdefault((r.name, side), []).append(r.term)
    terms = [w for _, *parts in rows for t in (parts[0] + parts[1], parts[0] + parts[2])
             for w in weights(t)]
    code = {r.w: r.h for r in spark.createDataFrame([(t,) for t in set(terms)], "w string").select(
        "w", F.xxhash64("w").alias("h")).collect()}
    for name, kept, own, other in rows:
        for side, text in enumerate((kept + own, kept + other)):
            want = [code[w] for w in weights(text).elements()]
            assert sorted(got[name, side]) == sorted(want)


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select(
        "doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op13_fingerprints(spark, SMALL).collect()}
    want = edits(rows)
    assert {k: (r.n_chars, r.edited_sha256) for k, r in got.items()} == {
        k: (n, d) for k, n, d, *_ in want}
    texts = {k: t or "" for k, t in rows}
    near = np.array([got[k].near_edited - jaccard(texts[k], made) for k, _, _, made, _ in want])
    apart = np.array([got[k].near_next - jaccard(texts[k], after) for k, *_, after in want])
    for error in near, apart:
        assert abs(error.mean()) < .02 and error.std() < .1
    equal = {}
    for k, text in texts.items():
        assert equal.setdefault(text, got[k].fingerprint) == got[k].fingerprint
