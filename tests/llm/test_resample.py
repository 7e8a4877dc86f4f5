"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, resample

SMALL = "/root/testdata/sf0.001"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def buckets(text):
    found = words(text)
    runs = found + [f"{a} {b}" for a, b in zip(found, found[1:], strict=False)]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(rows, target, percent=25):
    source, wanted = np.zeros(10_000, int), np.zeros(10_000, int)
    for _, text in rows:
        np.add.at(source, buckets(text), 1)
    for text in target:
        np.add.at(wanted, buckets(text), 1)
    gain = [math.floor(1000 * math.log((int(t) + 1) * (int(source.sum()) + 10_000)
                                       / ((int(s) + 1) * (int(wanted.sum()) + 10_000))))
            for s, t in zip(source, wanted, strict=True)]
    out = []
    for key, text in rows:
        own = buckets(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        name = "null" if key is None else key
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(own), weight, score, None])
    able = sorted((r for r, (_, text) in zip(out, rows, strict=True) if len(words(text)) >= 20),
                  key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, out), key=repr)


def drawn(frame):
    return sorted((tuple(r) for r in frame.select(
        "doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def odd_rows():
    long_word = "w" * 5_000
    rows = [(None, "a b " * 20), (1, None), (2, ""), (3, "  ..  "), (4, "One"),
            (5, "ÄÖ straße 漢字 " * 8), (6, f"x {long_word} y {long_word}" * 12),
            (7, "a\x00b\x7fc " * 30), (8, "le chat " * 100_000)]
    rows += [(9, "the same text again " * 6)] * 40 + [(i, "word " * (i % 30)) for i in range(10, 60)]
    return rows + [(9, "another text of the same key " * 5)]


@pytest.mark.parametrize("size", [1, 64, 1 << 20])
def test_resample_equals_plain_version(spark, monkeypatch, size):
    monkeypatch.setattr(resample, "joined", lambda texts, f=resample.joined: f(texts, size))
    rows, target = odd_rows(), ["le chat the text", "One", None, ""]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr(
        "*", "1 AS weight", "2 AS score", "3 AS key", "4 AS rank")
    got = resample.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), 25)
    assert drawn(got) == plain(rows, target)


def test_resample_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 10)], "doc_id long, text string")
    assert drawn(resample.resample(none, none, 25)) == []
    assert drawn(resample.resample(none, some, 25)) == []
    assert drawn(resample.resample(some, none, 100)) == plain([(1, "a b c " * 10)], [], 100)


def test_registered_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select(
        "doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = queries.op12_resample(spark, SMALL)
    assert [k for _, k in got.dtypes] == ["bigint"] * 5
    assert drawn(got) == plain(rows, target)


def test_drawn_rows_are_whole(spark):
    docs = spark.createDataFrame(odd_rows(), "doc_id long, text string")
    ranked = resample.resample(docs, docs.limit(3), 50)
    ids = {r.doc_id for r in ranked.where(F.col("rank").isNotNull()).collect()}
    kept = resample.drawn_rows(docs, ranked).collect()
    assert {r.doc_id for r in kept} == ids - {None} and all(r.text for r in kept)
