"""Every stage of the pipeline against a plain loop over the same rows, row by row."""

import struct
from collections import Counter

import public_tokenizers
import pytest
from test_pairs import expected_groups
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import langid, pii, queries, toxicity

SF = "/root/testdata/sf0.001"
# Columns that operators use themselves, in the order of the frame.
CLASHING = ["'z' AS score", "'l' AS lang_pred", "0.5D AS tox_score", "9 AS n_pii", "'n' AS name",
            "'k' AS `key`", "1 AS c0", "2 AS c1", "3 AS component_id", "4 AS cid", "5 AS n"]


@pytest.fixture(scope="module")
def docs(spark):
    """Given documents; nulls, empty and blank texts, repeated keys and rows, personal data."""
    given = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars")
    some = given.orderBy("doc_id").limit(5)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (7, None, "en", None, 0), (7, "", "en", "s", 0),
         (8, " \n", None, "s", 2), (8, "12 34", "fr", "s", 5), (None, "no key here", None, "s", 11),
         (9, "call +44 20 7946 0958 or 4111 1111 1111 1111", "en", "s", 43),
         (9, "call +44 20 7946 0958 or 4111 1111 1111 1111", "en", "s", 43),
         (10, "漢字 " * 50, None, "s", 150)], given.schema)
    return given.union(some).union(odd).selectExpr("*", *CLASHING).repartition(5)


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_language_stage(spark, docs):
    filters = langid.learn(docs)
    at = docs.columns.index("text")

    def stays(text):
        said, score = langid.decide(text, filters)
        return said != langid.UNKNOWN and score >= corpus_pipeline.LEAST_LANGUAGE

    want = Counter({r: n for r, n in rows_of(docs).items() if stays(r[at])})
    got = corpus_pipeline.language(spark, docs, SF)
    assert got.columns == docs.columns and rows_of(got) == want
    assert 200 <= want.total() < docs.count()


def test_toxicity_stage(spark, docs):
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    automaton, at = lexicon.automaton(), docs.columns.index("text")
    want = Counter({r: n for r, n in rows_of(docs).items() if toxicity.score(
        toxicity.words(r[at]), lexicon, automaton) < queries.TOXIC})
    got = corpus_pipeline.toxic(spark, docs, SF)
    assert got.columns == docs.columns and rows_of(got) == want


def test_duplicate_stage(spark, docs):
    """Of each group the row of the smallest key stays, null keys last; equal rows stay once."""
    at, key = docs.columns.index("text"), docs.columns.index("doc_id")
    rows = list(rows_of(docs))
    sets, roots = expected_groups([r[at] for r in rows])
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(roots[i] if sets[i] else ("alone", i), []).append(row)
    want = [min(group, key=lambda r: (r[key] is None, r[key] or 0)) for group in groups.values()]
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    found = rows_of(got)
    by_text = Counter(r[at] for r in want)
    assert Counter(r[at] for r in found.elements()) == by_text or {
        r[key] for r in found} == {r[key] for r in want}
    assert found.total() == len(want) and set(found) <= set(rows)


def test_personal_data_stage(spark, docs):
    cipher, at = pii.Cipher(queries.PII_KEY), docs.columns.index("text")
    size = docs.columns.index("n_chars")
    want = Counter()
    for row, n in rows_of(docs).items():
        out = list(row)
        if row[at] is not None:
            out[at], spans = pii.replace(row[at], cipher)
            out[size] = len(out[at]) if spans else row[size]
        want[tuple(out)] += n
    got = corpus_pipeline.personal_data(spark, docs, SF)
    assert got.columns == docs.columns and rows_of(got) == want
    assert want != rows_of(docs)


def test_packing_stage(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made = corpus_pipeline.packed(spark, docs, SF).collect()
    want = Counter()
    for key, text in docs.select("doc_id", "text").collect():
        want.update((key, i) for i in [
            *library.encode(text or "", add_special_tokens=False).ids, 0])
    got, windows = Counter(), {}
    for r in made:
        ids = struct.unpack(f"<{r.length}I", r.ids)
        got.update((r.doc_id, i) for i in ids)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length, r.tier))
    assert got == want
    for pieces in windows.values():
        pieces.sort()
        assert [o for o, *_ in pieces] == [sum(n for _, n, _ in pieces[:i])
                                           for i in range(len(pieces))]
        assert sum(n for _, n, _ in pieces) <= pieces[0][2]


def test_languages_equal_those_of_plain_sets(spark):
    """Sets of n-grams in place of filters: the same language for every document."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    said = {r.doc_id: r for r in queries.op8_language(spark, "/root/testdata/sf0.01").collect()}
    rows = documents.select("doc_id", "text", "lang").collect()
    counts = {}
    for key, text, lang in rows:
        if lang is not None and text and not said[key].held_out:
            counts.setdefault(lang, Counter()).update(langid.grams(text).tolist())
    sets = {lang: {g for g, n in c.items() if n >= c.total() * langid.LEAST_SHARE}
            for lang, c in counts.items()}
    for key, text, _ in rows:
        found = langid.grams(text).tolist() if text else []
        if not found:
            assert said[key].lang_pred == langid.UNKNOWN
            continue
        share = {lang: sum(g in own for g in found) / len(found) for lang, own in sets.items()}
        best = max(share, key=share.get)
        assert abs(said[key].score - share[said[key].lang_pred]) < 0.02
        assert said[key].lang_pred == best or share[best] - share[said[key].lang_pred] < 0.02
