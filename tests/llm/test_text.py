"""Per-text operators against libraries, round trips and plain versions."""

import base64
import hashlib
import json
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, langid, packing, pii, queries, secrets, sharding, toxicity
from tidemark.llm.common import hash_below

# Nulls, empty and blank texts, ties, repeated rows, a very long text; ids repeat or lack.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (4, "a b"), (None, "x"), (None, None),
       (5, "word " * 40_000), (6, "naïve Σίσυφος 日本 <|endoftext|> don't 12"), (7, "7 8 !")]


def odd(spark, rows=None):
    """Such rows, with columns whose names the operators use themselves."""
    made = spark.createDataFrame(ODD if rows is None else rows, "doc_id bigint, text string")
    return made.selectExpr("doc_id", "text", "'z' AS score", "1 AS n_tokens", "2 AS shard",
                           "3 AS `a.b`", "4 AS c0", "'k' AS key", "'t' AS tox_score")


def test_encoding_equals_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    made = bpe.decode(bpe.encode(odd(spark), path), path)
    assert made.exceptAll(bpe.round_trip(odd(spark), path)).isEmpty()
    got = sorted((r.doc_id or 0, r.n_tokens, bytes(r.ids), r.decoded) for r in made.collect())
    want = []
    for key, text in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key or 0, len(ids), struct.pack(f"<{len(ids)}I", *ids),
                     library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe.encode(odd(spark, []), path).count() == 0


def test_merging_skips_stale_pairs():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = bpe.WordBpe(path), Tokenizer.from_file(path)
    draw = random.Random(5)
    for _ in range(400):
        text = "".join(draw.choices("aabenrst' .,İß９́ ", k=draw.randint(1, 40)))
        assert list(memoryview(own.encode(text)).cast("I")) == library.encode(
            text, add_special_tokens=False).ids, text


def test_shards_follow_the_hash(spark):
    def brute(key, weights):
        def value(shard):
            seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
            bits = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed) >> 11
            return -np.log((bits + 0.5) / (1 << 53)) / weights[shard]
        return min((value(s), s) for s in range(len(weights)) if weights[s])[1]

    # 32-bit values are hashed as four bytes.
    rows = [*ODD, *((i, f"t{i}") for i in range(100, 400))]
    made = sharding.with_slots(sharding.assign(odd(spark, rows), [1, 2, 1, 0], [1, 2, 1, 0, 3]))
    got = made.collect()
    assert made.columns == ["doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"]
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (k or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    assert all(r.shard == brute(r.doc_id, [1, 2, 1, 0]) for r in got)
    assert all(r.grown_shard in (r.shard, 4) for r in got)
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(
            range(sum(r.shard == shard for r in got)))
    assert sharding.with_slots(sharding.assign(odd(spark, []), [1.0])).count() == 0


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([i + 1] * 60)) for i in range(8)))


def test_base_patterns_are_leftmost_and_drop_short_ones():
    text = 'é PassWord = "abcdefghijkl" token: short secret=ſecret AKIA' + "A" * 14 + " " + "0" * 15
    assert secrets.base_spans(text) == [("assign", 2, 26), ("access", 55, 73)]
    assert secrets.base_spans("password: secret: abcdefghijklmnop") == []


def test_structure_confirms_candidates():
    def kinds(text):
        return {k for k, _, _ in secrets.confirmed_spans(text)}

    def b64(data):
        return base64.b64encode(data).decode()

    token = ".".join(base64.urlsafe_b64encode(json.dumps(o).encode()).decode().rstrip("=")
                     for o in ({"alg": "HS256"}, {"sub": "someone"})) + ".c2lnbmF0dXJl"
    assert kinds(f"x {token} y") == {"jwt"}
    assert kinds(f"x {b64(RSA)} y") == {"key"}
    assert kinds(f"x {RSA.hex()} y") == {"key"}
    assert kinds(f"x {b64(RSA[:-3])}") == kinds(f"x {b64(bytes(range(90)))}") == set()
    body = b64(RSA)
    assert "pem" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----")
    assert "nested" in kinds(b64(b"password=abcdefghijklmnop"))


def test_keys_in_either_alphabet_and_after_a_hexadecimal_prefix():
    draw = random.Random(8)
    rsa = bytes.fromhex("300d06092a864886f70d0101010500")
    for _ in range(50):
        numbers = der(2, b"\0") + b"".join(der(2, b"\1" + draw.randbytes(60)) for _ in range(8))
        key = der(0x30, der(2, b"\0") + rsa + der(4, der(0x30, numbers)))
        safe, plain = (f(key).decode() for f in (base64.urlsafe_b64encode, base64.b64encode))
        assert set("-_") & set(safe) and set("+/") & set(plain)
        for text in (safe, safe.rstrip("="), plain, key.hex(), key.hex().upper()):
            for before in ("", "x ", "key=", "0x", "0X")[:5 if text.lower() == key.hex() else 3]:
                at = len(before)
                assert secrets.confirmed_spans(f"{before}{text} y") == [
                    ("key", at, at + len(text))], before
        # What only stands beside a standard key is not taken with it.
        assert ("key", 7, 7 + len(plain)) in secrets.confirmed_spans(f"my_key-{plain}")
    inner = "ÿþ ~~~ ??? öÿ? password=abcdefghijklmnop"
    safe = base64.urlsafe_b64encode(inner.encode()).decode()
    assert set("-_") & set(safe)
    assert secrets.confirmed_spans(safe) == [("nested", 0, len(safe))]
    assert secrets.confirmed_spans("0x" + inner.encode().hex()) == [
        ("nested", 2, 2 + 2 * len(inner.encode()))]


def test_secret_digests(spark):
    made = secrets.digests(secrets.scan(odd(spark, [*ODD, (9, "token=abcdefghijkl")]))).collect()
    by_key = {r.doc_id: r for r in made}
    assert len(made) == len(ODD) + 1
    assert by_key[1].base_sha256 == hashlib.sha256(b"").hexdigest() and by_key[1].spans == ""
    assert by_key[9].spans == "assign:0:18" and by_key[9].n_assign == 1


def test_feistel_is_a_permutation():
    cipher = pii.Cipher(b"k")
    for n in (2, 10, 97, 1000):
        image = [cipher.permute(v, n, "t") for v in range(n)]
        assert sorted(image) == list(range(n))
        assert [cipher.permute(v, n, "t", back=True) for v in image] == list(range(n))


def test_pseudonyms_keep_formats_and_link_values():
    cipher = pii.Cipher(b"k")

    def one(text):
        return pii.replace(text, cipher)

    card, spans = one("pay 4111 1111 1111 1111 now")
    digits = pii.digits_of(card)
    assert spans == ["card:4:23"] and card != "pay 4111 1111 1111 1111 now"
    assert pii.luhn_digit(digits[:-1]) == digits[-1]
    assert pii.digits_of(one("4111-1111-1111-1111")[0]) == digits
    assert one("4111 1111 1111 1112")[1] == []
    iban = one("GB82 WEST 1234 5698 7654 32")[0]
    assert iban.startswith("GB") and pii.iban_rest(iban.replace(" ", "")) == 1
    day = one("1999-12-31")[0]
    assert day != "1999-12-31" and one(day)[1] == ["date:0:10"]
    assert one("1999-13-45")[1] == [] and one("31.12.1999")[1] == ["date:0:10"]
    assert one("31.12.1999")[0].split(".")[::-1] == day.split("-")
    assert one("999.1.1.1")[1] == [] and one("10.1.2.3")[1] == ["ip:0:8"]
    assert one("ann.lee@mail.example.org")[0].endswith(".org")
    a, b = one("+1 (386) 555-1832")[0], one("+1 386 555 1832")[0]
    assert pii.digits_of(a) == pii.digits_of(b) != "13865551832"
    assert one("plain words, 12 of them") == ("plain words, 12 of them", [])


def test_year_last_dates_of_either_order():
    cipher = pii.Cipher(b"k")
    for sep in "-./":
        made = set()
        for month, day in ((m, d) for m in range(1, 13) for d in range(13, 29)):
            for first, last in ((month, day), (day, month)):
                text = f"{first:02d}{sep}{last:02d}{sep}1999"
                out, spans = pii.replace(text, cipher)
                assert spans == ["date:0:10"] and out != text, text
                a, b, _ = map(int, out.split(sep))
                # What was the second order of the separator cannot be read in the first.
                if (sep == "/") == (first == day):
                    assert (a if sep == "/" else b) > 12, (text, out)
                made.add((first == day, out))
        assert len(made) == 2 * 12 * 16
        for text in (f"13{sep}13{sep}1999", f"12{sep}31{sep}1899", f"12{sep}31{sep}2100"):
            assert pii.replace(text, cipher) == (text, [])


NEIGHBOURS = {
    "email": ["ann.lee@mail.example.org"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "BE68 5390 0754 7034", "ES9121000418450200051332"],
    "card": ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111",
             "3782 822463 10005", "378282246310005"],
    "phone": ["+1 (386) 555-1832", "+13865551832", "386 555 1832", "+33 1 42 68 53 00"],
    "ip": ["97.51.17.173"], "ssn": ["078-05-1120"],
    "date": ["1999-12-31", "12/31/1999", "31.12.1999"],
    "": ["97", "123", "1234", "12/27", "7.5"]}  # short numbers


def test_values_directly_before_others_are_found_whole():
    cipher = pii.Cipher(b"k")
    values = [(kind, v) for kind, given in NEIGHBOURS.items() for v in given]
    for kind, value in values:
        for other, after in values:
            at = len(value) + 1
            want = [f"{k}:{s}:{e}" for k, s, e in (
                (kind, 0, at - 1), (other, at, at + len(after))) if k]
            assert pii.replace(f"{value} {after}", cipher)[1] == want, (value, after)
    alone = pii.replace("4111111111111111", cipher)[0]
    # About one in ten of the longer runs passes the checksum as well.
    for n in range(1000):
        for text in (f"4111111111111111 {n}", f"4111111111111111-{n}"):
            assert pii.replace(text, cipher)[0] == alone + text[16:]
        assert pii.replace(f"{n} 4111111111111111", cipher)[0] == f"{n} {alone}"


def test_pseudonymise_keeps_rows_and_columns(spark):
    frame = odd(spark)
    made = pii.pseudonymise(frame, b"k")
    assert made.columns == [*frame.columns, "n_pii", "pii_spans"]
    assert sorted(map(repr, ((r[0], r[1]) for r in made.collect()))) == sorted(map(repr, ODD))


def test_samples_of_a_very_small_share(spark):
    def kept(rows, fraction):
        return spark.range(rows).where(hash_below(fraction, "id")).count()

    assert kept(1000, 0.0) == 0 and kept(1000, 1.0) == 1000 and 200 < kept(1000, 0.25) < 300
    # Ten rows of 50 million, as 10,000 of 5e10 would be.
    assert 2 <= kept(50_000_000, 10 / 50_000_000) <= 25


def test_language_of_texts(spark):
    french, german = "le chat dort dans la maison ", "der hund schläft in dem haus "
    rows = [(i, f"{french if i % 2 else german} {i}", "fr" if i % 2 else "de") for i in range(200)]
    filters = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert filters.languages == ["de", "fr"]
    made = langid.with_language(odd(spark, [*ODD, (20, "la maison du chat")]), filters)
    got = {r.doc_id: (r.lang_pred, r.score) for r in made.collect()}
    assert got[1] == got[2] == got[3] == got[7] == ("und", 0.0) and got[20][0] == "fr"
    assert all(0 <= s <= 1 for _, s in got.values())
    none = langid.learn(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert langid.decide("la maison", none) == ("und", 0.0)


def test_more_than_64_languages_fit_the_masks(spark):
    letters = [chr(0x4E00 + i) for i in range(70)]
    rows = [(7 * i + j, c * 5, f"l{i:02d}") for i, c in enumerate(letters) for j in range(4)]
    filters = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert filters.masks.shape[1] == 2
    assert langid.decide(letters[69] * 5, filters)[0] == "l69"


def test_folding_reads_lookalikes_and_substitutes():
    assert toxicity.words("1d10t, ІDIОТ! id​iot é 42 a1") == ["idiot"] * 3 + ["e", "ai"]
    assert toxicity.words(None) == []


def test_lexicon_is_learned_and_exceptions_count(spark):
    rows, labels = [], []
    for i in range(600):
        text = f"filler number{i} words here"
        bad = i % 3 == 0
        if bad:
            text += f" you are a grumble{'abcdefgh'[i % 8]} mudface"
        elif i % 10 == 1:
            text += " the famous mudface"
        rows.append((i, text))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    lexicon = toxicity.learn(docs, marks)
    assert any(e.startswith(" grumble") for e in lexicon.weights)
    scored = {r.doc_id: r.tox_score for r in toxicity.with_score(odd(spark, [
        *ODD, (30, "you GRUMBLEx"), (31, "filler words")]), lexicon).collect()}
    assert scored[30] > 0.5 > scored[31] and scored[1] == scored[2] == scored[31]
    assert toxicity.learn(docs, marks.where("toxic = 0")) == toxicity.Lexicon()


def test_toxicity_model_is_the_same_in_any_order(spark):
    draw = random.Random(9)
    rows = [(i % 150, f"some filler {draw.randrange(30)} " + (
        f"you grumble{i % 5} " if i % 3 == 0 else "fine day ") * draw.randint(1, 3))
        for i in range(600)] + [(5, None), (6, "")]
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)],
                                  "doc_id bigint, toxic int")
    models = []
    for parts, order in ((1, rows), (7, rows[::-1]), (3, draw.sample(rows, len(rows)))):
        frame = spark.createDataFrame(order, "doc_id bigint, text string").repartition(parts)
        models.append(toxicity.learn(frame, marks.repartition(parts)))
    for other in models[1:]:
        assert other.weights == models[0].weights and other.exceptions == models[0].exceptions
        assert np.array_equal(other.curve, models[0].curve)
    assert models[0].weights


def test_pieces_cover_every_token_once(spark):
    rows = [*ODD, *((i, "some words " * (i % 97)) for i in range(100, 900))]
    made = queries.pack_documents(odd(spark, rows).where("doc_id IS NOT NULL").dropDuplicates(
        ["doc_id"])).toPandas()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {k: t for k, t in rows if k is not None}
    for key, pieces in made.groupby("doc_id"):
        pieces = pieces.sort_values("start")
        ids = library.encode(texts[key] or "", add_special_tokens=False).ids + [0]
        assert b"".join(pieces.ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert pieces.start.tolist() == [0, *pieces.length.cumsum()[:-1]]
        assert set(pieces.doc_tokens) == {len(ids)}
    padding = 0
    for _, pieces in made.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces.offset.tolist() == [0, *pieces.length.cumsum()[:-1]]
        used = pieces.length.sum()
        assert used <= pieces.tier.iloc[0] and pieces.step_group.nunique() == 1
        padding += 0 if used & (used - 1) == 0 else 1024 - used
    assert padding < 0.02 * made.length.sum() + 1024 * 8
    groups = made.groupby("step_group").length.sum()
    assert (groups <= packing.STEP_TOKENS).all()
    assert queries.pack_documents(odd(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op1_bpe", "op5_secrets", "op6_toxicity", "op8_language"])
def test_queries_return_a_row_for_each_document(spark, name):
    sf = "/root/testdata/sf0.001"
    made = queries.queries()[name](spark, sf)
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    assert made.select("doc_id").exceptAll(documents.select("doc_id")).isEmpty()
    assert made.count() == documents.count()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    said = queries.op8_language(spark, sf).where("held_out").join(documents, "doc_id")
    assert said.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.98
    found = queries.op6_toxicity(spark, sf).where("held_out").join(labels, "doc_id").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("recall"),
        F.avg(F.when(F.col("predicted") == 1, F.col("toxic"))).alias("precision")).first()
    assert found.recall > 0.85 and found.precision > 0.9
