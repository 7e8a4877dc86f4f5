import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import (
    Vocabulary, anchor, bucket_of, cost_center, draw, expected_hot_share, id_key, keyed_hash,
    minutes_after, pick, seconds_before, skewed_key,
)

MASK = 0xFFFFFFFF


def _rotate(x, bits):
    return ((x << bits) | (x >> (32 - bits))) & MASK


def murmur(words, length, seed):
    """Murmur3 written from its definition, as an independent reference."""
    h = seed & MASK
    for word in words:
        k = _rotate((word & MASK) * 0xCC9E2D51 & MASK, 15) * 0x1B873593 & MASK
        h = (_rotate(h ^ k, 13) * 5 + 0xE6546B64) & MASK
    h ^= length
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK
    return h ^ h >> 16


def expected_hash(key, salt):
    data = salt.encode()
    whole = len(data) // 4 * 4
    words = [int.from_bytes(data[i:i + 4], "little") for i in range(0, whole, 4)]
    words += [b - 256 if b > 127 else b for b in data[whole:]]
    h = murmur([key & MASK, (key >> 32) & MASK], 8, 42)
    h = murmur(words, len(data), h)
    return h - (1 << 32) if h >= 1 << 31 else h


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.integers(-2**63, 2**63 - 1), min_size=1, max_size=30),
       salt=st.text(st.characters(codec="ascii", exclude_characters="\x00"), max_size=9))
def test_keyed_hash_is_murmur_of_key_then_salt(spark, keys, salt):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [row.h for row in df.select(keyed_hash(id_key("k"), salt).alias("h")).collect()]
    assert got == [expected_hash(k, salt) for k in keys]


def test_int_keys_hash_like_bigint_keys(spark):
    df = spark.range(5).select(F.col("id"), F.col("id").cast("int").alias("small"))
    assert df.filter(keyed_hash(id_key("id"), "a") != keyed_hash(id_key("small"), "a")).count() == 0
    assert df.filter(keyed_hash(F.col("id"), "a") == keyed_hash(F.col("small"), "a")).count() < 5


def test_draws_stay_in_range_and_salts_differ(spark):
    df = spark.range(-500, 500).select(
        draw(id_key("id"), "a", 7).alias("a"), draw(id_key("id"), "b", 7).alias("b"))
    assert {row.a for row in df.collect()} == set(range(7))
    assert 0 < df.filter("a = b").count() < 400
    with pytest.raises(ValueError):
        draw(F.col("id"), "a", 0)


def test_pick_takes_every_value(spark):
    df = spark.range(200).select(pick(["x", "y", "z"], id_key("id"), "s").alias("v"))
    assert {row.v for row in df.collect()} == {"x", "y", "z"}


def test_cost_center_has_six_digits(spark):
    df = spark.range(500).select(cost_center(id_key("id")).alias("c"))
    assert df.filter(~F.col("c").rlike("^CC-4[0-9]{5}$")).count() == 0


def test_bucket_is_int_and_never_negative(spark):
    df = spark.range(-10, 10).select(bucket_of(F.col("id"), 3).alias("b"))
    assert df.schema["b"].dataType.simpleString() == "int"
    assert {row.b for row in df.collect()} == {0, 1, 2}


@pytest.mark.parametrize("n", [1, 2, 3, 24])
def test_skewed_key_names_existing_parents_only(spark, n):
    df = spark.range(4000).select(skewed_key(id_key("id"), n).alias("k"))
    assert {row.k for row in df.distinct().collect()} == set(range(1, n + 1))
    hot = df.filter(F.col("k") <= 3).count() / 4000
    assert abs(hot - expected_hot_share(n)) < 0.03


def test_hot_share_counts_both_draws():
    assert expected_hot_share(24) == pytest.approx(0.3875)
    assert expected_hot_share(2) == pytest.approx(1.0)


def test_timestamps_stay_on_their_side_of_the_anchor(spark):
    at = anchor("2026-08-14 00:00:00")
    df = spark.range(5000).select(
        seconds_before(at, id_key("id"), "ts", 90 * 86_400).alias("old"),
        minutes_after(at, id_key("id"), "newts", 720).alias("new"), at.alias("at"))
    assert df.schema["old"].dataType.simpleString() == "timestamp_ntz"
    assert df.filter("old > at OR old <= at - INTERVAL 90 DAYS").count() == 0
    assert df.filter("new < at OR new > at + INTERVAL 719 MINUTES").count() == 0


def test_long_history_does_not_overflow(spark):
    days = 40_000  # more seconds than an INT holds
    df = spark.range(2000).select(seconds_before(
        anchor("2026-08-14 00:00:00"), id_key("id"), "ts", days * 86_400).alias("t"))
    assert df.filter("t < TIMESTAMP_NTZ '1990-01-01 00:00:00'").count() > 0
    assert df.filter(f"t < TIMESTAMP_NTZ '2026-08-14 00:00:00' - INTERVAL {days} DAYS").count() == 0


def test_vocabulary_refuses_what_breaks_the_join():
    with pytest.raises(ValueError):
        Vocabulary(departments=("a", "a"))
    with pytest.raises(ValueError):
        Vocabulary(divisions=())
