import pytest
from conftest import dim_of, fact_of, plan_of, rows_of
from pyspark.sql import functions as F

from tidemark.functions import draw, id_key
from tidemark.operators import (
    FanOutError, computed_key_join, many_to_one_join, measure_side, unmatched_rows,
)

DIM = [("x", "1"), ("y", "2"), ("z", "3")]
FACT = [(1, "x", 0, 0), (2, "y", 0, 0), (3, "x", 0, 0), (4, "q", 0, 0), (5, None, 0, 0)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 9,000 rows on one key, some without a key, the others on 500 keys."""
    return spark.range(9_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k")
    ).cache()


@pytest.fixture(scope="module")
def parents(spark):
    return spark.range(450).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("a")).union(dim_of(spark, [("hot", "h")])).cache()


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_inner_join_keeps_matching_rows_only(spark, limit):
    got = many_to_one_join(fact_of(spark, FACT), dim_of(spark, DIM), "k", broadcast_limit=limit)
    assert rows_of(got, "id", "a") == [(1, "1"), (2, "2"), (3, "1")]


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_left_join_keeps_all_rows(spark, limit):
    got = many_to_one_join(
        fact_of(spark, FACT), dim_of(spark, DIM), "k", "left", broadcast_limit=limit)
    assert rows_of(got, "id", "a") == [(1, "1"), (2, "2"), (3, "1"), (4, None), (5, None)]


def test_duplicate_parents_are_refused_before_joining(spark):
    with pytest.raises(FanOutError):
        many_to_one_join(fact_of(spark, FACT), dim_of(spark, DIM + [("x", "9")]), "k")


def test_null_parents_match_nothing(spark):
    got = many_to_one_join(
        fact_of(spark, FACT), dim_of(spark, DIM + [(None, "8"), (None, "9")]), "k")
    assert rows_of(got, "id") == [(1,), (2,), (3,)]


def test_other_join_types_are_refused(spark):
    with pytest.raises(ValueError):
        many_to_one_join(fact_of(spark, FACT), dim_of(spark, DIM), "k", "outer")


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_unmatched_rows_include_null_keys(spark, limit):
    got = unmatched_rows(fact_of(spark, FACT), dim_of(spark, DIM + [("x", "9")]), "k", limit)
    assert rows_of(got, "id") == [(4,), (5,)]


def test_measure_side(spark):
    size = measure_side(dim_of(spark, DIM + [("x", "9"), (None, "0")]), ["k"])
    assert (size.rows, size.rows_of_largest_key, size.null_keys) == (5, 2, 1)
    assert size.bytes > 5 * 48 and not size.unique
    empty = measure_side(dim_of(spark, []), ["k"])
    assert (empty.rows, empty.bytes, empty.unique) == (0, 0, True)


def test_wide_values_count_towards_the_size(spark):
    wide = spark.range(10).select(
        "id", F.repeat(F.lit("x"), 100_000).alias("text"), F.array(F.lit(1)).alias("list"))
    assert measure_side(wide, ["id"]).bytes > 1_000_000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_shuffled_join_equals_plain_join(skewed, parents, how):
    joined = many_to_one_join(skewed, parents, "k", how, broadcast_limit=0)
    assert rows_of(joined, "id", "k", "a") == rows_of(skewed.join(parents, "k", how), "id", "k", "a")


def test_shuffled_anti_join_equals_plain_anti_join(skewed, parents):
    some = parents.filter("k <> 'hot'")
    joined = unmatched_rows(skewed, some.union(some), "k", broadcast_limit=0)
    assert rows_of(joined, "id", "k") == rows_of(skewed.join(some, "k", "left_anti"), "id", "k")


def test_small_side_is_broadcast_and_large_side_not_shuffled(skewed, parents):
    plan = plan_of(many_to_one_join(skewed, parents, "k"))
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert "hashpartitioning" not in plan.split("InMemoryRelation")[0]


@pytest.mark.parametrize("kind", ["string", "decimal(9,2)", "timestamp", "double"])
def test_large_side_is_merged_once_for_any_key_type(spark, kind):
    keys = spark.range(40).selectExpr("cast(id % 4 as int) AS n", "id")
    cast = "timestamp_seconds(n)" if kind == "timestamp" else f"cast(n AS {kind})"
    large = keys.selectExpr("id", f"{cast} AS k")
    small = spark.range(3).selectExpr("cast(id as int) AS n", "id AS a").selectExpr(
        f"{cast} AS k", "a")
    joined = many_to_one_join(large, small, "k", broadcast_limit=0)
    plan = plan_of(joined)
    assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in plan
    assert joined.count() == 30


def test_computed_key_join_reaches_every_parent(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n int, name string")
    got = computed_key_join(
        spark.range(300), parents, "n", lambda n: draw(id_key("id"), "s", n) + 1, ["n", "name"])
    assert got.columns == ["id", "n", "name"]
    assert got.count() == 300 and got.select("n").distinct().count() == 3
