"""Mergeable statistics, digests that locate differences, clustering by several keys."""

import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from tidemark.operators import (
    column_stats, locate_differences, merged_stats, refresh_sketches, sketch_partitions,
)
from tidemark.sources import file_spans, materialise, read_table, write_clustered, write_curved


def table(spark, low, high, path):
    spark.range(low, high, 1, 4).select(
        (F.col("id") % 5).cast("int").alias("p"), "id",
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id") % 900)).alias("t"),
        (F.col("id") / 10).alias("x"), F.lit(None).cast("int").alias("none"),
    ).write.partitionBy("p").mode("append").parquet(path)
    return spark.read.parquet(path)


def test_merged_sketches_equal_the_statistics(spark, tmp_path):
    df = table(spark, 0, 20_000, str(tmp_path / "t"))
    got = {r.column_name: r for r in merged_stats(sketch_partitions(df, ["p"])).collect()}
    assert list(got) == ["id", "t", "x", "none"]
    for want in column_stats(df.select("id", "t", "x", "none"), distinct="exact").collect():
        row = got[want.column_name]
        assert (row.rows, row.nulls, row.min_value, row.max_value) == (
            want.rows, want.nulls, want.min_value, want.max_value)
        assert abs(row.distinct_values - want.distinct_values) <= 0.05 * want.distinct_values
    for q, value in zip((.25, .5, .75), got["id"].quantiles, strict=True):
        assert abs(value / 20_000 - q) < 0.03
    assert got["t"].quantiles is None and got["none"].quantiles is None
    assert abs(got["x"].quantiles[1] - 1_000) < 60


def test_a_batch_refreshes_only_the_partitions_it_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = materialise(sketch_partitions(table(spark, 0, 5_000, path), ["p"]), "sketches")
    spark.range(5_000, 5_050).selectExpr(
        "3 AS p", "id", "'new' AS t", "1.5D AS x", "CAST(NULL AS INT) AS none").write.partitionBy(
        "p").mode("append").parquet(path)
    for file in (tmp_path / "t" / "p=1").glob("*.parquet"):
        file.write_bytes(b"unreadable")  # not touched, so not read
    touched = spark.createDataFrame([(3,), (9,)], "p int")
    fresh = materialise(refresh_sketches(stored, spark.read.parquet(path), ["p"], touched), "sketches")
    assert rows_of(fresh, "p", "rows") == [(p, 1_050 if p == 3 else 1_000) for p in range(5)]
    got = {r.column_name: r for r in merged_stats(fresh).collect()}
    assert got["id"].rows == 5_050 and got["id"].max_value == "5049" and got["t"].max_value == "t99"
    assert merged_stats(stored.limit(0)).first().rows == 0


def test_equal_tables_are_compared_without_their_keys(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "id * 3 AS v").write.parquet(str(tmp_path / "a"))
    one = spark.read.parquet(str(tmp_path / "a"))
    other = one.repartition(7)
    found = locate_differences(one, other, "id", ["v"])
    assert found.isEmpty()
    found.collect()
    plan = plan_of(found)
    assert "PushedFilters: []" not in plan or "LocalTableScan" in plan  # nothing is read again


@pytest.mark.parametrize("leaves", [1, 16, 4096])
def test_differences_are_located(spark, leaves):
    rows = [(i * 3, i % 10) for i in range(2_000)] + [(None, 1), (9, 5)]
    one = spark.createDataFrame(rows, "id long, v int")
    assert locate_differences(one, one.repartition(3), "id", ["v"], leaves).isEmpty()
    # One lost, one doubled, one changed, one new, one with a null key lost: the count is equal.
    two = [r for r in rows if r[0] not in (300, None)] + [(900, 0), (-8, 1)]
    two = [(k, 77 if k == 1500 else v) for k, v in two]
    assert len(two) == len(rows)
    found = locate_differences(one, spark.createDataFrame(two, "id long, v int"), "id", ["v"], leaves)
    assert rows_of(found) == sorted([
        (300, 1, 0), (900, 1, 2), (1500, 1, 1), (-8, 0, 1), (None, 1, 0)], key=repr)
    # Keys alone: the changed row does not show.
    keys = locate_differences(one, spark.createDataFrame(two, "id long, v int"), "id", [], leaves)
    assert (1500, 1, 1) not in rows_of(keys) and len(rows_of(keys)) == 4
    none = one.limit(0)
    assert locate_differences(none, none, "id", [], leaves).isEmpty()
    assert locate_differences(one, none, "id", [], leaves).count() == 2_001


def test_a_curve_serves_every_key(spark, tmp_path):
    draw = random.Random(2)
    rows = spark.createDataFrame(
        [(i, draw.randrange(10_000), draw.randrange(500), draw.choice([None, 1.5, 2.5]))
         for i in range(8_000)], "id long, a int, b int, c double")
    write_curved(rows, str(tmp_path / "z"), ["a", "b"], ["id"], files=16)
    write_clustered(rows, str(tmp_path / "s"), ["a"], ["id"], files=16)
    z, s = (read_table(spark, str(tmp_path / f)) for f in "zs")
    assert rows_of(z) == rows_of(rows)
    spans = {r.key: r for r in file_spans(z, ["a", "b"]).collect()}
    sorted_spans = {r.key: r for r in file_spans(s, ["a", "b"]).collect()}
    assert spans["a"].files == 16
    assert spans["a"].share_of_span < 0.45 and spans["b"].share_of_span < 0.45
    assert sorted_spans["b"].share_of_span > 0.9  # the first key alone is served
    write_curved(rows, str(tmp_path / "n"), ["c", "a"], ["id"], files=4)
    assert read_table(spark, str(tmp_path / "n")).count() == 8_000
    write_curved(rows.limit(0), str(tmp_path / "e"), ["a", "b"], ["id"])
    assert read_table(spark, str(tmp_path / "e")).count() == 0
