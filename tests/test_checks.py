import pytest
from conftest import SMALL, SPEC, dim_of, fact_of, plan_of, rows_of
from pyspark.sql import functions as F

from tidemark.operators import (
    column_stats, duplicate_keys, not_null_report, orphans, partition_profile, reconcile,
    relationships, row_counts, skew_profile, watermark_profile,
)
from tidemark.plans import (
    Expectations, build_output, generate_dimension, generate_fact, verify,
)

DIM = [("x", "1"), ("y", "2"), ("z", "3")]
FACT = [(1, "x", 0, 0), (2, "y", 0, 1), (3, "x", 0, 1), (4, "q", 0, 2), (5, None, 0, 2),
        (6, None, 0, 2)]


def test_row_counts_takes_names_from_the_first(spark):
    got = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert got.columns == ["table_name", "rows"]
    assert rows_of(got) == [("a", 3), ("b", 0)]


def test_duplicate_keys(spark):
    fact = fact_of(spark, FACT)
    assert rows_of(duplicate_keys(fact, ["k"])) == [("x", 2), (None, 2)]
    assert rows_of(duplicate_keys(fact, ["k"], ignore_null=True)) == [("x", 2)]
    assert duplicate_keys(fact, ["k", "id"]).count() == 0


def test_not_null_report_is_one_pass(spark):
    got = not_null_report(fact_of(spark, FACT), ["id", "k"])
    assert rows_of(got) == [("id", 0), ("k", 2)]
    assert rows_of(not_null_report(fact_of(spark, []), ["id"])) == [("id", 0)]


def test_orphans_count_null_keys_and_relationships_do_not(spark):
    fact, dim = fact_of(spark, FACT), dim_of(spark, DIM)
    assert rows_of(orphans(fact, dim, "k")) == [("q", 1), (None, 2)]
    assert rows_of(relationships(fact, dim, "k")) == [("q", 1)]
    renamed = dim.withColumnRenamed("k", "name")
    assert rows_of(orphans(fact, renamed, "k", "name")) == [("q", 1), (None, 2)]


def test_orphan_rows_are_counted_before_the_join_when_it_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = orphans(spark.range(1000).selectExpr("id % 3 AS k"), spark.range(2).toDF("k"), "k")
        plan = plan_of(got)
        assert rows_of(got) == [(2, 333)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("Join") < plan.index("partial_count")  # the plan prints parents first


def test_equal_counts_do_not_hide_a_swap(spark):
    source = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    output = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    row = reconcile(source, output, "id").first()
    assert row.source_rows == row.output_rows == 3
    assert (row.missing_keys, row.extra_keys, row.duplicate_output_keys) == (1, 0, 1)


def test_reconcile_counts_extra_and_null_keys_and_nulls(spark):
    source = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    output = spark.createDataFrame([(1, None), (9, None), (9, "c")], "id int, v string")
    row = reconcile(source, output, "id", ["v"]).first()
    assert (row.extra_keys, row.missing_keys, row.null_source_keys, row.output_nulls) == (1, 1, 1, 2)
    empty = reconcile(source.limit(0), output.limit(0), "id").first()
    assert set(empty) == {0}


def test_partition_profile_truncates_the_average(spark):
    df = spark.createDataFrame([(1, 0)] * 5 + [(1, 1)] * 2 + [(2, 0)], "a int, b int")
    row = partition_profile(df, ["a", "b"], expected=4).first()
    assert (row.partitions, row.expected_partitions, row.total_rows) == (3, 4, 8)
    assert (row.avg_rows_per_partition, row.min_rows, row.max_rows, row.thin) == (2, 1, 5, True)
    assert not partition_profile(df, ["a"], thin=4).first().thin
    none = partition_profile(df.limit(0), ["a"]).first()
    assert (none.partitions, none.total_rows, none.thin) == (0, 0, False)


def test_skew_profile_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbccd"], "k string")
    got = [tuple(r) for r in skew_profile(df, ["k"], 3).collect()]
    assert got == [("a", 3, 37.5), ("b", 2, 25.0), ("c", 2, 25.0)]


def test_skew_profile_reads_its_input_once_and_uses_no_window(spark):
    got = skew_profile(spark.range(100).selectExpr("id % 5 AS k"), ["k"])
    got.collect()
    plan = plan_of(got)
    assert "ReusedExchange" in plan and "Window" not in plan


def test_watermark_profile(spark):
    row = watermark_profile(fact_of(spark, FACT + [(7, "x", 0, None)]), "ts").first()
    assert (str(row.earliest), str(row.latest), row.distinct_days) == (
        "2026-01-01 00:00:00", "2026-01-03 00:00:00", 3)


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_column_stats(spark, mode):
    got = column_stats(fact_of(spark, FACT), ["id", "k", "ts"], mode)
    assert rows_of(got) == [
        ("id", 6, 0, 6, "1", "6"), ("k", 6, 2, 3, "q", "y"),
        ("ts", 6, 0, 3, "2026-01-01 00:00:00", "2026-01-03 00:00:00")]


def test_exact_column_stats_scan_once(spark, tmp_path):
    fact_of(spark, FACT).write.parquet(str(tmp_path / "t"))
    stats = column_stats(spark.read.parquet(str(tmp_path / "t")), ["id", "k"], "exact")
    assert plan_of(stats).split("Initial Plan")[-1].count("FileScan") == 1


def test_column_stats_refuses_other_modes(spark):
    with pytest.raises(ValueError):
        column_stats(spark.range(1), distinct="some")


@pytest.fixture(scope="module")
def generated(spark):
    dimension = generate_dimension(spark, SMALL).cache()
    fact = generate_fact(spark, SMALL, dimension).cache()
    return fact, dimension, build_output(fact, dimension).cache()


EXPECTED = Expectations.of(SMALL, tolerance=4.0)


def _failed(report):
    return {r["check"] for r in report.filter("NOT passed").collect()}


def test_good_tables_pass_every_check(generated):
    fact, dimension, output = generated
    report = verify(fact, dimension, output, expected=EXPECTED)
    assert report.columns == ["check", "expected", "actual", "passed"]
    assert _failed(report) == set() and report.count() == 18


def test_verify_without_an_output(generated):
    fact, dimension, _ = generated
    assert _failed(verify(fact, dimension, expected=EXPECTED)) == set()


def test_verify_names_what_is_wrong_with_the_output(generated):
    fact, dimension, output = generated
    gone = output.filter("employee_id <> 100005")
    assert _failed(verify(fact, dimension, gone, expected=EXPECTED)) == {
        "output_rows_equal_fact_rows", "output_missing_keys"}
    swapped = gone.union(output.filter("employee_id = 100006"))
    assert _failed(verify(fact, dimension, swapped, expected=EXPECTED)) == {
        "output_missing_keys", "output_key_unique"}
    blank = output.withColumn("cost_center", F.when(F.col("employee_id") > 100_001, "x"))
    assert _failed(verify(fact, dimension, blank, expected=EXPECTED)) == {"output_not_null"}


def test_verify_names_what_is_wrong_with_the_sources(generated):
    fact, dimension, output = generated
    doubled = dimension.union(dimension.filter("department_number = 1"))
    assert _failed(verify(fact, doubled, output, expected=EXPECTED)) == {
        "dimension_rows", "dimension_key_unique"}
    lacking = dimension.filter("department_number <> 5")
    assert _failed(verify(fact, lacking, output, expected=EXPECTED)) == {
        "dimension_rows", "fact_orphan_rows"}
    flat = fact.withColumn("updated_at", F.lit("2026-08-01 00:00:00").cast("timestamp_ntz"))
    assert _failed(verify(flat, dimension, output, expected=EXPECTED)) == {"fact_distinct_days"}
    unmarked = fact.withColumn(
        "updated_at", F.when(F.col("employee_id") > 100_001, F.col("updated_at")))
    assert _failed(verify(unmarked, dimension, output, expected=EXPECTED)) == {
        "fact_watermark_not_null"}
    even = fact.withColumn("department_number", F.lit(4))
    assert _failed(verify(even, dimension, output, expected=EXPECTED)) == {
        "fact_partitions", "fact_hot_share_pct"}


def test_verify_of_empty_tables_reports_instead_of_failing(generated):
    fact, dimension, output = generated
    report = verify(fact.limit(0), dimension, output.limit(0), expected=EXPECTED)
    assert "fact_rows" in _failed(report)


def test_verify_takes_other_tables(spark):
    fact, dim = fact_of(spark, FACT), dim_of(spark, DIM)
    report = verify(fact, dim, build_output(fact, dim, SPEC), SPEC,
                    Expectations(rows_per_partition=None), partition_by=["v"])
    assert _failed(report) == {
        "fact_join_key_not_null", "fact_orphan_rows", "output_rows_equal_fact_rows",
        "output_missing_keys"}
