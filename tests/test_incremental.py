from dataclasses import replace

import pytest
from conftest import SMALL, SPEC, dim_of, fact_of, plan_of, rows_of
from pyspark.sql import functions as F

from tidemark.config import BatchConfig, WatermarkPolicy
from tidemark.operators import high_water_mark, newer_than
from tidemark.plans import (
    OutputCheckError, build_output, check_output, compact_overlay, create_sources, land_batch,
    quarantine, refresh_output, refresh_overlay, run_build, verify_layout,
)

from tidemark.sources.layout import clustering_columns

DIM = [("x", "1"), ("y", "2"), ("z", "3")]
BASE = [(1, "x", 0, 0), (2, "y", 0, 1), (3, "z", 0, 2)]


def test_mark_of_an_empty_table_is_none(spark):
    assert high_water_mark(fact_of(spark, []), "ts") is None
    assert high_water_mark(fact_of(spark, [(1, "x", 0, None)]), "ts") is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_mark_keeps_its_value_in_any_zone(spark, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(5).selectExpr(
            f"id", f"CAST('2026-03-08 01:30:00.123456' AS {kind}) + make_interval(0,0,0,0,0,id) AS ts")
        mark = high_water_mark(df.filter("id <= 2"), "ts")
        assert rows_of(newer_than(df, "ts", mark), "id") == [(3,), (4,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_mark_in_the_hour_clocks_are_set_back(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 05:30 and 06:30 UTC are both 01:30 on this day
        df = spark.createDataFrame([(1, 1793511000), (2, 1793514600)], "id int, s bigint").select(
            "id", F.timestamp_seconds("s").alias("ts"))
        assert rows_of(df, F.col("ts").cast("string"))[0] == rows_of(
            df, F.col("ts").cast("string"))[1]
        assert rows_of(newer_than(df, "ts", high_water_mark(df, "ts")), "id") == []
        first = high_water_mark(df.filter("id = 1"), "ts")
        assert rows_of(newer_than(df, "ts", first), "id") == [(2,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_strict_drops_rows_at_the_mark_and_inclusive_keeps_them(spark):
    fact = fact_of(spark, BASE + [(4, "x", 0, 2), (5, "y", 0, 3)])
    mark = high_water_mark(fact_of(spark, BASE), "ts")
    assert rows_of(newer_than(fact, "ts", mark), "id") == [(5,)]
    assert rows_of(newer_than(fact, "ts", mark, WatermarkPolicy("inclusive")), "id") == [
        (3,), (4,), (5,)]
    late = WatermarkPolicy("strict", "1 day 12 hours")
    assert rows_of(newer_than(fact, "ts", mark, late), "id") == [(2,), (3,), (4,), (5,)]


def test_the_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact_of(spark, BASE).write.parquet(path)
    fact = spark.read.parquet(path)
    plan = plan_of(build_output(
        newer_than(fact, "ts", high_water_mark(fact, "ts")), dim_of(spark, DIM), SPEC))
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThan(ts,2026-01-03T00:00)" in pushed


def test_unread_fact_columns_are_pruned(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact_of(spark, BASE).withColumn("wide", F.lit("w")).write.parquet(path)
    plan = plan_of(build_output(spark.read.parquet(path), dim_of(spark, DIM), SPEC))
    assert "wide" not in plan.split("ReadSchema: ")[1]


def test_the_join_key_prunes_no_partitions(spark, database):
    employee, department = create_sources(
        spark, SMALL, f"{database}.employee", f"{database}.department")
    plan = plan_of(build_output(spark.table(employee), spark.table(department)))
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert plan.count("PartitionFilters: []") == 2


def test_incremental_equals_full(spark):
    dim = dim_of(spark, DIM)
    previous = build_output(fact_of(spark, BASE), dim, SPEC)
    now = fact_of(spark, [(1, "x", 0, 0), (2, "z", 9, 5), (3, "z", 0, 2), (4, "x", 0, 6)])
    refreshed = refresh_output(now, dim, previous, SPEC)
    assert rows_of(refreshed) == rows_of(build_output(now, dim, SPEC))
    # nothing new: nothing changes
    assert rows_of(refresh_output(now, dim, refreshed, SPEC)) == rows_of(refreshed)


def test_first_run_and_empty_target_load_everything(spark):
    fact, dim = fact_of(spark, BASE), dim_of(spark, DIM)
    full = rows_of(build_output(fact, dim, SPEC))
    assert rows_of(refresh_output(fact, dim, None, SPEC)) == full
    empty = build_output(fact.limit(0), dim, SPEC)
    assert rows_of(refresh_output(fact, dim, empty, SPEC)) == full


def test_second_batch_hides_below_a_fixed_anchor(spark):
    """Both batches lie after the same anchor; the second ends before the first does."""
    dim = dim_of(spark, DIM)
    first = BASE + [(4, "x", 0, 20)]
    second = first + [(5, "y", 0, 15)]
    previous = build_output(fact_of(spark, first), dim, SPEC)
    missed = refresh_output(fact_of(spark, second), dim, previous, SPEC)
    assert (5,) not in rows_of(missed, "id")
    found = refresh_output(
        fact_of(spark, second), dim, previous, SPEC, WatermarkPolicy("strict", "10 days"))
    assert (5,) in rows_of(found, "id")
    later = refresh_output(fact_of(spark, first + [(5, "y", 0, 25)]), dim, previous, SPEC)
    assert (5,) in rows_of(later, "id")


def test_two_versions_of_a_row_in_one_delta(spark):
    dim = dim_of(spark, DIM)
    previous = build_output(fact_of(spark, BASE), dim, SPEC)
    now = fact_of(spark, BASE + [(2, "x", 5, 4), (2, "z", 6, 5)])
    got = refresh_output(now, dim, previous, SPEC)
    assert rows_of(got.filter("id = 2"), "k", "v", "a") == [("z", 6, "3")]


def test_dimension_changes_show_only_when_restated(spark):
    fact = fact_of(spark, BASE)
    previous = build_output(fact, dim_of(spark, DIM), SPEC)
    changed = dim_of(spark, [("x", "new"), ("y", "2"), ("z", "3")])
    stale = refresh_output(fact, changed, previous, SPEC)
    assert rows_of(stale.filter("k = 'x'"), "a") == [("1",)]
    restated = refresh_output(fact, changed, previous, SPEC, restate=True)
    assert rows_of(restated) == rows_of(build_output(fact, changed, SPEC))


def test_quarantined_rows_come_back_when_their_parent_arrives(spark):
    fact = fact_of(spark, BASE + [(4, "q", 0, 1), (5, None, 0, 1)])
    dim = dim_of(spark, DIM)
    previous = build_output(fact, dim, SPEC)
    held = quarantine(fact, dim, SPEC)
    assert rows_of(held, "id") == [(4,), (5,)]
    complete = dim_of(spark, DIM + [("q", "4")])
    assert (4,) not in rows_of(refresh_output(fact, complete, previous, SPEC), "id")
    got = refresh_output(fact, complete, previous, SPEC, retry=held)
    assert rows_of(got) == rows_of(build_output(fact, complete, SPEC))


def test_check_output_refuses_lost_and_doubled_rows(spark):
    fact, dim = fact_of(spark, BASE + [(4, "q", 0, 0)]), dim_of(spark, DIM)
    output = build_output(fact, dim, SPEC)
    lost = output.filter("id <> 1")
    for level in ("keys", "counts"):
        check_output(fact, dim, output, SPEC, level)  # the orphan is not expected in the output
        with pytest.raises(OutputCheckError):
            check_output(fact, dim, lost, SPEC, level)
    swapped = lost.union(output.filter("id = 2"))
    check_output(fact, dim, swapped, SPEC, "counts")
    with pytest.raises(OutputCheckError):
        check_output(fact, dim, swapped, SPEC)
    with pytest.raises(ValueError):
        check_output(fact, dim, output, SPEC, "some")


def _sources(spark, database):
    employee, department = create_sources(
        spark, SMALL, f"{database}.employee", f"{database}.department")
    return employee, department, spark.table(department)


BATCHES = [BatchConfig(new_rows=20, updated_rows=15),
           BatchConfig(new_rows=20, updated_rows=15, asof="2026-08-15 00:00:00")]


def test_published_table_follows_its_sources(spark, database, tmp_path):
    employee, department, dimension = _sources(spark, database)
    output, root = f"{database}.output", str(tmp_path / "versions")
    first = run_build(spark, output, spark.table(employee), dimension, root)
    assert first.mode == "full"
    for batch in BATCHES:
        land_batch(spark, employee, department, SMALL, batch)
        result = run_build(spark, output, spark.table(employee), dimension, root)
        assert result.mode == "incremental"
        assert rows_of(spark.table(output)) == rows_of(
            build_output(spark.table(employee), dimension))
    # older versions stay readable
    assert spark.read.parquet(first.path).count() == SMALL.employees
    layout = verify_layout(spark, employee, department, output)
    assert layout.count() == 4 and layout.filter("NOT passed").count() == 0


def test_a_failed_check_leaves_the_published_version(spark, database, tmp_path, monkeypatch):
    employee, department, dimension = _sources(spark, database)
    output, root = f"{database}.output", str(tmp_path / "versions")
    run_build(spark, output, spark.table(employee), dimension, root)
    land_batch(spark, employee, department, SMALL, BATCHES[0])
    monkeypatch.setattr(
        "tidemark.plans.output.build_output", lambda fact, dim, spec: build_output(
            fact, dim, spec).filter("employee_id <> 102000"))
    with pytest.raises(OutputCheckError):
        run_build(spark, output, spark.table(employee), dimension, root)
    assert spark.table(output).count() == SMALL.employees


def test_overlay_follows_its_sources_without_rewriting_the_base(spark, database, tmp_path):
    employee, department, dimension = _sources(spark, database)
    view, root = f"{database}.output", str(tmp_path / "versions")
    assert refresh_overlay(spark, view, spark.table(employee), dimension, root).mode == "full"

    def base_files():
        return rows_of(spark.table(f"{view}_base").select("_metadata.file_path").distinct())

    files = base_files()
    for batch in BATCHES:
        land_batch(spark, employee, department, SMALL, batch)
        result = refresh_overlay(spark, view, spark.table(employee), dimension, root)
        assert result.mode == "changes" and result.changed_rows == 35
        assert rows_of(spark.table(view)) == rows_of(
            build_output(spark.table(employee), dimension))
    assert base_files() == files
    again = refresh_overlay(spark, view, spark.table(employee), dimension, root)
    assert again.changed_rows == 0
    expected = rows_of(spark.table(view))
    compact_overlay(spark, view, root)
    assert rows_of(spark.table(view)) == expected == rows_of(spark.table(f"{view}_base"))
    assert spark.table(f"{view}_changes").count() == 0


def test_overlay_compacts_when_changes_outgrow_a_broadcast(spark, database, tmp_path):
    employee, department, dimension = _sources(spark, database)
    view, root = f"{database}.output", str(tmp_path / "versions")
    refresh_overlay(spark, view, spark.table(employee), dimension, root)
    land_batch(spark, employee, department, SMALL, BATCHES[0])
    result = refresh_overlay(
        spark, view, spark.table(employee), dimension, root, broadcast_limit=100)
    assert result.mode == "compacted"
    assert spark.table(f"{view}_base").count() == SMALL.employees + 20
    assert spark.table(f"{view}_changes").count() == 0
    assert rows_of(spark.table(view)) == rows_of(build_output(spark.table(employee), dimension))


def test_overlay_heals_after_a_fold_that_stopped_half_way(
        spark, database, tmp_path, monkeypatch):
    employee, department, dimension = _sources(spark, database)
    view, root = f"{database}.output", str(tmp_path / "versions")
    refresh_overlay(spark, view, spark.table(employee), dimension, root)
    land_batch(spark, employee, department, SMALL, BATCHES[0])
    refresh_overlay(spark, view, spark.table(employee), dimension, root)
    land_batch(spark, employee, department, SMALL, BATCHES[1])
    with monkeypatch.context() as patch:
        patch.setattr("tidemark.plans.overlay._clear_changes", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_overlay(
                spark, view, spark.table(employee), dimension, root, broadcast_limit=100)
    keys = rows_of(spark.table(employee), "employee_id")
    assert rows_of(spark.table(view), "employee_id") == keys  # each once, none lost
    refresh_overlay(spark, view, spark.table(employee), dimension, root)
    assert rows_of(spark.table(view)) == rows_of(build_output(spark.table(employee), dimension))


def test_overlay_over_an_empty_fact_fills_later(spark, database, tmp_path):
    view, root, dim = f"{database}.output", str(tmp_path / "versions"), dim_of(spark, DIM)
    refresh_overlay(spark, view, fact_of(spark, []), dim, root, SPEC)
    assert spark.table(view).count() == 0
    refresh_overlay(spark, view, fact_of(spark, BASE), dim, root, SPEC)
    assert rows_of(spark.table(view)) == rows_of(build_output(fact_of(spark, BASE), dim, SPEC))


def test_a_row_that_moves_to_a_missing_parent_leaves_both_outputs(spark, database, tmp_path):
    before = fact_of(spark, [(1, "a", 1, 1), (2, "a", 2, 2)])
    after = fact_of(spark, [(1, "gone", 1, 5), (2, "a", 2, 2)])
    dim = dim_of(spark, [("a", "A")])
    root = f"{tmp_path}/versions"
    table, view = f"{database}.rewritten", f"{database}.overlaid"
    run_build(spark, table, before, dim, root, SPEC)
    refresh_overlay(spark, view, before, dim, root, SPEC)
    run_build(spark, table, after, dim, root, SPEC)
    assert refresh_overlay(spark, view, after, dim, root, SPEC).mode == "compacted"
    assert rows_of(spark.table(table), "id") == rows_of(spark.table(view), "id") == [(2,)]
    assert refresh_overlay(spark, view, after, dim, root, SPEC).mode == "changes"


def test_publishing_another_type_or_cluster_key_is_declared(spark, database, tmp_path):
    fact, dim = fact_of(spark, [(1, "a", 1, 1)]), dim_of(spark, [("a", "7")])
    table, root = f"{database}.typed", f"{tmp_path}/versions"
    run_build(spark, table, fact, dim, root, SPEC, full=True)
    wide = dim.withColumn("a", F.col("a").cast("bigint"))
    other = replace(SPEC, cluster_by=("v",))
    run_build(spark, table, fact, wide, root, other, full=True)
    assert rows_of(spark.table(table), "a") == [(7,)]
    assert clustering_columns(spark, table) == ["v"]
