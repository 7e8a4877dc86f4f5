"""Refreshing a read table by the key ranges a change falls into."""

from dataclasses import replace

import pytest
from conftest import SMALL, SPEC, dim_of, fact_of, plan_of, rows_of
from pyspark.sql import functions as F

from tidemark.config import BatchConfig
from tidemark.plans import (
    OutputCheckError, build_output, create_sources, drop_replaced, land_batch, live_ranges,
    refresh_ranges, stored_rows, verify_layout,
)

DIM = [("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("e", None)]


def base(n=400):
    return [(i, "abcd"[i * 4 // n], i % 7, i % 5) for i in range(n)]


def files(spark, view):
    """Path and time of every file readers see, with its range."""
    return {(r.range_id, r.file) for r in stored_rows(spark, view).select(
        "range_id", "file").distinct().collect()}


def full(spark, fact, dim, spec=SPEC):
    return rows_of(build_output(fact, dim, spec))


def test_only_ranges_of_changed_rows_are_rewritten(spark, database, tmp_path):
    view, dim = f"{database}.t", dim_of(spark, DIM)
    rows = base()
    first = refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC, files=8)
    assert (first.mode, first.ranges) == ("full", 8)
    assert rows_of(spark.table(view)) == full(spark, fact_of(spark, rows), dim)
    before = files(spark, view)
    times = {p: (tmp_path / "db").joinpath(*p.split("/db/")[1].split("/")).stat().st_mtime_ns
             for _, p in before}

    # One row changes in place, one is new, one moves to another range and one to no parent.
    rows[10] = (10, "a", 99, 10)
    rows[11] = (11, "nobody", 5, 10)
    rows[12] = (12, "d", 5, 10)
    rows.append((1000, "a", 1, 11))
    result = refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC)
    assert result.mode == "ranges" and result.ranges == 8
    assert 2 <= result.rewritten <= 3 and result.changed_rows == 3
    assert rows_of(spark.table(view)) == full(spark, fact_of(spark, rows), dim)
    after = files(spark, view)
    kept = before & after
    assert len({r for r, _ in kept}) == 8 - result.rewritten
    for _, path in kept:
        file = (tmp_path / "db").joinpath(*path.split("/db/")[1].split("/"))
        assert file.stat().st_mtime_ns == times[path]

    # Nothing new: nothing is written.
    assert refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC).rewritten == 0
    assert files(spark, view) == after


def test_rows_before_behind_and_between_all_ranges_find_one(spark, database):
    view, dim = f"{database}.t", dim_of(spark, [*DIM, ("", "0"), ("zz", "9")])
    rows = [(i * 10, "bc"[i >= 50], 0, 0) for i in range(100)]
    refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC, files=4)
    rows += [(-5, "", 0, 3), (5, "b", 0, 3), (499, "b", 0, 3), (7, "zz", 0, 3), (1, "c", 0, 3)]
    refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC)
    assert rows_of(spark.table(view)) == full(spark, fact_of(spark, rows), dim)
    spans = stored_rows(spark, view).groupBy("range_id").agg(
        F.min(F.struct("k", "id")).alias("low"), F.max(F.struct("k", "id")).alias("high"))
    found = sorted((tuple(r.low), tuple(r.high)) for r in spans.collect())
    assert all(a[1] < b[0] for a, b in zip(found, found[1:], strict=False))  # still disjoint
    assert rows_of(live_ranges(spark, view).select(F.sum("rows"))) == [(105,)]


def test_many_refreshes_equal_one_build(spark, database):
    view, dim = f"{database}.t", dim_of(spark, DIM)
    rows = dict((r[0], r) for r in base(120))
    refresh_ranges(spark, view, fact_of(spark, list(rows.values())), dim, SPEC, files=6)
    for turn in range(1, 5):
        for i in range(turn, 130, 37):
            rows[i] = (i, "abcdex"[(i + turn) % 6], turn, 10 + turn)
        fact = fact_of(spark, list(rows.values()))
        refresh_ranges(spark, view, fact, dim, SPEC)
        assert rows_of(spark.table(view)) == full(spark, fact, dim)
    stored = spark.sql(f"SHOW PARTITIONS {_rows(spark, view)}").count()
    gone = drop_replaced(spark, view)
    assert len(gone) == stored - live_ranges(spark, view).count() > 0
    assert rows_of(spark.table(view)) == full(spark, fact, dim)
    assert drop_replaced(spark, view) == []


def _rows(spark, view):
    name, = [t.name for t in spark.catalog.listTables(view.split(".")[0]) if "_rows_" in t.name]
    return f"{view.split('.')[0]}.{name}"


def test_readers_prune_to_live_ranges(spark, database):
    view, dim = f"{database}.t", dim_of(spark, DIM)
    rows = base(40)
    refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC, files=4)
    rows[0] = (0, "a", 9, 9)
    refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC)
    scan = spark.table(view).where("k = 'a'")
    assert scan.count() == 10
    scan.collect()
    plan = plan_of(scan)
    assert "dynamicpruning" in plan and "EqualTo(k,a)" in plan
    assert spark.table(view).columns == list(SPEC.columns)


def test_a_refresh_that_fails_its_check_changes_nothing(spark, database, monkeypatch):
    view, dim = f"{database}.t", dim_of(spark, DIM)
    rows = base(80)
    refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC, files=4)
    before, seen = files(spark, view), rows_of(spark.table(view))
    rows[5] = (5, "c", 1, 9)
    for damage in ("id <> 30", "id <> 5"):
        with monkeypatch.context() as patch:
            patch.setattr("tidemark.plans.ranges.by_partition",
                          lambda df, *a, d=damage, **k: df.where(d))
            with pytest.raises(OutputCheckError):
                refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC)
        assert files(spark, view) == before and rows_of(spark.table(view)) == seen
    with monkeypatch.context() as patch:  # one row lost and one doubled keep the count
        patch.setattr("tidemark.plans.ranges.by_partition", lambda df, *a, **k: df.where(
            "id <> 30").unionByName(df.where("id = 31")))
        with pytest.raises(OutputCheckError):
            refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC)
    assert refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC).rewritten == 2
    assert rows_of(spark.table(view)) == full(spark, fact_of(spark, rows), dim)


def test_a_full_build_replaces_the_view_with_other_types(spark, database):
    view = f"{database}.t"
    fact = fact_of(spark, base(20))
    refresh_ranges(spark, view, fact, dim_of(spark, DIM), SPEC, files=2)
    running = spark.table(view).where("a = '1'")  # a query of the old view
    wide = dim_of(spark, DIM).withColumn("a", F.col("a").cast("bigint"))
    other = replace(SPEC, cluster_by=("v",))
    assert refresh_ranges(spark, view, fact, wide, other, full=True).mode == "full"
    assert dict(spark.table(view).dtypes)["a"] == "bigint"
    assert running.count() == 5
    layout = verify_layout(spark, view, view, view, other).where("check LIKE 'output%'")
    assert layout.count() == 2 and layout.where("NOT passed").isEmpty()


def test_empty_and_null(spark, database):
    view, dim = f"{database}.t", dim_of(spark, DIM)
    refresh_ranges(spark, view, fact_of(spark, []), dim, SPEC)
    assert spark.table(view).count() == 0
    rows = [(1, "a", None, 0), (2, "e", 1, None), (3, None, 1, 0)]
    assert refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC).mode == "full"
    assert rows_of(spark.table(view)) == full(spark, fact_of(spark, rows), dim)
    rows = [(1, None, None, 5), *rows[1:], (4, "e", 0, 6)]
    refresh_ranges(spark, view, fact_of(spark, rows), dim, SPEC)
    assert rows_of(spark.table(view), "id") == [(2,), (4,)]


def test_the_cycle_of_batches(spark, database):
    employee, department = create_sources(
        spark, SMALL, f"{database}.employee", f"{database}.department")
    view, dim = f"{database}.output", spark.table(department)
    refresh_ranges(spark, view, spark.table(employee), dim, files=5)
    for day in (14, 15):
        land_batch(spark, employee, department, SMALL,
                   BatchConfig(new_rows=20, updated_rows=15, asof=f"2026-08-{day} 00:00:00"))
        result = refresh_ranges(spark, view, spark.table(employee), dim)
        assert result.mode == "ranges" and result.changed_rows == 35
        assert rows_of(spark.table(view)) == rows_of(build_output(spark.table(employee), dim))
