from pathlib import Path

import pytest
from conftest import SMALL, declared, fact_of, plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.config import BatchConfig, GenerationConfig
from tidemark.operators import (
    FanOutError, append_only, duplicate_keys, hash_order_sample, latest_per_key,
    move_partitions, one_per_key, partial_update, touched_partitions, upsert,
)
from tidemark.operators.merge import held_partitions
from tidemark.sources.writers import within
from tidemark.plans import (
    allocate_ids, create_sources, generate_dimension, generate_fact, land_batch, moved_rows,
    new_rows, next_id,
)
from tidemark.plans.batch import HELD, MOVE
from tidemark.sources import EMPLOYEE
from tidemark.sources.scratch import scratch_folder

TARGET = [(1, "a", 10, 0), (2, "b", 20, 0), (3, "c", 30, 0)]
BATCH = [(2, "B", 21, 5), (4, "D", 40, 5)]


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_upsert_replaces_and_inserts(spark, limit):
    got = upsert(fact_of(spark, TARGET), fact_of(spark, BATCH), "id", limit)
    assert rows_of(got, "id", "k", "v") == [
        (1, "a", 10), (2, "B", 21), (3, "c", 30), (4, "D", 40)]


def test_upsert_twice_changes_nothing(spark):
    batch = fact_of(spark, BATCH)
    once = upsert(fact_of(spark, TARGET), batch, "id")
    assert rows_of(upsert(once, batch, "id")) == rows_of(once)


def test_upsert_refuses_an_ambiguous_batch(spark):
    with pytest.raises(FanOutError):
        upsert(fact_of(spark, TARGET), fact_of(spark, BATCH + BATCH), "id")


def test_append_only_duplicates_what_upsert_restates(spark):
    target, batch = fact_of(spark, TARGET), fact_of(spark, BATCH)
    assert rows_of(duplicate_keys(append_only(target, batch), ["id"])) == [(2, 2)]
    assert duplicate_keys(upsert(target, batch, "id"), ["id"]).count() == 0


def test_latest_row_of_a_key_wins(spark):
    batch = fact_of(spark, [(1, "a", 1, 0), (1, "b", 2, 3), (1, "c", 3, 3), (2, None, 4, 0)])
    assert rows_of(latest_per_key(batch, "id", ["ts"]), "id", "k") == [(1, "c"), (2, None)]
    assert one_per_key(batch, "id", ["ts"]).columns == batch.columns
    with pytest.raises(FanOutError):
        one_per_key(batch, "id", ["ts"], "raise")
    with pytest.raises(ValueError):
        one_per_key(batch, "id", ["ts"], "first")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 8), st.integers(0, 3)), max_size=20),
       st.lists(st.tuples(st.integers(1, 12), st.integers(0, 3)), max_size=20))
def test_upsert_behaves_like_a_dictionary(spark, target, batch):
    target, batch = dict(target), dict(batch)
    schema = "id int, v int"
    got = upsert(spark.createDataFrame(list(target.items()), schema),
                 spark.createDataFrame(list(batch.items()), schema), "id")
    assert dict(rows_of(got)) == {**target, **batch}


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_partial_update_sets_only_what_it_names(spark, limit):
    updates = spark.createDataFrame([(2, 99, "z"), (9, 1, "y")], "id bigint, nv bigint, nk string")
    target = fact_of(spark, TARGET)
    got = partial_update(target, updates, "id", {"v": "nv", "k": "nk"}, limit)
    assert got.dtypes == target.dtypes
    assert rows_of(got, "id", "k", "v") == [(1, "a", 10), (2, "z", 99), (3, "c", 30)]


def test_partial_update_assigns_nulls(spark):
    updates = spark.createDataFrame([(2, None)], "id bigint, nv int")
    got = partial_update(fact_of(spark, TARGET), updates, "id", {"v": "nv"})
    assert rows_of(got, "id", "v") == [(1, 10), (2, None), (3, 30)]


def test_touched_partitions_name_old_and_new(spark):
    target = spark.createDataFrame([(1, 5, 0), (2, 6, 0), (3, 7, 1)], "id bigint, p int, b int")
    updates = spark.createDataFrame([(1, 8), (9, 4)], "id bigint, np int")
    got = touched_partitions(target, updates, "id", {"p": "np"}, ["p", "b"])
    assert rows_of(got) == [(5, 0), (8, 0)]


def _partitions(spark, table):
    return sorted(row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect())


def test_moves_rewrite_both_partitions_and_drop_emptied_ones(spark, database, tmp_path):
    table = f"{database}.t"
    rows = [(1, "x", 1), (2, "y", 1), (3, "z", 2), (4, "w", 3)]
    spark.createDataFrame(rows, "id bigint, v string, p int").write.partitionBy("p").saveAsTable(table)
    kept = {str(f) for f in (tmp_path / "db" / "t" / "p=3").glob("*.parquet")}
    updates = spark.createDataFrame([(3, 1), (1, 9)], "id bigint, np int")
    assert move_partitions(spark, table, updates, "id", {"p": "np"}, ["p"]) == 3
    assert rows_of(spark.table(table), "id", "v", "p") == [
        (1, "x", 9), (2, "y", 1), (3, "z", 1), (4, "w", 3)]
    assert _partitions(spark, table) == ["p=1", "p=3", "p=9"]
    assert not (tmp_path / "db" / "t" / "p=2").exists()
    # an untouched partition keeps its very files
    assert {str(f) for f in (tmp_path / "db" / "t" / "p=3").glob("*.parquet")} == kept


def test_only_the_named_partitions_are_read(spark, tmp_path):
    rows = [(i, i % 5 if i % 5 else None, i % 2) for i in range(50)]
    spark.createDataFrame(rows, "id int, p int, b int").write.partitionBy("p", "b").parquet(
        str(tmp_path / "t"))
    wanted = spark.createDataFrame([(None, 1), (3, 0), (7, 7)], "p int, b int")
    got = within(spark.read.parquet(str(tmp_path / "t")), wanted)
    assert {r.id for r in got.collect()} == {i for i in range(50) if (i % 5, i % 2) in {(0, 1), (3, 0)}}
    # Pruned by whole partitions: (3, 1) is not read although 3 and 1 both occur.
    scan = plan_of(got).split("PartitionFilters: [")[1].split("]")[0]
    assert scan.startswith("dynamicpruningexpression(struct(p, p#")


def test_movers_that_know_their_partition_spare_the_scan(spark, database, tmp_path):
    """A table whose other partitions cannot be read any more."""
    table = f"{database}.t"
    rows = [(i, f"v{i}", i % 6) for i in range(60)]
    spark.createDataFrame(rows, "id bigint, v string, p int").write.partitionBy("p").saveAsTable(table)
    for p in (3, 4, 5):
        for file in (tmp_path / "db" / "t" / f"p={p}").glob("*.parquet"):
            file.write_bytes(b"no parquet")
    moves = spark.createDataFrame([(0, 0, 1), (6, 0, 2), (7, 1, 2)], "id bigint, op int, np int")
    assert move_partitions(spark, table, moves, "id", {"p": "np"}, ["p"], held={"p": "op"}) == 3
    left = spark.table(table).where("p < 3")
    want = {i: i % 6 for i in range(60) if i % 6 < 3} | {0: 1, 6: 2, 7: 2}
    assert {r.id: r.p for r in left.collect()} == want


def test_landing_reads_the_fact_once(spark, database):
    """Between sample and rewrite, no job reads the fact without pruning it."""
    employee, department = create_sources(
        spark, SMALL, f"{database}.employee", f"{database}.department")
    dimension = spark.table(department)
    moves = moved_rows(spark.table(employee).select(EMPLOYEE.columns), dimension,
                       BatchConfig(updated_rows=3, force_move=True))
    assert set(HELD.values()) <= set(moves.columns)
    places = held_partitions(moves, spark.table(employee), MOVE, HELD)
    assert places.count() <= 6
    assert rows_of(places) == rows_of(touched_partitions(
        spark.table(employee), moves, "employee_id", MOVE, EMPLOYEE.partition_by))


def test_moves_without_a_match_touch_nothing(spark, database):
    table = f"{database}.t"
    spark.createDataFrame([(1, 1)], "id bigint, p int").write.partitionBy("p").saveAsTable(table)
    updates = spark.createDataFrame([(7, 2)], "id bigint, np int")
    assert move_partitions(spark, table, updates, "id", {"p": "np"}, ["p"]) == 0
    assert rows_of(spark.table(table)) == [(1, 1)]


def test_moves_write_the_rows_of_a_partition_once(spark, database):
    """Scratch holds the moves and a row for each partition, not the rows that stay."""
    table = f"{database}.t"
    spark.range(5_000).selectExpr("id", "concat('v', id) AS v", "int(id % 2) AS p").write.partitionBy(
        "p").saveAsTable(table)
    root = Path(scratch_folder(spark, "any").removeprefix("file:")).parent
    before = set(root.iterdir()) if root.exists() else set()
    updates = spark.createDataFrame([(4, 1), (7, 3)], "id bigint, np int")
    assert move_partitions(spark, table, updates, "id", {"p": "np"}, ["p"]) == 3
    written = sum(spark.read.parquet(str(f)).count() for f in set(root.iterdir()) - before)
    assert written < 50
    want = {i: i % 2 for i in range(5_000)} | {4: 1, 7: 3}
    assert {r.id: r.p for r in spark.table(table).collect()} == want


def test_moves_handle_null_and_text_partitions(spark, database):
    table = f"{database}.t"
    rows = [(1, None), (2, "it's a \\ here"), (3, "c")]
    spark.createDataFrame(rows, "id bigint, p string").write.partitionBy("p").saveAsTable(table)
    updates = spark.createDataFrame([(1, "c"), (2, None)], "id bigint, np string")
    move_partitions(spark, table, updates, "id", {"p": "np"}, ["p"])
    assert rows_of(spark.table(table), "id", "p") == [(1, "c"), (2, None), (3, "c")]


def test_moves_restore_the_session_setting(spark, database):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    test_moves_without_a_match_touch_nothing(spark, database)
    assert spark.conf.get(name) == before


def test_ids_follow_the_largest(spark):
    df = spark.createDataFrame([(7,), (41,)], "employee_id bigint")
    assert rows_of(allocate_ids(df, "employee_id", 3, 100)) == [(42,), (43,), (44,)]
    assert next_id(df.limit(0), "employee_id", 100) == 100  # not one too high


def test_new_rows_continue_the_fact(spark):
    dimension = generate_dimension(spark, SMALL)
    fact = generate_fact(spark, SMALL, dimension)
    added = new_rows(fact, dimension, SMALL, BatchConfig(new_rows=50))
    assert declared(added.schema) == declared(EMPLOYEE.schema) and added.count() == 50
    assert added.agg(F.min("employee_id")).first()[0] == 100_000 + SMALL.employees
    assert added.filter("updated_at < TIMESTAMP_NTZ '2026-08-14 00:00:00'").count() == 0


def test_movers_are_older_than_the_anchor(spark):
    dimension = generate_dimension(spark, SMALL)
    fact = generate_fact(spark, SMALL, dimension)
    moves = moved_rows(fact, dimension, BatchConfig(updated_rows=40))
    assert moves.count() == 40
    assert moves.join(fact, "employee_id").filter("updated_at >= '2026-08-14'").count() == 0


@pytest.mark.parametrize("force", [False, True])
def test_a_mover_may_stay_unless_forced(spark, force):
    dimension = generate_dimension(spark, SMALL)
    fact = generate_fact(spark, SMALL, dimension)
    moves = moved_rows(fact, dimension, BatchConfig(updated_rows=400, force_move=force))
    stayed = moves.join(fact, "employee_id").filter(
        "department_number = new_department_number").count()
    assert stayed == 0 if force else stayed > 0


def test_forcing_needs_two_departments(spark):
    config = GenerationConfig(employees=10, departments=1)
    dimension = generate_dimension(spark, config)
    with pytest.raises(ValueError):
        moved_rows(generate_fact(spark, config, dimension), dimension,
                   BatchConfig(force_move=True))


@pytest.mark.parametrize("k", [0, 1, 7, 500, 2_000, 5_000])
def test_sample_by_cutoff_equals_top_k(spark, k):
    df = spark.range(2_000)
    plain = rows_of(hash_order_sample(df, "id", k))
    assert len(plain) == min(k, 2_000)
    assert rows_of(hash_order_sample(df, "id", k, top_k_limit=0)) == plain
    # few hash values: many ties for the key to settle
    assert rows_of(hash_order_sample(df, "id", k, span=10, top_k_limit=0)) == rows_of(
        hash_order_sample(df, "id", k, span=10))


def test_landing_a_batch(spark, database):
    employee, department = create_sources(
        spark, SMALL, f"{database}.employee", f"{database}.department")
    before = {r.employee_id: r for r in spark.table(employee).collect()}
    batch = BatchConfig(new_rows=30, updated_rows=20, force_move=True)
    land_batch(spark, employee, department, SMALL, batch)
    after = {r.employee_id: r for r in spark.table(employee).collect()}
    assert spark.table(employee).count() == len(after) == len(before) + 30
    changed = [i for i in before if before[i] != after[i]]
    assert len(changed) == 20
    names = {r.department_number: r.department_name for r in spark.table(department).collect()}
    for i in changed:
        old, new = before[i].asDict(), after[i].asDict()
        assert old["department_number"] != new["department_number"]
        assert new["department_name"] == names[new["department_number"]]
        assert new["updated_at"] > old["updated_at"]
        for column in ("employee_name", "location_code", "salary_band", "employee_id_bucket"):
            assert old[column] == new[column]
