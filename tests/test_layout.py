import threading

import pytest
from conftest import SMALL, plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import create_sources
from tidemark.sources import (
    TableSpec, analyze, append_rows, by_partition, cluster_profile, cluster_summary, clustering_columns,
    compact_partitions, create_or_replace, materialise, partition_columns, publish_clustered,
    read_table, scratch_folder, table_detail, value_rows, write_clustered, write_partitioned,
)
from tidemark.sources.writers import PLACED, _rows_per_task, group_slots, in_slots


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key."""
    return spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("k"),
        (F.col("id") % 2).cast("int").alias("b"), F.repeat(F.lit("x"), 50).alias("text"))


def test_partitioned_write_round_trip(spark, skewed, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(skewed, path, ["k", "b"], ["id"])
    assert (tmp_path / "t" / "k=0" / "b=0").is_dir()
    back = read_table(spark, path)
    assert rows_of(back.select(skewed.columns)) == rows_of(skewed)
    assert "PartitionFilters: [isnotnull(k" in plan_of(back.filter("k = 7"))


def files_in(folder):
    return len(list(folder.glob("*.parquet")))


def test_a_hot_partition_is_written_by_several_tasks(spark, skewed, tmp_path):
    write_partitioned(skewed, str(tmp_path / "t"), ["k"], ["id"], rows_per_file=1_000)
    assert files_in(tmp_path / "t" / "k=0") == 11  # 10,400 rows
    assert {files_in(tmp_path / "t" / f"k={k}") for k in range(1, 50)} == {1}
    table = read_table(spark, str(tmp_path / "t"))
    assert rows_of(table.select(skewed.columns)) == rows_of(skewed)
    assert table.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] < 1_200


def test_a_hot_null_partition_is_split_too(spark, tmp_path):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, 1).alias("k"))
    write_partitioned(df, str(tmp_path / "t"), ["k"], rows_per_file=100)
    assert files_in(tmp_path / "t" / "k=__HIVE_DEFAULT_PARTITION__") == 3
    assert rows_of(read_table(spark, str(tmp_path / "t"))) == rows_of(df)


def slots_of(spark, sizes, rows_per_file):
    """Groups of the given sizes, and how many rows of each lie in each slot."""
    rows = spark.createDataFrame(list(enumerate(sizes)), "k int, n int").select(
        "k", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).repartition(16)
    slots = group_slots(rows, ["k"], rows_per_file)
    laid = in_slots(rows, ["k"], slots).groupBy("k", F.spark_partition_id().alias("slot")).count()
    return slots, {(r.k, r.slot): r["count"] for r in laid.collect()}


def test_groups_follow_each_other_in_key_order(spark):
    slots, found = slots_of(spark, [30, 30, 75, 15, 15, 8], rows_per_file=30)
    assert sorted(slot for k, slot in found if k != 2) == [0, 1, 4, 4, 5] or slots.all <= 7
    assert [k for k, _ in sorted(found, key=lambda f: (f[1], f[0]))] == sorted(k for k, _ in found)
    assert len([k for k, _ in found if k == 2]) == 3  # 75 rows in files of 30
    assert all(len([1 for k, _ in found if k == one]) == 1 for one in (0, 1, 3, 4, 5))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 400), max_size=40), st.integers(20, 100))
def test_slots_keep_their_promises(spark, sizes, rows_per_file):
    slots, found = slots_of(spark, sizes, rows_per_file)
    rows, load, files = sum(sizes), {}, {}
    per_task = _rows_per_task(spark, rows, rows_per_file, 1)
    for (k, slot), n in found.items():
        load[slot] = load.get(slot, 0) + n
        files[k] = files.get(k, 0) + 1
    assert sum(load.values()) == rows
    for k, n in enumerate(sizes):
        assert files[k] == 1 if n <= rows_per_file else 1 < files[k] <= -(-n // rows_per_file)
    assert slots.placed.count() <= PLACED * (-(-rows // per_task) if rows else 0)
    assert slots.all <= 2 * (rows // per_task) + len([n for n in sizes if n > rows_per_file]) + 2
    assert all(s >= slots.own for k, s in found if sizes[k] * PLACED < per_task)


def test_a_hot_directory_among_very_many_is_cut_like_one_among_few(spark):
    """Nothing but single rows reaches the driver, whatever the number of directories."""
    hot = spark.range(0, 40_000, 1, 16).select(F.lit(-1).cast("long").alias("k"), "id")
    for many in (20, 200_000):
        rows = hot.union(spark.range(0, many, 1, 8).select(F.col("id").alias("k"), "id"))
        slots = group_slots(rows, ["k"], rows_per_file=10_000)
        laid = in_slots(rows, ["k"], slots).select("k", F.spark_partition_id().alias("slot"))
        per_slot = laid.where("k = -1").groupBy("slot").count().collect()
        assert len(per_slot) == 4 and max(r["count"] for r in per_slot) < 15_000
        assert slots.placed.count() <= PLACED * 40
        split = laid.where("k >= 0").distinct().groupBy("k").count().where("count > 1")
        assert split.isEmpty()
        assert laid.count() == 40_000 + many
        load = laid.groupBy("slot").count().agg(F.max("count")).first()[0]
        assert load < 25_000


def test_slots_take_a_single_shuffle(spark, skewed):
    plan = plan_of(by_partition(skewed, ["k", "b"], rows_per_file=1_000))
    assert plan.count("Exchange") == 1 + plan.count("BroadcastExchange") + plan.count(
        "Exchange SinglePartition") and "REBALANCE" not in plan


def test_ranges_of_many_keys(spark, skewed, tmp_path):
    write_clustered(skewed, str(tmp_path / "t"), ["k"], ["id"], rows_per_file=5_000)
    summary = cluster_summary(read_table(spark, str(tmp_path / "t")), "k").first()
    assert summary.well_clustered and summary.files == 6 and summary.rows == 30_000
    assert summary.max_rows_per_file < 30_000 / 3


def test_empty_tables_are_written(spark, skewed, tmp_path):
    none = skewed.limit(0)
    write_partitioned(none, str(tmp_path / "p"), ["k"])
    write_clustered(none, str(tmp_path / "c"), ["k"], ["id"])
    assert read_table(spark, str(tmp_path / "c")).count() == 0


@pytest.mark.parametrize("rows_per_file", [1_000, 1_000_000])
def test_the_writer_needs_no_second_sort(spark, skewed, rows_per_file):
    laid_out = by_partition(skewed, ["k", "b"], ["id"], rows_per_file)
    written = laid_out.write.format("noop").mode("overwrite")
    written.save()
    plan = plan_of(laid_out)
    assert plan.startswith("AdaptiveSparkPlan") and plan.count("Sort [k") <= 2  # rows, and groups


@pytest.mark.parametrize("how", [{"files": 6}, {"rows_per_file": 5_000}])
def test_clustered_write_splits_a_hot_key_and_skips_files(spark, skewed, tmp_path, how):
    path = str(tmp_path / "t")
    write_clustered(skewed, path, ["k"], ["id"], **how)
    table = read_table(spark, path)
    assert rows_of(table) == rows_of(skewed)
    summary = cluster_summary(table, "k").first()
    assert summary.well_clustered and summary.files >= 6 and summary.rows == 30_000
    assert summary.max_files_per_key >= 2  # the hot key spans several files
    assert summary.max_rows_per_file < 30_000 / 3  # and none holds all of it
    files = cluster_profile(table, "k").collect()
    assert sum(f.rows for f in files) == 30_000
    assert max(f.rows for f in files) == summary.max_rows_per_file


@pytest.mark.parametrize("how", [{"files": 4}, {"rows_per_file": 2_000}])
def test_copies_of_one_row_do_not_end_in_one_task(spark, tmp_path, how):
    copies = spark.range(0, 8_000, 1, 64).select(F.lit(1).alias("k"), F.lit(2).alias("id"))
    write_clustered(copies, str(tmp_path / "c"), ["k"], ["id"], **how)
    per_file = read_table(spark, str(tmp_path / "c")).groupBy("_metadata.file_path").count()
    assert per_file.agg(F.max("count")).first()[0] <= 4_000


def test_cluster_summary_scans_once(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "t"))
    summary = cluster_summary(read_table(spark, str(tmp_path / "t")), "k")
    summary.collect()
    assert "ReusedExchange" in plan_of(summary)


def test_scattered_rows_are_not_well_clustered(spark, skewed, tmp_path):
    path = str(tmp_path / "t")
    skewed.repartition(6).write.parquet(path)
    assert not cluster_summary(read_table(spark, path), "k").first().well_clustered


def test_table_detail_of_partitioned_and_clustered_tables(spark, database, skewed, tmp_path):
    employee, department = create_sources(
        spark, SMALL, f"{database}.employee", f"{database}.department")
    detail = table_detail(spark, employee).first()
    assert detail.partition_columns == "department_number,employee_id_bucket"
    assert (detail.partitions, detail.rows, detail.clustering_columns) == (10, 2_000, "")
    assert detail.files >= 10 and detail.bytes > 0

    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    write_clustered(skewed, first, ["k"], ["id"], files=3)
    publish_clustered(spark, f"{database}.t", first, ["k"], "it's clustered")
    assert clustering_columns(spark, f"{database}.t") == ["k"]
    assert partition_columns(spark, f"{database}.t") == []
    assert table_detail(spark, f"{database}.t").first().files == 3
    write_clustered(skewed.limit(10), second, ["k"], ["id"], files=1)
    publish_clustered(spark, f"{database}.t", second, ["k"])
    assert spark.table(f"{database}.t").count() == 10
    assert clustering_columns(spark, f"{database}.t") == ["k"]
    third = str(tmp_path / "v3")
    write_clustered(skewed.limit(5).drop("text"), third, ["k"], ["id"], files=1)
    publish_clustered(spark, f"{database}.t", third, ["k"])
    assert spark.table(f"{database}.t").columns == ["id", "k", "b"]
    assert spark.read.parquet(second).count() == 10


def test_analyze_gives_the_optimiser_column_statistics(spark, database):
    names = create_sources(spark, SMALL, f"{database}.employee", f"{database}.department")
    analyze(spark, *names)
    stats = spark.sql(f"DESCRIBE EXTENDED {names[0]} employee_id").collect()
    assert {r.info_name: r.info_value for r in stats}["num_nulls"] == "0"


def test_value_rows_number_from_zero_within_a_row(spark):
    got = value_rows(spark.range(2), ["a", "b"])
    assert rows_of(got) == [(0, 0, "a"), (0, 1, "b"), (1, 0, "a"), (1, 1, "b")]


def test_tasks_follow_the_rows_up_to_a_limit(spark):
    assert _rows_per_task(spark, 1_000, 50, 1) == 50  # 20 tasks, more than the usual 4
    assert _rows_per_task(spark, 1_000, 5_000, 1) == 250  # the usual 4 tasks
    assert _rows_per_task(spark, 1_000, 5_000, 500) == 500  # 2 tasks, not 4 tiny files
    assert _rows_per_task(spark, 10**12, 2_000_000, 1) == 10**7  # no more than 100,000 tasks


def test_scratch_is_below_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != two and one.startswith(root + "/x-")


class _Session:
    """As much of a session as the scratch folder looks at."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name.replace(".", "_"), default)


def test_only_a_local_session_may_do_without_the_setting():
    local = _Session(spark_master="local[4]", spark_sql_warehouse_dir="/w")
    assert scratch_folder(local, "x").startswith("/w/_scratch/x-")
    with pytest.raises(RuntimeError):
        scratch_folder(_Session(spark_master="yarn"), "x")
    shared = _Session(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/c/")
    assert scratch_folder(shared, "x").startswith("hdfs://shared/c/x-")


def test_materialise_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS int) AS n")
    got = materialise(df, "m")
    assert got.dtypes == df.dtypes and rows_of(got) == rows_of(df)
    assert "Range" not in plan_of(got)


def test_readers_never_miss_a_table_that_is_published_anew(spark, database, tmp_path):
    """With another type each time, while another thread reads it."""
    table, seen, stop = f"{database}.t", [], threading.Event()

    def publish(turn, kind):
        path = str(tmp_path / f"v{turn}")
        write_clustered(spark.range(60).selectExpr("id", f"CAST(id AS {kind}) AS v"), path, ["id"],
                        ["id"], files=2)
        publish_clustered(spark, table, path, ["id"])

    publish(0, "bigint")
    running = spark.table(table)

    def read():
        while not stop.is_set():
            found = read_table(spark, table)
            seen.append((dict(found.dtypes)["v"], found.count()))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for turn in range(1, 13):
            publish(turn, ("string", "int", "bigint", "double")[turn % 4])
    finally:
        stop.set()
        reader.join()
    assert {n for _, n in seen} == {60} and len({kind for kind, _ in seen}) >= 3
    assert running.count() == 60  # a query of the replaced table
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]
    with pytest.raises(AnalysisException):
        read_table(spark, f"{database}.nowhere")


def files_of(spark, table):
    return {(r.p, r.file) for r in spark.table(table).select(
        "p", F.col("_metadata.file_path").alias("file")).distinct().collect()}


def test_batches_do_not_pile_up_files(spark, database):
    table = f"{database}.t"
    spec = TableSpec(T.StructType([T.StructField("id", T.LongType()),
                                   T.StructField("p", T.IntegerType())]), ("p",))

    def rows(low, high, parts):
        return spark.range(low, high).selectExpr("id", f"CAST(id % {parts} AS INT) AS p")

    create_or_replace(rows(0, 4_000, 4), table, spec)
    first = files_of(spark, table)
    for batch in range(10):
        low = 4_000 + batch * 20
        append_rows(rows(low, low + 20, 2), table, spec)
        touched = rows(low, low + 20, 2).select("p")
        compact_partitions(spark, table, ["p"], ["id"], touched, most_files=2, rows_per_file=2_000)
    files = files_of(spark, table)
    assert len(files) <= 2 * len(first)
    assert {f for f in files if f[0] > 1} == {f for f in first if f[0] > 1}  # never touched
    assert sorted(r.id for r in spark.table(table).collect()) == list(range(4_200))
    assert compact_partitions(spark, table, ["p"], most_files=100) == 0
