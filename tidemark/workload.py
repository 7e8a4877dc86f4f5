"""The registered queries: every operator over the given tables.

Two settings are used.  Plain operators run on the given tables themselves, with ``orders``
as the fact and ``customer`` or ``nation`` as the dimension.  The composite jobs run on an
employee table with one row per order, whose content is generated from the order keys, and
its department table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import (
    FIRST_EMPLOYEE_ID, BatchConfig, GenerationConfig, OutputSpec, WatermarkPolicy,
)
from tidemark.functions import (
    anchor, bucket_of, draw, id_key, keyed_hash, minutes_after, pick, seconds_before,
    skewed_key,
)
from tidemark.functions import vocabulary as v
from tidemark.operators import (
    append_only, column_stats, computed_key_join, duplicate_keys, hash_order_sample,
    high_water_mark, locate_differences, many_to_one_join, merged_stats, move_partitions,
    newer_than, not_null_report, one_per_key, orphans, partial_update, partition_profile,
    reconcile, refresh_sketches, relationships, row_counts, sketch_partitions, skew_profile,
    upsert, watermark_profile,
)
from tidemark.operators.joins import BROADCAST_LIMIT
from tidemark.plans import (
    Expectations, allocate_ids, build_output, create_sources, generate_dimension,
    generate_fact, land_batch, live_ranges, new_rows, quarantine, refresh_output,
    refresh_overlay, refresh_ranges, run_build, stored_rows, verify, verify_layout,
)
from tidemark.sources import (
    EMPLOYEE, analyze, append_rows, by_partition, cluster_summary, file_spans, materialise,
    read_table, scratch_folder, stored_statistics, table_detail, write_clustered, write_curved,
    write_partitioned,
)

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = GenerationConfig()
BATCH = BatchConfig()
LATER_BATCH = BatchConfig(asof="2026-08-15 00:00:00", force_move=True)

# The read table over orders and customers.
ORDERS = OutputSpec(
    key="o_orderkey",
    join_key="c_name",
    watermark="o_orderdate",
    fact_columns=("o_orderkey", "c_name", "o_orderstatus", "o_totalprice", "o_orderdate"),
    dim_columns=("c_mktsegment", "c_nationkey", "c_acctbal"),
    cluster_by=("c_name",),
)
ORDERS_CUT = "2000-01-01 00:00:00"
EVENTS_CUT = "2024-01-20 00:00:00"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _named_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's name on them, as a fact carries its join key."""
    return many_to_one_join(
        _table(spark, sf_dir, "orders"),
        _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"),
        "o_custkey")


def _employee_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + FIRST_EMPLOYEE_ID).alias("employee_id"))


def _employees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    dimension = generate_dimension(spark, CONFIG)
    return generate_fact(spark, CONFIG, dimension, _employee_ids(spark, sf_dir)), dimension


def scratch_database(spark: SparkSession) -> str:
    """A database of its own below the shared folder, so runs never meet."""
    path = scratch_folder(spark, "tables")
    name = "tidemark_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def _source_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    database = scratch_database(spark)
    employee, department = f"{database}.employee", f"{database}.department"
    create_sources(spark, CONFIG, employee, department, _employee_ids(spark, sf_dir))
    return database, employee, department


# --- keyed content ------------------------------------------------------------------

def keyed_hash_query(spark, sf_dir):
    key = id_key("l_orderkey")
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        keyed_hash(key, v.SALT_IS_HOT).alias("hash_skew"),
        keyed_hash(key, v.SALT_MOVE_KEY).alias("hash_move"),
        draw(key, v.SALT_IS_HOT, 100).alias("draw_100"),
    )


def pick_from_list_query(spark, sf_dir):
    key = id_key("c_custkey")
    return _table(spark, sf_dir, "customer").select(
        "c_custkey",
        pick(v.LOCATION_CODES, key, v.SALT_LOCATION).alias("location_code"),
        pick(v.SALARY_BANDS, key, v.SALT_BAND).alias("salary_band"),
    )


def timestamp_spread_query(spark, sf_dir):
    key, at = id_key("o_orderkey"), anchor(CONFIG.asof)
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        seconds_before(at, key, v.SALT_UPDATED, 90 * 86_400).alias("before_anchor"),
        minutes_after(at, key, v.SALT_NEW_UPDATED, 720).alias("after_anchor"),
        minutes_after(F.col("o_orderdate"), key, v.SALT_MOVE_UPDATED, 720).alias("after_order"),
    )


def skewed_key_query(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        "event_id", skewed_key(id_key("event_id"), 24).alias("department_number"))


def gen_dimension_query(spark, sf_dir):
    """As many departments as there are customers."""
    customers = _table(spark, sf_dir, "customer").agg(F.count("*").alias("n")).first().n
    return generate_dimension(spark, GenerationConfig(departments=max(customers, 1)))


def gen_fact_query(spark, sf_dir):
    return _employees(spark, sf_dir)[0]


# --- joins --------------------------------------------------------------------------

def denormalise_key_query(spark, sf_dir):
    return _named_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "c_name")


def gold_full_query(spark, sf_dir):
    """Orders joined to customers on the name, with the customer's nation."""
    nation = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    customer = many_to_one_join(_table(spark, sf_dir, "customer"), nation, "c_nationkey")
    spec = OutputSpec(
        key="o_orderkey", join_key="c_name", watermark="o_orderdate",
        fact_columns=ORDERS.fact_columns, dim_columns=("c_mktsegment", "nation"),
        cluster_by=("c_name",))
    return build_output(_named_orders(spark, sf_dir), customer, spec)


def gold_employee_department_query(spark, sf_dir):
    return build_output(*_employees(spark, sf_dir))


def shuffled_join_query(spark, sf_dir):
    """The same join with broadcasting ruled out: line items to their orders."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderdate")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return many_to_one_join(lines, orders, "l_orderkey", broadcast_limit=0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", "o_orderdate")


def skewed_join_query(spark, sf_dir):
    """Line items of which a third belong to one order, joined without a broadcast."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    hot = orders.agg(F.min("o_orderkey")).first()[0]
    lines = _table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 3 == 0, F.lit(hot)).otherwise(F.col("l_orderkey"))
        .alias("o_orderkey"), "l_linenumber", "l_partkey")
    return many_to_one_join(lines, orders, "o_orderkey", broadcast_limit=0)


def computed_key_join_query(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    return computed_key_join(
        events, _table(spark, sf_dir, "nation"), "n_nationkey",
        lambda n: draw(id_key("event_id"), v.SALT_MOVE_KEY, n), ["n_nationkey", "n_name"])


# --- checks -------------------------------------------------------------------------

def row_counts_query(spark, sf_dir):
    return row_counts({name: _table(spark, sf_dir, name) for name in (
        "lineitem", "orders", "customer", "events", "nation")})


def duplicate_keys_query(spark, sf_dir):
    return duplicate_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def not_null_report_query(spark, sf_dir):
    """Nulls a left join leaves behind when part of the dimension is missing."""
    some = _table(spark, sf_dir, "customer").filter(F.col("c_nationkey") < 20).select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    joined = many_to_one_join(_table(spark, sf_dir, "orders"), some, "o_custkey", "left")
    return not_null_report(joined, ["o_orderkey", "o_custkey", "c_name", "c_mktsegment"])


def _orders_with_gaps(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders whose key is null for urgent ones, and the customers of some nations."""
    child = _table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")))
    return child, _table(spark, sf_dir, "customer").filter(F.col("c_nationkey") < 20)


def orphans_query(spark, sf_dir):
    return orphans(*_orders_with_gaps(spark, sf_dir), "o_custkey", "c_custkey")


def relationships_query(spark, sf_dir):
    return relationships(*_orders_with_gaps(spark, sf_dir), "o_custkey", "c_custkey")


def quarantine_query(spark, sf_dir):
    child, parent = _orders_with_gaps(spark, sf_dir)
    spec = OutputSpec(
        key="o_orderkey", join_key="o_custkey", watermark="o_orderdate",
        fact_columns=("o_orderkey", "o_custkey", "o_orderdate"), dim_columns=(), cluster_by=())
    return quarantine(child, parent.withColumnRenamed("c_custkey", "o_custkey"), spec)


def row_count_reconcile_query(spark, sf_dir):
    """A faulty output: pending orders lost, urgent ones doubled."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    kept = orders.filter(F.col("o_orderstatus") != "P")
    doubled = kept.filter(F.col("o_orderpriority") == "1-URGENT")
    return reconcile(orders, kept.unionByName(doubled), "o_orderkey", ["o_custkey"])


# --- profiles -----------------------------------------------------------------------

def partition_profile_query(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", bucket_of(F.col("l_orderkey"), 4).alias("bucket"))
    return partition_profile(lines, ["l_suppkey", "bucket"])


def skew_profile_query(spark, sf_dir):
    return skew_profile(skewed_key_query(spark, sf_dir), ["department_number"], 10, "employees")


def watermark_profile_query(spark, sf_dir):
    return watermark_profile(_table(spark, sf_dir, "events"), "ts")


def column_stats_query(spark, sf_dir):
    return column_stats(_table(spark, sf_dir, "orders"), distinct="exact")


def employee_partition_profile_query(spark, sf_dir):
    fact, _ = _employees(spark, sf_dir)
    return partition_profile(fact, EMPLOYEE.partition_by, CONFIG.departments * CONFIG.buckets)


def employee_skew_profile_query(spark, sf_dir):
    fact, _ = _employees(spark, sf_dir)
    return skew_profile(fact, ["department_number", "department_name"], 10, "employees")


def employee_watermark_profile_query(spark, sf_dir):
    return watermark_profile(_employees(spark, sf_dir)[0], "updated_at")


def sketch_stats_query(spark, sf_dir):
    """Statistics of orders kept by priority: sketched once, then refreshed for the urgent ones,
    which have got a later date meanwhile; the estimate of distinct values is within five percent."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    kind = orders.schema["o_orderdate"].dataType
    now = orders.withColumn("o_orderdate", F.when(
        urgent, anchor("2030-01-01 00:00:00").cast(kind)).otherwise(F.col("o_orderdate")))
    stored = materialise(sketch_partitions(orders, ["o_orderpriority"]), "sketches")
    touched = now.where(urgent).select("o_orderpriority").distinct()
    kept = refresh_sketches(stored, now, ["o_orderpriority"], touched)
    exact = column_stats(now.drop("o_orderpriority"), distinct="exact").select(
        "column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged_stats(kept).join(F.broadcast(exact), "column_name").select(
        "column_name", "rows", "nulls", "min_value", "max_value", near.alias("near"))


def differences_located_query(spark, sf_dir):
    """Orders against a copy that lost some, doubled some and changed the price of others."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    key = F.col("o_orderkey")
    copy = orders.where(key % 1000 != 1).withColumn("o_totalprice", F.when(
        key % 1000 == 3, F.lit(0.0)).otherwise(F.col("o_totalprice")))
    copy = copy.unionByName(copy.where(key % 1000 == 2)).repartition("o_custkey")
    return locate_differences(orders, copy, "o_orderkey", ["o_custkey", "o_totalprice"])


# --- high-water mark and samples ----------------------------------------------------

def _older_events(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").filter(F.col("ts") < anchor(EVENTS_CUT))


def watermark_delta_query(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return newer_than(events, "ts", high_water_mark(_older_events(spark, sf_dir), "ts"))


def watermark_inclusive_query(spark, sf_dir):
    """Orders carry whole days, so many share the mark's timestamp."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    mark = high_water_mark(orders.filter(F.col("o_orderdate") < anchor(ORDERS_CUT)), "o_orderdate")
    return newer_than(orders, "o_orderdate", mark, WatermarkPolicy("inclusive", "12 hours"))


def hash_order_sample_query(spark, sf_dir):
    old = _table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < anchor(ORDERS_CUT))
    return hash_order_sample(old, "o_orderkey", 200).select("o_orderkey", "o_orderdate")


def hash_cutoff_sample_query(spark, sf_dir):
    """Half of all orders: more rows than one task should merge."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    half = orders.agg(F.floor(F.count("*") / 2).alias("n")).first().n
    return hash_order_sample(orders, "o_orderkey", half, top_k_limit=0)


# --- batches and merges -------------------------------------------------------------

def allocate_ids_query(spark, sf_dir):
    """A new event id for each customer."""
    n = _table(spark, sf_dir, "customer").agg(F.count("*").alias("n")).first().n
    return allocate_ids(_table(spark, sf_dir, "events"), "event_id", n, 0)


def append_batch_query(spark, sf_dir):
    database, employee, department = _source_tables(spark, sf_dir)
    fact, dimension = spark.table(employee), spark.table(department)
    append_rows(new_rows(fact, dimension, CONFIG, BATCH), employee, EMPLOYEE)
    return spark.table(employee).select(EMPLOYEE.columns)


def land_batch_query(spark, sf_dir):
    database, employee, department = _source_tables(spark, sf_dir)
    land_batch(spark, employee, department, CONFIG, BATCH)
    return spark.table(employee).select(EMPLOYEE.columns)


def _customer_moves(spark, sf_dir) -> DataFrame:
    """Customers in debt move to the nation a keyed draw names and are cleared."""
    key = id_key("c_custkey")
    return _table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        "c_custkey", draw(key, v.SALT_MOVE_KEY, 25).alias("new_nationkey"),
        (-F.col("c_acctbal")).alias("new_acctbal"))


def merge_partial_update_query(spark, sf_dir):
    return partial_update(
        _table(spark, sf_dir, "customer"), _customer_moves(spark, sf_dir), "c_custkey",
        {"c_nationkey": "new_nationkey", "c_acctbal": "new_acctbal"})


def merge_partition_move_query(spark, sf_dir):
    """Customers partitioned by nation; those of the first nations leave them empty."""
    table = f"{scratch_database(spark)}.customer"
    customer = _table(spark, sf_dir, "customer")
    by_partition(customer, ["c_nationkey"]).write.partitionBy("c_nationkey").saveAsTable(table)
    moves = customer.filter(F.col("c_nationkey") < 3).select(
        "c_custkey", (F.col("c_nationkey") + 10).alias("new_nationkey"))
    move_partitions(spark, table, moves, "c_custkey", {"c_nationkey": "new_nationkey"},
                    ["c_nationkey"])
    return spark.table(table).select(customer.columns)


def _event_batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events up to a cut, and a batch: the later ones plus new values for some old ones.

    Old errors occur twice in the batch, under two timestamps; the later one counts.
    """
    events = _table(spark, sf_dir, "events").drop("props")
    old = events.filter(F.col("ts") < anchor(EVENTS_CUT))
    errors = old.filter(F.col("event_type") == "error")
    at = anchor("2024-03-01 00:00:00")
    first = errors.withColumns({"ts": at, "value": F.lit(-1.0)})
    second = errors.withColumns(
        {"ts": F.timestamp_add("HOUR", F.lit(1), at), "value": F.lit(-2.0)})
    batch = events.filter(F.col("ts") >= anchor(EVENTS_CUT)).unionByName(first).unionByName(second)
    return old, batch


def merge_upsert_query(spark, sf_dir):
    target, batch = _event_batch(spark, sf_dir)
    return upsert(target, one_per_key(batch, "event_id", ["ts"]), "event_id")


def append_only_duplicates_query(spark, sf_dir):
    target, batch = _event_batch(spark, sf_dir)
    return duplicate_keys(append_only(target, batch), ["event_id"])


def gold_incremental_query(spark, sf_dir):
    """Orders up to a cut are built and written, the rest arrives by high-water mark."""
    fact, customer = _named_orders(spark, sf_dir), _table(spark, sf_dir, "customer")
    path = scratch_folder(spark, "output")
    write_clustered(
        build_output(fact.filter(F.col("o_orderdate") < anchor(ORDERS_CUT)), customer, ORDERS),
        path, ORDERS.cluster_by, [ORDERS.key])
    return refresh_output(fact, customer, read_table(spark, path), ORDERS)


def gold_restated_query(spark, sf_dir):
    """As above, after segments of the dimension changed: all rows carry the new ones."""
    fact, customer = _named_orders(spark, sf_dir), _table(spark, sf_dir, "customer")
    before = customer.withColumn("c_mktsegment", F.lit("UNKNOWN"))
    previous = materialise(
        build_output(fact.filter(F.col("o_orderdate") < anchor(ORDERS_CUT)), before, ORDERS),
        "output")
    return refresh_output(fact, customer, previous, ORDERS, restate=True)


def gold_orphaned_move_query(spark, sf_dir):
    """Urgent orders before a cut move to a customer that is not there, and so leave."""
    fact, customer = _named_orders(spark, sf_dir), _table(spark, sf_dir, "customer")
    before = F.col("o_orderdate") < anchor(ORDERS_CUT)
    previous = materialise(build_output(fact.filter(before), customer, ORDERS), "output")
    moved = before & (F.col("o_orderpriority") == "1-URGENT")
    kind = fact.schema["o_orderdate"].dataType
    fact = fact.withColumns({
        "c_name": F.when(moved, F.lit("nobody")).otherwise(F.col("c_name")),
        "o_orderdate": F.when(moved, anchor(ORDERS_CUT).cast(kind)).otherwise(
            F.col("o_orderdate"))})
    return refresh_output(fact, customer, previous, ORDERS)


def batch_cycle_query(spark, sf_dir):
    """Generate, build, land two batches with a refresh after each; the read table at the end."""
    database, employee, department = _source_tables(spark, sf_dir)
    root = scratch_folder(spark, "output")
    output = f"{database}.employee_department"
    dimension = spark.table(department)
    run_build(spark, output, spark.table(employee), dimension, root, check="counts")
    for batch in (BATCH, LATER_BATCH):
        land_batch(spark, employee, department, CONFIG, batch)
        run_build(spark, output, spark.table(employee), dimension, root)
    return spark.table(output)


def batch_cycle_overlay_query(spark, sf_dir):
    """The same cycle with changes kept beside the base; the last one is folded in."""
    database, employee, department = _source_tables(spark, sf_dir)
    root = scratch_folder(spark, "output")
    output = f"{database}.employee_department"
    dimension = spark.table(department)
    refresh_overlay(spark, output, spark.table(employee), dimension, root)
    for batch in (BATCH, LATER_BATCH):
        land_batch(spark, employee, department, CONFIG, batch)
        refresh_overlay(spark, output, spark.table(employee), dimension, root,
                        broadcast_limit=0 if batch is LATER_BATCH else BROADCAST_LIMIT)
    return spark.table(output)


RANGES = 16


def _late_orders(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders before and after those of every tenth of the first customers came in again: these
    have another status and a later date; and the customers."""
    fact, customer = _named_orders(spark, sf_dir), _table(spark, sf_dir, "customer")
    few = customer.agg(F.floor(F.max("c_custkey") / 10)).first()[0]
    late = F.col("o_custkey") <= few
    kind = fact.schema["o_orderdate"].dataType
    after = fact.withColumns({
        "o_orderstatus": F.when(late, F.lit("X")).otherwise(F.col("o_orderstatus")),
        "o_orderdate": F.when(late, anchor("2030-01-01 00:00:00").cast(kind)).otherwise(
            F.col("o_orderdate"))})
    return fact, after, customer


def gold_ranges_query(spark, sf_dir):
    """The read table after a refresh that rewrites only the ranges of changed customers."""
    before, after, customer = _late_orders(spark, sf_dir)
    view = f"{scratch_database(spark)}.orders"
    refresh_ranges(spark, view, before, customer, ORDERS, files=RANGES)
    refresh_ranges(spark, view, after, customer, ORDERS)
    return spark.table(view)


def ranges_report_query(spark, sf_dir):
    """What that refresh wrote: changed rows, ranges, whether it rewrote less than half of them,
    and how many of the ranges it left alone kept their very files."""
    before, after, customer = _late_orders(spark, sf_dir)
    view = f"{scratch_database(spark)}.orders"
    refresh_ranges(spark, view, before, customer, ORDERS, files=RANGES)
    stored = materialise(stored_rows(spark, view).select("range_id", "file").distinct(), "stored")
    result = refresh_ranges(spark, view, after, customer, ORDERS)
    kept = stored_rows(spark, view).select("range_id", "file").distinct().join(
        stored, ["range_id", "file"], "left_semi")
    return live_ranges(spark, view).agg(
        F.sum("rows").alias("rows"), F.count("*").cast("int").alias("ranges")).select(
        "*", F.lit(result.changed_rows).cast("bigint").alias("changed_rows"),
        F.lit(0 < result.rewritten < RANGES / 2).alias("less_than_half"),
        F.lit(kept.select("range_id").distinct().count() == RANGES - result.rewritten)
        .alias("others_untouched"))


def batch_cycle_ranges_query(spark, sf_dir):
    """The cycle of batches with refreshes by range."""
    database, employee, department = _source_tables(spark, sf_dir)
    output, dimension = f"{database}.employee_department", spark.table(department)
    refresh_ranges(spark, output, spark.table(employee), dimension, files=RANGES)
    for batch in (BATCH, LATER_BATCH):
        land_batch(spark, employee, department, CONFIG, batch)
        refresh_ranges(spark, output, spark.table(employee), dimension)
    return spark.table(output)


# --- layout -------------------------------------------------------------------------

def partitioned_write_roundtrip_query(spark, sf_dir):
    """Orders through a two-key partitioned folder, customers' nations through a one-key one."""
    orders = _table(spark, sf_dir, "orders").withColumn(
        "bucket", bucket_of(F.col("o_orderkey"), 4))
    path = scratch_folder(spark, "orders")
    write_partitioned(orders, path, ["o_orderpriority", "bucket"], ["o_orderdate"])
    return read_table(spark, path).select(*orders.columns, _directory(path))


def _directory(path: str):
    """The folder a row was read from, below the table's own."""
    name = path.rsplit("/", 1)[1]
    return F.regexp_extract(
        F.url_decode("_metadata.file_path"), f"{name}/(.*)/[^/]*$", 1).alias("directory")


def partitioned_write_one_key_query(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    path = scratch_folder(spark, "customer")
    write_partitioned(customer, path, ["c_nationkey"])
    return read_table(spark, path).select(*customer.columns, _directory(path))


def stored_statistics_query(spark, sf_dir):
    """Statistics that the catalog keeps of a partitioned table."""
    table = f"{scratch_database(spark)}.orders"
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    by_partition(orders, ["status"]).write.partitionBy("status").saveAsTable(table)
    analyze(spark, table)
    return stored_statistics(spark, table).where("column_name <> 'status'")


def layout_detail_query(spark, sf_dir):
    """Layout of both source tables and the read table; files vary with the session."""
    database, employee, department = _source_tables(spark, sf_dir)
    output = f"{database}.employee_department"
    run_build(spark, output, spark.table(employee), spark.table(department),
              scratch_folder(spark, "output"), check=None)
    details = [table_detail(spark, table) for table in (employee, department, output)]
    return details[0].union(details[1]).union(details[2]).select(
        F.substring_index("table_name", ".", -1).alias("table_name"),
        "partition_columns", "clustering_columns", "partitions", "rows")


def cluster_profile_query(spark, sf_dir):
    """Line items laid out by part, in several files even when they are few."""
    path = scratch_folder(spark, "lineitem")
    write_clustered(_table(spark, sf_dir, "lineitem"), path, ["l_partkey"],
                    ["l_orderkey", "l_linenumber"], smallest_file=10_000)
    return cluster_summary(read_table(spark, path), "l_partkey").select(
        "rows", "keys", "well_clustered")


def curve_profile_query(spark, sf_dir):
    """Line items laid out by part and supplier at once: in sixteen files, each covers less than
    half of the span of either key."""
    path = scratch_folder(spark, "lineitem")
    write_curved(_table(spark, sf_dir, "lineitem"), path, ["l_partkey", "l_suppkey"],
                 ["l_orderkey", "l_linenumber"], files=16)
    laid = read_table(spark, path)
    spans = file_spans(laid, ["l_partkey", "l_suppkey"]).select(
        "key", "files", (F.col("share_of_span") < 0.5).alias("skips"))
    return spans.crossJoin(F.broadcast(laid.agg(F.count("*").alias("rows"))))  # one row


def verify_report_query(spark, sf_dir):
    """Every check on freshly built tables."""
    database, employee, department = _source_tables(spark, sf_dir)
    output = f"{database}.employee_department"
    fact, dimension = spark.table(employee), spark.table(department)
    run_build(spark, output, fact, dimension, scratch_folder(spark, "output"), check=None)
    orders = _table(spark, sf_dir, "orders").agg(F.count("*").alias("n")).first().n
    config = GenerationConfig(employees=orders)
    data = verify(fact, dimension, spark.table(output), expected=Expectations.of(config))
    return data.union(verify_layout(spark, employee, department, output)).select(
        "check", "expected", "actual", "passed")


def verify_after_batch_query(spark, sf_dir):
    """Every check after two landed batches, each followed by a refresh."""
    database, employee, department = _source_tables(spark, sf_dir)
    output, dimension = f"{database}.employee_department", spark.table(department)
    orders = spark.table(employee).count()
    refresh_ranges(spark, output, spark.table(employee), dimension, check=None)
    for batch in (BATCH, LATER_BATCH):
        land_batch(spark, employee, department, CONFIG, batch)
        refresh_ranges(spark, output, spark.table(employee), dimension)
    expected = Expectations.of(GenerationConfig(employees=orders),
                               landed=BATCH.new_rows + LATER_BATCH.new_rows)
    data = verify(spark.table(employee), dimension, spark.table(output), expected=expected)
    return data.union(verify_layout(spark, employee, department, output)).select(
        "check", "expected", "actual", "passed")


def queries() -> dict[str, Query]:
    return {
        "keyed_hash": keyed_hash_query,
        "pick_from_list": pick_from_list_query,
        "timestamp_spread": timestamp_spread_query,
        "skewed_key_assignment": skewed_key_query,
        "gen_dimension": gen_dimension_query,
        "gen_fact": gen_fact_query,
        "denormalise_key": denormalise_key_query,
        "gold_full": gold_full_query,
        "gold_employee_department": gold_employee_department_query,
        "shuffled_join": shuffled_join_query,
        "skewed_join": skewed_join_query,
        "computed_key_join": computed_key_join_query,
        "row_counts": row_counts_query,
        "duplicate_keys": duplicate_keys_query,
        "not_null_report": not_null_report_query,
        "orphans": orphans_query,
        "relationships": relationships_query,
        "quarantine": quarantine_query,
        "row_count_reconcile": row_count_reconcile_query,
        "partition_profile": partition_profile_query,
        "skew_profile": skew_profile_query,
        "watermark_profile": watermark_profile_query,
        "employee_partition_profile": employee_partition_profile_query,
        "employee_skew_profile": employee_skew_profile_query,
        "employee_watermark_profile": employee_watermark_profile_query,
        "column_stats": column_stats_query,
        "sketch_stats": sketch_stats_query,
        "differences_located": differences_located_query,
        "watermark_delta": watermark_delta_query,
        "watermark_inclusive": watermark_inclusive_query,
        "hash_order_sample": hash_order_sample_query,
        "hash_cutoff_sample": hash_cutoff_sample_query,
        "allocate_ids": allocate_ids_query,
        "append_batch": append_batch_query,
        "land_batch": land_batch_query,
        "merge_partial_update": merge_partial_update_query,
        "merge_partition_move": merge_partition_move_query,
        "merge_upsert": merge_upsert_query,
        "append_only_duplicates": append_only_duplicates_query,
        "gold_incremental": gold_incremental_query,
        "gold_restated": gold_restated_query,
        "gold_orphaned_move": gold_orphaned_move_query,
        "batch_cycle": batch_cycle_query,
        "batch_cycle_overlay": batch_cycle_overlay_query,
        "gold_ranges": gold_ranges_query,
        "ranges_report": ranges_report_query,
        "batch_cycle_ranges": batch_cycle_ranges_query,
        "partitioned_write_roundtrip": partitioned_write_roundtrip_query,
        "partitioned_write_one_key": partitioned_write_one_key_query,
        "layout_detail": layout_detail_query,
        "cluster_profile": cluster_profile_query,
        "curve_profile": curve_profile_query,
        "verify_report": verify_report_query,
        "verify_after_batch": verify_after_batch_query,
        "stored_statistics": stored_statistics_query,
    }
