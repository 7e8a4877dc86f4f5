"""Refresh a large read table by rewriting only the key ranges a change falls into.

The rows lie in ranges of (cluster columns, key), one directory each, which no run ever writes
to again.  A small manifest lists the ranges that are live, with their first row, their high-water
mark and an order-free digest of their keys; readers use a view that joins the rows to it, so the
scan is pruned to live ranges at run time.  A refresh

1. takes the mark from the manifest and the rows beyond it from the fact,
2. finds the ranges in which these rows lie now and those in which they belong,
3. writes these ranges anew under new names, without the old and with the new versions of rows,
4. compares the digests of what it wrote with those of what it should have written, and
5. lets the manifest point to the new ranges: a single change of one location.

Readers see all of a refresh or nothing of it, untouched ranges keep their files, and a run that
fails leaves directories that no manifest names.  A full build makes a new pair of tables and
replaces the view, also in one change and with other columns or types if need be.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import OutputSpec, WatermarkPolicy
from tidemark.operators.joins import BROADCAST_LIMIT, filtering_join
from tidemark.operators.watermark import high_water_mark
from tidemark.plans.output import OutputCheckError, build_output, changed_rows, check_output
from tidemark.sources.layout import CLUSTERED_BY, table_properties
from tidemark.sources.scratch import materialise, scratch_folder
from tidemark.sources.writers import ROWS_PER_FILE, by_partition, quoted, range_files

RANGE = "range_id"
GENERATION = "tidemark.generation"


@dataclass(frozen=True)
class RangeResult:
    view: str
    mode: str  # "full" or "ranges"
    rewritten: int
    ranges: int
    changed_rows: int


def _rows_table(view: str, generation: str) -> str:
    return f"{view}_rows_{generation}"


def _live_table(view: str, generation: str) -> str:
    return f"{view}_live_{generation}"


def _generation(spark: SparkSession, view: str) -> str | None:
    if not spark.catalog.tableExists(view):
        return None
    return table_properties(spark, view).get(GENERATION)


def live_ranges(spark: SparkSession, view: str) -> DataFrame:
    """The manifest: a row for each live range."""
    return spark.table(_live_table(view, _generation(spark, view)))


def stored_rows(spark: SparkSession, view: str) -> DataFrame:
    """Rows with their range and the path of their file; only live ranges are read."""
    rows = spark.table(_rows_table(view, _generation(spark, view)))
    return _live(rows.select("*", F.col("_metadata.file_path").alias("file")),
                 live_ranges(spark, view))


def _live(rows: DataFrame, live: DataFrame) -> DataFrame:
    """Rows of the ranges that are listed; the broadcast list prunes the scan at run time."""
    return rows.join(F.broadcast(live.where("rows > 0").select(RANGE)), RANGE, "left_semi")


def _digest(key: str) -> list[Column]:
    """Equal for equal sets of keys in any order; adding a key twice or losing one shows."""
    hashed = F.xxhash64(key)
    return [F.count("*").alias("rows"),
            F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
            .alias("key_sum"),
            F.coalesce(F.bit_xor(hashed), F.lit(0)).alias("key_xor")]


def _place(spec: OutputSpec) -> Column:
    """A row's place in the order of the ranges; nulls come first inside a struct."""
    return F.struct(*dict.fromkeys([*spec.cluster_by, spec.key]))


def _described(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    """Manifest rows of what was written, read back from it."""
    return rows.groupBy(RANGE).agg(
        F.min(_place(spec)).alias("first"), F.max(spec.watermark).alias("mark"),
        *_digest(spec.key))


def _written(spark: SparkSession, table: str, laid_out: DataFrame, ids: DataFrame,
             spec: OutputSpec) -> DataFrame:
    """Add new ranges to the table and describe them; ``ids`` names them, once written."""
    laid_out.select(*spec.columns, RANGE).write.insertInto(table)
    return materialise(_described(_only(spark.table(table), ids), spec), "ranges")


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    counted = ids.groupBy(RANGE).agg(F.count("*").alias("__rows")).where("__rows > 0")
    return rows.join(F.broadcast(counted.select(RANGE)), RANGE, "left_semi")


def _publish(spark: SparkSession, live: str, manifest: DataFrame) -> None:
    path = scratch_folder(spark, "manifest")
    manifest.coalesce(1).write.parquet(path)
    spark.sql(f"ALTER TABLE {live} SET LOCATION {quoted(path)}")
    spark.catalog.refreshTable(live)


def _build(spark: SparkSession, view: str, fact: DataFrame, dimension: DataFrame,
           spec: OutputSpec, files: int | None, rows_per_file: int,
           check: str | None) -> RangeResult:
    generation = uuid.uuid4().hex[:12]
    rows, live = _rows_table(view, generation), _live_table(view, generation)
    built = build_output(fact, dimension, spec)
    order = list(dict.fromkeys([*spec.cluster_by, spec.key]))
    files = files or range_files(built, rows_per_file)
    ranged = (built.repartitionByRange(files, *order).sortWithinPartitions(*order)
              .withColumn(RANGE, F.concat(F.lit(f"{generation}-"), F.spark_partition_id())))
    ranged.write.partitionBy(RANGE).saveAsTable(rows)
    if check:
        check_output(fact, dimension, spark.table(rows), spec, check)
    manifest = _described(spark.table(rows), spec)
    path = scratch_folder(spark, "manifest")
    manifest.coalesce(1).write.parquet(path)
    spark.sql(f"CREATE TABLE {live} USING parquet LOCATION {quoted(path)}")
    columns = ", ".join(f"r.{c}" for c in spec.columns)
    spark.sql(f"""
        CREATE OR REPLACE VIEW {view}
        TBLPROPERTIES ({quoted(GENERATION)} = {quoted(generation)},
                       {quoted(CLUSTERED_BY)} = {quoted(','.join(spec.cluster_by))})
        AS SELECT /*+ BROADCAST(l) */ {columns} FROM {rows} r
           LEFT SEMI JOIN (SELECT {RANGE} FROM {live} WHERE rows > 0) l
           ON r.{RANGE} = l.{RANGE}""")
    count = spark.table(live).count()
    return RangeResult(view, "full", count, count, 0)


def _belonging(rows: DataFrame, live: DataFrame, spec: OutputSpec) -> DataFrame:
    """Rows with the range they belong to: the last one that does not start behind them, or the
    first one for rows before all.  Each row looks its range up in a list of all of them, of which
    there are no more than files; no pair of row and range is made."""
    ranges = live.agg(F.sort_array(F.collect_list(F.struct("first", RANGE)))).scalar()
    place = _place(spec)
    begun = F.filter("__ranges", lambda one: one["first"] <= place)
    chosen = F.coalesce(F.try_element_at(begun, F.lit(-1)), F.element_at("__ranges", F.lit(1)))
    return rows.withColumn("__ranges", ranges).withColumn(RANGE, chosen[RANGE]).drop("__ranges")


def refresh_ranges(spark: SparkSession, view: str, fact: DataFrame, dimension: DataFrame,
                   spec: OutputSpec = OutputSpec(), full: bool = False,
                   policy: WatermarkPolicy = WatermarkPolicy(),
                   retry: DataFrame | None = None, files: int | None = None,
                   rows_per_file: int = ROWS_PER_FILE, check: str | None = "keys",
                   broadcast_limit: int = BROADCAST_LIMIT) -> RangeResult:
    """Bring the view up to date; the first run, ``full`` and an empty table load everything.

    ``check`` compares a full build with its sources, by ``"keys"`` or ``"counts"``; a refresh is
    checked against the digests of the ranges it replaces unless ``check`` is ``None``.
    """
    generation = None if full else _generation(spark, view)
    mark = None
    if generation:
        live = live_ranges(spark, view)
        mark = high_water_mark(live, "mark")
    if mark is None:
        return _build(spark, view, fact, dimension, spec, files, rows_per_file, check)
    rows = spark.table(_rows_table(view, generation))
    changed = changed_rows(fact, mark, spec, policy, retry)
    built = materialise(build_output(changed, dimension, spec), "built")
    lying = materialise(filtering_join(
        _live(rows.select(spec.key, RANGE), live), changed, spec.key, "left_semi",
        broadcast_limit), "lying")
    belonging = materialise(_belonging(built, live, spec), "belonging")
    ids = materialise(lying.select(RANGE).union(belonging.select(RANGE)).distinct(), "touched")
    total, touched = live.count(), ids.count()
    if not touched:
        return RangeResult(view, "ranges", 0, total, 0)

    run = uuid.uuid4().hex[:12]
    renamed = F.concat(F.lit(f"{run}-"), F.substring_index(RANGE, "-", -1)).alias(RANGE)
    kept = filtering_join(_only(rows, ids), changed, spec.key, "left_anti", broadcast_limit)
    parts = kept.select(*spec.columns, RANGE).unionByName(belonging.select(*spec.columns, RANGE))
    sizes = live.select(RANGE, "rows").union(
        belonging.groupBy(RANGE).agg(F.count("*").alias("rows")))
    sizes = _only(sizes, ids).groupBy(renamed).agg(F.sum("rows").alias("__rows"))
    laid_out = by_partition(
        parts.select(*spec.columns, renamed), [RANGE], [*spec.cluster_by, spec.key],
        rows_per_file, sizes)
    new = _written(spark, _rows_table(view, generation), laid_out, ids.select(renamed), spec)
    if check:
        _check_ranges(_only(live, ids), lying, belonging, new, spec)
    remaining = live.join(F.broadcast(ids), RANGE, "left_anti")
    _publish(spark, _live_table(view, generation), remaining.unionByName(new))
    return RangeResult(view, "ranges", touched, total, belonging.count())


def _check_ranges(replaced: DataFrame, lying: DataFrame, belonging: DataFrame, new: DataFrame,
                  spec: OutputSpec) -> None:
    """Raise unless the new ranges hold the keys of the old ones, less those that lay there and
    with those that belong there: one row of each is compared, and no key is shuffled."""
    def total(df: DataFrame) -> tuple:
        return tuple(df.agg(*[F.coalesce(c, F.lit(0)) for c in (
            F.sum("rows"), F.sum("key_sum"), F.bit_xor("key_xor"))]).first())

    old, found = total(replaced), total(new)
    out, into = (tuple(df.agg(*_digest(spec.key)).first()) for df in (lying, belonging))
    expected = (old[0] - out[0] + into[0], old[1] - out[1] + into[1], old[2] ^ out[2] ^ into[2])
    nulls = belonging.where(" OR ".join(f"`{c}` IS NULL" for c in (
        spec.key, spec.join_key))).count()
    if expected != found or nulls:
        raise OutputCheckError(
            f"{found[0]} rows in new ranges where {expected[0]} should be, or other keys; "
            f"{nulls} rows without a key")


def drop_replaced(spark: SparkSession, view: str) -> Sequence[str]:
    """Remove the directories of ranges that the manifest no longer names.

    Not part of a refresh: a query that began before it may still read them.
    """
    generation = _generation(spark, view)
    table = _rows_table(view, generation)
    stored = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.substring_index("partition", "=", -1).alias(RANGE))
    gone = [r[0] for r in stored.join(
        live_ranges(spark, view).select(RANGE), RANGE, "left_anti").collect()]
    for at in range(0, len(gone), 1000):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(
            f"PARTITION ({RANGE} = {quoted(one)})" for one in gone[at:at + 1000]))
    return gone
