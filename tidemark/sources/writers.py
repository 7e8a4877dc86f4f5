"""Sinks: ingest layout (partitioned), read layout (clustered), append and replace."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.layout import clustering_columns
from tidemark.sources.scratch import materialise, scratch_folder
from tidemark.sources.tables import STAGED, TableSpec, conform

# A task sorts and writes about this many rows (100 to 200 MB as a rule) at any size of the
# table, until that would take more tasks than a shuffle bears; they grow from there on.
ROWS_PER_FILE = 2_000_000
MAX_TASKS = 100_000

# A group of at least this share of a task's rows gets a place of its own.  There are no more of
# them than this many for each task, which bounds what is broadcast.
PLACED = 4

SMALLEST_FILE = 100_000


def _spread(df: DataFrame) -> Column:
    """A number that scatters rows, and even copies of one row, as long as they come from
    different input partitions.  A retried task computes the same numbers again."""
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(F.spark_partition_id(), *hashable)


def _usual_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _rows_per_task(spark: SparkSession, rows: int, most: int, least: int) -> int:
    """As many tasks as the session usually takes, of ``least`` to ``most`` rows each."""
    even = -(-rows // _usual_tasks(spark))
    return max(min(max(even, least), most), -(-rows // MAX_TASKS), 1)


@dataclass(frozen=True)
class Slots:
    """Where groups go.  ``placed`` holds the first slot and the number of slots of each group
    that has a place of its own; the others go by their hash to the ``loose`` last ones."""

    placed: DataFrame
    own: int
    loose: int

    @property
    def all(self) -> int:
        return self.own + self.loose


def group_slots(df: DataFrame, keys: Sequence[str], rows_per_file: int,
                counts: DataFrame | None = None) -> Slots:
    """Slots for the groups of a frame, from one count that reads the keys only, unless the
    ``counts`` of ``__rows`` for each key are known (about) already.

    The counts stay a frame.  A group of more rows than a file holds gets as many slots as it
    fills; smaller ones of some size follow one another in key order, by a running sum, and share
    slots with their neighbours; what is smaller still is scattered evenly by its hash.
    """
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count("*").alias("__rows"))
    counts = materialise(counts, "groups")
    rows = counts.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    per_file = max(rows_per_file, -(-rows // MAX_TASKS))
    per_task = _rows_per_task(df.sparkSession, rows, per_file, 1)
    several = F.ceil(F.col("__rows") / F.lit(per_file))
    weight = F.when(several > 1, several * per_task).otherwise(F.col("__rows"))
    large = F.col("__rows") * PLACED >= per_task
    filled, rest = counts.agg(F.coalesce(F.sum(F.when(large, weight)), F.lit(0)),
                              F.coalesce(F.sum(F.when(~large, F.col("__rows"))), F.lit(0))).first()
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    first = F.floor(F.coalesce(F.sum(weight).over(before), F.lit(0)) / per_task)
    placed = counts.where(large).select(
        *[F.col(key).alias(f"__{key}") for key in keys], first.cast("int").alias("__first"),
        several.alias("__several"))
    return Slots(placed, filled // per_task + 1 if filled else 0, -(-rest // per_task))


def in_slots(df: DataFrame, keys: Sequence[str], slots: Slots) -> DataFrame:
    """Shuffle rows once, by slot: a group lies in one task, or in several if it is that large."""
    if slots.all <= 1:
        return df.repartition(1)
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys])
    own = F.col("__first") + F.when(
        F.col("__several") > 1, F.pmod(_spread(df), F.col("__several")).cast("int")).otherwise(0)
    by_hash = slots.own + F.pmod(F.xxhash64(*keys), F.lit(max(slots.loose, 1))).cast("int")
    return (df.join(F.broadcast(slots.placed), same, "left")
            .withColumn("__slot", F.coalesce(own, by_hash))
            .repartitionById(slots.all, "__slot").select(df.columns))


def by_partition(df: DataFrame, keys: Sequence[str], sort_by: Sequence[str] = (),
                 rows_per_file: int = ROWS_PER_FILE,
                 counts: DataFrame | None = None) -> DataFrame:
    """Bring the rows of one partition directory together, however large it is and however many
    there are.

    A hot directory is written by many tasks and a small one gets a single file.  (A plain
    ``repartition(keys)`` sends the hot one to a single task.)  Sorting by the keys saves the
    writer its own sort.
    """
    together = in_slots(df, keys, group_slots(df, keys, rows_per_file, counts))
    return together.sortWithinPartitions(*keys, *sort_by)


def range_files(df: DataFrame, rows_per_file: int = ROWS_PER_FILE,
                smallest_file: int = SMALLEST_FILE) -> int:
    """Into how many files the rows of a frame should go."""
    rows = df.count()
    return max(1, -(-rows // _rows_per_task(
        df.sparkSession, rows, rows_per_file, min(smallest_file, rows_per_file))))


def by_range(df: DataFrame, keys: Sequence[str], tie: Sequence[str],
             files: int | None = None, rows_per_file: int = ROWS_PER_FILE,
             smallest_file: int = SMALLEST_FILE) -> DataFrame:
    """Order rows over files by the read keys, so min/max statistics skip files.

    Spark finds the bounds of the ranges by sampling rows; they include the tie columns (a unique
    id) and a scattered number, so a key that holds a third of the rows is cut into as many files
    as its size asks for, and copies of one row do not meet either.
    """
    order = [*keys, *[column for column in tie if column not in keys]]
    files = files or range_files(df, rows_per_file, smallest_file)
    together = df.withColumn("__scattered", _spread(df)).repartitionByRange(
        files, *order, "__scattered")
    return together.sortWithinPartitions(*order).select(df.columns)


def _bucket(df: DataFrame, keys: Sequence[str], bits: int) -> list[Column]:
    """For each key the number of the range a value falls into, of two to the ``bits`` ranges of
    about as many rows; nulls come first.  Bounds are estimated in one aggregate, which returns a
    row; the ranges are found by halving, in compiled code."""
    cuts = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = df.agg(*[F.approx_percentile(key, cuts).alias(f"b{i}")
                     for i, key in enumerate(keys)]).first()

    def halve(value: Column, bounds: list, low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]), halve(value, bounds, low, middle)).otherwise(
            halve(value, bounds, middle + 1, high))

    out = []
    for key, bounds in zip(keys, found, strict=True):
        if bounds is None:  # no value at all
            out.append(F.lit(0))
            continue
        bounds = sorted(set(bounds))
        out.append(F.when(F.col(key).isNull(), 0).otherwise(
            halve(F.col(key), bounds, 0, len(bounds))))
    return out


def curve(df: DataFrame, keys: Sequence[str], bits: int = 5) -> Column:
    """A row's place on a curve through the space of the keys, whose stretches are narrow in all
    of them: the bits of each key's range in turn (Morton order)."""
    place = F.lit(0).cast("long")
    for i, bucket in enumerate(_bucket(df, keys, bits)):
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.shiftleft(one, bit * len(keys) + i)
    return place


def write_curved(df: DataFrame, path: str, keys: Sequence[str], tie: Sequence[str],
                 files: int | None = None, rows_per_file: int = ROWS_PER_FILE,
                 smallest_file: int = SMALLEST_FILE) -> None:
    """Cluster rows by several numeric or temporal keys alike, so that a filter on any of them
    skips files; sorting by the first key would serve that one alone."""
    placed = df.withColumn("__curve", curve(df, keys))
    by_range(placed, ["__curve"], [*keys, *tie], files, rows_per_file, smallest_file).drop(
        "__curve").write.parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str],
                      sort_by: Sequence[str] = (), mode: str = "errorifexists",
                      rows_per_file: int = ROWS_PER_FILE) -> None:
    by_partition(df, keys, sort_by, rows_per_file).write.mode(mode).partitionBy(*keys).parquet(path)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], tie: Sequence[str],
                    files: int | None = None, rows_per_file: int = ROWS_PER_FILE,
                    smallest_file: int = SMALLEST_FILE) -> None:
    by_range(df, keys, tie, files, rows_per_file, smallest_file).write.parquet(path)


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def staged_name(table: str) -> str:
    return f"{table}{STAGED}"


def swap_in(spark: SparkSession, table: str) -> None:
    """Let the table declared under the staged name take the table's place.

    The catalog renames one table at a time, so the old one leaves its name just before the new
    one takes it: two changes in a row with no work in between, for which ``read_table`` waits.
    The old files stay for queries that run on them.
    """
    if spark.catalog.tableExists(table):
        retired = f"{table}__retired_{uuid.uuid4().hex[:12]}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {retired}")
        spark.sql(f"ALTER TABLE {staged_name(table)} RENAME TO {table}")
        spark.sql(f"DROP TABLE {retired}")
    else:
        spark.sql(f"ALTER TABLE {staged_name(table)} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def create_or_replace(df: DataFrame, table: str, spec: TableSpec,
                      sort_by: Sequence[str] = ()) -> None:
    """Declare a partitioned catalog table with its comments and fill it.

    Rows go by position and are cast to the declared types.  ``sort_by`` orders rows
    inside each file; sorting by the high-water-mark column lets a later incremental read
    skip row groups.  An older table goes before the new one is filled.
    """
    spark = df.sparkSession
    laid_out = by_partition(conform(df, spec), spec.partition_by, sort_by)
    laid_out.write.mode("overwrite").partitionBy(*spec.partition_by).saveAsTable(table)
    if spec.comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(spec.comment)}")


def append_rows(df: DataFrame, table: str, spec: TableSpec,
                sort_by: Sequence[str] = ()) -> None:
    """Insert by position into a declared table; other rows are not touched or read."""
    spark = df.sparkSession
    stored = spark.table(table).columns
    rows = by_partition(conform(df, spec), spec.partition_by, sort_by)
    rows.select(stored).write.insertInto(table)


def publish_clustered(spark: SparkSession, table: str, path: str, keys: Sequence[str],
                      comment: str = "") -> None:
    """Point a table at a finished folder of clustered files.

    With the columns and types as before the swing is one catalog change: readers see the
    old files or the new ones.  With others the table is declared anew under a second name and
    then takes the place of the first (``swap_in``).  Either way the old folder stays readable
    for queries still running on it.
    """
    columns = spark.read.parquet(path).schema
    described = [(f.name, f.dataType) for f in columns]
    if spark.catalog.tableExists(table) and [
            (f.name, f.dataType) for f in spark.table(table).schema] == described:
        if clustering_columns(spark, table) != list(keys):
            spark.sql(f"ALTER TABLE {table} CLUSTER BY ({', '.join(keys)})")
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(path)}")
    else:
        clause = f"COMMENT {quoted(comment)}" if comment else ""
        spark.sql(f"DROP TABLE IF EXISTS {staged_name(table)}")
        spark.sql(
            f"CREATE TABLE {staged_name(table)} ({columns.toDDL()}) USING parquet "
            f"CLUSTER BY ({', '.join(keys)}) {clause} LOCATION {quoted(path)}"
        )
        swap_in(spark, table)
    spark.catalog.refreshTable(table)


def within(df: DataFrame, partitions: DataFrame) -> DataFrame:
    """Rows of the given partitions, a row each.

    The keys are broadcast, as one struct each, and prune the scan at run time: no other partition
    is read, not even one that shares each single key with some of them, and no list of keys
    passes through the plan.  Null keys compare as equal inside a struct.  The count is what tells
    the optimiser that the keys select; without a condition on them it does not prune.
    """
    keys = partitions.columns
    some = partitions.groupBy(F.struct(*keys).alias("__partition")).agg(
        F.count("*").alias("__rows")).where("__rows > 0")
    return df.join(F.broadcast(some), F.struct(*[df[key] for key in keys]) == F.col("__partition"),
                   "left_semi")


def overwriting_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings in which an overwrite replaces only what it writes to."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return own


def compact_partitions(spark: SparkSession, table: str, partition_by: Sequence[str],
                       sort_by: Sequence[str] = (), only: DataFrame | None = None,
                       most_files: int = 4, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Merge the small files of the directories that hold more than ``most_files`` of them.

    A file is small if it has less than half of the rows a file should have; ``only`` names the
    directories to look at, such as those a batch touched.  They are written anew from a copy in
    scratch, each into as few files as its rows fill; others keep their files.  Returns how many
    directories were merged.
    """
    stored = spark.table(table)
    if only is not None:
        stored = within(stored, only.select(*partition_by).distinct())
    per_file = stored.groupBy(*partition_by, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"))
    small = F.count_if(F.col("n") * 2 < rows_per_file)
    crowded = materialise(per_file.groupBy(*partition_by).agg(
        small.alias("small"), F.sum("n").alias("__rows")).where(F.col("small") > most_files),
        "crowded")
    count = crowded.count()
    if count:
        path = scratch_folder(spark, "compact")
        within(spark.table(table), crowded.select(*partition_by)).write.parquet(path)
        rows = overwriting_session(spark).read.schema(spark.table(table).schema).parquet(path)
        by_partition(rows, partition_by, sort_by, rows_per_file,
                     crowded.select(*partition_by, "__rows")).select(
            spark.table(table).columns).write.mode("overwrite").insertInto(table)
        spark.catalog.refreshTable(table)
    return count
