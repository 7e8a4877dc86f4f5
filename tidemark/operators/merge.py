"""Matching a batch of changes to a table by key.

Parquet has no row-level update, so each operator describes the merged table as a frame;
the caller writes it to a new place (``plans.output``) or, for a partitioned table, has
only the touched partitions rewritten (``move_partitions``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import (
    BROADCAST_LIMIT, FanOutError, many_to_one_join, measure_side, sized_join,
)
from tidemark.sources.scratch import materialise
from tidemark.sources.writers import by_partition, overwriting_session, quoted, within


def latest_per_key(batch: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``order_by``, ties settled by the remaining columns.

    An aggregate rather than a ranking window, so the copies of a hot key are reduced
    where they lie, before the shuffle.
    """
    rest = [c for c in batch.columns if c != key and c not in order_by]
    best = F.max(F.struct(*order_by, *rest)).alias("best")
    return batch.groupBy(key).agg(best).select(key, "best.*").select(batch.columns)


def one_per_key(batch: DataFrame, key: str, order_by: Sequence[str],
                on_duplicate: str = "latest") -> DataFrame:
    """Make a batch unambiguous: keep the latest row of a key, or refuse duplicates."""
    if on_duplicate == "latest":
        return latest_per_key(batch, key, order_by)
    if on_duplicate != "raise":
        raise ValueError(f"unknown duplicate mode {on_duplicate!r}")
    size = measure_side(batch, [key])
    if not size.unique:
        raise FanOutError(f"a batch with {size.rows_of_largest_key} rows for one {key!r}")
    return batch


def upsert(target: DataFrame, batch: DataFrame, key: str,
           broadcast_limit: int = BROADCAST_LIMIT, changed: DataFrame | None = None) -> DataFrame:
    """Target rows whose key is not in the batch, then the batch itself.

    ``batch`` must hold one row per key (``one_per_key``).  Only its keys meet the target;
    while they fit, the target is neither shuffled nor sorted.  ``changed`` names all keys
    whose target rows go, if those are more than the batch's own: a changed row that no
    longer belongs to the target leaves it.
    """
    keys = (batch if changed is None else changed).select(key)
    size = measure_side(keys, [key])
    if not size.unique:
        raise FanOutError(f"a batch with {size.rows_of_largest_key} rows for one {key!r}")
    kept = sized_join(target, keys, key, "left_anti", size.bytes <= broadcast_limit)
    return kept.select(target.columns).unionByName(batch.select(target.columns))


def append_only(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The naive alternative: a changed row ends up beside its old version."""
    return target.unionByName(batch.select(target.columns))


def partial_update(target: DataFrame, updates: DataFrame, key: str,
                   assign: Mapping[str, str],
                   broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Set ``{target column: update column}`` on matching rows.

    Other columns keep their value, update rows without a match are ignored, and a null
    in an update row is assigned like any value.
    """
    matched = "__matched"
    side = updates.select(
        key, F.lit(True).alias(matched),
        *[F.col(new).alias(f"__set_{old}") for old, new in assign.items()])
    joined = many_to_one_join(target, side, key, "left", broadcast_limit)
    return joined.select([
        F.when(F.col(matched), F.col(f"__set_{c}")).otherwise(F.col(c))
        .cast(target.schema[c].dataType).alias(c) if c in assign else F.col(c)
        for c in target.columns
    ])


def touched_partitions(target: DataFrame, updates: DataFrame, key: str,
                       assign: Mapping[str, str], partition_by: Sequence[str],
                       broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The partitions updated rows lie in before and after, as distinct key values.

    Reads only the key and the partition columns of the target.
    """
    columns = list(dict.fromkeys([key, *partition_by]))
    side = updates.select(
        key, *[F.col(new).alias(f"__set_{old}") for old, new in assign.items()
               if old in partition_by])
    hit = many_to_one_join(target.select(columns), side, key, "inner", broadcast_limit)
    before = F.struct(*partition_by)
    after = F.struct(*[
        F.col(f"__set_{c}").cast(target.schema[c].dataType).alias(c)
        if c in assign else F.col(c) for c in partition_by])
    return hit.select(F.explode(F.array(before, after)).alias("p")).select("p.*").distinct()


def held_partitions(updates: DataFrame, target: DataFrame, assign: Mapping[str, str],
                    held: Mapping[str, str]) -> DataFrame:
    """The same from the updates alone, whose ``held`` columns say where their rows lie now."""
    before = F.struct(*[F.col(now).alias(c) for c, now in held.items()])
    after = F.struct(*[F.col(assign.get(c, now)).cast(target.schema[c].dataType).alias(c)
                       for c, now in held.items()])
    return updates.select(F.explode(F.array(before, after)).alias("p")).select("p.*").distinct()


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[key].eqNullSafe(right[key]) for key in keys])


def _partition_spec(row: Row) -> str:
    values = {name: "NULL" if value is None else str(value) if isinstance(value, int)
              else quoted(str(value)) for name, value in row.asDict().items()}
    return ", ".join(f"`{name}` = {value}" for name, value in values.items())


def move_partitions(spark: SparkSession, table: str, updates: DataFrame, key: str,
                    assign: Mapping[str, str], partition_by: Sequence[str],
                    sort_by: Sequence[str] = (), held: Mapping[str, str] | None = None) -> int:
    """Partial update of a partitioned catalog table, rewriting only what it touches.

    A row whose partition key changes leaves one directory for another, so the partitions
    of both its old and its new key are rewritten; one that ends up empty receives no
    write and has to be dropped instead.  ``held`` names, for each partition column, the column
    of the updates that says where the row lies now; the table is then read in those partitions
    alone.  Without it the keys of the whole table are read to find them.

    New contents are staged beside the old ones and take their place when the job commits, after
    all has been read: a lost executor costs a task, not the table.  The emptied
    partitions go in one statement after the others are in place, so a failure in between leaves
    rows that can be seen twice, but none is lost.  Returns the number of partitions touched.
    """
    target = overwriting_session(spark).table(table)
    frozen = materialise(updates, "updates")
    touched = materialise(
        held_partitions(frozen, target, assign, held).select(*partition_by) if held
        else touched_partitions(target, frozen, key, assign, partition_by), "touched")
    count = touched.count()
    if not count:
        return 0
    moved = partial_update(within(target, touched), frozen, key, assign)
    counts = materialise(
        moved.groupBy(*partition_by).agg(F.count("*").alias("__rows")), "filled")
    by_partition(moved, partition_by, sort_by, counts=counts).select(target.columns).write.mode(
        "overwrite").insertInto(table)
    filled = counts.select(*partition_by)
    emptied = touched.join(filled, _same(touched, filled, partition_by), "left_anti").collect()
    if emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(
            f"PARTITION ({_partition_spec(row)})" for row in emptied))
    spark.catalog.refreshTable(table)
    return count
