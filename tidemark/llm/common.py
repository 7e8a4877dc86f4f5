"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import functools
import pickle
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(key: str = "doc_id") -> Column:
    """Rows that no label or model is learned from; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


PORTION = 1000  # rows that a task works on at a time


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """An object kept in each Python worker, such as a loaded vocabulary.

    Workers outlive the stages of a job; a task that asks for another object ends the one that an
    earlier operator left.
    """
    name = "_tidemark_llm_worker"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("made", {})
    if key not in store:
        if TaskContext.get() is not None:
            store.clear()
            give_back()
        store[key] = make()
    return store[key]


def give_back() -> None:
    """Return memory that the process has freed but still holds to the system, where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def in_portions(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a task, given its rows a portion at a time, since a batch of whole texts
    may take tens of MB in each form they pass through; memory goes back when the task ends."""
    def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PORTION):
                yield batch.slice(at, PORTION)

    @functools.wraps(run)
    def portioned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(portions(batches))
        give_back()

    return portioned


def share(sampled: int, rows: int) -> float:
    """The share of hash values that keeps about ``sampled`` of ``rows`` rows."""
    return 1.0 if rows <= sampled else sampled / rows


def hash_below(fraction: float, *columns: str, seed: int = 7) -> Column:
    """True for about ``fraction`` of all rows, however small, the same ones on every run."""
    bound = int(fraction * 2 ** 64) - 2 ** 63
    return F.lit(True) if bound >= 2 ** 63 else F.xxhash64(F.lit(seed), *columns) < F.lit(bound)


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """The rows of a frame and their place in an order, from 0 without gaps.

    Rows are dealt into sorted ranges, written, and numbered by their place in the range and
    the rows of the ranges before; of those one row for each task meets in one task.  The
    ranges are found by a sample, so a costly ``df`` is better materialised.
    """
    placed = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id()), label)
    part = F.shiftright("__place", 33)
    ranges = placed.groupBy(part.alias("__part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("__place").alias("__first"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("__part", "__first", F.coalesce(
        F.sum("rows").over(before), F.lit(0)).alias("__before"))
    return (placed.withColumn("__part", part).join(F.broadcast(ranges), "__part")
            .withColumn(name, F.col("__before") + F.col("__place") - F.col("__first"))
            .drop("__part", "__place", "__first", "__before"))


def shared(spark: SparkSession, made: Any) -> Callable[[], Any]:
    """Broadcast an object of bounded size, by value; the function returns it in a task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(made))
    return lambda: pickle.loads(sent.value)


def add_columns(df: DataFrame, column: str, added: list[tuple[str, str, pa.DataType]],
                start: Callable[[], Callable[[list], tuple[list, ...]]],
                replaced: bool = False) -> DataFrame:
    """All columns of a frame and others computed from one of them.

    ``added`` has a name, a Spark type and an Arrow type for each new column; they replace
    columns of those names.  ``start`` runs once in a task and returns the function of a
    batch; with ``replaced`` the first column it gives takes the place of the given one.
    Columns are addressed by place, so names may hold anything or occur twice.
    """
    names = [name for name, _, _ in added]
    where = [i for i, c in enumerate(df.columns) if c not in names or c == column]
    at = where.index(df.columns.index(column))
    kept = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(*[f"c{i}" for i in where])
    schema = T.StructType([*kept.schema.fields, *(
        T.StructField(f"a{i}", T.StructType.fromDDL(f"a {kind}")["a"].dataType)
        for i, (_, kind, _) in enumerate(added))])
    types, labels = [kind for _, _, kind in added], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            columns, made = list(batch.columns), list(work(batch.column(at).to_pylist()))
            if replaced:
                columns[at] = pa.array(made.pop(0), columns[at].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, *map(pa.array, made, types)], names=labels)

    return kept.mapInArrow(in_portions(run), schema).toDF(*[df.columns[i] for i in where], *names)
