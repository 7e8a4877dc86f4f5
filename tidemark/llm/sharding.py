"""Rendezvous hashing of stable record keys over weighted shards.

Each shard draws a number from a hash of the key and its own id, scaled by its weight; the
best draw takes the record.  A further shard can only win records for itself, and a shard
that goes gives up only its own.

A null key hashes like any other value and lands on one shard, as do the rows of a repeated
key.  A null text has size 1 and the checksum of the empty text.  Places on a shard are
gapless and ordered by key, size and checksum; equal rows take theirs in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise


def draw(key: Column, shard: int, weight: float) -> Column:
    """An exponential variate of rate ``weight``; the smallest of all shards wins."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; a tie goes to the smaller shard.  Shards of no weight take nothing."""
    draws = [F.struct(draw(key, s, w).alias("d"), F.lit(s).alias("s"))
             for s, w in enumerate(weights) if w > 0]
    if not draws:
        raise ValueError("no shard has a positive weight")
    return (F.least(*draws) if len(draws) > 1 else draws[0])["s"].cast("int")


def assign(df: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, checksum, shard and, if ``grown`` is given, the shard under those weights."""
    body = F.coalesce(F.col(text), F.lit(""))
    ident = F.col(key)
    return df.select(
        ident, (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        rendezvous(ident, weights).alias("shard"),
        (rendezvous(ident, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))


def with_slots(assigned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    Rows are dealt into ranges of (shard, key, ...), so neither a large shard nor a repeated
    key meets in one task.  A row's place is its place in the range, plus what the ranges
    before hold of its shard: one row for each range and shard it touches, hence no more rows
    than there are tasks and shards together.
    """
    order = ["shard", key, "size", "text_crc32", "row"]
    rows = materialise(assigned.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    placed = materialise(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "shard-places")
    part = F.shiftright("place", 33).alias("part")
    ranges = placed.groupBy("shard", part).agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    ranges = ranges.select("shard", "part", "first", F.coalesce(
        F.sum("rows").over(before), F.lit(0)).alias("before"))
    return (placed.withColumn("part", F.shiftright("place", 33))
            .join(F.broadcast(ranges), ["shard", "part"])
            .withColumn("slot", F.col("before") + F.col("place") - F.col("first"))
            .select(key, "size", "text_crc32", "shard", "slot", "grown_shard"))
