"""Data checks.  Each returns the offending groups (no rows: passed) or one report row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its label and its number of rows."""
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
               for name, df in tables.items()]
    return reduce(DataFrame.union, counted)


def duplicate_keys(df: DataFrame, keys: Sequence[str], ignore_null: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count.

    ``ignore_null`` follows the column test ``unique``: rows without a key do not count.
    """
    if ignore_null:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def not_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls; a single pass without a shuffle of rows."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    return counted.select(F.inline(F.array(*entries)))


def orphans(child: DataFrame, parent: DataFrame, key: str,
            parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent and how many rows carry them; null is an orphan too.

    Rows are counted per key before the join, so a hot key reaches it as a single row.
    """
    counted = child.groupBy(key).agg(F.count("*").alias("orphaned_rows"))
    parents = parent.select(F.col(parent_key or key).alias(key))
    return counted.join(parents, key, "left_anti")


def relationships(child: DataFrame, parent: DataFrame, key: str,
                  parent_key: str | None = None) -> DataFrame:
    """Non-null child keys without a parent and how many rows carry them."""
    return orphans(child.filter(F.col(key).isNotNull()), parent, key, parent_key)


def reconcile(source: DataFrame, output: DataFrame, key: str,
              not_null: Sequence[str] = ()) -> DataFrame:
    """One row that compares two tables by row count and by key.

    Equal counts alone do not prove a clean join: one dropped and one doubled row cancel.
    Both sides are reduced to one row per key before they meet, in one shuffle.
    ``not_null`` counts the output's nulls in the same pass.
    """
    nulls = reduce(lambda total, c: total + F.col(c).isNull().cast("bigint"), not_null,
                   F.lit(0).cast("bigint"))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = source.select(key, one.alias("s"), none.alias("o"), none.alias("nulls")).union(
        output.select(key, none, one, nulls))
    per_key = sides.groupBy(key).agg(
        F.sum("s").alias("s"), F.sum("o").alias("o"), F.sum("nulls").alias("nulls"))
    total = per_key.agg(
        F.sum("s").alias("source_rows"),
        F.sum("o").alias("output_rows"),
        F.count_if((F.col("s") > 0) & (F.col("o") == 0)).alias("missing_keys"),
        F.count_if((F.col("s") == 0) & (F.col("o") > 0)).alias("extra_keys"),
        F.count_if((F.col("s") > 1) & F.col(key).isNotNull()).alias("duplicate_source_keys"),
        F.count_if((F.col("o") > 1) & F.col(key).isNotNull()).alias("duplicate_output_keys"),
        F.sum(F.when(F.col(key).isNull(), F.col("s"))).alias("null_source_keys"),
        F.sum("nulls").alias("output_nulls"),
    )
    return total.fillna(0)


def leaf_digests(df: DataFrame, key: str, low: int, width: int, columns: Sequence[str] = (),
                 ) -> DataFrame:
    """Rows of each key range with a digest that does not depend on their order.

    The digest covers the key and ``columns``.  Ranges are counted from ``low`` and ``width`` keys
    wide, null keys on their own; sums combine where the rows lie, so a row for each range and task
    is shuffled and no key is.
    """
    hashed = F.xxhash64(key, *columns)
    leaf = F.coalesce(F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(-1)).alias("leaf")
    return df.groupBy(leaf).agg(
        F.count("*").alias("rows"), F.sum(hashed.cast("decimal(38,0)")).alias("total"),
        F.bit_xor(hashed).alias("mixed"))


def locate_differences(source: DataFrame, output: DataFrame, key: str,
                       columns: Sequence[str] = (), leaves: int = 4096) -> DataFrame:
    """Keys whose rows differ between two tables: ``key``, ``source_rows``, ``output_rows``.

    The key is a whole number.  Its span is cut into ``leaves`` ranges, whose digests are compared;
    equal tables are done with that, in one scan each that shuffles no key.  Only of ranges that
    differ the rows are read again, bounded by the smallest and largest of them so that the scan
    skips the rest, and compared key by key.  A key with as many rows on both sides is listed if
    its ``columns`` differ.
    """
    span = [df.agg(F.min(key).alias("low"), F.max(key).alias("high")) for df in (source, output)]
    low, high = span[0].union(span[1]).agg(
        F.coalesce(F.min("low"), F.lit(0)), F.coalesce(F.max("high"), F.lit(0))).first()
    width = max(1, -(-(high - low + 1) // leaves))
    one, two = (leaf_digests(df, key, low, width, columns) for df in (source, output))
    sides = one.withColumn("side", F.lit(1)).union(two.withColumn("side", F.lit(2)))
    # At most two rows of a leaf, so equality of all is that of the smallest and largest.
    odd = sides.groupBy("leaf").agg(
        F.count("*").alias("sides"), *[(F.min(c) == F.max(c)).alias(c) for c in (
            "rows", "total", "mixed")]).where(
        (F.col("sides") < 2) | ~(F.col("rows") & F.col("total") & F.col("mixed")))
    odd = materialise(odd.select("leaf"), "leaves")
    first, last, null = odd.agg(
        F.min(F.when(F.col("leaf") >= 0, F.col("leaf"))), F.max("leaf"),
        F.coalesce(F.bool_or(F.col("leaf") < 0), F.lit(False))).first()

    def rows(df: DataFrame, own: int) -> DataFrame:
        bounds = F.lit(False) if first is None else F.col(key).between(
            low + first * width, low + (last + 1) * width - 1)
        some = df.where(bounds | F.col(key).isNull() if null else bounds)
        leaf = F.coalesce(F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(-1))
        found = some.withColumn("__leaf", leaf).join(
            F.broadcast(odd.withColumnRenamed("leaf", "__leaf")), "__leaf", "left_semi")
        hashed = F.xxhash64(F.lit(0), *columns)
        return found.select(key, hashed.alias("h"), F.lit(own).alias("s"), F.lit(1 - own).alias("o"))

    balance = F.sum(F.col("h").cast("decimal(38,0)") * (F.col("s") - F.col("o"))).alias("balance")
    per_key = rows(source, 1).union(rows(output, 0)).groupBy(key).agg(
        F.sum("s").alias("source_rows"), F.sum("o").alias("output_rows"), balance,
        F.bit_xor("h").alias("odd"))
    same = (F.col("source_rows") == F.col("output_rows")) & (F.col("balance") == 0) & (
        F.col("odd") == 0)
    return per_key.where(~same).select(key, "source_rows", "output_rows")
