"""Profiles of a table: partition sizes, skew, high-water mark, columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THIN_PARTITION_ROWS = 50


def partition_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def partition_profile(df: DataFrame, keys: Sequence[str], expected: int | None = None,
                      thin: int = THIN_PARTITION_ROWS) -> DataFrame:
    """One row: partitions found (and expected), total, average, smallest, largest, thin flag.

    Only partitions that hold rows can be found, hence the expected number beside it.
    """
    sizes = partition_sizes(df, keys)
    profile = sizes.agg(
        F.count("*").alias("partitions"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.avg("rows").cast("int").alias("avg_rows_per_partition"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
    ).withColumn("thin", F.coalesce(F.col("avg_rows_per_partition") < thin, F.lit(False)))
    if expected is not None:
        profile = profile.withColumn("expected_partitions", F.lit(expected).cast("bigint"))
    return profile


def skew_profile(df: DataFrame, keys: Sequence[str], k: int = 10,
                 count_name: str = "rows") -> DataFrame:
    """The k largest groups and their share of all rows in percent, ties broken by key.

    The total comes from the same grouped counts (one scan, the exchange is reused), and
    groups are compared as counts: no window over the whole table.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias(count_name))
    total = counts.agg(F.sum(count_name)).scalar()
    share = F.round(F.expr("100.0") * F.col(count_name) / total, 2).cast("double")
    return (
        counts.withColumn("pct_of_total", share)
        .orderBy(F.desc(count_name), *keys)
        .limit(k)
    )


def watermark_profile(df: DataFrame, column: str) -> DataFrame:
    """One row: earliest and latest value, and the number of distinct days."""
    days = (
        df.groupBy(F.to_date(column).alias("day"))
        .agg(F.min(column).alias("low"), F.max(column).alias("high"))
    )
    return days.agg(
        F.min("low").alias("earliest"),
        F.max("high").alias("latest"),
        F.count("day").alias("distinct_days"),
    )


def column_stats(df: DataFrame, columns: Sequence[str] | None = None,
                 distinct: str = "approx") -> DataFrame:
    """One row per column: rows, nulls, distinct values, smallest and largest as text.

    ``approx`` estimates distinct values like the optimiser's own statistics do: one pass,
    nothing shuffled but the sketches.  ``exact`` counts them, in one scan as well, whose rows
    are grouped by the values of each column where they lie before these are shuffled.
    """
    columns = list(columns or df.columns)
    if distinct not in ("approx", "exact"):
        raise ValueError(f"unknown distinct mode {distinct!r}")
    count = F.count_distinct if distinct == "exact" else F.approx_count_distinct
    measures = [F.count("*").alias("rows")]
    for c in columns:
        measures += [
            F.count_if(F.col(c).isNull()).alias(f"{c}.nulls"),
            count(F.col(c)).alias(f"{c}.distinct"),
            F.min(c).cast("string").alias(f"{c}.min"),
            F.max(c).cast("string").alias(f"{c}.max"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows"),
            F.col(f"`{c}.nulls`").alias("nulls"),
            F.col(f"`{c}.distinct`").alias("distinct_values"),
            F.col(f"`{c}.min`").alias("min_value"),
            F.col(f"`{c}.max`").alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(*measures).select(F.inline(F.array(*entries)))
