"""All checks on the source tables and the read table, as one report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import GenerationConfig, OutputSpec
from tidemark.functions import expected_hot_share
from tidemark.operators.checks import reconcile
from tidemark.operators.profiles import THIN_PARTITION_ROWS, watermark_profile
from tidemark.sources.layout import clustering_columns, partition_columns
from tidemark.sources.tables import EMPLOYEE


@dataclass(frozen=True)
class Expectations:
    """What the report holds the tables against; ``None`` leaves a check out."""

    fact_rows: int | None = None
    dimension_rows: int | None = None
    partitions: int | None = None
    rows_per_partition: int | None = THIN_PARTITION_ROWS
    hot_keys: int = 3
    hot_percent: tuple[float, float] | None = None
    distinct_days: tuple[int, int] | None = None

    @classmethod
    def of(cls, config: GenerationConfig, tolerance: float = 2.0,
           landed: int = 0) -> Expectations:
        """What freshly generated tables should show, or those with ``landed`` rows added.

        The hot share follows from the draw (38.75% with 24 departments, not the 30% that
        go to the hot keys only); landed rows are spread evenly, so they are weighed in with
        an even share.  The days number one more when a row falls on the anchor itself.
        """
        skewed = expected_hot_share(config.departments, config.hot_keys, config.hot_percent)
        even = min(config.hot_keys, config.departments) / config.departments
        share = 100.0 * (config.employees * skewed + landed * even) / (config.employees + landed)
        return cls(
            fact_rows=config.employees + landed,
            dimension_rows=config.departments,
            partitions=config.departments * config.buckets,
            hot_keys=config.hot_keys,
            hot_percent=(share - tolerance, share + tolerance),
            # a batch adds the anchor's day, and part of the next one
            distinct_days=(config.history_days, config.history_days + (2 if landed else 1)),
        )


def _report(measured: DataFrame, checks: Sequence[tuple[str, str, Column, Column]]) -> DataFrame:
    """Turn one row of measures into one row per check."""
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            F.lit(expected).alias("expected"),
            actual.cast("string").alias("actual"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for name, expected, actual, passed in checks
    ]
    return measured.select(F.inline(F.array(*entries)))


def _equals(name: str, column: str, expected: int) -> tuple[str, str, Column, Column]:
    return name, str(expected), F.col(column), F.col(column) == expected


def _dimension_report(dimension: DataFrame, spec: OutputSpec, expected: Expectations) -> DataFrame:
    key = F.col(spec.join_key)
    per_key = dimension.groupBy(spec.join_key).agg(F.count("*").alias("n"))
    measured = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if((F.col("n") > 1) & key.isNotNull()).alias("duplicates"),
        F.coalesce(F.sum(F.when(key.isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
    )
    checks = [
        _equals("dimension_key_unique", "duplicates", 0),
        _equals("dimension_key_not_null", "nulls", 0),
    ]
    if expected.dimension_rows is not None:
        checks.insert(0, _equals("dimension_rows", "rows", expected.dimension_rows))
    return _report(measured, checks)


def _fact_report(fact: DataFrame, dimension: DataFrame, spec: OutputSpec,
                 partition_by: Sequence[str], expected: Expectations) -> DataFrame:
    """Counts, partitions, skew and orphans out of one scan.

    The scan is reduced to one row per (partition, join key) first; everything else works
    on those few rows.
    """
    groups = fact.groupBy(*partition_by, spec.join_key).agg(
        F.count("*").alias("n"), F.count_if(F.col(spec.watermark).isNull()).alias("unmarked"))
    known = dimension.select(spec.join_key, F.lit(True).alias("known")).distinct()
    per_partition = groups.join(known, spec.join_key, "left").groupBy(*partition_by).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col(spec.join_key).isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("orphans"),
        F.sum("unmarked").alias("unmarked"),
    )
    hot = F.when(F.col(partition_by[0]).between(1, expected.hot_keys), F.col("n")).otherwise(0)
    measured = per_partition.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("partitions"),
        F.avg("n").cast("bigint").alias("per_partition"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum("unmarked"), F.lit(0)).alias("unmarked"),
        F.round(F.expr("100.0") * F.sum(hot) / F.sum("n"), 2).alias("hot"),
    )
    checks = [
        _equals("fact_join_key_not_null", "nulls", 0),
        _equals("fact_orphan_rows", "orphans", 0),
        _equals("fact_watermark_not_null", "unmarked", 0),  # a refresh never sees such a row
    ]
    if expected.fact_rows is not None:
        checks.append(_equals("fact_rows", "rows", expected.fact_rows))
    if expected.partitions is not None:
        checks.append(_equals("fact_partitions", "partitions", expected.partitions))
    if expected.rows_per_partition is not None:
        checks.append((
            "fact_rows_per_partition", f">= {expected.rows_per_partition}",
            F.col("per_partition"), F.col("per_partition") >= expected.rows_per_partition))
    if expected.hot_percent is not None:
        low, high = expected.hot_percent
        checks.append((
            "fact_hot_share_pct", f"{low:.2f}..{high:.2f}", F.col("hot"),
            F.col("hot").cast("double").between(low, high)))
    return _report(measured, checks)


def _key_report(fact: DataFrame, output: DataFrame | None, spec: OutputSpec,
                not_null: Sequence[str]) -> DataFrame:
    """Key checks of both tables in one shuffle."""
    if output is None:
        key = F.col(spec.key)
        measured = fact.groupBy(key).agg(F.count("*").alias("n")).agg(
            F.count_if((F.col("n") > 1) & key.isNotNull()).alias("duplicate_source_keys"),
            F.coalesce(F.sum(F.when(key.isNull(), F.col("n"))), F.lit(0)).alias("null_source_keys"),
        )
    else:
        measured = reconcile(fact, output, spec.key, not_null)
    checks = [
        _equals("fact_key_unique", "duplicate_source_keys", 0),
        _equals("fact_key_not_null", "null_source_keys", 0),
    ]
    if output is not None:
        checks += [
            ("output_rows_equal_fact_rows", "equal", F.concat_ws(
                "/", F.col("output_rows").cast("string"), F.col("source_rows").cast("string")),
             F.col("output_rows") == F.col("source_rows")),
            _equals("output_missing_keys", "missing_keys", 0),
            _equals("output_extra_keys", "extra_keys", 0),
            _equals("output_key_unique", "duplicate_output_keys", 0),
            _equals("output_not_null", "output_nulls", 0),
        ]
    return _report(measured, checks)


def _spread_report(fact: DataFrame, spec: OutputSpec, expected: Expectations) -> DataFrame:
    low, high = expected.distinct_days
    return _report(watermark_profile(fact, spec.watermark), [
        ("fact_distinct_days", f"{low}..{high}", F.col("distinct_days"),
         F.col("distinct_days").between(low, high))])


def verify(fact: DataFrame, dimension: DataFrame, output: DataFrame | None = None,
           spec: OutputSpec = OutputSpec(), expected: Expectations = Expectations(),
           partition_by: Sequence[str] = EMPLOYEE.partition_by) -> DataFrame:
    """One row per check: its name, the expected and actual value, and whether it passed."""
    not_null = [spec.key, spec.join_key, *spec.dim_columns]
    parts = [
        _dimension_report(dimension, spec, expected),
        _fact_report(fact, dimension, spec, partition_by, expected),
        _key_report(fact, output, spec, not_null),
    ]
    if expected.distinct_days is not None:
        parts.append(_spread_report(fact, spec, expected))
    return reduce(DataFrame.union, parts)


def verify_layout(spark: SparkSession, fact_table: str, dimension_table: str,
                  output_table: str | None = None, spec: OutputSpec = OutputSpec()) -> DataFrame:
    """The layout premise: sources are not partitioned by the join key, the output is
    clustered by its read key and not partitioned at all."""
    def text(columns: Sequence[str]) -> str:
        return ",".join(columns) or "none"

    rows = []
    for label, table in (("fact", fact_table), ("dimension", dimension_table)):
        keys = partition_columns(spark, table)
        rows.append((f"{label}_not_partitioned_by_join_key", f"without {spec.join_key}",
                     text(keys), bool(keys) and spec.join_key not in keys))
    if output_table is not None:
        keys = partition_columns(spark, output_table)
        clustered = clustering_columns(spark, output_table)
        rows.append(("output_not_partitioned", "none", text(keys), not keys))
        rows.append(("output_clustered", text(spec.cluster_by), text(clustered),
                     list(spec.cluster_by) == clustered))
    return spark.createDataFrame(rows, "check string, expected string, actual string, passed boolean")
