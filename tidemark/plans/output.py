"""Build the denormalised read table, in full or by what changed, and publish it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import OutputSpec, WatermarkPolicy
from tidemark.operators.checks import reconcile
from tidemark.operators.joins import (
    BROADCAST_LIMIT, filtering_join, many_to_one_join, unmatched_rows,
)
from tidemark.operators.merge import one_per_key, upsert
from tidemark.operators.watermark import Watermark, high_water_mark, is_newer
from tidemark.sources.scratch import materialise
from tidemark.sources.writers import publish_clustered, write_clustered


class OutputCheckError(RuntimeError):
    """A freshly built version is not what its sources say it should be."""


def build_output(fact: DataFrame, dimension: DataFrame, spec: OutputSpec = OutputSpec(),
                 broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Fact columns, then the columns of the one matching dimension row."""
    joined = many_to_one_join(
        fact.select(*spec.fact_columns), dimension.select(spec.join_key, *spec.dim_columns),
        spec.join_key, "inner", broadcast_limit)
    return joined.select(*spec.columns)


def changed_rows(fact: DataFrame, mark: Watermark, spec: OutputSpec = OutputSpec(),
                 policy: WatermarkPolicy = WatermarkPolicy(),
                 retry: DataFrame | None = None) -> DataFrame:
    """Fact rows beyond the high-water mark, filtered before any join; the latest per key.

    ``retry`` holds keys that failed to join earlier (the quarantine): they are read again
    although the mark has passed them.  The rows are written to scratch once, so the size
    checks, the join and the merge that follow read them there and not in the fact.
    """
    rows = fact.select(*spec.fact_columns)
    newer = is_newer(spec.watermark, mark, policy)
    changed = rows.filter(newer)
    if retry is not None:
        older = rows.filter(~F.coalesce(newer, F.lit(False)))
        changed = changed.unionByName(filtering_join(older, retry, spec.key, "left_semi"))
    return materialise(one_per_key(changed, spec.key, [spec.watermark]), "changed")


def refresh_output(fact: DataFrame, dimension: DataFrame, previous: DataFrame | None,
                   spec: OutputSpec = OutputSpec(),
                   policy: WatermarkPolicy = WatermarkPolicy(),
                   retry: DataFrame | None = None, restate: bool = False) -> DataFrame:
    """The read table after a refresh.

    Without a previous output, or with an empty one, this is the full build.  Otherwise
    only fact rows beyond the mark are joined, and replace or join the previous rows by
    key; a row whose new version finds no dimension row leaves the output.  ``restate`` also renews the dimension columns of all other rows; changes of the
    dimension alone carry no mark and would go unnoticed.
    """
    mark = None if previous is None else high_water_mark(previous, spec.watermark)
    if mark is None:
        return build_output(fact, dimension, spec)
    changed = changed_rows(fact, mark, spec, policy, retry)
    if restate:
        merged = upsert(previous.select(*spec.fact_columns), changed, spec.key)
        return build_output(merged, dimension, spec)
    return upsert(previous, build_output(changed, dimension, spec), spec.key, changed=changed)


def quarantine(fact: DataFrame, dimension: DataFrame, spec: OutputSpec = OutputSpec()) -> DataFrame:
    """Fact rows the build drops because their join key has no dimension row."""
    return unmatched_rows(fact.select(*spec.fact_columns), dimension, spec.join_key)


def new_version(table: str, root: str) -> str:
    return f"{root.rstrip('/')}/{table.replace('.', '_')}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class BuildResult:
    table: str
    path: str
    mode: str


def check_output(fact: DataFrame, dimension: DataFrame, built: DataFrame,
                 spec: OutputSpec = OutputSpec(), level: str = "keys") -> None:
    """Raise unless the output holds the fact rows that have a dimension row.

    ``keys`` compares key by key, which shuffles the keys of both tables; ``counts``
    compares the numbers of rows only and shuffles nothing, but misses a lost row that a
    doubled one makes up for.
    """
    joinable = filtering_join(
        fact.select(spec.key, spec.join_key), dimension, spec.join_key, "left_semi")
    if level == "counts":
        expected, found, faults = joinable.count(), built.count(), {}
    elif level == "keys":
        row = reconcile(joinable, built, spec.key, [spec.key, spec.join_key]).first().asDict()
        expected, found = row["source_rows"], row["output_rows"]
        faults = {name: row[name] for name in (
            "missing_keys", "extra_keys", "duplicate_output_keys", "output_nulls") if row[name]}
    else:
        raise ValueError(f"unknown check level {level!r}")
    if expected != found or faults:
        raise OutputCheckError(f"{found} rows built from {expected}: {faults}")


def run_build(spark: SparkSession, table: str, fact: DataFrame, dimension: DataFrame,
              root: str, spec: OutputSpec = OutputSpec(), full: bool = False,
              policy: WatermarkPolicy = WatermarkPolicy(), retry: DataFrame | None = None,
              restate: bool = False, files: int | None = None,
              check: str | None = "keys") -> BuildResult:
    """Build a new version below ``root``, check it, then point the table at it.

    The first run, and ``full``, load everything; later runs take what changed.  Until the
    check (``"keys"``, ``"counts"`` or ``None``) has passed, readers keep the previous
    version.
    """
    exists = spark.catalog.tableExists(table)
    previous = spark.table(table) if exists and not full else None
    result = refresh_output(fact, dimension, previous, spec, policy, retry, restate)
    path = new_version(table, root)
    write_clustered(result, path, spec.cluster_by, [spec.key], files)
    if check:
        check_output(fact, dimension, spark.read.parquet(path), spec, check)
    publish_clustered(spark, table, path, spec.cluster_by)
    return BuildResult(table, path, "full" if previous is None else "incremental")
