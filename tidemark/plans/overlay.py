"""Refresh a large read table at the cost of what changed.

``run_build`` writes a whole new version, which is right but costs a full write however
little changed.  Here the clustered base stays as it is; current versions of changed rows
are kept in a small table of their own, and readers use a view that prefers them.  The
changes are folded into a new base before their keys outgrow a broadcast.

Changed rows replace base rows by key, so it does not matter if the base already contains
them: at every step the view shows each key once.  Between the two steps of a fold it may
still show a row as it was before the refresh.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import OutputSpec, WatermarkPolicy
from tidemark.operators.joins import BROADCAST_LIMIT, filtering_join, measure_side
from tidemark.operators.merge import upsert
from tidemark.operators.watermark import high_water_mark
from tidemark.plans.output import (
    build_output, changed_rows, new_version, run_build,
)
from tidemark.sources.scratch import materialise
from tidemark.sources.writers import publish_clustered, write_clustered


@dataclass(frozen=True)
class OverlayResult:
    view: str
    mode: str  # "full", "changes" or "compacted"
    changed_rows: int


def _base(view: str) -> str:
    return f"{view}_base"


def _changes(view: str) -> str:
    return f"{view}_changes"


def _define_view(spark: SparkSession, view: str, spec: OutputSpec) -> None:
    columns = ", ".join(spec.columns)
    spark.sql(f"""
        CREATE OR REPLACE VIEW {view} AS
        SELECT /*+ BROADCAST(c) */ {', '.join('b.' + c for c in spec.columns)}
        FROM {_base(view)} b LEFT ANTI JOIN {_changes(view)} c ON b.{spec.key} = c.{spec.key}
        UNION ALL
        SELECT {columns} FROM {_changes(view)}""")


def _write(df: DataFrame, table: str, root: str, spec: OutputSpec,
           files: int | None = None) -> None:
    path = new_version(table, root)
    write_clustered(df.select(*spec.columns), path, spec.cluster_by, [spec.key], files)
    publish_clustered(df.sparkSession, table, path, spec.cluster_by)


def _clear_changes(spark: SparkSession, view: str, root: str, spec: OutputSpec) -> None:
    none = spark.table(_base(view)).select(*spec.columns).limit(0)
    path = new_version(_changes(view), root)
    none.coalesce(1).write.parquet(path)
    publish_clustered(spark, _changes(view), path, spec.cluster_by)


def _fold(spark: SparkSession, view: str, changes: DataFrame, root: str, spec: OutputSpec,
          files: int | None = None) -> None:
    base = spark.table(_base(view)).select(*spec.columns)
    _write(upsert(base, changes, spec.key), _base(view), root, spec, files)
    _clear_changes(spark, view, root, spec)


def compact_overlay(spark: SparkSession, view: str, root: str,
                    spec: OutputSpec = OutputSpec(), files: int | None = None) -> None:
    """Fold the changes into a new clustered base."""
    _fold(spark, view, spark.table(_changes(view)).select(*spec.columns), root, spec, files)


def refresh_overlay(spark: SparkSession, view: str, fact: DataFrame, dimension: DataFrame,
                    root: str, spec: OutputSpec = OutputSpec(),
                    policy: WatermarkPolicy = WatermarkPolicy(),
                    retry: DataFrame | None = None,
                    broadcast_limit: int = BROADCAST_LIMIT) -> OverlayResult:
    """Bring the view up to date; the first run builds the base."""
    if not spark.catalog.tableExists(_base(view)):
        run_build(spark, _base(view), fact, dimension, root, spec)
        _clear_changes(spark, view, root, spec)
        _define_view(spark, view, spec)
        return OverlayResult(view, "full", 0)
    # Changes were taken from beyond the base's mark, so theirs is the later one and the base
    # is read for it only while there are none.  (Were it the lower one, because all changes
    # are retried rows, some rows would be merged a second time, to the same result.)
    mark = (high_water_mark(spark.table(_changes(view)), spec.watermark)
            or high_water_mark(spark.table(_base(view)), spec.watermark))
    if mark is None:  # the base is empty
        run_build(spark, _base(view), fact, dimension, root, spec, full=True)
        return OverlayResult(view, "full", 0)
    changed = changed_rows(fact, mark, spec, policy, retry)
    built = materialise(build_output(changed, dimension, spec), "built")
    arrived = built.count()
    changes = spark.table(_changes(view)).select(*spec.columns)
    lost = filtering_join(changed, built, spec.key, "left_anti").select(spec.key)
    if not lost.isEmpty() and not filtering_join(
            spark.table(view).select(spec.key), lost, spec.key, "left_semi").isEmpty():
        # A view of kept and changed rows cannot take one out of the base, so the base is
        # written anew without the rows that no longer join.
        base = spark.table(_base(view)).select(*spec.columns)
        merged = upsert(base, changes, spec.key)
        _write(upsert(merged, built, spec.key, changed=changed), _base(view), root, spec)
        _clear_changes(spark, view, root, spec)
        return OverlayResult(view, "compacted", arrived)
    if arrived == 0:
        return OverlayResult(view, "changes", 0)
    current = upsert(changes, built, spec.key)
    # the view broadcasts the keys of all changes it keeps, so they have to stay small
    if measure_side(current.select(spec.key), [spec.key]).bytes > broadcast_limit:
        _fold(spark, view, current, root, spec)
        return OverlayResult(view, "compacted", arrived)
    _write(current, _changes(view), root, spec)
    return OverlayResult(view, "changes", arrived)
