"""Reading tables, declaring them, and the two generated row sources."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGED = "__staged"  # behind the name of a table whose successor is being written


@dataclass(frozen=True)
class TableSpec:
    """A declared table: typed columns with comments, and what it is partitioned by."""

    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    comment: str = ""

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _column(name: str, data_type: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, data_type, True, {"comment": comment} if comment else None)


DEPARTMENT = TableSpec(
    T.StructType([
        _column("department_number", T.IntegerType(), "Directory of the row"),
        _column("department_name", T.StringType(), "Looked up by the read table; one row each"),
        _column("department_head", T.StringType()),
        _column("cost_center", T.StringType()),
        _column("division", T.StringType()),
    ]),
    partition_by=("department_number",),
    comment="Drawn departments, one row each",
)

EMPLOYEE = TableSpec(
    T.StructType([
        _column("employee_id", T.LongType(), "Identifies a row; changes are matched on it"),
        _column("employee_name", T.StringType()),
        _column("department_number", T.IntegerType(), "First directory level of the row"),
        _column("department_name", T.StringType(), "Looked up in the departments"),
        _column("location_code", T.StringType()),
        _column("salary_band", T.StringType()),
        _column("updated_at", T.TimestampNTZType(), "When the row last changed; refreshes read from its maximum on"),
        _column("employee_id_bucket", T.IntegerType(), "Second directory level, drawn from the id"),
    ]),
    partition_by=("department_number", "employee_id_bucket"),
    comment="Drawn employees; changes arrive in batches",
)


def read_table(spark: SparkSession, table: str, patience: float = 5.0) -> DataFrame:
    """A named catalog table, or a parquet folder when given a path.

    A table that is being replaced lacks its name for a moment; as long as its successor stands
    ready under the staged name, this is waited for.
    """
    if "/" in table:
        return spark.read.parquet(table)
    until = time.monotonic() + patience
    while True:
        try:
            return spark.table(table)
        except AnalysisException as error:
            if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND" or time.monotonic() > until or not (
                    spark.catalog.tableExists(f"{table}{STAGED}")
                    or spark.catalog.tableExists(table)):
                raise
            time.sleep(0.02)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Assign columns to the declared ones by position, cast to the declared types.

    With ANSI mode on (the default) a value that does not fit its column raises.
    """
    if len(df.columns) != len(spec.schema):
        raise ValueError(f"{len(df.columns)} columns for a table of {len(spec.schema)}")
    placed = df.toDF(*spec.columns)
    return placed.select([
        F.col(field.name).cast(field.dataType).alias(field.name, metadata=field.metadata)
        for field in spec.schema
    ])


def row_range(spark: SparkSession, low: int, high: int, name: str = "id",
              partitions: int | None = None) -> DataFrame:
    """Consecutive BIGINTs low..high-1, produced on the executors."""
    return spark.range(low, high, 1, partitions).withColumnRenamed("id", name)


def value_rows(source: DataFrame, values: Sequence[str], index: str = "idx",
               name: str = "name") -> DataFrame:
    """One row per (source row, list entry); the index counts from 0 within a source row."""
    listed = F.array(*[F.lit(value) for value in values])
    return source.select("*", F.posexplode(listed).alias(index, name))
