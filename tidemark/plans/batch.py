"""Land a batch on the fact: new rows, and rows that move to another parent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import BatchConfig, GenerationConfig
from tidemark.functions import anchor, draw, id_key, minutes_after
from tidemark.functions import vocabulary as v
from tidemark.operators.joins import computed_key_join, measure_side
from tidemark.operators.merge import move_partitions
from tidemark.operators.sampling import hash_order_sample
from tidemark.plans.generate import employee_rows
from tidemark.sources.tables import EMPLOYEE, row_range
from tidemark.sources.writers import append_rows

# What a move assigns: {employee column: column of the moved row}
MOVE = {
    "department_number": "new_department_number",
    "department_name": "new_department_name",
    "updated_at": "new_updated_at",
}
# Where a moved row lies before: {partition column: column of the moved row}
HELD = {column: f"old_{column}" for column in EMPLOYEE.partition_by}


def next_id(df: DataFrame, key: str, start: int) -> int:
    """The first id above those in use; ``start`` for an empty table."""
    return df.agg(F.coalesce(F.max(key) + 1, F.lit(start)).alias("next")).first().next


def allocate_ids(df: DataFrame, key: str, n: int, start: int) -> DataFrame:
    """n consecutive ids above those in use."""
    first = next_id(df, key, start)
    return row_range(df.sparkSession, first, first + n, key)


def new_rows(fact: DataFrame, dimension: DataFrame, config: GenerationConfig,
             batch: BatchConfig) -> DataFrame:
    """New employees: ids above the current ones, evenly spread over all departments."""
    ids = allocate_ids(fact, "employee_id", batch.new_rows, config.first_employee_id)
    departments = measure_side(dimension, ["department_number"]).rows
    key = id_key("employee_id")
    assigned = ids.withColumn(
        "department_number", (draw(key, v.SALT_NEW_KEY, departments) + 1).cast("int"))
    updated = minutes_after(anchor(batch.asof), key, v.SALT_NEW_UPDATED, batch.span_minutes)
    return employee_rows(assigned, dimension, config, updated)


def moved_rows(fact: DataFrame, dimension: DataFrame, batch: BatchConfig) -> DataFrame:
    """Employees that change department: a repeatable sample of the rows before the anchor.

    They carry the partition they lie in, so nothing else of the fact is read to move them.
    """
    eligible = fact.filter(F.col("updated_at") < anchor(batch.asof)).select(
        "employee_id", *[F.col(column).alias(old) for column, old in HELD.items()])
    movers = hash_order_sample(eligible, "employee_id", batch.updated_rows)
    key = id_key("employee_id")

    def destination(n: int):
        if not batch.force_move:
            return draw(key, v.SALT_MOVE_KEY, n) + 1
        if n < 2:
            raise ValueError("a forced move needs at least two departments")
        step = draw(key, v.SALT_MOVE_KEY, n - 1) + 1
        return F.pmod(F.col("old_department_number") - 1 + step, F.lit(n)) + 1

    placed = computed_key_join(
        movers,
        dimension.withColumnsRenamed({
            "department_number": "new_department_number",
            "department_name": "new_department_name"}),
        "new_department_number", destination,
        ["new_department_number", "new_department_name"])
    return placed.select(
        "employee_id", *HELD.values(), "new_department_number", "new_department_name",
        minutes_after(anchor(batch.asof), key, v.SALT_MOVE_UPDATED, batch.span_minutes)
        .alias("new_updated_at"),
    )


def land_batch(spark: SparkSession, employee_table: str, department_table: str,
               config: GenerationConfig, batch: BatchConfig) -> int:
    """Append the new rows, then move the sampled ones between partitions.

    Returns the number of partitions the moves rewrote.  New rows lie at or above the
    anchor, so they are never among the movers.
    """
    dimension = spark.table(department_table)

    def fact():
        return spark.table(employee_table).select(EMPLOYEE.columns)

    append_rows(new_rows(fact(), dimension, config, batch), employee_table, EMPLOYEE,
                sort_by=["updated_at"])
    moves = moved_rows(fact(), dimension, batch)
    return move_partitions(spark, employee_table, moves, "employee_id", MOVE,
                           EMPLOYEE.partition_by, sort_by=["updated_at"], held=HELD)
