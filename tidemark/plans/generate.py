"""Generate the two source tables: a small dimension and a large, skewed fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SECONDS_PER_DAY, GenerationConfig
from tidemark.functions import (
    anchor, bucket_of, cost_center, full_name, id_key, pick, seconds_before, skewed_key,
)
from tidemark.functions import vocabulary as v
from tidemark.operators.joins import many_to_one_join
from tidemark.sources.tables import (
    DEPARTMENT, EMPLOYEE, conform, row_range, value_rows,
)
from tidemark.sources.writers import create_or_replace


def generate_dimension(spark: SparkSession, config: GenerationConfig) -> DataFrame:
    """One row per department, numbered from 1.

    The value list is exploded once per round; beyond its length, names carry the round
    as a suffix and so stay unique at any number of departments.
    """
    words = config.vocabulary
    listed = len(words.departments)
    rounds = -(-config.departments // listed)
    names = value_rows(row_range(spark, 0, rounds, "round"), words.departments, "idx", "name")
    number = F.col("round") * listed + F.col("idx") + 1
    name = F.col("department_name")
    return conform(
        names.select(
            number.alias("department_number"),
            F.when(F.col("round") == 0, F.col("name"))
            .otherwise(F.concat("name", F.lit(" "), (F.col("round") + 1).cast("string")))
            .alias("department_name"),
        )
        .filter(F.col("department_number") <= config.departments)
        .select(
            "department_number",
            name,
            full_name(words.first_names, words.last_names, name,
                      v.SALT_HEAD_FIRST, v.SALT_HEAD_LAST),
            cost_center(name),
            pick(words.divisions, name, v.SALT_DIVISION),
        ),
        DEPARTMENT,
    )


def employee_rows(assigned: DataFrame, dimension: DataFrame, config: GenerationConfig,
                  updated_at: Column) -> DataFrame:
    """Complete (employee_id, department_number) rows to employee rows."""
    words, key = config.vocabulary, id_key("employee_id")
    named = many_to_one_join(
        assigned, dimension.select("department_number", "department_name"), "department_number")
    return conform(
        named.select(
            "employee_id",
            full_name(words.first_names, words.last_names, key, v.SALT_FIRST, v.SALT_LAST),
            "department_number",
            "department_name",
            pick(words.locations, key, v.SALT_LOCATION),
            pick(words.salary_bands, key, v.SALT_BAND),
            updated_at,
            bucket_of(key, config.buckets),
        ),
        EMPLOYEE,
    )


def generate_fact(spark: SparkSession, config: GenerationConfig, dimension: DataFrame,
                  ids: DataFrame | None = None) -> DataFrame:
    """One row per employee, skewed towards the first departments.

    ``ids`` supplies the ids in its first column; by default they are counted up from
    ``first_employee_id``.  Each row depends on its id alone.
    """
    if ids is None:
        first = config.first_employee_id
        ids = row_range(spark, first, first + config.employees)
    key = id_key("employee_id")
    assigned = ids.select(id_key(F.col(ids.columns[0])).alias("employee_id")).withColumn(
        "department_number",
        skewed_key(key, config.departments, config.hot_keys, config.hot_percent))
    updated = seconds_before(
        anchor(config.asof), key, v.SALT_UPDATED, config.history_days * SECONDS_PER_DAY)
    return employee_rows(assigned, dimension, config, updated)


def create_sources(spark: SparkSession, config: GenerationConfig, employee_table: str,
                   department_table: str, ids: DataFrame | None = None) -> Sequence[str]:
    """Create and fill both tables, laid out for ingest."""
    create_or_replace(generate_dimension(spark, config), department_table, DEPARTMENT)
    fact = generate_fact(spark, config, spark.table(department_table).select(
        DEPARTMENT.columns), ids)
    create_or_replace(fact, employee_table, EMPLOYEE, sort_by=["updated_at"])
    return employee_table, department_table
