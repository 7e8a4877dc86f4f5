from __future__ import annotations

import pytest

from tidemark.config import GenerationConfig, OutputSpec
from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        cores=4, shuffle_partitions=4,
        **{"spark.checkpoint.dir": f"{root}/scratch",
           "spark.sql.warehouse.dir": f"{root}/warehouse"})
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A database of its own, so tables of one test never meet those of another."""
    name = f"db_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


SMALL = GenerationConfig(employees=2_000, departments=5, buckets=2)

# A read table with few columns: fact (id, k, v, ts), dimension (k, a).
SPEC = OutputSpec(key="id", join_key="k", watermark="ts", fact_columns=("id", "k", "v", "ts"),
                  dim_columns=("a",), cluster_by=("k",))


def fact_of(spark, rows):
    """Rows of (id, k, v, day); a day number stands for a date in January 2026."""
    made = spark.createDataFrame(rows, "id bigint, k string, v int, day int")
    return made.selectExpr(
        "id", "k", "v", "timestampadd(DAY, day, TIMESTAMP_NTZ '2026-01-01 00:00:00') AS ts")


def dim_of(spark, rows):
    return spark.createDataFrame(rows, "k string, a string")


def rows_of(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def declared(schema):
    """Names, types and comments; whether a column may be null follows from its expression."""
    return [(f.name, f.dataType, f.metadata) for f in schema]
