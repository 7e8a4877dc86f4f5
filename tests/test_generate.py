import pytest
from conftest import SMALL, declared, rows_of
from pyspark.sql import functions as F

from tidemark.config import BatchConfig, GenerationConfig, OutputSpec, WatermarkPolicy
from tidemark.functions.vocabulary import DEPARTMENT_NAMES
from tidemark.operators import duplicate_keys, watermark_profile
from tidemark.plans import create_sources, generate_dimension, generate_fact
from tidemark.sources import DEPARTMENT, EMPLOYEE, conform


@pytest.mark.parametrize("bad", [
    {"departments": 0}, {"buckets": 0}, {"history_days": 0}, {"employees": -1},
    {"hot_percent": 101}, {"employees": 1.5},
])
def test_generation_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        GenerationConfig(**bad)


def test_other_parameters_are_checked():
    with pytest.raises(ValueError):
        BatchConfig(new_rows=-1)
    with pytest.raises(ValueError):
        WatermarkPolicy("sometimes")
    with pytest.raises(ValueError):
        OutputSpec(dim_columns=("department_name",))
    with pytest.raises(ValueError):
        OutputSpec(cluster_by=("nowhere",))


def test_dimension_lists_names_in_order(spark):
    got = generate_dimension(spark, GenerationConfig(departments=24))
    assert declared(got.schema) == declared(DEPARTMENT.schema)
    rows = got.orderBy("department_number").collect()
    assert [r.department_name for r in rows] == list(DEPARTMENT_NAMES[:24])
    assert [r.department_number for r in rows] == list(range(1, 25))


def test_dimension_is_not_capped_by_its_value_list(spark):
    n = len(DEPARTMENT_NAMES) * 2 + 5
    got = generate_dimension(spark, GenerationConfig(departments=n))
    assert got.count() == n
    assert duplicate_keys(got, ["department_name"]).count() == 0
    short = generate_dimension(spark, GenerationConfig(departments=3))
    assert rows_of(got.filter("department_number <= 3")) == rows_of(short)


def test_fact_matches_its_declaration(spark):
    dimension = generate_dimension(spark, SMALL)
    fact = generate_fact(spark, SMALL, dimension)
    assert declared(fact.schema) == declared(EMPLOYEE.schema)
    assert fact.count() == SMALL.employees
    assert duplicate_keys(fact, ["employee_id"]).count() == 0
    assert fact.agg(F.min("employee_id"), F.max("employee_id")).first()[:] == (100_000, 101_999)
    assert fact.filter("employee_id_bucket <> employee_id % 2").count() == 0
    assert fact.join(dimension, ["department_number", "department_name"]).count() == 2_000


@pytest.mark.parametrize("departments", [1, 2])
def test_tiny_dimensions_lose_no_rows(spark, departments):
    config = GenerationConfig(employees=300, departments=departments)
    assert generate_fact(spark, config, generate_dimension(spark, config)).count() == 300


def test_empty_fact(spark):
    config = GenerationConfig(employees=0, departments=3)
    assert generate_fact(spark, config, generate_dimension(spark, config)).count() == 0


def test_content_depends_on_the_id_alone(spark):
    dimension = generate_dimension(spark, SMALL)
    fact = generate_fact(spark, SMALL, dimension)
    ids = spark.range(100_500, 100_600).repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = rows_of(generate_fact(spark, SMALL, dimension, ids))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert again == rows_of(fact.filter("employee_id BETWEEN 100500 AND 100599"))


def test_days_are_ninety_or_ninety_one(spark):
    config = GenerationConfig(employees=20_000, departments=3)
    fact = generate_fact(spark, config, generate_dimension(spark, config))
    assert watermark_profile(fact, "updated_at").first().distinct_days in (90, 91)


def test_tables_are_declared_with_comments_and_partitions(spark, database):
    employee, department = create_sources(
        spark, SMALL, f"{database}.employee", f"{database}.department")
    columns = {c.name: c for c in spark.catalog.listColumns(employee)}
    assert [n for n, c in columns.items() if c.isPartition] == list(EMPLOYEE.partition_by)
    assert columns["employee_id"].description == EMPLOYEE.schema["employee_id"].metadata["comment"]
    assert columns["employee_id_bucket"].dataType == "int"
    assert spark.catalog.getTable(employee).description == EMPLOYEE.comment
    assert spark.table(department).count() == SMALL.departments
    # a second run replaces, it does not add
    create_sources(spark, SMALL, employee, department)
    assert spark.table(employee).count() == SMALL.employees


def test_positional_assignment_casts_and_refuses_overflow(spark):
    rows = spark.range(3).select("id", *[F.lit("x")] * 4)
    assert declared(conform(rows, DEPARTMENT).schema) == declared(DEPARTMENT.schema)
    with pytest.raises(ValueError):
        conform(rows.drop("id"), DEPARTMENT)
    too_big = spark.range(1).select((F.col("id") + 2**40).alias("n"), *[F.lit("x")] * 4)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        conform(too_big, DEPARTMENT).collect()
