"""Run the jobs from the command line, one by one or as a whole cycle.

    spark-submit ... -m tidemark  or  python -m tidemark
        generate | land | build | verify | cycle  --database NAME --root FOLDER [options]

Separate steps need a catalog that outlives the session; ``cycle`` does not.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_ASOF, BatchConfig, GenerationConfig
from tidemark.operators import partition_profile, row_counts, skew_profile, watermark_profile
from tidemark.plans import (
    Expectations, create_sources, land_batch, refresh_overlay, run_build, verify, verify_layout,
)
from tidemark.session import SETTINGS
from tidemark.sources import DEPARTMENT, EMPLOYEE, analyze, table_detail


def _options() -> argparse.ArgumentParser:
    generation, batch = GenerationConfig(), BatchConfig()
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=["generate", "land", "build", "verify", "cycle"])
    parser.add_argument("--database", required=True, help="holds all tables; created if missing")
    parser.add_argument("--root", required=True, help="shared folder for versions of the read table")
    parser.add_argument("--employees", type=int, default=generation.employees)
    parser.add_argument("--departments", type=int, default=generation.departments)
    parser.add_argument("--buckets", type=int, default=generation.buckets)
    parser.add_argument("--history-days", type=int, default=generation.history_days)
    parser.add_argument("--asof", default=DEFAULT_ASOF, help="anchor of the generated timestamps")
    parser.add_argument("--new-rows", type=int, default=batch.new_rows)
    parser.add_argument("--updated-rows", type=int, default=batch.updated_rows)
    parser.add_argument("--batch-asof", help="anchor of the batch; advance it per batch")
    parser.add_argument("--full", action="store_true", help="rebuild the read table in full")
    parser.add_argument("--overlay", action="store_true",
                        help="keep changes beside the read table instead of rewriting it")
    return parser


class Jobs:
    """The jobs over the tables of one database."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace) -> None:
        self.spark, self.args = spark, args
        self.employee = f"{args.database}.employee"
        self.department = f"{args.database}.department"
        self.output = f"{args.database}.employee_department"
        self.config = GenerationConfig(
            employees=args.employees, departments=args.departments, buckets=args.buckets,
            history_days=args.history_days, asof=args.asof)
        self.batch = BatchConfig(
            new_rows=args.new_rows, updated_rows=args.updated_rows,
            asof=args.batch_asof or args.asof)

    def generate(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.args.database}")
        create_sources(self.spark, self.config, self.employee, self.department)
        analyze(self.spark, self.department, self.employee)

    def land(self) -> None:
        land_batch(self.spark, self.employee, self.department, self.config, self.batch)

    def build(self) -> None:
        fact, dimension = self.spark.table(self.employee), self.spark.table(self.department)
        if self.args.overlay:
            if self.args.full:
                raise SystemExit("--full rebuilds the published table; leave out --overlay")
            print(refresh_overlay(self.spark, self.output, fact, dimension, self.args.root))
        else:
            print(run_build(self.spark, self.output, fact, dimension, self.args.root,
                            full=self.args.full))

    def verify(self, landed: int | None = None) -> None:
        """Without a number, all rows beyond the generated ones are taken as landed: their
        ids follow the generated ones."""
        if landed is None:
            landed = self.spark.table(self.employee).where(
                F.col("employee_id") >= self.config.first_employee_id + self.config.employees
            ).count()
        fact = self.spark.table(self.employee).select(EMPLOYEE.columns)
        dimension = self.spark.table(self.department).select(DEPARTMENT.columns)
        output = self.spark.table(self.output)
        row_counts({"employee": fact, "department": dimension, "output": output}).show()
        for table in (self.employee, self.department):
            table_detail(self.spark, table).show(truncate=False)
        partition_profile(fact, EMPLOYEE.partition_by,
                          self.config.departments * self.config.buckets).show()
        skew_profile(fact, ["department_number", "department_name"], 10, "employees").show(
            truncate=False)
        watermark_profile(fact, "updated_at").show(truncate=False)
        expected = Expectations.of(self.config, landed=landed)
        built = f"{self.output}_base" if self.args.overlay else self.output
        report = verify(fact, dimension, output, expected=expected).union(
            verify_layout(self.spark, self.employee, self.department, built))
        report.show(100, truncate=False)

    def cycle(self) -> None:
        """Generate, build, land a batch, build again, verify."""
        self.generate()
        self.build()
        self.land()
        self.build()
        self.verify(landed=self.batch.new_rows)


def main() -> None:
    args = _options().parse_args()
    builder = SparkSession.builder.appName("tidemark")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    jobs = Jobs(builder.getOrCreate(), args)
    getattr(jobs, args.step)()


if __name__ == "__main__":
    main()
