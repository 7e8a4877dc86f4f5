"""What a table's files look like: statistics, partitioning, clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLUSTERED_BY = "tidemark.clustered_by"


def analyze(spark: SparkSession, *tables: str) -> None:
    """Column statistics for the optimiser.

    Analyse both sides of a join or neither: with only the large side known, the planner
    has been seen to broadcast that one.
    """
    for table in tables:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def stored_statistics(spark: SparkSession, table: str) -> DataFrame:
    """What ``analyze`` has left in the catalog: rows of the table, and for each column nulls and,
    other than for text, the smallest and largest value."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'").first()
    rows = int(described.data_type.split(", ")[1].split()[0]) if described else None
    found = []
    for column in spark.table(table).columns:  # the catalog alone is read
        info = {r.info_name: r.info_value for r in spark.sql(
            f"DESCRIBE EXTENDED {table} `{column}`").collect()}
        kept = {name: None if info.get(name) in (None, "NULL") else info[name]
                for name in ("num_nulls", "min", "max")}
        found.append((column, rows, kept["num_nulls"] and int(kept["num_nulls"]), kept["min"],
                      kept["max"]))
    return spark.createDataFrame(
        found, "column_name string, rows bigint, nulls bigint, min_value string, max_value string")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def clustering_columns(spark: SparkSession, table: str) -> list[str]:
    """What a table is clustered by; a view over clustered rows names it in a property."""
    named = table_properties(spark, table).get(CLUSTERED_BY)
    if named:
        return named.split(",")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()  # one row per column
    names = [row.col_name for row in described]
    if "# Clustering Information" not in names:
        return []
    start = names.index("# Clustering Information") + 2  # skips its own header line
    found = []
    for name in names[start:]:
        if not name or name.startswith("#"):
            break
        found.append(name)
    return found


def table_detail(spark: SparkSession, table: str) -> DataFrame:
    """One row: how the table is partitioned and clustered, its partitions, files, bytes.

    Rows and files are counted from the scan's file metadata; no data column is read
    besides the partition keys, which come from the directory names.
    """
    keys = partition_columns(spark, table)
    clustered = clustering_columns(spark, table)
    per_file = (
        spark.table(table)
        .groupBy(*keys, F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("n"), F.max("_metadata.file_size").alias("size"))
    )
    partitions = F.countDistinct(F.struct(*keys)) if keys else F.lit(0).cast("bigint")
    return per_file.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        partitions.alias("partitions"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("partition_columns"),
        F.lit(",".join(clustered)).alias("clustering_columns"),
        "partitions", "files", "bytes", "rows",
    )


def files_by_key(df: DataFrame, key: str) -> DataFrame:
    """Rows of each (file, key) pair; the base of the cluster profile."""
    return df.groupBy(F.col("_metadata.file_path").alias("file"), key).agg(
        F.count("*").alias("n"))


def cluster_profile(df: DataFrame, key: str) -> DataFrame:
    """Per file: rows, distinct keys and key range."""
    return files_by_key(df, key).groupBy("file").agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("keys"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )


def cluster_summary(df: DataFrame, key: str) -> DataFrame:
    """One row on how well files separate the key.

    In a range-clustered table neighbouring files share at most their border key, so the
    (file, key) pairs number at most ``keys + files - 1``; ``well_clustered`` tests that.
    """
    pairs = files_by_key(df, key)
    per_file = pairs.groupBy("file").agg(F.sum("n").alias("n"))
    files = per_file.agg(F.struct(
        F.count("*").alias("files"), F.max("n").alias("max_rows_per_file"))).scalar()
    per_key = pairs.groupBy(key).agg(F.count("*").alias("files_of_key"), F.sum("n").alias("n"))
    keys = per_key.agg(
        F.count("*").alias("keys"), F.sum("files_of_key").alias("pairs"),
        F.max("files_of_key").alias("max_files_per_key"), F.sum("n").alias("rows"))
    return keys.withColumn("file", files).select("*", "file.*").drop("file").withColumn(
        "well_clustered", F.col("pairs") <= F.col("keys") + F.col("files") - 1)



def file_spans(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per numeric key: files, and the share of its whole span that a file covers on
    average.  The smaller the share, the fewer files a filter on the key reads."""
    spans = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(*[
        f(k).alias(f"{n}_{k}") for k in keys for f, n in ((F.min, "low"), (F.max, "high"))])
    measures = [F.struct(
        F.lit(k).alias("key"), F.count("*").alias("files"),
        (F.avg(F.col(f"high_{k}") - F.col(f"low_{k}"))
         / (F.max(f"high_{k}") - F.min(f"low_{k}"))).alias("share_of_span")) for k in keys]
    return spans.agg(F.array(*measures).alias("k")).select(F.inline("k"))
