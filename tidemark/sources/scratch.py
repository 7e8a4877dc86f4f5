"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared one the session names.

    ``spark.checkpoint.dir`` must be reachable by every executor.  Only a local session
    without the setting falls back to a folder beside its tables, in the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to scratch and read it back: cuts lineage, survives lost executors."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
