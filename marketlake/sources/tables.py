"""Reading the supplied parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table; Catalyst prunes columns and pushes filters into the scan.

    How a scan is split is the session's matter (``spark.sql.files.maxPartitionBytes``):
    no exchange is added here.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
