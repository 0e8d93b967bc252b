"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<data_dir>/<name>.parquet``; selecting columns here lets Catalyst prune the scan."""
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
