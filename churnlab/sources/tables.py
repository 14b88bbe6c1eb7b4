"""Parquet tables of a data directory (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, data_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    return {n: table(spark, data_dir, n) for n in names}
