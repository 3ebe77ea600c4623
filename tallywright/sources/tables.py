"""Scanning the source tables and watching their freshness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.config import Config
from tallywright.sources.schemas import SCHEMAS, conform

#: column that tells when a row was loaded, for the tables that have one
LOADED_AT = {name: "created_at" for name, schema in SCHEMAS.items() if "created_at" in schema.fieldNames()}


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All seven tables from ``folder``, one parquet dataset each; a missing or mistyped column is an error."""
    return {name: conform(spark.read.parquet(f"{folder.rstrip('/')}/{name}"), name) for name in SCHEMAS}


def catalog_sources(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """All seven tables from a catalog database."""
    return {name: conform(spark.table(f"{database}.{name}"), name) for name in SCHEMAS}


def freshness(sources: Mapping[str, DataFrame], now: Column, cfg: Config) -> DataFrame:
    """Age of each table's newest row: ``table_name, max_loaded_at, age_hours, status``."""
    newest = [
        sources[name].agg(F.max(column).alias("max_loaded_at")).select(F.lit(name).alias("table_name"), "max_loaded_at")
        for name, column in LOADED_AT.items()
        if name in sources
    ]
    seconds = F.unix_timestamp(now) - F.unix_timestamp("max_loaded_at")
    age = F.col("age_hours")
    return (
        reduce(DataFrame.unionByName, newest)
        .withColumn("age_hours", F.floor(seconds / 3600))
        .withColumn(
            "status",
            F.when(age.isNull() | (seconds > cfg.freshness_error_hours * 3600), "error")
            .when(seconds > cfg.freshness_warn_hours * 3600, "warn")
            .otherwise("pass"),
        )
    )
