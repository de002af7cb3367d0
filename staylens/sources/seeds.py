"""Seed (dimension) tables: read as text, columns by header name; typing and
cleaning happen in ``staylens.operators.dimensions``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.schemas import INVENTORY_RAW, MANIFEST_RAW, MARKET_RAW
from staylens.sources.feeds import read_csv_by_name


def read_seed(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_csv_by_name(spark, path, schema)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, INVENTORY_RAW)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, MANIFEST_RAW)


def read_market(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, MARKET_RAW)
