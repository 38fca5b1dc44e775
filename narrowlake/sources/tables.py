"""Narrow tables, item dictionaries and code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of an item dictionary.
DICTIONARY_COLUMNS = (
    "item_mdrm",
    "item_desc",
    "context_level1_mdrm",
    "context_level1_desc",
    "context_level1_value",
)


def scan_narrow(spark: SparkSession, table_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in table_or_path:
        return spark.read.parquet(table_or_path)
    return spark.table(table_or_path)


def item_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Codes with description and level-1 context, as text."""
    schema = ", ".join(f"{c} string" for c in DICTIONARY_COLUMNS)
    return spark.read.options(header=True, quote='"', escape='"').schema(schema).csv(path)


def code_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed codes of comma-separated text files."""
    return (
        spark.read.text(path)
        .select(F.explode(F.split("value", ",")).alias("code"))
        .select(F.trim("code").alias("code"))
        .where(F.col("code") != "")
        .distinct()
    )
