"""Ingest gate: every expected raw file must be present before a run starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar.schemas import RAW_TABLES
from edustar.sources.log import log_exists

EXPECTED_FILES = [fname for fname, _ in RAW_TABLES.values()]


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """File names under ``folder`` (the listing only; file contents are not read)."""
    return (spark.read.format("binaryFile").load(folder.rstrip("/") + "/*")
            .select(F.element_at(F.split("path", "/"), -1).alias("file_name")))


def missing_sources(spark: SparkSession, folder: str, expected: list[str] | None = None) -> DataFrame:
    want = spark.createDataFrame([(n,) for n in (expected or EXPECTED_FILES)], "file_name string")
    if not log_exists(spark, folder):  # an absent folder: every file is missing
        return want
    return want.join(listing(spark, folder), "file_name", "left_anti")


def require_sources(spark: SparkSession, folder: str, expected: list[str] | None = None) -> None:
    missing = sorted(r.file_name for r in missing_sources(spark, folder, expected).collect())
    if missing:
        raise FileNotFoundError(f"missing source files in {folder}: {missing}")
