"""CSV sources: the raw files, read with their declared schemas.

Header names are checked against the schema (``enforceSchema=false``): a file
with swapped or renamed columns fails instead of loading shifted values.
Malformed fields become null (PERMISSIVE); the raw line of such a row is kept
in ``_corrupt_record`` when asked for, so it can be counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from edustar.schemas import RAW_TABLES

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType, keep_corrupt: bool = False) -> DataFrame:
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    return (spark.read
            .option("header", "true")
            .option("nullValue", "")
            .option("quote", '"')
            .option("escape", '"')
            .option("enforceSchema", "false")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .schema(schema)
            .csv(path))


def count_corrupt(df: DataFrame) -> DataFrame:
    """Rows and malformed rows in one aggregate (needs ``keep_corrupt=True``)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_rows"))


def read_raw_folder(spark: SparkSession, folder: str, keep_corrupt: bool = False) -> dict[str, DataFrame]:
    """The seven raw tables from ``folder`` (file names as in ``RAW_TABLES``)."""
    folder = folder.rstrip("/")
    return {name: read_csv(spark, f"{folder}/{fname}", schema, keep_corrupt)
            for name, (fname, schema) in RAW_TABLES.items()}
