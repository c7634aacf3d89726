"""The check log: append sink partitioned by time, and its partition labels.

An append is idempotent by run: rows lie in folders year / quarter / run, and a run's folders are replaced as a whole
(dynamic partition overwrite), so a job that is repeated after a failure leaves its rows once. Ids are
made of the run and the row's place in it, so that runs at the same time need not agree on a counter.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The log's range partitions (label, exclusive upper bound);
# yearly for 2025, quarterly for 2026, yearly for 2027, then open-ended.
LOG_PARTITIONS = [
    ("p_2025", "2026-01-01"),
    ("p_2026_q1", "2026-04-01"),
    ("p_2026_q2", "2026-07-01"),
    ("p_2026_q3", "2026-10-01"),
    ("p_2026_q4", "2027-01-01"),
    ("p_2027", "2028-01-01"),
]
LAST_PARTITION = "p_max"


def partition_label(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    expr = F.lit(LAST_PARTITION)
    for label, bound in reversed(LOG_PARTITIONS):
        expr = F.when(ts < F.lit(bound).cast("timestamp_ntz"), label).otherwise(expr)
    return expr


PLACES = 10  # low bits of an id: the row's place in its run; the others are a hash of the run


def with_partition_columns(log: DataFrame) -> DataFrame:
    """year/quarter columns used as directory partitions of the written log."""
    return log.withColumn("year", F.year("checked_at")).withColumn("quarter", F.quarter("checked_at"))


def run_id(run: str, place: int) -> int:
    """Id of a run's row: 53 bits of the run's SHA-256, then the place."""
    if not 0 <= place < 1 << PLACES:
        raise ValueError(f"a run has at most {1 << PLACES} rows")
    return (int.from_bytes(hashlib.sha256(run.encode()).digest()[:8], "big") >> 11 << PLACES) | place


def append_log(log_rows: DataFrame, path: str, run: str) -> None:
    """Write a run's rows, partitioned by year, quarter and run; rows that the run has written before are replaced."""
    rows = with_partition_columns(log_rows).withColumn("run", F.lit(run))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "quarter", "run").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with its folder columns year and quarter, on which time filters prune."""
    return spark.read.parquet(path).drop("run")


def log_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a log folder; asks the path's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _quarter_number(year: Column, quarter: Column) -> Column:
    return year * 4 + quarter


def newest(log: DataFrame) -> Column:
    """The newest entry's time as a scalar; only the newest quarter's folder is read for it."""
    q = _quarter_number(F.col("year"), F.col("quarter"))
    return log.where(q == log.select(F.max(q)).scalar()).select(F.max("checked_at")).scalar()


def recent(log: DataFrame, since: Column) -> DataFrame:
    """Rows after ``since``. The bound on the folder columns is worked out from it at run time, so older folders aren't read."""
    bound = _quarter_number(F.year(since), F.quarter(since))
    return log.where((_quarter_number(F.col("year"), F.col("quarter")) >= bound) & (F.col("checked_at") > since))
