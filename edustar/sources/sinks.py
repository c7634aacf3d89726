"""Writers: Parquet with a row count from the same pass, partitioned log, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_parquet_counted(df: DataFrame, path: str, partition_by: list[str] | None = None,
                          mode: str = "overwrite") -> int:
    """Write ``df`` and return its row count, counted while writing (one scan, not two)."""
    obs = Observation("rows")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["n"])


# Most concurrent connections a JDBC write opens; a database cannot take one
# connection per partition of a large table (Spark coalesces down to this).
JDBC_MAX_CONNECTIONS = 64


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batchsize: int = 5000, truncate: bool = False,
               max_connections: int = JDBC_MAX_CONNECTIONS) -> None:
    """JDBC sink. ``mode='overwrite', truncate=True`` is the full-refresh load:
    the table definition stays, its rows are replaced. One connection per
    partition, at most ``max_connections`` at once; inserts are batched."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    props.setdefault("numPartitions", str(max_connections))
    if truncate:
        props["truncate"] = "true"
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)
