"""Named catalog tables that outlive the session, bucketed where joins gain from it.

Tables are written with ``bucketBy(...).sortBy(...).saveAsTable`` to a folder of their own, with a description
beside them (``_tables``), from which ``attach`` enters them into another session's catalog without reading
a row. Rows are dealt by the same hash as the buckets before they are written, so each bucket is one file.

``EnrolmentTables`` keeps both sides of the enrolment joins in as many buckets of the same keys, so the joins need no
shuffle at all. A hot enrolment doesn't make a hot bucket: the salt of hot keys (``joins.HotKeys``) is one of the bucket
columns on both sides, its rows lie in several buckets and its few partner rows in each of them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edustar.operators.joins import SALT, HotKeys

ROWS_PER_BUCKET = 2_000_000


@dataclass(frozen=True)
class Buckets:
    by: list[str]
    n: int


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets for ``rows`` rows: at least as many as shuffles have partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BUCKET))


def _database(spark: SparkSession, database: str, location: str) -> None:
    # a folder of its own: some catalogs delete a database's folder with it, and the tables' files must stay
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location.rstrip('/')}/_database_{database}'")


def save(spark: SparkSession, database: str, location: str, frames: dict[str, DataFrame], buckets: dict[str, Buckets] | None = None) -> list[str]:
    """Write ``frames`` under ``location`` and enter them into ``database``; returns the tables' full names."""
    _database(spark, database, location)
    described = []
    for name, df in frames.items():
        b = (buckets or {}).get(name)
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        path = f"{location.rstrip('/')}/{name}"
        if b:
            df.repartition(b.n, *b.by).write.mode("overwrite").option("path", path).bucketBy(b.n, *b.by).sortBy(*b.by).saveAsTable(f"{database}.{name}")
        else:
            df.write.mode("overwrite").option("path", path).saveAsTable(f"{database}.{name}")
        described.append((name, path, df.schema.json(), b.by if b else [], b.n if b else 0))
    spark.createDataFrame(described, DESCRIPTION).coalesce(1).write.mode("overwrite").parquet(f"{location.rstrip('/')}/_tables")
    return [f"{database}.{n}" for n in frames]


DESCRIPTION = "name string, path string, schema string, bucket_by array<string>, buckets int"


def attach(spark: SparkSession, database: str, location: str) -> list[str]:
    """Enter the tables saved under ``location`` into this session's catalog as ``database``."""
    _database(spark, database, location)
    names = []
    for r in spark.read.schema(DESCRIPTION).parquet(f"{location.rstrip('/')}/_tables").collect():  # a row per table
        schema = T.StructType.fromJson(json.loads(r["schema"]))
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{c}`" for c in r["bucket_by"])
        clustered = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {r['buckets']} BUCKETS" if r["buckets"] else ""
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{r['name']}`")
        spark.sql(f"CREATE TABLE `{database}`.`{r['name']}` ({cols}) USING parquet {clustered} LOCATION '{r['path']}'")
        names.append(f"{database}.{r['name']}")
    return names


@dataclass
class EnrolmentTables:
    """Catalog tables of submissions (salted), collapsed enrolments and click totals (spread), bucketed alike."""

    spark: SparkSession
    database: str
    keys: list[str]

    @classmethod
    def save(cls, spark: SparkSession, location: str, database: str, submissions: DataFrame, enrolments: DataFrame, clicks: DataFrame,
             keys: list[str], hot: HotKeys, n: int) -> "EnrolmentTables":
        zero = F.lit(0)
        big = hot.salt(submissions) if hot.any else submissions.withColumn(SALT, zero)
        small = {k: hot.spread(v) if hot.any else v.withColumn(SALT, zero) for k, v in (("enrolments", enrolments), ("clicks", clicks))}
        frames = {"submissions": big, **small}
        save(spark, database, location, frames, dict.fromkeys(frames, Buckets([*keys, SALT], n)))
        return cls(spark, database, keys)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def left_join(self, name: str) -> DataFrame:
        """Submissions left-joined to ``enrolments`` or ``clicks``, bucket by bucket."""
        return self.table("submissions").join(self.table(name).hint("merge"), [*self.keys, SALT], "left").drop(SALT)
