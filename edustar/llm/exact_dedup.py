"""Exact deduplication as a stateful stream.

Every row's normalised text is reduced to its SHA-256 digest. The digests run through a Structured
Streaming aggregation without watermark, so its keyed state never expires: per digest the state holds the
stable identifier and content locator of the row that stays (smallest doc_id, then first row) and the
number of rows. The state lives in RocksDB on the executors' disks with its changes in the shared
checkpoint folder, and the result is read from that state. Rows of one digest are combined on the map
side, so a group holding a third of all rows sends one row per task.

On a hit (a digest seen more than once) the full normalised bytes of the rows are compared; rows whose
bytes differ under one digest are grouped again by digest and text, so a collision never drops a document.

Defined results: null text counts as empty, and empty texts equal each other. Null doc_ids come after all
others (``keep_id`` is null only where every copy has a null doc_id). Of repeated rows (same doc_id and
text) one is kept. An empty table gives an empty result. Only doc_id and text are read, so further
columns of any name have no effect; ``keep_rows`` returns them untouched.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, shared_dir, table, written

BROADCAST_ROWS = 250_000  # hit digests are broadcast up to this many rows of about 70 bytes, joined by shuffle beyond
STATE = "spark.sql.streaming.stateStore."
STATE_CONF = {
    STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    STATE + "rocksdb.allowFAllocate": "false",  # no preallocated files: many partitions have little state each
    STATE + "rocksdb.changelogCheckpointing.enabled": "true",
    STATE + "rocksdb.boundedMemoryUsage": "true",  # all stores of an executor share one bounded memory
    STATE + "rocksdb.maxMemoryUsageMB": "128",
    STATE + "maintenanceInterval": "10s",  # stores of an ended stream are closed soon
}


@contextmanager
def state_conf(spark: SparkSession):
    """Session settings of the state, while a stream starts or its state is read."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def digest_rows(docs: DataFrame, digest=sha256) -> DataFrame:
    """doc_id, digest and locator (``row``, the row's place in the scan) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(normalised(F.col("text"))).alias("digest"),
                       F.monotonically_increasing_id().alias("row"))


def dedup_stream(rows: DataFrame, checkpoint: str):
    """Run a stream of ``digest_rows`` through the keyed state kept in ``checkpoint``; returns the ended query.

    Called again with the same checkpoint, it takes up the state and reads only files it hasn't seen.
    """
    spark = rows.sparkSession
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    state = rows.groupBy("digest").agg(F.min(first).alias("keep"), F.count("*").alias("group_size"))
    with state_conf(spark):
        query = (state.writeStream.format("noop").outputMode("update")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    return query


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, keep (doc_id and row of the row that stays) and group_size, from the state itself."""
    s = spark.read.format("statestore").load(checkpoint)
    value = s.schema["value"].dataType.names
    return s.select(F.col("key")[s.schema["key"].dataType.names[0]].alias("digest"),
                    F.col("value")[value[0]].alias("keep"), F.col("value")[value[1]].alias("group_size"))


def _fits(hits: DataFrame, n: int) -> DataFrame:
    return F.broadcast(hits) if n <= BROADCAST_ROWS else hits


def _split(hits: DataFrame, n: int, limit: int | None = None) -> list[DataFrame]:
    """Hits in two: those of so many rows that there can only be ``BROADCAST_ROWS`` of them, to be broadcast, and the others.

    A shuffle join by digest then never meets a digest with a large share of the rows.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    if n <= limit:
        return [F.broadcast(hits)]
    rows = hits.agg(F.sum("group_size")).first()[0]
    large = F.col("group_size") > rows // limit
    return [F.broadcast(hits.where(large)), hits.where(~large)]


def _collided(docs: DataFrame, hits: DataFrame, n: int, digest) -> DataFrame:
    """Digests under which the full bytes of the rows are not all the same."""
    text = docs.select(normalised(F.col("text")).alias("content")).withColumn("digest", digest(F.col("content")))
    same = [text.join(h.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.min("content").alias("low"), F.max("content").alias("high"))
            for h in _split(hits, n)]
    return reduce(DataFrame.unionByName, same).where("low != high").select("digest")


def _grouped(rows: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """Every row with its group, if it has one."""
    first, *more = _split(groups, n)
    out = rows.join(first, "digest", "left")
    for g in more:  # rows that the first join left alone
        alone = out.where("keep_id IS NULL AND keep_row IS NULL AND group_size IS NULL").select(*rows.columns)
        out = out.where("group_size IS NOT NULL").unionByName(alone.join(g, "digest", "left"))
    return out


def exact_groups(docs: DataFrame, digest=sha256) -> DataFrame:
    """One row per input row: doc_id, digest, row, keep_id, keep_row, group_size, kept."""
    spark = docs.sparkSession
    rows = written(digest_rows(docs, digest), "exact-digests")
    path = rows.inputFiles()
    if not path:  # a table without any file
        return rows.select("doc_id", "digest", "row", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
                           F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    stream = spark.readStream.schema(rows.schema).parquet(path[0].rsplit("/", 1)[0])
    state = shared_dir(spark, "exact-state")
    dedup_stream(stream, state)
    with state_conf(spark):
        hits = written(read_state(spark, state).where("group_size > 1"), "exact-hits")
    n = hits.count()
    bad = written(_collided(docs, hits, n, digest), "exact-collided")
    groups = hits.select("digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size")
    if bad.isEmpty():
        found = _grouped(rows, groups, n)
    else:
        m = bad.count()
        # the same digest under different bytes: those rows are grouped by their text as well
        text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("content"),
                           F.monotonically_increasing_id().alias("row")).withColumn("digest", digest(F.col("content")))
        text = written(text.join(_fits(bad, m), "digest", "left_semi"), "exact-collided-rows")
        exact = text.groupBy("digest", "content").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
        exact = text.join(exact, ["digest", "content"]).select(
            "digest", "doc_id", "row", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size")
        found = rows.join(_fits(bad, m), "digest", "left_anti").transform(_grouped, groups, n).unionByName(exact)
    alone = F.col("keep_row").isNull()
    return found.select("doc_id", "digest", "row", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                        F.coalesce("keep_row", "row").alias("keep_row"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"))


def keep_rows(docs: DataFrame) -> DataFrame:
    """The documents without the copies, all columns as they came."""
    groups = written(exact_groups(docs), "exact-groups")
    by_id, by_text, mine = (free_name(docs, n) for n in ("_drop_id", "_drop_digest", "_text_digest"))
    key = [F.col("doc_id").alias(by_id), F.col("digest").alias(by_text)]
    kept_keys = groups.where("kept").select(F.col("doc_id").alias("_k_id"), F.col("digest").alias("_k_digest"))
    drop = written(groups.where("not kept").select(*key).distinct().join(
        kept_keys, F.col(by_id).eqNullSafe(F.col("_k_id")) & (F.col(by_text) == F.col("_k_digest")), "left")
        .select(by_id, by_text, F.col("_k_digest").isNotNull().alias("_repeated")), "exact-drop")
    n = drop.count()
    keyed = docs.withColumn(mine, sha256(normalised(F.col("text"))))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(by_id)) & (F.col(mine) == F.col(by_text))
    kept = keyed.join(_fits(drop.select(by_id, by_text), n), on, "left_anti").drop(mine)
    repeated = drop.where("_repeated").select(by_id, by_text)
    if not repeated.isEmpty():  # rows repeated as a whole: one of each stays
        again = keyed.join(_fits(repeated, n), on, "left_semi").dropDuplicates(["doc_id", mine])
        kept = kept.unionByName(again.drop(mine))
    return kept


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = exact_groups(table(spark, sf_dir, "documents"))
    return g.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP9_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
