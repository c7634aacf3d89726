"""Deterministic dedupe and distributed dense surrogate keys.

``row_number() OVER (ORDER BY k)`` without a partition runs in one task;
on a large dimension that task sorts everything alone. ``dense_key`` gives
the same 1..n numbering with the work spread over range partitions:

1. range-partition by the key and sort within partitions;
2. checkpoint to the shared checkpoint folder, so the partition boundaries
   are fixed (a recomputed range shuffle may sample different bounds);
3. count rows per partition (one row per partition, a proven size bound),
   turn the counts into offsets and broadcast them;
4. key = offset of the partition + position within it + 1.

``histogram_key`` numbers a fact by two dense keys: no sampling and no sort over all rows, since
counts per key say where each stretch of numbers begins.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from edustar.operators.joins import sized_broadcast
from edustar.session import ensure_checkpoint_dir


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order``, remaining columns break ties; nulls come last.

    ``min(struct(...))`` is an aggregate with a map-side partial step, so a
    key holding a large share of the rows is reduced before the shuffle
    instead of being sorted in one window partition.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = order + rest
    ranked = [x for i, c in enumerate(ordered) for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}"))]
    best = F.min(F.struct(*ranked)).alias("_best")
    agg = df.groupBy(*keys).agg(best)
    return agg.select(*keys, *[F.col(f"_best._o{i}").alias(c) for i, c in enumerate(ordered)]) \
              .select(*df.columns)


# Rows per range partition when numbering a dimension of known size.
ROWS_PER_KEY_PARTITION = 500_000


def partitions_for(rows: int | None) -> int | None:
    """Range partitions for ``rows`` input rows (None: use the shuffle default)."""
    if rows is None:
        return None
    return max(1, -(-rows // ROWS_PER_KEY_PARTITION))


def dense_key(df: DataFrame, order: list[str], key: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``key`` = 1..n in ascending ``order`` (which must be unique per row)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .checkpoint(eager=True))
    numbered = ranged.select("*", F.spark_partition_id().alias("_pid"),
                             F.monotonically_increasing_id().alias("_mid"))
    counts = ranged.groupBy(F.spark_partition_id().alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # n rows at most: one per partition, so the running total and broadcast are bounded.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    pos: Column = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (numbered.join(F.broadcast(offsets), "_pid")
            .select((F.col("_off") + pos + 1).alias(key), *df.columns))


# --- numbering by histogram ----------------------------------------------------------------------
# Rows that one bucket should hold at large sizes, and buckets per shuffle partition at small ones.
ROWS_PER_BUCKET = 1_000_000
BUCKETS_PER_PARTITION = 8
COPIES_PER_ARRAY = 1024


def _written(df: DataFrame, name: str, **observed: Column) -> tuple[DataFrame, dict]:
    """``df`` written to the shared folder and read back, with aggregates observed while writing."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    obs = Observation(name)
    df.observe(obs, *[c.alias(k) for k, c in observed.items()]).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), obs.get


def _before(counts: DataFrame, order: str, *by: str) -> Column:
    """Rows counted before each entry of a histogram (column ``_n``)."""
    w = (Window.partitionBy(*by) if by else Window).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(w), F.lit(0))


@dataclass(frozen=True)
class Histogram:
    """Rows per value of a dense key (key, ``_n``), written, with their sum, the largest count and the largest key."""

    table: DataFrame
    total: int
    most: int
    top: int

    @classmethod
    def of(cls, keys: DataFrame, first: str) -> "Histogram":
        counts = keys.groupBy(first).agg(F.count(F.lit(1)).alias("_n"))
        table, seen = _written(counts, "key-histogram", total=F.sum("_n"), most=F.max("_n"), top=F.max(first))
        return cls(table, seen["total"] or 0, seen["most"] or 0, seen["top"] or 1)


def histogram_key(rows: DataFrame, first: str, second: str, order: list[str], key: str, keys: DataFrame | None = None,
                  known: Histogram | None = None) -> DataFrame:
    """Add ``key`` = 1..n in ascending (first, second, *order), without sampling, ranges or a global sort.

    ``first`` and ``second`` are dense surrogate keys (1..m). The rows are counted per ``first`` (a map-side
    aggregate over ``keys``, by default the two columns of ``rows``); consecutive values make arithmetic buckets
    of about equal width, whose counts, added up, are the bucket's offset. The rows are shuffled once, by bucket, and
    numbered inside it, so ids of one task are runs of consecutive numbers.

    A value that holds more rows than two buckets should leaves its bucket and is split by ``second``, with offsets from
    a second histogram over such rows alone. A pair that still holds that many rows has few distinct ``order`` values
    per row; its equal rows are counted map-side, numbered as one entry and written out again by many tasks.
    Rows that agree in all of these columns take consecutive numbers. ``known``: the histogram of ``first``, if there is one already.
    """
    spark = rows.sparkSession
    keys = (rows if keys is None else keys).select(first, second)
    n = F.count(F.lit(1)).alias("_n")
    known = known or Histogram.of(keys, first)
    hist, total, top = known.table, known.total, known.top
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(top, max(-(-total // ROWS_PER_BUCKET), BUCKETS_PER_PARTITION * parts)))
    # as many tasks as stated: merged by compressed bytes, they would sort several times as many rows each
    tasks = max(parts, -(-total // ROWS_PER_BUCKET))
    width, limit = -(-top // buckets), max(2 * total // buckets, 1)
    bucket = F.floor((F.col(first) - 1) / width).alias("_b")
    # one entry per bucket: the running total and its broadcast are bounded by ``buckets``
    at = hist.groupBy(bucket).agg(F.sum("_n").alias("_n"))
    at = at.select("_b", _before(at, "_b").alias("_at"))
    if known.most <= limit:
        w = Window.partitionBy("_b").orderBy(first, second, *order)
        return rows.withColumn("_b", bucket).repartition(tasks, "_b").withColumn("_i", F.row_number().over(w)).join(F.broadcast(at), "_b") \
            .select((F.col("_at") + F.col("_i")).alias(key), *rows.columns)

    # fewer than half as many as there are buckets
    hot = hist.where(F.col("_n") > limit).select(first, "_n", bucket)
    beside = hot.groupBy("_b").agg(F.collect_list(F.struct(F.col(first).alias("k"), F.col("_n").alias("n"))).alias("_hot"))
    at = at.join(F.broadcast(beside), "_b", "left")
    lower = hist.select(F.col(first).alias("_k"), F.col("_n").alias("_m"), bucket).join(F.broadcast(hot.drop("_n")), "_b").where(F.col("_k") < F.col(first)) \
        .groupBy(first).agg(F.sum("_m").alias("_lower"))
    start = hot.join(F.broadcast(at.select("_b", "_at")), "_b").join(lower, first, "left") \
        .select(first, (F.col("_at") + F.coalesce("_lower", F.lit(0))).alias("_start"))
    pairs, seen = _written(keys.join(F.broadcast(hot.select(first)), first, "left_semi").groupBy(first, second).agg(n), "pair-histogram", most=F.max("_n"))
    pairs = pairs.select(first, second, "_n", _before(pairs, second, first).alias("_in")).join(F.broadcast(start), first) \
        .select(first, second, "_n", (F.col("_start") + F.col("_in")).alias("_pair_at"))
    large = None
    if (seen["most"] or 0) > limit:
        large = F.broadcast(pairs.where(F.col("_n") > limit).select(first, second, "_pair_at"))  # as few again
        rest = rows.join(large.drop("_pair_at"), [first, second], "left_anti").select(*rows.columns)
    else:
        rest = rows
    tagged = rest.withColumn("_b", bucket).join(F.broadcast(hot.select(first, F.lit(True).alias("_is_hot"))), first, "left") \
        .withColumn("_s1", F.when(F.col("_is_hot"), F.col(first))).withColumn("_s2", F.when(F.col("_is_hot"), F.col(second)))
    w = Window.partitionBy("_b", "_s1", "_s2").orderBy(first, second, *order)
    numbered = tagged.repartition(tasks, "_b", "_s1", "_s2").withColumn("_i", F.row_number().over(w)).join(F.broadcast(at), "_b")
    p = sized_broadcast(pairs.select(F.col(first).alias("_s1"), F.col(second).alias("_s2"), "_pair_at"))
    numbered = numbered.join(p, ["_s1", "_s2"], "left")
    passed = F.aggregate(F.filter(F.coalesce("_hot", F.array().cast("array<struct<k:bigint,n:bigint>>")), lambda h: h["k"] < F.col(first)),
                         F.lit(0).cast("long"), lambda s, h: s + h["n"])
    out = numbered.select((F.coalesce("_pair_at", F.col("_at") + passed) + F.col("_i")).alias(key), *rows.columns)
    if large is None:
        return out
    same = rows.join(large, [first, second]).groupBy(*rows.columns, "_pair_at").agg(n)
    w = Window.partitionBy(first, second).orderBy(*order, *[c for c in rows.columns if c not in (first, second, *order)])
    same = same.withColumn("_at", F.col("_pair_at") + F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    size = F.lit(COPIES_PER_ARRAY)
    chunks = same.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / size)))).repartition(parts)
    each = F.sequence(F.col("_c") * size + 1, F.least(F.col("_n"), (F.col("_c") + 1) * size))
    return out.unionByName(chunks.withColumn("_i", F.explode(each)).select((F.col("_at") + F.col("_i")).alias(key), *rows.columns))
