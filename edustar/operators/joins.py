"""Join helpers: broadcast only behind an explicit size check; hot keys salted.

Two ways a shuffle join goes wrong at scale, and what is done about each:

* **Broadcasting something that grows.** ``sized_broadcast`` ships a side to
  every task only when its rows times their width are within ``BROADCAST_MAX_BYTES``.
* **A hot key.** In a shuffle join every row of one key lands in one task;
  a key holding a third of the rows makes that task a third of the job.
  ``detect_hot_keys`` finds the keys that hold more than one partition's share
  of a sample of the big side; since shares sum to one, there are at most as many
  as partitions. ``HotKeys.join`` spreads each hot key's big-side rows
  over several salt buckets while the small side's rows for that key are
  copied into every bucket. Every big row still meets exactly the small
  rows of its key, so inner, left and left-anti results are unchanged;
  non-hot keys keep salt 0 and are not copied.

``lookup_join`` combines both: broadcast when the small side is bounded,
otherwise a (salted where needed) shuffle join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edustar.session import ensure_checkpoint_dir

# Bytes up to which a dimension is shipped to every task.
BROADCAST_MAX_BYTES = 64 * 1024 ** 2
STRING_BYTES = 48  # a string column's assumed width; other types have their own

# Hot-key detection: rows sampled per shuffle partition (so a key of one partition's share
# is met about this often), and the smallest sample.
SAMPLE_PER_PARTITION = 200
LEAST_SAMPLE_ROWS = 200_000
# Buckets per partition-share of a hot key: a bucket is about 1/8 of an average
# partition, so buckets landing on the same task (hash collisions) average out.
# Hot shares sum to at most 1, so all hot keys together get at most 8 x partitions
# buckets (and one more each), which bounds the copies of small-side rows.
BUCKETS_PER_PARTITION_SHARE = 8
HOT_SEED = 17

SALT = "_salt"
BUCKETS = "_buckets"


def row_bytes(schema: T.StructType) -> int:
    """A row's assumed width in a broadcast table."""
    width = {T.StringType: STRING_BYTES, T.BinaryType: STRING_BYTES, T.IntegerType: 4, T.FloatType: 4, T.BooleanType: 1}
    return 16 + sum(width.get(type(f.dataType), 8) for f in schema.fields)


def sized_broadcast(df: DataFrame, max_bytes: int | None = None,
                    known_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its rows take at most ``max_bytes``, else ``df`` unchanged.

    ``known_rows`` skips the count when the caller already knows the size
    (e.g. from a materialised table's write metrics). Above the bound the
    join stays a shuffle join, which AQE may still turn into a broadcast or
    split for skew at run time.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes, known_rows) else df


def fits_broadcast(df: DataFrame, max_bytes: int | None = None, known_rows: int | None = None) -> bool:
    limit = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    n = known_rows if known_rows is not None else df.count()
    return n * row_bytes(df.schema) <= limit


@dataclass
class HotKeys:
    """Keys of a join that hold more than one shuffle partition's share of rows.

    ``table`` has the key columns plus ``_buckets`` (salt buckets for that
    key); shares above 1/p sum to at most one, so it has fewer rows than the join has
    partitions and broadcasting it is bounded. ``table`` is None when no key is hot:
    joins then stay plain.
    """

    keys: list[str]
    table: DataFrame | None

    @property
    def any(self) -> bool:
        return self.table is not None

    def salt(self, big: DataFrame) -> DataFrame:
        """Add ``_salt``: for hot keys a hash of the whole row and of the task's
        partition index modulo the key's bucket count, 0 otherwise.

        The partition index splits a group of identical rows (copies) by the
        input split they come from, where a hash of the row alone would send
        them all to one bucket. Both parts survive recomputation: a lost task
        is re-run on the same partition, whose set of rows is fixed (only
        their order may change), so every row gets the same bucket again.
        """
        if not self.any:
            return big
        h = F.broadcast(self.table)
        salted = big.join(h, self.keys, "left")
        b = F.coalesce(F.col(BUCKETS), F.lit(1))
        s = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns], F.spark_partition_id()),
                   b.cast("long")).cast("int")
        return salted.select(*big.columns, s.alias(SALT))

    def spread(self, small: DataFrame) -> DataFrame:
        """Copy each small-side row of a hot key into all of its buckets."""
        if not self.any:
            return small
        h = F.broadcast(self.table)
        spread = small.join(h, self.keys, "left")
        b = F.coalesce(F.col(BUCKETS), F.lit(1))
        return spread.select(*small.columns, F.explode(F.sequence(F.lit(0), b - 1)).alias(SALT))

    def join(self, salted_big: DataFrame, small: DataFrame, how: str = "inner") -> DataFrame:
        """Join a ``salt``-ed big side to a small side; keeps ``_salt`` for
        further joins on the same keys (drop it with ``unsalt``)."""
        if how not in ("inner", "left", "left_outer", "left_anti", "left_semi"):
            raise ValueError(f"salted join supports inner/left/semi/anti, not {how}")
        if not self.any:
            return salted_big.join(small, self.keys, how)
        return salted_big.join(self.spread(small), [*self.keys, SALT], how)

    @staticmethod
    def unsalt(df: DataFrame) -> DataFrame:
        return df.drop(SALT) if SALT in df.columns else df


def detect_hot_keys(df: DataFrame | None, keys: list[str], known_rows: int | None = None,
                    partitions: int | None = None,
                    sampler: Callable[[float], DataFrame] | None = None) -> HotKeys:
    """Keys whose share of ``df`` exceeds one shuffle partition's share.

    A seeded Bernoulli sample, larger the more partitions there are, is counted per key
    (partial aggregate). The keys stay a DataFrame, checkpointed so that both sides of a join
    see the same ones. Which keys are salted never changes a join's result, only how
    its rows are spread over tasks, so a sample is enough. Pass
    ``known_rows`` for derived frames (a plain Parquet scan counts cheaply).
    ``sampler(fraction)`` builds the key columns from a sample taken before
    any join (Spark does not push a sample below a join), instead of
    sampling ``df`` itself.
    """
    if sampler is None:
        def sampler(frac: float) -> DataFrame:
            k = df.select(*keys)
            return k.sample(False, frac, seed=HOT_SEED) if frac < 1.0 else k
    total = known_rows if known_rows is not None else (df if df is not None else sampler(1.0)).count()
    if total == 0:
        return HotKeys(keys, None)
    whole = sampler(1.0).select(*keys)
    spark = whole.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if p <= 1:
        return HotKeys(keys, None)
    frac = min(1.0, max(LEAST_SAMPLE_ROWS, SAMPLE_PER_PARTITION * p) / total)
    sample = sampler(frac).select(*keys) if frac < 1.0 else whole
    sampled = total * frac
    share = F.col("_hits") / F.lit(float(sampled))
    ensure_checkpoint_dir(spark)
    hot = (sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits"))
           .filter((F.col("_hits") > 1) & (share > 1.0 / p))
           .select(*keys, F.greatest(F.lit(2), F.ceil(share * (BUCKETS_PER_PARTITION_SHARE * p)).cast("int")).alias(BUCKETS))
           .checkpoint(eager=True))
    return HotKeys(keys, None if hot.isEmpty() else hot)


def skew_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
              hot: HotKeys | None = None, big_rows: int | None = None, rows_per_task: int | None = None) -> DataFrame:
    """Shuffle join of ``big`` to ``small`` with hot keys of ``big`` salted.

    ``rows_per_task`` (with ``big_rows``) states how many tasks join, at least the shuffle's partitions: where rows are
    narrow, partitions merged by their compressed bytes hold many times as many rows in memory.
    """
    hot = hot or detect_hot_keys(big, keys, big_rows)
    salted = hot.salt(big)
    if rows_per_task and big_rows:
        parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = salted.repartition(max(parts, -(-big_rows // rows_per_task)), *keys, *([SALT] if hot.any else []))
    return HotKeys.unsalt(hot.join(salted, small, how))


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                small_rows: int | None = None,
                hot: Callable[[], HotKeys] | None = None) -> DataFrame:
    """Broadcast join when ``small`` is within the size bound; else a shuffle
    join with hot keys salted. ``hot`` (a thunk, so it only runs on the
    shuffle path) detects hot keys on a cheap source with the same key
    distribution as ``big``; by default ``big`` itself is sampled."""
    if fits_broadcast(small, known_rows=small_rows):
        return big.join(F.broadcast(small), keys, how)
    return skew_join(big, small, keys, how, hot=hot() if hot else None)


COPIES = "_copies"


def collapse_copies(df: DataFrame) -> DataFrame:
    """Identical rows → one row with their count in ``_copies``.

    A partial aggregate: a group of copies (even a third of the table) is
    reduced map-side before the shuffle, so it never reaches one task whole.
    Join the collapsed side, then ``expand_copies`` restores the fan-out.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


# Copies generated per array when a collapsed row is expanded: two levels of
# explode (chunks, then rows in a chunk) keep every array this size or less.
COPY_CHUNK = 1024


def most_copies(collapsed: DataFrame) -> int:
    """The largest copy count of a collapsed (and best written) table."""
    return collapsed.agg(F.max(COPIES)).first()[0] or 1


def expand_copies(df: DataFrame, most: int) -> DataFrame:
    """Repeat each row ``_copies`` times (once where the join found no match)
    and drop the count: the rows a join to the uncollapsed side would give.

    ``most`` is the largest count there is. Rows are generated chunk by chunk, and
    where a row has several chunks these are dealt over all tasks before the rows are
    made, so a group of a billion copies is no single array and no single task's work.
    """
    if most <= 1:
        return df.drop(COPIES)
    n = F.coalesce(F.col(COPIES), F.lit(1)).cast("long")
    chunk = F.lit(COPY_CHUNK).cast("long")
    if most > COPY_CHUNK:
        p = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk)))).repartition(p)
        n = F.least(chunk, n - F.col("_chunk") * chunk)
    return (df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), n)))
            .drop("_copy", "_chunk", COPIES))
