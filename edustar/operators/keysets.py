"""Sets of whole-number keys as bitmap words: exact distinct counts, uniqueness and containment.

A set is rows of (group, word number, 64 bits): key k is bit k mod 64 of word k div 64. Over dense surrogate keys a word
stands for up to 64 keys, and a fact that lies in runs of consecutive keys (``keys.histogram_key`` leaves it so) fills its
words inside one task. Words are built by ``bit_or``, a hash aggregate with a map-side step, so what crosses
the network is words, not keys; sets add up over any coarser grouping by ``bit_or`` again, where distinct counts
would not. (The built-in 32,768-bit bitmap aggregates have binary buffers, for which Spark sorts its input.) Keys that
aren't dense, negative ones too, give right results with fewer keys a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD, BITS, ROWS = "_word", "_bits", "_rows"


def word_of(key: Column | str) -> Column:
    return F.shiftright(_long(key), 6)


def bit_of(key: Column | str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), _long(key).bitwiseAND(F.lit(63).cast("long")).cast("int"))


def _long(key: Column | str) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("long")


def key_sets(df: DataFrame, by: list[str], key: str, *more: Column) -> DataFrame:
    """(by..., word, bits, rows): the set of non-null keys in each group, and the rows behind each word."""
    return df.where(F.col(key).isNotNull()).groupBy(*by, word_of(key).alias(WORD)).agg(
        F.bit_or(bit_of(key)).alias(BITS), F.count(F.lit(1)).alias(ROWS), *more)


def union(sets: DataFrame, by: list[str]) -> DataFrame:
    """Sets of a coarser grouping."""
    return sets.groupBy(*by, WORD).agg(F.bit_or(BITS).alias(BITS), F.sum(ROWS).alias(ROWS))


def size() -> Column:
    """Keys in a group's words, as an aggregate over sets."""
    return F.coalesce(F.sum(F.bit_count(BITS)), F.lit(0)).cast("long")


def distinct_count(df: DataFrame, by: list[str], key: str, name: str) -> DataFrame:
    """(by..., name): the number of different non-null keys of each group that has one."""
    return key_sets(df, by, key).groupBy(*by).agg(size().alias(name))


def with_totals(df: DataFrame, by: list[str], key: str, name: str, totals: dict[str, Column]) -> DataFrame:
    """(by..., name, totals...): different non-null keys and aggregates of each group, in one pass over ``df``.

    ``totals``: aggregates that add up, by name; a name that begins with ``min_`` or ``max_`` goes on as such, others are summed.
    Rows are first reduced per group and word, then per group, so neither keys nor rows are shuffled.
    """
    words = df.groupBy(*by, word_of(key).alias(WORD)).agg(F.bit_or(bit_of(key)).alias(BITS), *[c.alias(k) for k, c in totals.items()])
    merged = [{"min_": F.min, "max_": F.max}.get(k[:4], F.sum)(k).alias(k) for k in totals]
    return words.groupBy(*by).agg(size().alias(name), *merged)


def moments(x: str, like: Column | None = None) -> dict[str, Column]:
    """Totals of a column from which ``mean`` and ``deviation`` are worked out."""
    v = (F.col(x) if like is None else like).cast("double")
    return {f"n_{x}": F.count(v), f"s_{x}": F.sum(v), f"q_{x}": F.sum(v * v), f"min_{x}": F.min(v), f"max_{x}": F.max(v)}


def mean(x: str) -> Column:
    return F.col(f"s_{x}") / F.nullif(F.col(f"n_{x}"), F.lit(0)).cast("double")


def deviation(x: str) -> Column:
    """Population standard deviation; exactly 0 where all values are one."""
    var = F.col(f"q_{x}") / F.nullif(F.col(f"n_{x}"), F.lit(0)).cast("double") - mean(x) * mean(x)
    return F.when(F.col(f"min_{x}") == F.col(f"max_{x}"), F.lit(0.0)).otherwise(F.sqrt(F.greatest(var, F.lit(0.0))))


def _where_any(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """``rows`` where ``bad`` has a row, else nothing; decided before the rows are shuffled."""
    return rows.where(bad.select(F.count(F.lit(1))).scalar() > 0)


def duplicated(keys: DataFrame, by: str, key: str) -> DataFrame:
    """(by, failures): how many key values occur more than once, for the groups that have such.

    A word with as many rows as bits holds no value twice; only the keys of the other words, if there are any, are
    shuffled and counted one by one.
    """
    keys = keys.where(F.col(key).isNotNull())
    sets = key_sets(keys, [by], key)
    bad = sets.where(F.col(ROWS) != F.bit_count(BITS)).select(by, WORD)
    per_key = _where_any(keys, bad).withColumn(WORD, word_of(key)).join(bad, [by, WORD], "left_semi") \
        .groupBy(by, key).agg(F.count(F.lit(1)).alias(ROWS))
    return per_key.groupBy(by).agg(F.count_if(F.col(ROWS) > 1).alias("failures"))


def missing(keys: DataFrame, known: DataFrame, by: str, key: str) -> DataFrame:
    """(by, failures): rows of ``keys`` whose key isn't among ``known``'s of the same group; a null key never is.

    A word of keys within the known word has none missing; only keys of the other words, if there are any, are looked up.
    """
    have = key_sets(known, [by], key).select(by, WORD, F.col(BITS).alias("_known"))
    gap = F.col(BITS).bitwiseAND(F.bitwise_not(F.coalesce("_known", F.lit(0).cast("long"))))
    bad = key_sets(keys, [by], key).join(have, [by, WORD], "left").where(gap != 0).select(by, WORD, gap.alias("_gap"))
    some = _where_any(keys.where(F.col(key).isNotNull()), bad).groupBy(by, key).agg(F.count(F.lit(1)).alias(ROWS))
    rows = some.withColumn(WORD, word_of(key)).join(bad, [by, WORD]).where(bit_of(key).bitwiseAND(F.col("_gap")) != 0)
    null = keys.where(F.col(key).isNull()).groupBy(by).agg(F.count(F.lit(1)).alias(ROWS))
    return rows.select(by, ROWS).unionByName(null).groupBy(by).agg(F.sum(ROWS).alias("failures"))
