"""Line deduplication: a line that stands in several documents stays in the first of them.

A line's key is the line with white space ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased; keys of
fewer than ``min_chars`` code points are left alone. The keys' 128-bit hashes, without any text, are range-partitioned
and sorted by (hash, document, position); a running first value then streams over each hash's lines, and every
line of another document than the first one is dropped. The dropped places come back as one compressed keep
bitmap per document: the runs of lines that stay, as (start, length). ``apply_bitmaps`` cuts the texts with them.

Only DataFrame functions are used. A hash that holds more than a partition's share of the lines is salted before
the range partitioning, so its lines lie in many ranges; its first document is one aggregate (reduced map-side)
over the hot hashes alone, of which there are fewer than partitions.

Defined results: null or empty text is one empty line. Null doc_ids count as one document that comes after all
others. Rows with the same doc_id are one document: a line isn't dropped because of its own document, and a bitmap
belongs to (doc_id, hash of the text), so that rows with one doc_id and different texts keep bitmaps of their own
and repeated rows share one. A document that loses all its lines keeps an empty text. An empty table gives an
empty result. Only doc_id and text are read; further columns of any name have no effect and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edustar.operators.joins import SALT, detect_hot_keys

from .common import free_name, table, written

MIN_CHARS = 10
BROADCAST_BYTES = 16 << 20  # bitmaps are broadcast up to this many bytes, joined by shuffle beyond
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def line_key(line: Column) -> Column:
    """The stripped line, A-Z lower-cased (``lower`` does just that where all characters are ASCII)."""
    k = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(k) == F.char_length(k), F.lower(k)).otherwise(F.translate(k, UPPER, LOWER))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, n_lines, pos (from 0) and the key's hash (h1, h2) of every line whose key is long enough."""
    lines = F.split(F.col("text"), "\n")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    rows = d.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(lines).alias("n_lines"), F.posexplode(lines).alias("pos", "line"))
    rows = rows.where(F.char_length(F.btrim("line", F.lit(SPACE))) >= min_chars)
    key = line_key(F.col("line"))
    return rows.select("doc_id", "text_hash", "n_lines", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def dropped_lines(rows: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_lines and pos of the lines that go; ``rows`` are written ``line_rows``."""
    hot = detect_hot_keys(rows, ["h1", "h2"])
    salted, keys = hot.salt(rows), ["h1", "h2", *([SALT] if hot.any else [])]
    ranged = salted.repartitionByRange(*keys).sortWithinPartitions(*keys, F.col("doc_id").asc_nulls_last(), "pos")
    w = Window.partitionBy(*keys).orderBy(F.col("doc_id").asc_nulls_last(), "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranged.withColumn("first_id", F.first("doc_id").over(w))
    if not hot.any:
        return seen.where(~F.col("doc_id").eqNullSafe(F.col("first_id"))).select("doc_id", "text_hash", "n_lines", "pos")
    keyed = F.broadcast(hot.table.select("h1", "h2"))
    firsts = written(rows.join(keyed, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min("doc_id").alias("hot_id")), "line-hot")
    seen = seen.join(F.broadcast(firsts.withColumn("hot", F.lit(True))), ["h1", "h2"], "left")  # a row per hot hash, fewer than partitions
    first = F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("first_id"))
    return seen.where(~F.col("doc_id").eqNullSafe(first)).select("doc_id", "text_hash", "n_lines", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per document that loses lines: doc_id, text_hash, n_lines, n_dropped, keep.

    ``keep`` is the run-length compressed bitmap: array of (start, length) of the lines that stay, in order.
    """
    gone = dropped_lines(written(line_rows(docs, min_chars), "lines"))
    g = gone.groupBy("doc_id", "text_hash", "n_lines").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    gone_, last = F.col("gone"), F.size("gone") - 1
    starts = F.filter(gone_, lambda x, i: (i == 0) | (F.get(gone_, i - 1) != x - 1))
    ends = F.filter(gone_, lambda x, i: (i == last) | (F.get(gone_, i + 1) != x + 1))
    g = g.select("doc_id", "text_hash", "n_lines", F.size("gone").cast("long").alias("n_dropped"),
                 F.concat(F.array(F.lit(0)), F.transform(ends, lambda x: x + 1)).alias("open"),
                 F.concat(starts, F.array("n_lines")).alias("shut"))
    runs = F.zip_with("open", "shut", lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
    return g.select("doc_id", "text_hash", "n_lines", "n_dropped", F.filter(runs, lambda r: r["length"] > 0).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``keep``, joined by newline; the text is split once."""
    one = F.transform(F.array(F.split(text, "\n")), lambda ls: F.array_join(
        F.flatten(F.transform(keep, lambda r: F.slice(ls, r["start"] + 1, r["length"]))), "\n"))
    return F.get(one, F.lit(0))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str]:
    """All rows of ``docs`` with their bitmap (null: nothing goes) in a struct column, whose name is returned.

    Bitmaps up to ``BROADCAST_BYTES`` go to every task, so that no text is shuffled; beyond, both sides are shuffled by document.
    """
    bitmaps = written(bitmaps, "line-bitmaps")
    size = bitmaps.agg(F.sum(F.size("keep") * 16 + 64)).first()[0] or 0
    name, by_id, by_text = (free_name(docs, n) for n in ("_bitmap", "_bitmap_id", "_bitmap_text"))
    b = bitmaps.select(F.col("doc_id").alias(by_id), F.col("text_hash").alias(by_text), F.struct("n_lines", "n_dropped", "keep").alias(name))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(by_id)) & (F.xxhash64(whole(F.col("text"))) == F.col(by_text))
    return docs.join(F.broadcast(b) if size <= BROADCAST_BYTES else b, on, "left").drop(by_id, by_text), name


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents without the dropped lines; other columns as they came, untouched texts too."""
    d, b = with_bitmaps(docs, bitmaps)
    return d.withColumn("text", F.when(F.col(b).isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col(b)["keep"]))).drop(b)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    d, b = with_bitmaps(docs, keep_bitmaps(docs))
    text, b = whole(F.col("text")), F.col(b)
    n_lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    return d.select("doc_id", n_lines.alias("n_lines"), F.coalesce(b["n_dropped"], F.lit(0).cast("long")).alias("n_dropped"),
                    F.sha2(F.when(b.isNull(), text).otherwise(kept_text(text, b["keep"])), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.doc_id, pos, line, coalesce(first_id < k.doc_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
