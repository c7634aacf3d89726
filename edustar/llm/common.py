"""Shared helpers of the training-data operators: inputs, shared folders, Arrow batches, word fingerprints."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_BYTES = 1 << 20  # text handled at once inside a task: bounds the arrays built from it
ARROW_BYTES = 4 << 20  # of an Arrow batch between Spark and Python (one row at least)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (set here only for a local session that has none)."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="edustar-llm-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (names differ in more than case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Give executors this package where their Python path lacks it (``addPyFile`` of a zip of the package).

    Arrow batches are bounded by bytes as well, since ten thousand rows of text may be anything.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")) > ARROW_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if here in paths or getattr(sc, "_edustar_shipped", False):
        return
    pkg = os.path.join(here, "edustar")
    fd, out = tempfile.mkstemp(prefix="edustar-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(out, "w") as z:
        for d, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    f = os.path.join(d, n)
                    z.write(f, os.path.relpath(f, here))
    sc.addPyFile(out)
    sc._edustar_shipped = True


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = TEXT_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into slices of about ``limit`` bytes of text; null text becomes empty.

    The slices are found in the offsets, so only one slice's texts are Python objects at a time. A text longer
    than ``limit`` makes a slice of its own and is never cut.
    """
    for b in batches:
        for start, end, texts in slices(b.column(b.schema.get_field_index(text)), limit):
            yield b.slice(start, end - start), texts


def slices(column: pa.Array, limit: int = TEXT_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Start, end and texts of the slices of a text column (see ``chunks``)."""
    raw = column.cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8) if len(raw) else ()
    start = 0
    while start < len(raw):
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield start, end, [v or b"" for v in raw.slice(start, end - start).to_pylist()]
        start = end


def one_row_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids`` (few rows, a doc_id once), with ids' columns.

    Of repeated doc_ids the row with the least text fingerprint stays, found map-side, so no more rows come than ``ids`` has.
    """
    more = [c for c in ids.columns if c != "doc_id"]
    rest = [c for c in docs.columns if c != "doc_id"]
    one = F.min(F.struct(F.xxhash64("text").alias("_h"), *rest)).alias("_r")
    return docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", *more).agg(one).select("doc_id", *more, *[F.col(f"_r.{c}") for c in rest])


# --- word fingerprints ---------------------------------------------------------------------------
# A word's 64-bit fingerprint is a polynomial over a fixed random value per byte, modulo 2**64, mixed
# and tied to the word's length; all words of a slice are computed with a few array passes.

_VALUES = np.random.default_rng(20240917).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33, _S31 = np.uint64(33), np.uint64(31)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        m = max(n, TEXT_BYTES * 5 // 4)
        for k, base in (("p", _P), ("i", _P_INV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _POWERS[k] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["p"], _POWERS["i"]


def words(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased), and each text's offset into them."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=off[1:])
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    start, end = edge[0::2], edge[1::2]
    pw, inv = _powers(len(buf) + 1)
    v = _VALUES[_LOWER[buf] if lower else buf]
    v *= pw[: len(buf)]
    h = np.empty(len(buf) + 1, np.uint64)
    h[0] = 0
    np.cumsum(v, dtype=np.uint64, out=h[1:])
    w = mix((h[end] - h[start]) * inv[start] + (end - start).astype(np.uint64) * _M1)
    if len(buf) > 4 * TEXT_BYTES:
        _POWERS.clear()
    return w, np.searchsorted(start, off)


def shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's sorted distinct ``k``-word shingle fingerprints; fewer words: the whole sequence as one."""
    w, off = words(texts)
    n = len(w)
    s = np.zeros(n, np.uint64)
    for j in range(k):
        m = n - j
        if m <= 0:
            break
        s[:m] = (s[:m] + w[j:]) * _P
        s ^= s >> _S31
    out = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        m = b - a
        if m >= k:
            x = np.sort(s[a : b - k + 1])
            keep = np.empty(len(x), bool)
            keep[0] = True
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        elif m == 0:
            out.append(s[:0])
        else:  # a short sequence is told apart from a longer one by its word count
            x = np.full(1, m, np.uint64)
            for y in w[a:b]:
                x = mix((x + y) * _P)
            out.append(x)
    return out
