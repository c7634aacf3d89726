"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + <w, x> + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)), so all pairwise
interactions cost one pass over a document's features. Words are fingerprinted and hashed to ``WORD_DIMS``
features of equal length per document; the structure statistics describe bytes, words and lines of the whole
text; the metadata is n_chars. Labels, lang, source and doc_id are no inputs.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows (the smallest hashes of doc_id among the rows of
the learning fold), every row is scored where it lies.

Defined results: null text counts as empty; an empty text gets a score from its (constant) statistics. Null
n_chars counts as 0. A row with a null doc_id is scored and is not held out. Labels that are null are
skipped, repeated labels of a doc_id count once (the smallest). Without labels of both kinds every score
is the share of label 1 among them (0.5 without any). Repeated rows are scored each. Extra columns have no
effect; the result holds only the columns named here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _SPACE, chunks, one_row_each, table, words

WORD_BITS, FACTORS = 13, 8
WORD_DIMS = 1 << WORD_BITS
TRAIN_ROWS, EPOCHS, BATCH = 6000, 12, 64
LEAST_STEPS = 1100  # few rows are gone through more often
THRESHOLD = 0.7
SEED = 7

_CLASS = np.full(256, 7, np.int64)  # 7: other symbols
_CLASS[np.arange(97, 123)] = 0
_CLASS[np.arange(65, 91)] = 1
_CLASS[np.arange(48, 58)] = 2
_CLASS[_SPACE] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_CLASS[128:] = 6
STATS = 8 + 9


def held_out(doc_id: Column, parts: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == fold, F.lit(False))


def features(texts: list[bytes], n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics (row per text), and the distinct hashed words of all texts with each text's offset into them."""
    m = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.bincount(np.repeat(np.arange(m) * 8, size) + _CLASS[buf], minlength=8 * m).reshape(m, 8)
    w, off = words(texts)
    n = np.diff(off)
    doc = np.repeat(np.arange(m), n)
    key = np.sort((doc << WORD_BITS) | (w >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    first = np.flatnonzero(np.diff(key, prepend=-1))
    ids, of = key[first] & (WORD_DIMS - 1), key[first] >> WORD_BITS
    distinct = np.bincount(of, minlength=m)
    run = np.diff(np.append(first, len(key)))
    most = np.zeros(m, np.int64)
    np.maximum.at(most, of, run)
    twice = np.zeros(m, np.int64)
    if len(w) > 1:
        same = (w[1:] == w[:-1]) & (doc[1:] == doc[:-1])
        twice = np.bincount(doc[1:][same], minlength=m)
    lines = counts[:, 4] + 1
    share = counts / np.maximum(size, 1)[:, None]
    per = np.maximum(n, 1)
    s = np.column_stack((
        share, np.log1p(n), size / per, distinct / per, most / per, twice / per, np.log1p(lines), np.log1p(n / lines),
        np.log1p(n_chars), size == 0))
    return s, ids, np.searchsorted(of, np.arange(m + 1))


def _n_chars(batch: pa.RecordBatch) -> np.ndarray:
    k = batch.schema.get_field_index("n_chars")
    return np.array([max(v or 0, 0) for v in batch.column(k).to_pylist()], float) if k >= 0 else np.zeros(batch.num_rows)


class FactorisationMachine:
    """Weights of the statistics (``ws``, ``vs``) and words (``ww``, ``vw``) and the scaling of the statistics."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, bias: float = 0.0):
        r = np.random.default_rng(SEED)
        self.mean, self.std, self.w0 = mean, std, bias
        self.ws, self.vs = np.zeros(STATS), r.normal(0, 0.02, (STATS, FACTORS))
        self.ww, self.vw = np.zeros(WORD_DIMS), r.normal(0, 0.02, (WORD_DIMS, FACTORS))

    def scaled(self, s: np.ndarray) -> np.ndarray:
        return np.clip((s - self.mean) / self.std, -5, 5) / np.sqrt(STATS)

    def sums(self, x, ids, off):
        """Per text: sum of w x, of v x and of v^2 x^2 (one pass over the features)."""
        n = np.diff(off)
        scale = 1 / np.sqrt(np.maximum(n, 1))
        pad = np.append(ids, 0)  # reduceat needs an element after the last text
        full = n > 0
        lin, vec, sq = np.zeros(len(n)), np.zeros((len(n), FACTORS)), np.zeros((len(n), FACTORS))
        if full.any():
            at = off[:-1][full]
            lin[full] = np.add.reduceat(self.ww[pad[:-1]], at)
            v = self.vw[pad[:-1]]
            vec[full] = np.add.reduceat(v, at, axis=0)
            sq[full] = np.add.reduceat(v * v, at, axis=0)
        return x @ self.ws + lin * scale, x @ self.vs + vec * scale[:, None], (x * x) @ (self.vs ** 2) + sq * (scale ** 2)[:, None], scale

    def logit(self, stats, ids, off) -> np.ndarray:
        lin, vec, sq, _ = self.sums(self.scaled(stats), ids, off)
        return self.w0 + lin + 0.5 * (vec ** 2 - sq).sum(1)

    def fit(self, stats, ids, off, y) -> None:
        """Logistic loss by AdaGrad in a fixed order of mini-batches."""
        x_all, r = self.scaled(stats), np.random.default_rng(SEED)
        n = np.diff(off)
        par = {"w0": np.zeros(1), "ws": self.ws, "vs": self.vs, "ww": self.ww, "vw": self.vw}
        par["w0"][0] = self.w0
        acc = {k: np.full(v.shape, 1e-2) for k, v in par.items()}
        rate, l2 = 0.15, 1e-5

        def step(name, at, g):
            g = g + l2 * par[name][at]
            acc[name][at] += g * g
            par[name][at] -= rate * g / np.sqrt(acc[name][at])

        for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // len(y))):
            order = r.permutation(len(y))
            for k in range(0, len(y), BATCH):
                d = order[k:k + BATCH]
                cut = np.concatenate(([0], np.cumsum(n[d])))
                own = np.concatenate([ids[off[i]:off[i + 1]] for i in d]) if cut[-1] else ids[:0]
                x = x_all[d]
                lin, vec, sq, scale = self.sums(x, own, cut)
                z = par["w0"][0] + lin + 0.5 * (vec ** 2 - sq).sum(1)
                e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[d]) / len(d)
                step("w0", slice(None), np.array([e.sum()]))
                gs = x.T @ e, x.T @ (e[:, None] * vec) - self.vs * ((x * x).T @ e)[:, None]
                if len(own):
                    doc = np.repeat(np.arange(len(d)), n[d])
                    xe = scale[doc]
                    gw = e[doc] * xe
                    gv = gw[:, None] * vec[doc] - self.vw[own] * (gw * xe)[:, None]
                    u, back = np.unique(own, return_inverse=True)
                    sw, sv = np.zeros(len(u)), np.zeros((len(u), FACTORS))
                    np.add.at(sw, back, gw)
                    np.add.at(sv, back, gv)
                    step("ww", u, sw)
                    step("vw", u, sv)
                step("ws", slice(None), gs[0])
                step("vs", slice(None), gs[1])
        self.w0 = float(par["w0"][0])

    def compact(self) -> "FactorisationMachine":
        self.ww, self.vw = self.ww.astype(np.float32), self.vw.astype(np.float32)
        return self


def _train_features(batches):
    for b, texts in chunks(batches):
        s, ids, off = features(texts, _n_chars(b))
        yield pa.RecordBatch.from_arrays([
            pa.array(list(s), pa.list_(pa.float64())), pa.array([ids[i:j].astype(np.int16).tobytes() for i, j in zip(off[:-1], off[1:])], pa.binary()),
            b.column(b.schema.get_field_index("y"))], names=["stats", "ids", "y"])


def with_metadata(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _length(docs).alias("n_chars"))


def _length(docs: DataFrame) -> Column:
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(0.0)


def train(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> FactorisationMachine | float:
    """Fit on at most ``rows`` labelled documents; ``learn`` says on the column doc_id which labels may be used."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")) \
        .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull()).where(learn) \
        .groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    got = one_row_each(with_metadata(docs), y).mapInArrow(_train_features, "stats array<double>, ids binary, y int").toArrow()
    y = got.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    stats = np.array(got.column("stats").to_pylist())
    words_of = [np.frombuffer(v, np.int16).astype(np.int64) for v in got.column("ids").to_pylist()]
    order = np.lexsort((np.array([int(v.sum()) for v in words_of]), *stats.T))  # independent of the order rows arrive in
    stats, y, words_of = stats[order], y[order], [words_of[i] for i in order]
    off = np.concatenate(([0], np.cumsum([len(v) for v in words_of])))
    model = FactorisationMachine(stats.mean(0), stats.std(0) + 1e-6, float(np.log(y.mean() / (1 - y.mean()))))
    model.fit(stats, np.concatenate(words_of), off, y)
    return model.compact()


def _score(model):
    def run(batches):
        for b, texts in chunks(batches):
            if isinstance(model, float):
                p = np.full(len(texts), model)
            else:
                s, ids, off = features(texts, _n_chars(b))
                p = 1 / (1 + np.exp(-np.clip(model.logit(s, ids, off), -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(p, pa.float64())], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model) -> DataFrame:
    return with_metadata(docs).mapInArrow(_score(model), "doc_id long, score double")


def _accept(model, threshold):
    score = _score(model)

    @F.arrow_udf("boolean")
    def keep(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, n_chars in columns:
            b = pa.RecordBatch.from_arrays([pa.nulls(len(text), pa.int64()), text, n_chars], names=["doc_id", "text", "n_chars"])
            kept = [x.column(1).to_numpy() >= threshold for x in score([b])]
            yield pa.array(np.concatenate(kept) if kept else [], pa.bool_())
    return keep


def accepted(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, all columns as they came; only text and n_chars go to Python."""
    return docs.where(_accept(model, threshold)(F.col("text").cast("string"), _length(docs)))


def learning_fold() -> Column:
    return ~held_out(F.col("doc_id"), 4, 2)


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), learning_fold())
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
