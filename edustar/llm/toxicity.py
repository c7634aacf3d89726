"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding lower-cases, turns homoglyphs of other alphabets, compatibility forms and digits used as letters into the
Latin letter, and every other character that is no letter into a space; accents stay, they tell words apart. The lexicon is
learnt from labelled rows: whole words and word beginnings that occur in many toxic texts, in many different
contexts, and hardly in clean ones, each with its log odds as weight. Exception phrases are longer
words or word pairs around a lexicon entry that clean texts use; a match inside one doesn't count. A text's
score is a logistic function of the summed weights over 1 + ln(1 + words). Labels, lang, source and doc_id
are no inputs.

At most ``TRAIN_ROWS`` labelled rows are learnt from (the smallest hashes of doc_id in the learning fold);
every row is scored where it lies.

Defined results: null text counts as empty; an empty text has no match and gets the score of such a text.
A row with a null doc_id is scored and is not held out. Null labels are skipped, repeated ones count once
(the largest). Without toxic labels the lexicon is the one given (none by default) and a text without matches
scores below 0.5. Repeated rows are scored each; extra columns have no effect.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections import Counter
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import one_row_each, table, written
from .quality_fm import held_out

TRAIN_ROWS = 8000
PREFIXES = (3, 4, 5, 6, 7)
LEAST_SUPPORT, LEAST_SHARE, LEAST_G = 4, 0.8, 16.0
THRESHOLD = 0.5

# Letters of other alphabets, and digits, that stand for a Latin letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѡ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s"}  # stand for a letter only between letters


class _Fold(dict):
    """Translation table that works out each character once."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()
        if c in DIGITS:
            out = DIGITS[c]
        else:
            c = unicodedata.normalize("NFKC", c).lower()
            c = "".join(HOMOGLYPHS.get(x, x) for x in c if not unicodedata.combining(x))
            out = c if c.isalpha() or not c else " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Folded words, each with one space before and behind it where it is next to another character."""
    for sign, letter in SIGNS.items():
        if sign in text:
            at = text.find(sign)
            parts = []
            last = 0
            while at >= 0:
                if 0 < at < len(text) - 1 and text[at - 1].isalpha() and text[at + 1].isalpha():
                    parts += [text[last:at], letter]
                    last = at + 1
                at = text.find(sign, at + 1)
            text = "".join([*parts, text[last:]])
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)  # one letter per accented letter; other combining marks go
    return " " + text.translate(_FOLD) + " "


def _texts(batches):
    for b in batches:
        col = b.column(b.schema.get_field_index("text"))
        for i in range(0, b.num_rows, 64):
            yield b.slice(i, 64), [v or "" for v in col.slice(i, 64).to_pylist()]


def _uses(batches):
    """Every pattern (word or word beginning) that a text has, once per text."""
    for _, texts in _texts(batches):
        pat = []
        for t in texts:
            w = set(fold(t).split())
            pat += {f" {x} " for x in w} | {" " + x[:k] for x in w for k in PREFIXES if k <= len(x)}
        yield pa.RecordBatch.from_arrays([pa.array(pat, pa.string())], names=["pattern"])


def _patterns(batches):
    """Per text its distinct words and word beginnings, each with a hash of one context."""
    for b, texts in _texts(batches):
        pat, ctx = [], []
        for t in texts:
            w = fold(t).split()
            seen = {}
            for i, x in enumerate(w):
                for k in PREFIXES:
                    if k < len(x):
                        seen.setdefault(" " + x[:k], i)
                seen.setdefault(f" {x} ", i)
            pat += seen
            ctx += [xxhash.xxh3_64_intdigest(" ".join(w[max(0, i - 1): i + 2])) >> 1 for i in seen.values()]
        yield pa.RecordBatch.from_arrays([pa.array(pat, pa.string()), pa.array(ctx, pa.int64())], names=["pattern", "context"])


def _automaton(entries) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for i, p in enumerate(entries):
        a.add_word(p, i)
    if len(a):
        a.make_automaton()
    return a


def _pairs(patterns):
    """Phrases around a lexicon match: the whole word, and it with the word before or behind."""
    def run(batches):
        a = _automaton(patterns)
        for b, texts in _texts(batches):
            toxic, phrase = b.column(b.schema.get_field_index("y")).to_pylist(), []
            own = []
            for t, y in zip(texts, toxic):
                s, seen = fold(t), set()
                for end, i in a.iter(s):
                    lo = end - len(patterns[i]) + 1
                    hi = s.find(" ", lo + 1)
                    before, after = s.rfind(" ", 0, lo), s.find(" ", hi + 1)
                    seen |= {s[lo:hi + 1], s[max(before, 0):hi + 1], s[lo:after + 1] if after > 0 else s[lo:hi + 1]}
                phrase += seen
                own += [y] * len(seen)
            yield pa.RecordBatch.from_arrays([pa.array(phrase, pa.string()), pa.array(own, pa.int32())], names=["phrase", "y"])
    return run


class Lexicon:
    def __init__(self, weights: dict[str, float], exceptions=(), slope: float = 1.0, bias: float = -4.0):
        self.patterns, self.weights = list(weights), np.array(list(weights.values()))
        self.exceptions = list(exceptions)
        self.slope, self.bias = slope, bias

    def matcher(self):
        entries = _automaton(self.patterns)
        allowed = _automaton(self.exceptions)
        weight, patterns, exceptions = self.weights, self.patterns, self.exceptions

        def value(text: str) -> float:
            """Summed weights over 1 + ln(1 + words), matches inside exception phrases left out."""
            s = fold(text)
            hits = [(e - len(patterns[i]) + 1, e, i) for e, i in entries.iter(s)] if len(entries) else []
            if hits and len(allowed):
                free = [(e - len(exceptions[i]) + 1, e) for e, i in allowed.iter(s)]
                hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b in free)]
            uses = Counter(i for _, _, i in hits)
            # repetitions count less and less, but a text of nothing else never scores below a single use
            return sum(weight[i] * (1 + np.log(n)) for i, n in uses.items()) / (1 + np.log1p(len(s.split()))) if hits else 0.0
        return value

    def scores(self):
        slope, bias, make = self.slope, self.bias, self.matcher

        def run(batches):
            value = make()
            for b, texts in _texts(batches):
                v = np.array([value(t) for t in texts])
                yield pa.RecordBatch.from_arrays([
                    b.column(b.schema.get_field_index("doc_id")), pa.array(1 / (1 + np.exp(-np.clip(slope * v + bias, -30, 30))))], names=["doc_id", "score"])
        return run


def _learn_weights(pos: dict[str, int], neg: dict[str, int], n_pos: int, n_neg: int) -> dict[str, float]:
    """Weights of the patterns that passed, nested ones reduced to one each.

    Shorter ones first; a pattern is drawn out to the longest continuation with nearly the same support. Sorted,
    the continuations of a pattern follow it.
    """
    chosen: dict[str, int] = {}
    names = sorted(pos)
    for p in sorted(names, key=len):
        if any(p[:k] in chosen for k in range(2, len(p))):
            continue  # a shorter beginning covers it
        long = p
        for q in islice(names, bisect_left(names, p) + 1, None):
            if not q.startswith(p):
                break
            if pos[q] >= 0.95 * pos[p] and len(q) > len(long):
                long = q
        chosen[long] = pos[long]
    return {p: float(np.log((a + 0.5) / (n_pos + 1)) - np.log((neg.get(p, 0) + 0.5) / (n_neg + 1))) for p, a in chosen.items()}


def _fit_logistic(v: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic function by Newton steps with a little ridge."""
    x = np.column_stack((v, np.ones(len(v))))
    w = np.zeros(2)
    ridge = np.array([1e-3, 1e-3])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w = w - np.clip(np.linalg.solve(h, x.T @ (p - y) + ridge * w), -2, 2)
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS, lexicon: dict[str, float] | None = None,
          exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Lexicon from at most ``rows`` labelled documents, with entries and exception phrases given beforehand."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")) \
        .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull()).where(learn) \
        .groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = written(one_row_each(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), y), "toxic-sample")
    sizes = dict(sample.groupBy("y").count().toArrow().to_pydict().items())
    count = dict(zip(sizes["y"], sizes["count"]))
    n_pos, n_neg = count.get(1, 0), count.get(0, 0)
    weights = {fold(p).rstrip() + (" " if p.endswith(" ") else ""): w for p, w in (lexicon or {}).items()}
    allowed = [f" {' '.join(fold(p).split())} " for p in exceptions]
    if not n_pos or not n_neg:
        return Lexicon(weights, allowed)
    toxic, clean = sample.where("y = 1").select("text"), sample.where("y = 0").select("text")
    support = toxic.mapInArrow(_patterns, "pattern string, context long").groupBy("pattern") \
        .agg(F.count("*").alias("n"), F.countDistinct("context").alias("c")) \
        .select("pattern", F.least("n", "c").alias("n")).where(F.col("n") >= LEAST_SUPPORT)
    # counted and judged where they lie: only patterns that pass the bounds come to the driver
    clean_uses = clean.mapInArrow(_uses, "pattern string").groupBy("pattern").agg(F.count("*").alias("b"))
    a, b, share = F.col("n"), F.coalesce("b", F.lit(0)), n_pos / (n_pos + n_neg)
    g = 2 * (a * F.log(a / (a + b) / share) + F.when(b > 0, b * F.log(b / (a + b) / (1 - share))).otherwise(0.0))
    good = support.join(clean_uses, "pattern", "left").where((a / (a + b) >= LEAST_SHARE) & (g >= LEAST_G)).select("pattern", "n", b.alias("b")).toArrow()
    names = good.column("pattern").to_pylist()
    pos, neg = dict(zip(names, good.column("n").to_pylist())), dict(zip(names, good.column("b").to_pylist()))
    weights = {**_learn_weights(pos, neg, n_pos, n_neg), **weights}
    if weights:
        near = sample.select("text", "y").mapInArrow(_pairs(list(weights)), "phrase string, y int").groupBy("phrase") \
            .agg(F.sum("y").alias("a"), F.count("*").alias("n")).where("n - a >= 3 AND a * 4 <= n").orderBy("phrase")
        allowed += [p for p in near.toArrow().column("phrase").to_pylist() if p not in weights]
    lex = Lexicon(weights, allowed)
    got = sample.mapInArrow(_values(lex), "v double, y int").toArrow()
    v, t = got.column("v").to_numpy(), got.column("y").to_numpy().astype(float)
    order = np.lexsort((t, v))
    lex.slope, lex.bias = _fit_logistic(v[order], t[order])
    return lex


def _values(lex: Lexicon):
    def run(batches):
        value = lex.matcher()
        for b, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays([pa.array([value(t) for t in texts], pa.float64()), b.column(b.schema.get_field_index("y"))], names=["v", "y"])
    return run


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lexicon.scores(), "doc_id long, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lex = train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5, 0))
    return score(docs, lex).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                                   (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
