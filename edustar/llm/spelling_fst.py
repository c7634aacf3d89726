"""Spelling variants: pairs of vocabulary words one edit apart, by finite-state composition.

The vocabulary is dealt into partitions in which all words share a beginning and an end; what lies between is
accepted by a minimal acyclic automaton whose initial state is the state behind the shared beginning. It is composed
with the transducer of exactly one inserted, deleted or replaced code point and with itself again: before the edit
both readers stand in one state, at the edit they part, and behind it they must accept the same rest. What two
states have in common is worked out once per pair of states, and edits once per state, as ranks of words rather than
strings (a state knows how many words it accepts), so no two words are ever compared with each other.

A pair whose shorter word has k code points differs either behind the middle of it, and then both words share the
first half, or before, and then they share the second half. So each word goes to four partitions (k its length
or one less; first or second half). A partition of more than ``GROUP_ROWS`` words is dealt again by the same rule applied to
what its words don't share yet. That halves the open part each time, and a partition with one open code point has at
most 90 + 90^2 words, so every partition fits, whatever share of the words begins alike. A pair that both halves
would find is left to the first one.

Defined results: null or empty texts have no words, a null doc_id hashes as the empty string, repeated rows count
again, an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar.operators.joins import sized_broadcast

from .common import chunks, table, written

MIN_CHARS, MIN_COUNT, FACTOR, NOISE = 6, 5, 5, 199
GROUP_ROWS = 10_000     # words of a partition; more than 90 + 90**2
TASK_ROWS = 200_000     # words dealt to a task, in whole partitions
HELD_WORDS = 200_000    # words that a task counts before it sends partial counts on
LONG = 1 << 20
KEY = ["k", "a", "b", "bar", "head", "tail"]


# --- vocabulary ----------------------------------------------------------------------------------

def noisy(word: str, doc_crc: int) -> str:
    """The word, or what is left of it after the contract's rare deletion."""
    h = zlib.crc32(word.encode(), doc_crc)
    if h % NOISE:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1:]


def _count(batches):
    runs = re.compile(r"[a-zÀ-ÿ]{%d,}" % MIN_CHARS)
    held: Counter[str] = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for b, texts in chunks(batches):
        for doc_id, t in zip(b.column(b.schema.get_field_index("doc_id")).to_pylist(), texts):
            text = t.lower().decode("utf-8", "replace")  # lower() of bytes turns A-Z only
            crc = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            found = runs.findall(text) if len(t) <= LONG else (m.group() for m in runs.finditer(text))
            for w, n in Counter(found).items():
                w = noisy(w, crc)
                if len(w) >= MIN_CHARS:
                    held[w] += n
        if len(held) >= HELD_WORDS:
            yield out()
            held = Counter()
    if held:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of enough code points and occurrences, counted over all texts."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# --- partitions ----------------------------------------------------------------------------------

def _halves(rows: DataFrame) -> DataFrame:
    """Deal words (word, n, k, a, b, bar) to the two partitions of their open part.

    a, b: code points shared at the beginning and the end; pairs that share ``bar`` code points or more at the
    beginning belong to another partition.
    """
    half, open_ = F.expr("(k - a - b) div 2").cast("int"), F.col("k") - F.col("a") - F.col("b")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("bar").alias("bar"))
    second = F.struct(F.col("a").alias("a"), (F.col("b") + open_ - half).alias("b"), (F.col("a") + half).alias("bar"))
    r = rows.select("word", "n", "k", F.explode(F.array(first, second)).alias("p")).select("word", "n", "k", "p.*")
    return r.select("word", "n", "k", "a", "b", "bar", F.substring("word", F.lit(1), F.col("a")).alias("head"),
                    F.when(F.col("b") > 0, F.expr("substring(word, -b, b)")).otherwise("").alias("tail"))


def partitions(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Words with the partition (KEY) that each is dealt to; no partition has more than ``group_rows``."""
    m = F.char_length("word")
    start = words.select("word", "n", F.explode(F.array(m, m - 1)).alias("k")).where(F.col("k") >= MIN_CHARS)
    zero = F.lit(0)
    rows = written(_halves(start.select("word", "n", "k", zero.alias("a"), zero.alias("b"), F.lit(2**31 - 1).alias("bar"))), "spelling-rows")
    done = None
    while True:
        large = written(rows.groupBy(*KEY).agg(F.count("*").alias("rows")).where((F.col("rows") > group_rows) & (F.col("k") - F.col("a") - F.col("b") > 1)).select(*KEY), "spelling-large")
        n = large.count()
        if not n:
            return rows if done is None else done.unionByName(rows)
        keys = sized_broadcast(large, known_rows=n)
        fit = rows.join(keys, KEY, "left_anti").select(*rows.columns)
        done = fit if done is None else done.unionByName(fit)
        rows = written(_halves(rows.join(keys, KEY, "left_semi")), "spelling-rows")


# --- automata ------------------------------------------------------------------------------------

class Acceptor:
    """The minimal acyclic acceptor of sorted distinct strings; state q accepts ``count[q]`` strings from where it stands.

    ``arcs[q]`` maps a code point to (next state, number of q's strings that come before that arc's).
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        known: dict[tuple, int] = {}
        path, labels, last = [[False, []]], [], ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, out = path.pop()
                path[-1][1].append((labels.pop(), self._state(known, final, out)))

        for w in words:
            n, most = 0, min(len(w), len(last))
            while n < most and w[n] == last[n]:
                n += 1
            close(n)
            for c in w[n:]:
                path.append([False, []])
                labels.append(c)
            path[-1][0] = True
            last = w
        close(0)
        self.start = self._state(known, *path[0])

    def _state(self, known: dict, final: bool, out: list) -> int:
        key = (final, *out)
        q = known.get(key)
        if q is None:
            q = known[key] = len(self.arcs)
            arcs, before = {}, int(final)
            for c, to in out:
                arcs[c] = (to, before)
                before += self.count[to]
            self.arcs.append(arcs)
            self.final.append(final)
            self.count.append(before)
        return q


class Composition:
    """An acceptor composed with the one-edit transducer and itself; ``pairs`` gives the accepted pairs by rank."""

    def __init__(self, a: Acceptor):
        self.a = a
        self.rest: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.edits: dict[int, list[tuple[int, int]]] = {}

    def _shared(self, p: int, q: int) -> list[tuple[tuple[int, int], int, int]]:
        x, y = self.a.arcs[p], self.a.arcs[q]
        return [((t[0], y[c][0]), t[1], y[c][1]) for c, t in x.items() if c in y]

    def common(self, p: int, q: int) -> list[tuple[int, int]] | zip:
        """Ranks, from p and from q, of the strings that both states accept."""
        if p == q:
            n = self.a.count[p]
            return zip(range(n), range(n))
        todo, rest = [(p, q)], self.rest
        while todo:
            at = todo[-1]
            if at in rest:
                todo.pop()
                continue
            steps = self._shared(*at)
            missing = [s[0] for s in steps if s[0][0] != s[0][1] and s[0] not in rest]
            if missing:
                todo += missing
                continue
            found = [(0, 0)] if self.a.final[at[0]] and self.a.final[at[1]] else []
            for (x, y), i, j in steps:
                found += [(i + u, j + v) for u, v in (zip(range(self.a.count[x]), range(self.a.count[x])) if x == y else rest[x, y])]
            rest[at] = found
            todo.pop()
        return rest[p, q]

    def edits_at(self, q: int) -> list[tuple[int, int]]:
        """Pairs of strings of q that part at their first code point: one replaced there, or put in (second of the pair) there.

        A code point put in before its like gives the same word as behind it; only the last place counts.
        """
        found = self.edits.get(q)
        if found is None:
            arcs = list(self.a.arcs[q].items())
            found = []
            for n, (_, (p, i)) in enumerate(arcs):
                for _, (r, j) in arcs[n + 1:]:
                    found += [(i + u, j + v) for u, v in self.common(p, r)]
                end = i + self.a.count[p]
                found += [(u, i + v) for u, v in self.common(q, p) if not i <= u < end]
            self.edits[q] = found
        return found

    def pairs(self):
        """Every accepted pair once; where the words' lengths differ, the shorter one comes first."""
        todo = [(self.a.start, 0)]
        while todo:
            q, rank = todo.pop()
            if self.a.count[q] > 1:
                for u, v in self.edits_at(q):
                    yield rank + u, rank + v
                todo += [(to, rank + before) for to, before in self.a.arcs[q].values()]


def near_in(words: list[tuple[str, int]], k: int, a: int, b: int, bar: int):
    """(word, near words, largest n of them, its word) for the words of one partition that have near ones there."""
    if len(words) < 2 or all(len(w) != k for w, _ in words):
        return
    open_ = sorted((w[a:len(w) - b], w, n) for w, n in words)
    found: dict[int, list] = {}
    for i, j in Composition(Acceptor([x[0] for x in open_])).pairs():
        (_, x, nx), (_, y, ny) = open_[i], open_[j]
        if len(x) != k or x[:bar] == y[:bar] and len(x) >= bar:
            continue
        for me, other in ((i, (-ny, y)), (j, (-nx, x))):
            f = found.get(me)
            if f is None:
                found[me] = [1, other]
            else:
                f[0] += 1
                f[1] = min(f[1], other)
    for i, (n, (low, best)) in found.items():
        yield open_[i][1], n, -low, best


def _near(batches):
    def rows():
        for x in batches:
            yield from zip(*(x.column(x.schema.get_field_index(c)).to_pylist() for c in (*KEY, "word", "n")))

    out = []
    for key, group in groupby(rows(), itemgetter(0, 1, 2, 3, 4, 5)):
        out += near_in([g[6:] for g in group], *key[:4])
        if len(out) >= 20_000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(out: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["word", "n_near", "best_n", "best"])


# --- variants ------------------------------------------------------------------------------------

def near_words(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """word, n_near, best_n, best (the near word of largest n, ties: smallest) of the words that have near ones."""
    dealt = partitions(words, group_rows)
    tasks = max(8, -(-dealt.count() // TASK_ROWS))
    found = dealt.repartition(tasks, *KEY).sortWithinPartitions(*KEY).mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("low"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.low")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form) followed to the last; n grows FACTOR-fold a step, so chains are short and have no loops."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        next_ = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(at.join(next_, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(words: DataFrame, factor: int = FACTOR, group_rows: int = GROUP_ROWS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of a vocabulary (word, n)."""
    near = near_words(words, group_rows)
    is_form = F.col("best_n") >= factor * F.col("n")
    w = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    r = roots(w.where("form IS NOT NULL"))
    return w.join(r, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(written(vocabulary(table(spark, sf_dir, "documents")), "spelling-words"))
