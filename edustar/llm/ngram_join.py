"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence matrix.

Documents are rows, distinct shingles of k words are columns. Two rows link when their overlap is at least
t = num/den of their union, so a row of n columns has at most p - 1 columns that a linked row lacks, with
p = n - ceil(t n) + 1. ``Rule`` holds k and t. Equal sets are one row. The product is never formed as a whole:

1. Column frequencies, in column blocks. Tasks send packed (column, row) entries; a block counts its columns
   and replies, per row, how many of its columns have which frequency class. A row with p columns of its own
   links nothing and leaves. Counting is repeated over the rows that stay.
2. Overlap counts, in column blocks. Every row takes its rarest classes until they hold p columns (m in all); a
   block counts for each pair of rows the taken columns they share. Counts are added over the blocks, and
   a pair below the bound from its sizes, m - p + 1, is discarded. Columns in more than ``POPULAR`` rows form no
   pairs: their rows are connected along their sizes wherever the sizes allow a link, first within each
   task, which sends on only the smallest and largest row per size band, so no column is ever gathered whole.
3. Row blocks. The rows that 2 connects are multiplied, cut into tiles of bounded rows and cells. A tile
   adds up overlaps column block by column block and discards a pair as soon as its count plus what is left
   falls below the bound from its sizes.
4. The links of all tiles are contracted to components.

Long rows take part in 1 and 2 with the columns of a fixed part of the fingerprint range (``Rule.part``), as long as that
holds 2 p - 1 of them, short rows with all. No linked pair is lost: see ``needed``.

Defined results: null or empty text has n_shingles 0 and is its own component. Fewer than k words: the
whole sequence is the one shingle. Rows with the same doc_id belong to one component; a row with a null
doc_id gets its n_shingles and a null component_id, and links nothing. An empty table gives an empty
result. Only doc_id and text are read. Shingles and sets are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _M1, chunks, free_name, mix, shingles, table, written
from .components import components

POPULAR = 16                          # a column in more rows forms no pairs
TOP = 6                               # class of popular columns; 0: in one row
CLASS = np.array([0, 0, 1, 2, 3, 4, 4, 4, 4, 5, 5, 5, 5, 5, 5, 5, 5, TOP])
FLUSH = 1_000_000                     # entries that a task holds before it sends them on
BLOCK_ENTRIES = 2_000_000             # entries of a column block
TILE_ROWS, TILE_CELLS = 1024, 1_500_000  # rows and filled cells of a row block
BROADCAST_ROWS = 500_000   # lists of rows (at most 60 bytes each) are broadcast up to here, joined by shuffle beyond
COLUMN_BLOCK = 2048
PACKED = "block int, chunk long, payload binary"


class Rule(NamedTuple):
    """Rows link when their sets of ``k``-word shingles are similar by ``num`` / ``den`` (between 0 and 1) at least."""

    k: int
    num: int
    den: int

    @property
    def part(self) -> np.uint64:
        """Columns below it stand for a long row: a third more of the range than the 2 p - 1 columns need."""
        return np.uint64(min((1 << 64) - 1, 8 * (self.den - self.num) * (1 << 64) // (3 * self.den)))

    @property
    def band(self) -> float:
        """Sizes of one band differ by less than a link allows."""
        return 0.92 * np.log(self.den / self.num)


OP10 = Rule(4, 85, 100)    # op10's contract
WORDS5 = Rule(5, 80, 100)  # near copies of a corpus


def own_columns(n, rule: Rule = OP10):
    """p: with so many columns that no other row has, a row of n columns links nothing."""
    return n - (rule.num * n + rule.den - 1) // rule.den + 1


def taken_part(s: np.ndarray, rule: Rule = OP10) -> tuple[np.ndarray, bool]:
    """The columns with which a row takes part in the column blocks, and whether these are all."""
    part = s[: np.searchsorted(s, rule.part)]
    return (part, False) if len(part) >= 2 * own_columns(len(s), rule) - 1 else (s, True)


def needed(level: np.ndarray, need: np.ndarray, whole: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Shared taken columns without which rows i and j can't link.

    A row x that took m columns (all classes up to its level) shares at least m - p + 1 of them with a linked row y. If y's
    level is no lower and y takes part with the same part of the range at least, y has taken them too.
    """
    one = (level[i] <= level[j]) & (~whole[i] | whole[j])
    two = (level[j] <= level[i]) & (~whole[j] | whole[i])
    return np.maximum(np.where(one, need[i], 1), np.where(two, need[j], 1))


def _bits(entries: int) -> int:
    return min(20, max(1, int(np.ceil(np.log2(max(1, entries) / BLOCK_ENTRIES))))) if entries > BLOCK_ENTRIES else 1


def _blocks(h: np.ndarray, bits: int) -> np.ndarray:
    """Borders of the column blocks (the first ``bits`` bits) in sorted fingerprints."""
    return np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def _payload(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.uint32).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _arrays(payload: bytes, *kinds) -> list[np.ndarray]:
    n = np.frombuffer(payload, np.uint32, len(kinds))
    out, at = [], 4 * len(kinds)
    for m, k in zip(n.tolist(), kinds):
        out.append(np.frombuffer(payload[at: at + m * np.dtype(k).itemsize], k))
        at += m * np.dtype(k).itemsize
    return out


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(x)))


def set_id(s: np.ndarray) -> int:
    """Fingerprint of a set of shingles."""
    return int(mix(mix(s).sum(dtype=np.uint64, keepdims=True) ^ (np.full(1, len(s), np.uint64) * _M1)).view(np.int64)[0])


def _meta(rule: Rule):
    """doc_id, text hash, n and set fingerprint of every row."""
    def run(batches):
        for b, texts in chunks(batches):
            sets = shingles(texts, rule.k)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("text_hash")), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) if len(s) else 0 for s in sets], pa.int64())], names=["doc_id", "text_hash", "n", "node"])
    return run


def _taken(batches, rule: Rule):
    """(doc_id, other columns of the row, all its shingles, taken columns, whole) of rows whose set is the listed one."""
    for b, texts in chunks(batches):
        cols = {f: b.column(k).to_pylist() for k, f in enumerate(b.schema.names) if f != "text"}
        for k, s in enumerate(shingles(texts, rule.k)):
            if len(s) and set_id(s) == cols["node"][k]:
                yield {f: v[k] for f, v in cols.items()}, s, *taken_part(s, rule)


def _chunks_of(batches, size: int, rule: Rule):
    """Rows of a task in chunks of about ``size`` entries: chunk number, rows, sorted columns and each one's row."""
    task = pyspark.TaskContext.get().partitionId() << 24
    held, n, turn = [], 0, 0

    def out():
        x = np.concatenate([h[2] for h in held])
        row = np.repeat(np.arange(len(held), dtype=np.uint32), [len(h[2]) for h in held])
        order = np.argsort(x, kind="stable")
        return task + turn, held, x[order], row[order]

    for one in _taken(batches, rule):
        held.append(one)
        n += len(one[2])
        if n >= size:
            yield out()
            held, n, turn = [], 0, turn + 1
    if held:
        yield out()


def _packed(rows):
    b, c, p = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(c, pa.int64()), pa.array(p, pa.binary())], names=["block", "chunk", "payload"])


def _send_counts(bits: int, size: int, rule: Rule):
    """Entries for the column blocks; per chunk, under a negative block, its rows."""
    def run(batches):
        for chunk, held, x, row in _chunks_of(batches, size, rule):
            first, times = _runs(x)
            often = np.repeat(times > POPULAR, times)  # popular already here: one entry stands for all
            popular = np.bincount(row[often], minlength=len(held)).astype(np.uint32)
            lone, low = x[first[times > POPULAR]], x[~often]
            own, cut, cut_lone = row[~often], _blocks(x[~often], bits), _blocks(lone, bits)
            rows = [(-1 - chunk % (1 << bits), chunk, _payload(
                np.array([h[0]["node"] for h in held], np.int64), np.array([len(h[1]) for h in held], np.uint32),
                np.array([h[3] for h in held], np.uint8), popular))]
            for k in np.flatnonzero(np.diff(cut) + np.diff(cut_lone)).tolist():
                w = slice(cut[k], cut[k + 1])
                rows.append((k, chunk, _payload(_low(low[w], bits), own[w], _low(lone[cut_lone[k]: cut_lone[k + 1]], bits), np.ones(1, np.uint8),
                                                np.array([len(held)], np.uint32))))
            yield _packed(rows)
    return run


def _low(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(32 - bits)).astype(np.uint32)  # the 32 bits after the block's


def _classes(x: np.ndarray, popular: np.ndarray, block: int, bits: int, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Order of the entries by column, and the class of each in that order."""
    order = np.argsort(x, kind="stable")
    y = x[order]
    first, times = _runs(y)
    kind = CLASS[np.minimum(times, POPULAR + 1)]
    kind[np.isin(y[first], popular)] = TOP
    outside = ((np.uint64(block) << np.uint64(32)) | y[first].astype(np.uint64)) >= (rule.part >> np.uint64(32 - bits))
    kind[outside & (kind == 0)] = 1  # long rows don't show these columns, so none is known to be a row's own
    return order, np.repeat(kind, times)


def _reply(bits: int, rule: Rule):
    """Column block: per chunk and row, the number of its columns of each class (at most 255, a lower number does no harm)."""
    def run(block: pa.Table) -> pa.Table:
        k = block.column("block")[0].as_py()
        chunk, pay = block.column("chunk").to_numpy(), block.column("payload").to_pylist()
        if k < 0:
            return pa.table({"chunk": chunk, "kind": np.zeros(len(chunk), np.int32), "payload": pa.array(pay, pa.binary())})
        parts = [_arrays(p, np.uint32, np.uint32, np.uint32, np.uint8, np.uint32) for p in pay]
        order, kind = _classes(np.concatenate([p[0] for p in parts]), np.unique(np.concatenate([p[2] for p in parts])), k, bits, rule)
        back = np.empty(len(order), np.int64)
        back[order] = kind
        out, at = [], 0
        for p in parts:
            n = len(p[0])
            h = np.bincount(p[1] * np.int64(TOP + 1) + back[at: at + n], minlength=int(p[4][0]) * (TOP + 1))
            out.append(np.minimum(h, 255).astype(np.uint8).tobytes())
            at += n
        return pa.table({"chunk": chunk, "kind": np.ones(len(chunk), np.int32), "payload": pa.array(out, pa.binary())})
    return run


def _histograms(rule: Rule):
    """A chunk's replies added up: node, level, need and whole of its rows; level -1: links nothing."""
    def run(chunk: pa.Table) -> pa.Table:
        kind = np.array(chunk.column("kind").to_numpy())
        pay = chunk.column("payload").to_pylist()
        ids, n, whole, popular = _arrays(pay[int(np.flatnonzero(kind == 0)[0])], np.int64, np.uint32, np.uint8, np.uint32)
        h = np.zeros((len(ids), TOP + 1), np.int64)
        for k in np.flatnonzero(kind == 1):
            h += np.frombuffer(pay[k], np.uint8).reshape(h.shape)
        h[:, TOP] += popular
        p = own_columns(n.astype(np.int64), rule)
        sums = np.cumsum(h, 1)
        level = np.where(sums[:, -1] >= p, (sums >= p[:, None]).argmax(1), TOP)
        m = sums[np.arange(len(ids)), level]
        own = sums[:, 0] >= p
        level[whole == 1] = TOP
        m = np.where(whole == 1, n, m)
        level[own] = -1
        return pa.table({"node": ids, "level": level.astype(np.int32), "need": np.maximum(m - p + 1, 1), "whole": whole == 1})
    return run


def _send_taken(bits: int, size: int, rule: Rule):
    """Entries with their rows' levels and bounds; edges inside the task under a negative block."""
    def run(batches):
        for chunk, held, x, row in _chunks_of(batches, size, rule):
            ids = np.array([h[0]["node"] for h in held], np.int64)
            n = np.array([len(h[1]) for h in held], np.uint32)
            level = np.array([h[0]["level"] for h in held], np.int8)
            rows_of = [ids, n, level, np.array([h[0]["need"] for h in held], np.uint32), np.array([h[0]["whole"] for h in held], np.uint8)]
            first, times = _runs(x)
            often = np.repeat(times > POPULAR, times)
            # rows of popular columns: per size band the smallest and largest, the others connected here
            px, pr = x[often], row[often]
            keep = level[pr] == TOP
            px, pr = px[keep], pr[keep]
            order = np.lexsort((pr, n[pr], px))
            px, pr = px[order], pr[order]
            band = (np.log(n[pr]) / rule.band).astype(np.int32)
            same = (px[1:] == px[:-1]) & (band[1:] == band[:-1])
            inner = np.zeros(len(px), bool)
            inner[1:-1] = same[1:] & same[:-1]
            e = np.unique(np.stack((ids[pr[1:]][same], ids[pr[:-1]][same]), 1), axis=0)
            rows = [(-1 - chunk % (1 << bits), chunk, _payload(e.ravel()))] if len(e) else []
            px, pr = px[~inner], pr[~inner]
            lone, low, own = x[first[times > POPULAR]], x[~often], row[~often]
            cut, cut_lone, cut_p = _blocks(low, bits), _blocks(lone, bits), _blocks(px, bits)
            for k in np.flatnonzero(np.diff(cut) + np.diff(cut_lone)).tolist():
                w, v = slice(cut[k], cut[k + 1]), slice(cut_p[k], cut_p[k + 1])
                rows.append((k, chunk, _payload(_low(low[w], bits), own[w], _low(lone[cut_lone[k]: cut_lone[k + 1]], bits), _low(px[v], bits), pr[v], *rows_of)))
            if rows:
                yield _packed(rows)
    return run


def _share(bits: int, rule: Rule):
    """Column block: pairs of rows with the taken columns they share (need 0: connected over a popular column)."""
    def run(block: pa.Table) -> pa.Table:
        k = block.column("block")[0].as_py()
        pay = block.column("payload").to_pylist()
        if k < 0:
            e = np.unique(np.concatenate([_arrays(p, np.int64)[0] for p in pay]).reshape(-1, 2), axis=0)
            return _pairs(e[:, 0], e[:, 1], np.ones(len(e), np.int64), np.zeros(len(e), np.int64))
        parts = [_arrays(p, np.uint32, np.uint32, np.uint32, np.uint32, np.uint32, np.int64, np.uint32, np.int8, np.uint32, np.uint8) for p in pay]
        base = np.cumsum([0] + [len(p[5]) for p in parts])
        ids, n, level, need, whole = (np.concatenate([p[c] for p in parts]) for c in (5, 6, 7, 8, 9))
        n, need, whole = n.astype(np.int64), need.astype(np.int64), whole == 1
        x = np.concatenate([p[0] for p in parts])
        row = np.concatenate([p[1].astype(np.int64) + b for p, b in zip(parts, base)])
        order, kind = _classes(x, np.unique(np.concatenate([p[2] for p in parts])), k, bits, rule)
        x, row = x[order], row[order]
        # popular columns: rows along their sizes
        top = (kind == TOP) & (level[row] == TOP)
        px = np.concatenate([x[top], *(p[3] for p in parts)])
        pr = np.concatenate([row[top], *(p[4].astype(np.int64) + b for p, b in zip(parts, base))])
        order = np.lexsort((pr, n[pr], px))
        px, pr = px[order], pr[order]
        ok = (px[1:] == px[:-1]) & (n[pr[:-1]] * rule.den >= n[pr[1:]] * rule.num)
        strong = np.unique(np.stack((pr[:-1][ok], pr[1:][ok]), 1), axis=0)
        # other columns: all pairs
        some = (kind > 0) & (kind < TOP) & (kind <= level[row])
        x, row = x[some], row[some]
        first, times = _runs(x)
        a, b = [strong[:0, 0]], [strong[:0, 1]]
        for size in range(2, POPULAR + 1):
            at = first[times == size]
            if len(at):
                r = np.sort(row[at[:, None] + np.arange(size)], axis=1)
                i, j = np.triu_indices(size, 1)
                a.append(r[:, i].ravel())
                b.append(r[:, j].ravel())
        a, b = np.concatenate(a), np.concatenate(b)
        fit = np.minimum(n[a], n[b]) * rule.den >= np.maximum(n[a], n[b]) * rule.num
        pair, times = np.unique(a[fit] * np.int64(len(ids)) + b[fit], return_counts=True)
        a, b = pair // max(1, len(ids)), pair % max(1, len(ids))
        least = needed(level, need, whole, a, b)
        return _pairs(ids[np.concatenate((a, strong[:, 0]))], ids[np.concatenate((b, strong[:, 1]))],
                      np.concatenate((times, np.ones(len(strong), np.int64))), np.concatenate((least, np.zeros(len(strong), np.int64))))
    return run


def _pairs(a, b, times, need) -> pa.Table:
    other = a != b
    a, b, times, need = a[other], b[other], times[other], need[other]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "times": times.astype(np.int64), "need": need.astype(np.int64)})


def _listed(docs: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """The listed rows with their texts."""
    return docs.join(F.broadcast(rows) if n <= BROADCAST_ROWS else rows, "doc_id")


def _levels(docs: DataFrame, rows: DataFrame, name: str, rule: Rule) -> DataFrame:
    """Listed rows with level, need and whole, from the column frequencies among them."""
    n = rows.agg(F.count("*"), F.sum("n")).first()
    bits = _bits((n[1] or 0) // 2)
    sent = _listed(docs, rows.select("doc_id", "node"), n[0]).mapInArrow(_send_counts(bits, FLUSH, rule), PACKED)
    replies = sent.groupBy("block").applyInArrow(_reply(bits, rule), "chunk long, kind int, payload binary")
    found = replies.groupBy("chunk").applyInArrow(_histograms(rule), "node long, level int, need long, whole boolean")
    found = found.groupBy("node").agg(F.max(F.struct("level", "need", "whole")).alias("x"))  # one of a repeated row
    return written(rows.select("doc_id", "node", "n").join(found, "node").select("doc_id", "node", "n", "x.*"), name)


def _candidates(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b) of rows to multiply, as nodes: pairs that reach their bound, and edges over popular columns."""
    rows = _levels(docs, nodes, "ngram-rows", rule).where("level >= 0")
    rows = _levels(docs, rows, "ngram-levels", rule)
    n = rows.agg(F.count("*"), F.sum("n")).first()
    bits = _bits((n[1] or 0) // 2)
    sent = _listed(docs, rows.select("doc_id", "node", "level", "need", "whole"), n[0]).mapInArrow(_send_taken(bits, FLUSH, rule), PACKED)
    shared = sent.groupBy("block").applyInArrow(_share(bits, rule), "a long, b long, times long, need long")
    return shared.groupBy("a", "b").agg(F.sum("times").alias("times"), F.max("need").alias("need"), F.min("need").alias("least")) \
        .where("least = 0 OR times >= need").select("a", "b")


def link_roots(sets: list[np.ndarray], rule: Rule = OP10) -> np.ndarray:
    """Of each row, the first row that it reaches by links, from the blocked product of the rows with themselves."""
    m, num, den = len(sets), rule.num, rule.den
    n = np.array([len(s) for s in sets], np.int64)
    root = np.arange(m)
    if m < 2:
        return root
    if m == 2:
        o = len(np.intersect1d(*sets, assume_unique=True))
        root[1] = 0 if o * den >= num * (n.sum() - o) else 1
        return root
    doc = np.repeat(np.arange(m), n)
    col, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1  # other columns add to no overlap
    order = np.argsort(code[shared], kind="stable")
    doc, code = doc[shared][order], code[shared][order]
    left = np.bincount(doc, minlength=m)
    need = num * (n[:, None] + n[None, :])
    live = np.triu(np.minimum(n[:, None], n[None, :]) * den >= np.maximum(n[:, None], n[None, :]) * num, 1)
    over = np.zeros((m, m), np.float32)
    rows = np.arange(m)
    link_a, link_b = [], []
    names = np.unique(code)
    for at in range(0, len(names), COLUMN_BLOCK):
        part = names[at: at + COLUMN_BLOCK]
        lo, hi = np.searchsorted(code, part[0]), np.searchsorted(code, part[-1], "right")
        place = np.full(m, -1)
        place[rows] = np.arange(len(rows))
        d, c = place[doc[lo:hi]], np.searchsorted(part, code[lo:hi])
        left -= np.bincount(doc[lo:hi], minlength=m)
        a = np.zeros((len(rows), len(part)), np.float32)
        a[d[d >= 0], c[d >= 0]] = 1
        over += a @ a.T
        bound = over + np.minimum(left[rows][:, None], left[rows][None, :])
        live &= bound * (den + num) >= need
        keep = np.flatnonzero(live.any(0) | live.any(1))
        if not len(keep):
            rows = rows[:0]
            break
        if len(keep) < 0.8 * len(rows):
            grid = np.ix_(keep, keep)
            rows, over, live, need = rows[keep], over[grid], live[grid], need[grid]
    if len(rows):
        i, j = np.nonzero(live & (over * (den + num) >= need))
        link_a, link_b = rows[i], rows[j]
    while len(link_a):
        low = np.minimum(root[link_a], root[link_b])
        new = root.copy()
        np.minimum.at(new, root[link_a], low)
        np.minimum.at(new, root[link_b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


def _multiply(rule: Rule):
    """Links inside one tile, as (row, first row that it reaches)."""
    def run(tile: pa.Table) -> pa.Table:
        ids = tile.column("node").to_numpy()
        comp = tile.column("comp").to_numpy()
        out_a, out_b, sets = [], [], []
        for b, texts in chunks(tile.select(["text"]).to_batches()):
            sets += shingles(texts, rule.k)
        ok = np.array([len(s) > 0 and set_id(s) == i for s, i in zip(sets, ids)], bool)  # not another row of that doc_id
        order = np.flatnonzero(ok)
        order = order[np.lexsort((ids[order], comp[order]))]
        if len(order):
            first = np.concatenate(([True], ids[order][1:] != ids[order][:-1]))
            order = order[first]
            for group in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
                root = link_roots([sets[i] for i in group], rule)
                linked = root != np.arange(len(group))
                out_a.append(ids[group[linked]])
                out_b.append(ids[group[root[linked]]])
        z = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(out_a + z), "b": np.concatenate(out_b + z)})
    return run


def _tiles(docs: DataFrame, nodes: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidate rows with their texts and tile (g, i, j): small sets of rows share a tile, large ones have many."""
    comp = candidates.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        candidates.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct()
    rows = written(nodes.join(comp, "node").select("node", "n", "doc_id", "comp"), "ngram-candidates")
    total = rows.agg(F.count("*"), F.sum("n")).first()
    bundles = max(1, -(-(total[1] or 0) // (TILE_CELLS // 2)), -(-total[0] // (2 * TILE_ROWS)))
    parts = F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("n") / TILE_CELLS)).cast("int").alias("parts")
    size = rows.groupBy("comp").agg(parts)
    rows = _listed(docs, rows.join(size, "comp").select("doc_id", "node", "comp", "parts"), total[0])
    # copies for the tiles are made after the join: the list has one entry per row, however large its group
    i = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    rows = rows.withColumn("i", i).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    alone = F.col("parts") == 1
    return rows.select(
        "doc_id", "text", "node", "comp",
        F.when(alone, F.pmod(F.xxhash64("comp"), F.lit(bundles))).otherwise(F.col("comp")).alias("g"),
        F.when(alone, -1).otherwise(F.least("i", "o")).alias("i"), F.when(alone, -1).otherwise(F.greatest("i", "o")).alias("j"))


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _text_hash(docs: DataFrame):
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _rows_and_links(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row (doc_id, text_hash, n, node); the sets (node, n, least doc_id); links between nodes."""
    meta = written(docs.withColumn("text_hash", _text_hash(docs)).mapInArrow(_meta(rule), "doc_id long, text_hash long, n long, node long"), "ngram-meta")
    nodes = meta.where("n > 0 AND doc_id IS NOT NULL").groupBy("node", "n").agg(F.min("doc_id").alias("doc_id"))
    candidates = components(_candidates(docs, nodes, rule))
    return meta, nodes, _tiles(docs, nodes, candidates).groupBy("g", "i", "j").applyInArrow(_multiply(rule), "a long, b long")


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, least, root): the least doc_id of each set, and the node that stands for its component."""
    found = components(written(links, "ngram-links"))
    return nodes.select("node", F.col("doc_id").alias("least")).join(found.withColumnsRenamed({"a": "node", "b": "root"}), "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))


def near_groups(docs: DataFrame, rule: Rule = OP10) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    meta, nodes, links = _rows_and_links(_whole(docs), rule)
    real = meta.where("n > 0 AND doc_id IS NOT NULL")
    same_id = real.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b != top")
    repeated = real.join(same_id, "doc_id").where("node != b").select(F.col("node").alias("a"), "b")
    own = _rooted(nodes, links.unionByName(repeated))
    lowest = own.groupBy("root").agg(F.min("least").alias("component_id"))
    own = own.join(lowest, "root").select("node", "component_id")
    out = real.join(own, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    # a text without words is alone, or with the other rows of its doc_id
    rest = meta.where("n = 0 OR doc_id IS NULL")
    by_id = out.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    rest = rest.join(by_id, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.unionByName(rest)


def keep_rows(docs: DataFrame, rule: Rule = OP10) -> DataFrame:
    """The documents without near copies: of each component of texts the one with the smallest doc_id stays.

    Components are of texts: two texts under one doc_id that aren't near copies are not one. Texts without words and
    rows without a doc_id stay.
    """
    meta, nodes, links = _rows_and_links(_whole(docs), rule)
    own = _rooted(nodes, links)
    first = own.groupBy("root").agg(F.min(F.struct(F.col("least").alias("keep_id"), F.col("node").alias("keep_node"))).alias("k"))
    own = own.join(first, "root").select("node", "k.keep_id", "k.keep_node")
    by_id, by_text = free_name(docs, "_drop_id"), free_name(docs, "_drop_text")
    drop = meta.where("n > 0").join(own, "node").where("doc_id != keep_id OR node != keep_node") \
        .select(F.col("doc_id").alias(by_id), F.col("text_hash").alias(by_text)).distinct()
    drop = written(drop, "ngram-drop")
    n = drop.count()
    on = (docs["doc_id"].cast("long") == F.col(by_id)) & (_text_hash(docs) == F.col(by_text))
    return docs.join(F.broadcast(drop) if n <= BROADCAST_ROWS else drop, on, "left_anti")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), OP10)
