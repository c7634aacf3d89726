r"""Personal data by patterns and a skip-chain conditional random field.

The patterns give the base spans of four kinds (email, ip, card, phone). The field's nodes are whole numbers as people
write them (digits with single separators, "(415) 555-7713" is one node) and words with '@' or "(at)"; its labels are
the four kinds and "other". Potentials come from
* the node's shape, its check digit and its neighbouring words,
* chain edges between nodes that follow one another,
* skip edges between nodes anywhere in the document that spell the same thing: one address (lower-cased, "(at)" as
  '@'), the same last seven digits (phones with and without their country code), or the same digits if there are twelve
  or more; each node links to the next of its group, so a group of n nodes has n - 1 edges.
Loopy sum-product message passing over all edges of a document makes labels consistent: a spelling that no pattern takes
gets the label of its repetitions. Base spans hold their nodes' labels. A linked node that no base span touches and
that ends with a marginal of at least ``CONFIDENT`` is an added span, whether or not a pattern hit anything in the document.

Weights are learnt by pseudo-likelihood from the base spans of at most ``TRAIN_DOCS`` documents (smallest hashes of
doc_id among those with a number of four digits or an '@'; one row of a repeated doc_id). What no pattern took is no
proof of "other" where it repeats a base span, so such nodes are left out; instead every base span is repeated twice in another
spelling, once with its shape hidden, so that only the skip edge can carry its label. Numbers of seven digits and more that are no base
span are repeated likewise as "other". Every document is tagged where it lies.

Defined results: null text counts as empty and has no span. Rows with a null or repeated doc_id are tagged
like any other. Without any node in the sample no span is added. An empty table gives an empty result; only
doc_id and text are read, ``masked`` keeps the other columns.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import batches_of_text
from .common import one_row_each, table

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = OTHER + 1
TRAIN_DOCS, EPOCHS = 3000, 200
CONFIDENT = 0.7
ROUNDS, DAMP = 10, 0.3
CONTEXTS = 128
HELD = 12.0  # log potential that holds a base span's label

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NODE = re.compile(r"[0-9@]|[\[(]at[\])]")
_DIGITS = re.compile(r"[^0-9]")
_MARK = re.compile(r"@|\x20?[\[(]at[\])]\x20?")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]+)*")
_NUMBER = re.compile(r"\+?\(?[0-9](?:(?:[-./\x20]|\)[-\x20]?|[-\x20]?\()?[0-9])*\)?")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
LONGEST = 19  # digits of one number; a longer run is taken apart at its spaces
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(d * 2 - 9 if d > 4 else d * 2 for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches of each kind that pass its test (code points, end exclusive)."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        last = 0
        for m in _AT.finditer(text):  # the local part is the run before '@' that no earlier match has taken
            s = m.start()
            if s < last:
                continue
            while s > last and text[s - 1] in _LOCAL_SET:
                s -= 1
            if s < m.start():
                out["email"].append((s, m.end()))
                last = m.end()
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _DIGITS.sub("", m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def nodes_of(text: str) -> list[tuple[int, int]]:
    """Places of the numbers and addresses of a text, in order."""
    mails, last = [], 0
    for m in _MARK.finditer(text):
        s, host = m.start(), _HOST.match(text, m.end())
        while s > last and text[s - 1] in _LOCAL_SET:
            s -= 1
        if host and last <= s < m.start():
            mails.append((s, host.end()))
            last = host.end()
    out, k = list(mails), 0
    for m in _NUMBER.finditer(text):
        a, b = m.span()
        if text[b - 1] == ")" and "(" not in m.group():
            b -= 1
        if a and (text[a - 1].isalnum() or text[a - 1] == "_") or b < len(text) and (text[b].isalnum() or text[b] == "_"):
            continue
        parts = [(a, b)]
        if sum(map(str.isdigit, text[a:b])) > LONGEST:
            parts = [(a + w.start(), a + w.end()) for w in re.finditer(r"[^\x20]+", text[a:b])]
        for x, y in parts:
            while k < len(mails) and mails[k][1] <= x:
                k += 1
            if k == len(mails) or mails[k][0] >= y:
                out.append((x, y))
    return sorted(out)


_SHAPES = 40


def features(text: str, a: int, b: int) -> list[int]:
    """Numbers of the features that a node has; the first one all nodes have."""
    w = text[a:b]
    d = _DIGITS.sub("", w)
    letters = sum(c.isalpha() for c in w)
    f = [0, 1 + min(len(d), 20), 22 + min(letters, 12) // 4]
    card = 16 <= len(d) <= 19
    f += [26 + k for k, ok in enumerate((
        "@" in w or "at" in w, _DOTTED.fullmatch(w), "." in w, w[0] == "+", "(" in w, "-" in w, len(d) == len(w), len(w) >= 16,
        len(w) <= 4, len(d) and letters, "/" in w, " " in w, card and luhn(d))) if ok]
    left = text[max(0, a - 24):a].split()
    right = text[b:b + 24].split()
    for side, x in enumerate((left[-1] if left else "", right[0] if right else "")):
        x = re.sub(r"[0-9]", "9", x.lower())
        f.append(_SHAPES + side * CONTEXTS + zlib.crc32(x.encode()) % CONTEXTS)
    return f


FEATURES = _SHAPES + 2 * CONTEXTS


def keys_of(w: str) -> list[str]:
    """What a node says, however it is spelt; nodes with a key in common are linked."""
    if "@" in w or "at" in w:
        return [re.sub(r"\x20?[\[(]dot[\])]\x20?", ".", _MARK.sub("@", w)).lower()]
    if _DOTTED.fullmatch(w) and max(map(int, w.split("."))) <= 255:
        return [w]
    d = _DIGITS.sub("", w)
    return ["#" + d[-7:]] * (7 <= len(d) <= 15) + ["=" + d] * (len(d) >= 12)


def edges_of(text: str, nodes: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges (neighbouring nodes) and skip edges (the next node with a key in common)."""
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][0] - nodes[i][1] <= 2]
    skip, last = set(), {}
    for i, (a, b) in enumerate(nodes):
        for key in keys_of(text[a:b]):
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    return chain, sorted(skip)


def respelt(w: str, kind: int) -> str:
    """Another spelling of a span of this kind, chosen by its own text."""
    d, pick = _DIGITS.sub("", w), zlib.crc32(w.encode()) % 4
    if KINDS[kind] == "email":
        return w.replace("@", ("(at)", " [at] ", " (at) ", "@")[pick]) if pick < 3 else w.upper()
    if KINDS[kind] == "phone":
        d = d[-10:]
        head, tail = (d[:-7], d[-7:])
        return (f"{head}-{tail[:3]}-{tail[3:]}", f"({head}) {tail[:3]}-{tail[3:]}", f"{head}.{tail[:3]}.{tail[3:]}", d)[pick].lstrip("-.")
    if KINDS[kind] == "card":
        return ("", ".", "/", "-")[pick].join(d[i:i + 4] for i in range(0, len(d), 4))
    return w


def example(text: str) -> tuple[list[list[int]], np.ndarray, list, list, np.ndarray] | None:
    """Features, labels, chain and skip edges of a document's nodes and their repetitions, and which labels count."""
    nodes = nodes_of(text)
    if not nodes:
        return None
    y, (chain, skip) = labels_of(nodes, base_spans(text)).tolist(), edges_of(text, nodes)
    feats = [features(text, a, b) for a, b in nodes]
    counts = [True] * len(nodes)
    for i, j in skip:  # not known to be "other"
        for x, z in ((i, j), (j, i)):
            if y[x] == OTHER != y[z]:
                counts[x] = False
    chain, skip = ([e for e in edges if counts[e[0]] and counts[e[1]]] for edges in (chain, skip))
    for i, (a, b) in enumerate(nodes):
        if counts[i] and (y[i] != OTHER or sum(map(str.isdigit, text[a:b])) >= 7):
            w = text[a:b] if y[i] == OTHER else respelt(text[a:b], y[i])
            n = len(y)
            feats += [features(text[max(0, a - 40):a] + w + text[b:b + 40], min(a, 40), min(a, 40) + len(w)), [0]]
            y += [y[i]] * 2
            counts += [True] * 2
            skip += [(i, n), (n, n + 1)]
    return feats, np.array(y), chain, skip, np.array(counts)


def labels_of(nodes, spans) -> np.ndarray:
    """The kind of the base span that a node overlaps; OTHER without one."""
    y = np.full(len(nodes), OTHER)
    for k in range(OTHER - 1, -1, -1):
        at = 0
        own = spans[KINDS[k]]
        for i, (a, b) in enumerate(nodes):
            while at < len(own) and own[at][1] <= a:
                at += 1
            if at < len(own) and own[at][0] < b:
                y[i] = k
    return y


def _neighbour_labels(n: int, edges, y: np.ndarray) -> np.ndarray:
    x = np.zeros((n, LABELS))
    for a, b in edges:
        x[a, y[b]] += 1
        x[b, y[a]] += 1
    return x


class SkipChainCRF:
    """Unary weights (features x labels) and pair weights of chain and skip edges (labels x labels)."""

    def __init__(self, unary, chain, skip):
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def learn(cls, rows: list[tuple[list[list[int]], np.ndarray, list, list, np.ndarray]]) -> "SkipChainCRF":
        """Pseudo-likelihood: each label given its features and its neighbours' labels, by full-batch AdaGrad."""
        f, own, y, c, s, counts = [], [], [], [], [], []
        n = 0
        for feats, labels, chain, skip, known in rows:
            counts.append(known)
            for k, x in enumerate(feats):
                f += x
                own += [n + k] * len(x)
            y.append(labels)
            c.append(_neighbour_labels(len(labels), chain, labels))
            s.append(_neighbour_labels(len(labels), skip, labels))
            n += len(labels)
        f, own, y = np.array(f), np.array(own), np.concatenate(y)
        c, s = np.concatenate(c), np.concatenate(s)
        par = [np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
        acc = [np.full(p.shape, 1e-3) for p in par]
        goal = np.eye(LABELS)[y]
        share = np.concatenate(counts)[:, None] / n
        for _ in range(EPOCHS):
            z = np.zeros((n, LABELS))
            np.add.at(z, own, par[0][f])
            z += c @ par[1] + s @ par[2]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            e = (p - goal) * share
            g = [np.zeros_like(par[0]), c.T @ e, s.T @ e]
            np.add.at(g[0], f, e[own])
            for k in range(3):
                d = g[k] + 1e-4 * par[k] / max(n, 1)
                acc[k] += d * d
                par[k] -= 0.5 * d / np.sqrt(acc[k])
        return cls(par[0], (par[1] + par[1].T) / 2, (par[2] + par[2].T) / 2)

    def marginals(self, feats, y, chain, skip) -> np.ndarray:
        """Loopy sum-product in log space; y holds the labels of base spans (OTHER: free)."""
        n = len(feats)
        u = np.stack([self.unary[x].sum(0) for x in feats])
        held = y != OTHER
        u[held] = 0
        u[held, y[held]] = HELD
        pairs = [*((a, b, self.chain) for a, b in chain), *((a, b, self.skip) for a, b in skip)]
        if pairs:
            src = np.array([p[0] for p in pairs] + [p[1] for p in pairs])
            dst = np.array([p[1] for p in pairs] + [p[0] for p in pairs])
            pot = np.stack([p[2] for p in pairs] * 2)
            m = len(pairs)
            back = np.concatenate((np.arange(m, 2 * m), np.arange(m)))
            msg = np.zeros((2 * m, LABELS))
            for _ in range(ROUNDS):
                belief = u.copy()
                np.add.at(belief, dst, msg)
                out = belief[src] - msg[back]
                new = _log_sum(out[:, :, None] + pot)
                new -= new.max(1, keepdims=True)
                if np.abs(new - msg).max() < 1e-4:
                    msg = new
                    break
                msg = DAMP * msg + (1 - DAMP) * new
            np.add.at(u, dst, msg)
        p = np.exp(u - u.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def _log_sum(x: np.ndarray) -> np.ndarray:
    m = x.max(1)
    return m + np.log(np.exp(x - m[:, None, :]).sum(1))


def added_spans(text: str, spans, crf: SkipChainCRF | None) -> dict[str, list[tuple[int, int]]]:
    """Linked nodes that the field labels with a kind and that touch no base span of any kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    nodes = nodes_of(text) if crf is not None else []
    if len(nodes) < 2:
        return out
    chain, skip = edges_of(text, nodes)
    y = labels_of(nodes, spans)
    linked = sorted({i for e in skip for i in e})
    if not any(y[i] == OTHER for i in linked):
        return out  # the patterns have all that is repeated
    p = crf.marginals([features(text, a, b) for a, b in nodes], y, chain, skip)
    for i in linked:
        k = int(p[i, :OTHER].argmax())
        if y[i] == OTHER and p[i, k] >= CONFIDENT:
            out[KINDS[k]].append(nodes[i])
    return out


def all_spans(base, added) -> dict[str, list[tuple[int, int]]]:
    return {k: sorted(base[k] + added[k]) for k in KINDS}


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def learn(docs: DataFrame, limit: int = TRAIN_DOCS) -> SkipChainCRF | None:
    """Learn from the base spans of at most ``limit`` documents; their nodes come to the driver, not their texts."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = d.where(F.col("text").rlike("[0-9]{4}|@") & F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    got = one_row_each(d, ids).mapInArrow(_examples, "doc_id long, example binary").toArrow()
    rows = sorted(zip(got.column("doc_id").to_pylist(), got.column("example").to_pylist()))
    return SkipChainCRF.learn([pickle.loads(x) for _, x in rows]) if rows else None


def _examples(batches):
    for b, texts in batches_of_text(batches):
        out = [pickle.dumps(x) if (x := example(t)) else None for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(out, pa.binary())], names=["doc_id", "example"]) \
            .filter(pa.array([o is not None for o in out]))


def _tag(crf):
    def run(batches):
        for b, texts in batches_of_text(batches):
            rows = []
            for t in texts:
                some = _NODE.search(t) is not None
                base = base_spans(t) if some else {k: [] for k in KINDS}
                every = all_spans(base, added_spans(t, base, crf)) if some else base
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5])],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def tag(docs: DataFrame, crf: SkipChainCRF | None) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, and all spans."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _tag(crf), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask_text(text: str, spans) -> str:
    """The text with every span replaced by its kind; overlapping spans are replaced as one, named by the first."""
    flat = sorted((a, b, k) for k in KINDS for a, b in spans[k])
    out, at = [], 0
    for a, b, k in flat:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _mask(crf):
    @F.arrow_udf("string")
    def mask(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in columns:
            new = []
            for i in range(0, len(text), 64):
                for t in text.slice(i, 64).to_pylist():
                    if t and _NODE.search(t):
                        base = base_spans(t)
                        t = mask_text(t, all_spans(base, added_spans(t, base, crf)))
                    new.append(t)
            yield pa.array(new, pa.string())
    return mask


def masked(docs: DataFrame, crf: SkipChainCRF | None) -> DataFrame:
    """The documents with personal data replaced, only text goes to Python; n_chars, where there is one, follows the new text."""
    out = docs.withColumn("text", _mask(crf)(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return out


def op4_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tag(docs, learn(docs))
