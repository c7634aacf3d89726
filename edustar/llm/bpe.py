"""Byte-level BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

Encoding reads a text in chunks. A word boundary that no later character can move closes what stands before
it; a run that stays open (one word of any length) is merged in a window. The window's tokens are emitted
once stable: from the merge list, ``lookahead`` works out how many bytes to the right can still change a
token, so tokens ending farther from the window's end are final and the memory stays constant.
Closed words are looked up in a bounded memory of words met before.

Decoding maps ids to bytes and runs an incremental UTF-8 state machine over them; bytes that form no
character become U+FFFD.

Defined results: null text counts as empty and has no tokens. The special token's string in a text is that
token, as the tokenizer file says. Rows with a null or repeated doc_id are encoded like any other; an empty
table gives an empty result; extra columns have no effect.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CHUNK = 1 << 16       # characters read at once
REMEMBERED = 150_000  # words in each of the two generations of the memory
PIECES = regex.compile(r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_RUNS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+")]
_NEVER = 1 << 40
_ODD = regex.compile(r" (?:\s|\Z)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the tokenizer file: itself if printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBPE:
    """Merge list, vocabulary and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        model = j["model"]
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merges = [(to_bytes(a), to_bytes(b)) for a, b in pairs]
        # a pair of ids as one number -> its place in the merge list -> the id it becomes
        self.rank = {self.ids[a] << 20 | self.ids[b]: i for i, (a, b) in enumerate(merges)}
        self.made = [self.ids[a + b] for a, b in merges]
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for b, i in self.ids.items():
            self.bytes[i] = b
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.lookahead = sufficient_lookahead(merges)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one closed piece: the pair that comes first in the merge list is joined until none is left."""
        if len(piece) > 48:
            return self._merge_long(piece)
        single, made, get = self.single, self.made, self.rank.get
        p = [single[b] for b in piece]
        r = [get(a << 20 | b, _NEVER) for a, b in zip(p, p[1:])]
        while r:
            m = min(r)
            if m == _NEVER:
                break
            i = r.index(m)
            p[i] = made[m]
            del p[i + 1], r[i]
            if i:
                r[i - 1] = get(p[i - 1] << 20 | p[i], _NEVER)
            if i < len(r):
                r[i] = get(p[i] << 20 | p[i + 1], _NEVER)
        return p

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        n, get = len(piece), self.rank.get
        part = [self.single[b] for b in piece]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(part, part[1:])) if (r := get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = nxt[i]
            if part[i] < 0 or j >= n or get(part[i] << 20 | part[j]) != r:
                continue
            part[i], part[j], nxt[i] = self.made[r], -1, nxt[j]
            j, h = nxt[i], prv[i]
            if j < n:
                prv[j] = i
                if (r := get(part[i] << 20 | part[j])) is not None:
                    heapq.heappush(heap, (r, i))
            if h >= 0 and (r := get(part[h] << 20 | part[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in part if p >= 0]


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes to the right of a token's end that can decide whether the token is final.

    A merge (u, v) at a border needs v to have formed: |v| bytes, and further ones where an earlier merge could
    take v's end away, i.e. one whose left part lies on the right edge of v's own merge tree.
    """
    edge = {}   # token -> its right part
    best = {}   # left part of a merge -> longest reach of such merges so far
    most = 0
    for u, v in merges:
        far, t = 0, v
        while t is not None:
            far = max(far, best.get(t, 0))
            t = edge.get(t)
        reach = len(v) + far
        best[u] = max(best.get(u, 0), reach)
        edge.setdefault(u + v, v)
        most = max(most, reach)
    return most


class OpenRun:
    """One piece of unknown length: tokens leave as soon as they are final."""

    def __init__(self, model: ByteBPE):
        self.model, self.held = model, b""
        self.window = max(4096, 8 * model.lookahead)

    def feed(self, data: bytes, end: bool = False) -> bytes:
        self.held += data
        out = []
        while self.held and (end or len(self.held) >= self.window):
            part, rest = (self.held, b"") if len(self.held) <= 2 * self.window else (self.held[:2 * self.window], self.held[2 * self.window:])
            last = end and not rest
            at, stable = 0, len(part) if last else len(part) - self.model.lookahead
            for t in self.model.merge(part):
                if at + len(self.model.bytes[t]) > stable:
                    break
                out.append(t)
                at += len(self.model.bytes[t])
            self.held = part[at:] + rest
            if not last and len(self.held) < 2 * self.window and not end:
                break
        return array("I", out).tobytes()


def _key(piece: str) -> str:
    """A piece that begins with a space is known by the rest of it, another one by itself behind a NUL."""
    return piece[1:] if piece[0] == " " and piece[1:2] != "\0" else "\0" + piece


class _Memory(dict):
    """Ids of closed strings met lately, in two generations: the older one goes when the newer one is full."""

    def __init__(self, model: ByteBPE, whole, size: int = REMEMBERED):
        self.model, self.whole, self.size, self.old = model, whole, size, {}

    def text(self, s: str) -> bytes:
        """Ids of a closed text without special tokens."""
        if self.whole:
            return self.whole(s)
        return b"".join([self[_key(p)] for p in PIECES.findall(s)])

    def __missing__(self, key: str) -> bytes:
        v = self.old.get(key)
        if v is None:
            s = key[1:] if key[:1] == "\0" else " " + key
            if self.whole:
                v = self.whole(s)
            else:
                pieces = PIECES.findall(s)
                v = array("I", self.model.merge(s.encode())).tobytes() if len(pieces) == 1 else \
                    b"".join([self[_key(p)] for p in pieces])
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = v
        return v


class Encoder:
    """``feed`` text in chunks, then ``finish``; both return ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, model: ByteBPE, whole=None, known: _Memory | None = None):
        """whole: another function from a closed text without special tokens to ids, in place of the merges.

        known: a memory of words to go on with, of the same model and function.
        """
        self.model = model
        self.known = _Memory(model, whole) if known is None else known
        self.plain = self.known.text
        self.special = sorted(model.special, key=len, reverse=True)
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.buf, self.run = "", None

    def _closed(self, s: str) -> bytes:
        """Ids of text between two borders, without special tokens."""
        if not s:
            return b""
        if _ODD.search(s) or "\0" in s:
            return self.plain(s)
        first, *rest = s.split(" ")
        return (self.plain(first) if first else b"") + b"".join(map(self.known.__getitem__, rest))

    def _closed_all(self, s: str) -> bytes:
        if not any(x in s for x in self.special):
            return self._closed(s)
        return b"".join(array("I", [self.model.special[p]]).tobytes() if p in self.model.special else self._closed(p)
                        for p in self.splitter.split(s))

    def feed(self, chunk: str) -> bytes:
        self.buf += chunk
        out = b""
        if self.run is None:
            cut = self._border()
            if cut > 0:
                out, self.buf = self._closed_all(self.buf[:cut]), self.buf[cut:]
        if self.run is not None or len(self.buf) > CHUNK:
            out += self._drain()
        return out

    def _border(self) -> int:
        """The last single space between two other characters: no piece crosses it."""
        b, p = self.buf, len(self.buf) - 1
        for _ in range(200):
            p = b.rfind(" ", 1, max(p, 1))
            if p < 1:
                return 0
            if not b[p - 1].isspace() and not b[p + 1].isspace():
                return p
        return 0

    def _drain(self) -> bytes:
        """Text without such a border: whole pieces leave, a long open run is merged in a window."""
        out = []
        while True:
            if self.run is not None:
                kind, stream = self.run
                m = kind.match(self.buf)
                end = m.end() if m else 0
                keep = self._partial_special(self.buf)
                sp = min((self.buf.find(x) for x in self.special if x in self.buf), default=-1)
                if sp >= 0:
                    end = min(end, sp)
                if end >= keep:  # still open
                    end = keep
                    if kind is _RUNS[2]:
                        end = max(0, end - 1)  # the last space may belong to the next word
                    out.append(stream.feed(self.buf[:end].encode()))
                    self.buf = self.buf[end:]
                    return b"".join(out)
                if kind is _RUNS[2] and end > 0 and sp != end:
                    end -= 1
                out.append(stream.feed(self.buf[:end].encode(), end=True))
                self.buf, self.run = self.buf[end:], None
            if any(x in self.buf for x in self.special):
                at = max(self.buf.rfind(x) + len(x) for x in self.special if x in self.buf)
                out.append(self._closed_all(self.buf[:at]))
                self.buf = self.buf[at:]
            keep = self._partial_special(self.buf)
            found = PIECES.findall(self.buf[:keep])
            hold = min(2, len(found)) if len(found) > 1 and found[-2] == "'" else min(1, len(found))
            done = found[:len(found) - hold]
            out.append(b"".join([self.known[_key(p)] for p in done]))
            self.buf = self.buf[sum(map(len, done)):]
            last = found[-1] if found else ""
            if hold == 1 and len(last) > 4096:
                space = 1 if last[0] == " " and not last.isspace() else 0
                self.run = (next(r for r in _RUNS if r.match(last, space)), OpenRun(self.model))
                if space:
                    self.run[1].held = b" "
                    self.buf = self.buf[1:]
                continue
            return b"".join(out)

    def _partial_special(self, s: str) -> int:
        """Where a special token may have begun at the end of what is known; the end if none has."""
        for k in range(min(len(s), max(map(len, self.special), default=1) - 1), 0, -1):
            if any(x.startswith(s[-k:]) for x in self.special):
                return len(s) - k
        return len(s)

    def finish(self) -> bytes:
        out = b""
        if self.run is not None:
            kind, stream = self.run
            m = kind.match(self.buf)
            end = m.end() if m else 0
            sp = min((self.buf.find(x) for x in self.special if x in self.buf), default=-1)
            if sp >= 0:
                end = min(end, sp)
            if kind is _RUNS[2] and end < len(self.buf) and end > 0 and end != sp:
                end -= 1
            out = stream.feed(self.buf[:end].encode(), end=True)
            self.buf, self.run = self.buf[end:], None
        out += self._closed_all(self.buf)
        self.buf = ""
        return out

    def encode(self, text: str):
        """Ids of a whole text, in arrays of bounded size."""
        if len(text) <= CHUNK:
            ids = self._closed_all(text)
            if ids:
                yield np.frombuffer(ids, "<u4")
            return
        for i in range(0, len(text), CHUNK):
            ids = self.feed(text[i:i + CHUNK])
            if ids:
                yield np.frombuffer(ids, "<u4")
        ids = self.finish()
        if ids:
            yield np.frombuffer(ids, "<u4")


@lru_cache(maxsize=2)
def worker_model(path: str) -> tuple[ByteBPE, _Memory]:
    """The tokenizer and a memory of words, read once by each Python worker and used by all its tasks."""
    model = ByteBPE(path)
    return model, _Memory(model, None)


def worker_encoder(path: str) -> Encoder:
    model, known = worker_model(path)
    return Encoder(model, known=known)


class Decoder:
    """Ids to text: vocabulary bytes through an incremental UTF-8 state machine."""

    def __init__(self, model: ByteBPE):
        self.get = model.bytes.__getitem__
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.get, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


def batches_of_text(batches, rows: int = 64):
    for b in batches:
        for i in range(0, b.num_rows, rows):
            part = b.slice(i, rows)
            yield part, [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]


def _round_trip(path: str):
    def run(batches):
        enc = worker_encoder(path)
        model = enc.model
        decimal = [str(i) for i in range(len(model.bytes))].__getitem__
        for b, texts in batches_of_text(batches):
            rows = []
            for t in texts:
                a, d, dec, n = hashlib.sha256(), hashlib.sha256(), Decoder(model), 0
                for ids in enc.encode(t):
                    ids = ids.tolist()
                    a.update(((("," if n else "")) + ",".join(map(decimal, ids))).encode())
                    d.update(dec.feed(ids).encode())
                    n += len(ids)
                d.update(dec.finish().encode())
                rows.append((n, a.hexdigest(), d.hexdigest()))
            n, a, d = zip(*rows)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(n, pa.int64()), pa.array(a), pa.array(d)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _ids(path: str):
    def run(batches):
        enc = worker_encoder(path)
        for b, texts in batches_of_text(batches):
            rows = [np.concatenate([*enc.encode(t), np.zeros(0, "<u4")]).astype(np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return run


def _texts(path: str):
    def run(batches):
        model, _ = worker_model(path)
        for b in batches:
            out = []
            for ids in b.column(b.schema.get_field_index("ids")).to_pylist():
                d = Decoder(model)
                out.append(d.feed([i for i in ids or [] if i is not None and 0 <= i < len(model.bytes)]) + d.finish())
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(out, pa.string())], names=["doc_id", "text"])
    return run


def _narrow(docs: DataFrame, *cols: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *cols)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every text."""
    return _narrow(docs, "text").mapInArrow(_ids(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every list of ids (null: empty; numbers that are no id are left out)."""
    return _narrow(encoded, "ids").mapInArrow(_texts(path), "doc_id long, text string")


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return _narrow(table(spark, sf_dir, "documents"), "text").mapInArrow(
        _round_trip(public_tokenizers.path("byte_bpe_50k.json")), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
