"""Cost-balanced packing of token sequences.

A piece of length n costs LINEAR * n + QUADRATIC * n^2 (attention stays inside a piece). Documents longer
than a sequence first give off full pieces; what remains of a block of documents is assigned in descending
order to the sequence of lowest cost that still has room, cut where it doesn't fit. A block opens only as
many sequences as its tokens fill; what is left over goes to the task's next block, and at the task's end to
sequences whose lengths are powers of two, so no padding is needed.

Each task packs the rows that it reads, block by block, in bounded memory and without a shuffle; sequence ids
are the task's number and a counter, and a task run again gives the same rows.

Defined results: null text counts as empty and is packed as the single end id. Rows with a null or repeated
doc_id are packed like any other. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import ByteBPE, Encoder, _Memory, batches_of_text, worker_model
from .common import table

LENGTH, END_ID = 2048, 1
BLOCK_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024  # a piece of 1024 tokens costs as much for attention as for the rest
TRIES = 8                            # sequences looked at for one in which a piece fits whole
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


class Packer:
    """Packs pieces (doc, start, ids) of a task; ``rows`` gets (doc, start, length, crc, sequence, offset)."""

    def __init__(self, first: int, length: int = LENGTH):
        self.next, self.length = first, length
        self.rest: list[tuple] = []
        self.tokens = 0
        self.rows: list[tuple] = []

    def _put(self, seq: int, offset: int, doc, start: int, ids: np.ndarray) -> None:
        self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), seq, offset))

    def full(self, doc, start: int, ids: np.ndarray) -> None:
        self._put(self.next, 0, doc, start, ids)
        self.next += 1

    def add(self, doc, start: int, ids: np.ndarray) -> None:
        self.rest.append((doc, start, ids))
        self.tokens += len(ids)

    def pack(self) -> None:
        """Fill as many sequences as the waiting pieces can; the rest waits on."""
        n = self.tokens // self.length
        if not n:
            return
        items = sorted(self.rest, key=lambda x: -len(x[2]))
        open_ = [(0.0, self.next + i, 0) for i in range(n)]  # cost, sequence, tokens in it
        self.next += n
        self.rest, self.tokens = [], 0
        for doc, start, ids in items:
            while len(ids) and open_:
                seen = []
                while open_ and len(seen) < TRIES:
                    seen.append(heapq.heappop(open_))
                    if self.length - seen[-1][2] >= len(ids):
                        break
                fits = self.length - seen[-1][2] >= len(ids)
                c, seq, used = seen.pop() if fits else seen.pop(0)
                for s in seen:
                    heapq.heappush(open_, s)
                part, rest = ids[:self.length - used], ids[self.length - used:]
                self._put(seq, used, doc, start, part)
                start, used = start + len(part), used + len(part)
                if used < self.length:
                    heapq.heappush(open_, (c + cost(len(part)), seq, used))
                ids = rest
            if len(ids):
                self.add(doc, start, ids)

    def finish(self) -> None:
        """The last tokens, fewer than a sequence holds, in sequences of power-of-two lengths."""
        self.pack()
        room, used = 0, 0
        for doc, start, ids in sorted(self.rest, key=lambda x: -len(x[2])):
            while len(ids):
                if not room:
                    room, used, self.next = 1 << (self.tokens.bit_length() - 1), 0, self.next + 1
                part = ids[:room]
                self._put(self.next - 1, used, doc, start, part)
                start, used, room, self.tokens = start + len(part), used + len(part), room - len(part), self.tokens - len(part)
                ids = ids[len(part):]
        self.rest = []


@lru_cache(maxsize=2)
def _source(path: str, ranks: str | None):
    """Tokenizer, compiled encoder and memory of words: made once by each Python worker, used by all its tasks."""
    if ranks is None:
        model, known = worker_model(path)
        return model, None, known
    import base64

    import tiktoken
    model = ByteBPE(path)
    with open(ranks, "rb") as f:
        ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
    whole = lambda s: array("I", enc.encode_ordinary(s)).tobytes()
    return model, whole, _Memory(model, whole)


def token_source(path: str, ranks: str | None) -> Encoder:
    """Encoder of the tokenizer file; words that are new to it go to the compiled library, if its ranks file is given."""
    return Encoder(*_source(path, ranks))


def _pack(path: str, ranks: str | None, length: int, end_id: int):
    def run(batches):
        enc = token_source(path, ranks)
        packer = Packer(pyspark.TaskContext.get().partitionId() << 40, length)
        total: list[int] = []   # tokens of each document of the task's open blocks, by its number
        ids_of: list = []
        end = np.array([end_id], "<u4")
        base = 0

        def out():
            nonlocal base
            d, s, n, c, q, o = zip(*packer.rows)
            packer.rows = []
            rows = pa.RecordBatch.from_arrays([
                pa.array([ids_of[i - base] for i in d], pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64()),
                pa.array([total[i - base] for i in d], pa.int64()), pa.array(q, pa.int64()), pa.array(o, pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            low = min((x[0] for x in packer.rest), default=base + len(total))
            del total[:low - base], ids_of[:low - base]
            base = low
            return rows

        for b, texts in batches_of_text(batches):
            for doc_id, t in zip(b.column(b.schema.get_field_index("doc_id")).to_pylist(), texts):
                doc, start, held = base + len(total), 0, np.zeros(0, "<u4")
                for part in (*enc.encode(t), end) if len(t) < 1 << 16 else _then(enc.encode(t), end):
                    held = np.concatenate((held, part))
                    k = 0
                    while len(held) - k >= length:
                        packer.full(doc, start, held[k:k + length])
                        start, k = start + length, k + length
                    held = held[k:]
                if len(held):
                    packer.add(doc, start, held.copy())
                total.append(start + len(held))
                ids_of.append(doc_id)
                if packer.tokens >= BLOCK_TOKENS:
                    packer.pack()
                    yield out()
            if len(packer.rows) >= 100_000:
                yield out()
        packer.finish()
        if packer.rows:
            yield out()
    return run


def _then(parts, last):
    yield from parts
    yield last


def pack(docs: DataFrame, path: str, ranks: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """A row per piece of every document: where it begins, its checksum, its sequence and place there."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack(path, ranks, length, end_id), SCHEMA)


def public_pack(docs: DataFrame) -> DataFrame:
    import public_tokenizers as p
    return pack(docs, p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"))


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return public_pack(table(spark, sf_dir, "documents"))
