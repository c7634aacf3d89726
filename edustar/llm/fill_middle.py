"""Fill-in-the-middle transformation with content-defined chunk memoization.

A text is cut into chunks where a rolling (gear) hash of the last 32 bytes has its low bits zero, so that equal
passages give equal chunks wherever they stand. A chunk's boundary summary is (code points, unit ends inside it,
does it begin with white space, does it end with white space). Summaries are kept in a cache of bounded size whose
key is the chunk's content itself, so a hit has been compared byte by byte; every shared passage is summarised once
per worker. Summaries add up: a unit ends where a non-space byte is followed by a space, also across two chunks, and
at the end of the text. The running sums give the number of units, and a cut is found by descending into the one
chunk that holds it.

A unit is ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, matched left to right. Where the cuts fall, which form
is taken and whether a text is transformed at all follow from the sha256 of ``<seed>:<doc_id>``.

Defined results: null text counts as empty and stays as it is (form plain, no units). A text that contains one of
the markers stays plain, so that every output can be taken apart again. A null doc_id hashes as the seed alone.
Repeated rows give equal rows. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, free_name, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
WINDOW = 32                                    # bytes that the rolling hash looks back on
LEAST, MEAN, MOST = 128, 1024, 1 << 16         # bytes of a chunk
BLOCK = 1 << 20                                # bytes hashed at once
CACHE_BYTES = 8 << 20                          # chunk contents that one generation of the cache holds
GEAR = np.random.default_rng(13).integers(0, 1 << 32, 256, dtype=np.uint32)
SPACES = b" \t\n\x0b\x0c\r"
KIND = bytes(32 if i in SPACES else 97 for i in range(256))  # a space, or a letter for any other byte
FOLLOWING = bytes(range(0x80, 0xC0))           # bytes that don't begin a code point


@dataclass(frozen=True)
class Rule:
    seed: int = 42
    rate: int = 50      # per cent of the texts that are transformed
    spm: int = 80       # per cent of those that put the suffix first


def hash_cuts(buf: np.ndarray) -> np.ndarray:
    """Places behind which the rolling hash asks for a cut, in ascending order."""
    out = []
    for at in range(0, len(buf), BLOCK):
        low = max(0, at - WINDOW + 1)
        h = GEAR[buf[low:at + BLOCK]]
        for s in (1, 2, 4, 8, 16):             # doubles the window: each byte's share moves up a bit per byte
            h[s:] += h[:-s] << np.uint32(s)
        p = np.flatnonzero((h >> np.uint32(32 - MEAN.bit_length() + 1)) == 0) + low + 1
        out.append(p[p > at])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def ends_of(n: int, cuts: list[int]) -> list[int]:
    """Ends of the chunks of a text of ``n`` bytes, none shorter than LEAST (but the last) or longer than MOST."""
    ends, last = [], 0
    for c in (*cuts, n):
        while c - last > MOST:
            last += MOST
            ends.append(last)
        if c - last >= LEAST or c == n and c > last:
            ends.append(c)
            last = c
    return ends


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    kind = chunk.translate(KIND)
    return len(chunk.translate(None, FOLLOWING)), kind.count(b"a "), kind[0] == 32, kind[-1] == 32


class Memory:
    """Summaries by chunk content, in two generations of bounded size."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.young, self.old, self.size, self.limit, self.hits = {}, {}, 0, limit, 0

    def __getitem__(self, chunk: bytes):
        s = self.young.get(chunk)
        if s is not None:
            self.hits += 1
            return s
        s = self.old.get(chunk)
        if s is None:
            s = summary(chunk)
        else:
            self.hits += 1
        if self.size + len(chunk) > self.limit:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[chunk] = s
        self.size += len(chunk) + 100
        return s


class Counted:
    """A text's chunks with the running sums of their summaries."""

    def __init__(self, text: bytes, ends: list[int], memory: Memory):
        self.text, self.starts, self.chars, self.units = text, [0, *ends], [0], [0]
        chars = units = 0
        open_ = False  # the chunk before ended inside a unit's word
        for a, b in zip(self.starts, ends):
            c, u, first, last = memory[text[a:b]]
            if open_ and first:
                self.units[-1] += 1
                units += 1
            chars, units, open_ = chars + c, units + u, not last
            self.chars.append(chars)
            self.units.append(units)
        self.n = units + 1 if text else 0      # the end of the text ends the last unit

    def cut(self, k: int) -> tuple[int, int]:
        """Byte and code point behind the first ``k`` units."""
        if k == 0:
            return 0, 0
        if k == self.n:
            return len(self.text), self.chars[-1]
        i = bisect_left(self.units, k) - 1     # the k-th unit end is in chunk i, or between it and the next
        a, b = self.starts[i], self.starts[i + 1]
        kind = np.frombuffer(self.text[a:b].translate(KIND), np.uint8)
        inside = np.flatnonzero((kind[:-1] == 97) & (kind[1:] == 32))
        j = k - self.units[i] - 1
        at = a + int(inside[j]) + 1 if j < len(inside) else b
        return at, self.chars[i] + len(self.text[a:at].translate(None, FOLLOWING))


def draws(seed: int, doc_id) -> list[int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transformed(text: bytes, doc_id, counted: Counted, rule: Rule) -> tuple[str, bytes, int | None, int | None]:
    """form, output, code points of prefix and of middle (None where plain)."""
    h1, h2, h3, h4 = draws(rule.seed, doc_id)
    if not text or h3 % 100 >= rule.rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", text, None, None
    x, y = sorted((h1 % (counted.n + 1), h2 % (counted.n + 1)))
    (a, ca), (b, cb) = counted.cut(x), counted.cut(y)
    if h4 % 100 < rule.spm:
        return "spm", b"".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b])), ca, cb - ca
    return "psm", b"".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b])), ca, cb - ca


def restored(output: bytes, form: str) -> bytes:
    """The text that an output of this form came from."""
    if form == "plain":
        return output
    second = PREFIX if form == "spm" else SUFFIX
    i, j = output.index(second), output.rindex(MIDDLE)
    one, two, middle = output[3:i], output[i + 3:j], output[j + 3:]
    return b"".join((two, middle, one) if form == "spm" else (one, middle, two))


@lru_cache(maxsize=1)
def worker_memory() -> Memory:
    """One cache per Python worker, used by all its tasks."""
    return Memory()


def counted_texts(texts: list[bytes], memory: Memory):
    """Chunks and sums of each text; the rolling hash runs over all of them at once."""
    cuts = hash_cuts(np.frombuffer(b"".join(texts), np.uint8))
    at = 0
    for t in texts:
        lo, hi = np.searchsorted(cuts, (at, at + len(t)), "right")
        yield Counted(t, ends_of(len(t), (cuts[lo:hi] - at).tolist()), memory)
        at += len(t)


def _rows(rule: Rule, digests: bool):
    def run(batches):
        memory = worker_memory()
        for b, texts in chunks(batches):
            ids = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            out = []
            for doc_id, t, c in zip(ids, texts, counted_texts(texts, memory)):
                form, output, p, m = transformed(t, doc_id, c, rule)
                if digests:
                    out.append((doc_id, c.n, form, p, m, hashlib.sha256(output).hexdigest(), hashlib.sha256(restored(output, form)).hexdigest()))
                else:
                    out.append((doc_id, c.n, form, p, m, output.decode()))
            cols = list(zip(*out))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", *(["output_sha256", "restored_sha256"] if digests else ["output"])])
    return run


_HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long, "


def fill_middle(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output of every document."""
    return _narrow(docs).mapInArrow(_rows(rule, False), _HEAD + "output string")


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def restore(outputs: DataFrame) -> DataFrame:
    """``fill_middle``'s rows with the text they came from, in a column ``text``."""
    o, form = F.col("output"), F.col("form")
    first = F.when(form == "spm", PREFIX.decode()).otherwise(SUFFIX.decode())
    i, j = F.instr(o, first), F.char_length(o) - F.instr(F.reverse(o), MIDDLE.decode()[::-1]) - 1
    one, two, middle = o.substr(F.lit(4), i - 4), o.substr(i + 3, j - i - 3), o.substr(j + 3, F.char_length(o))
    text = F.when(form == "plain", o).when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))
    return outputs.withColumn(free_name(outputs, "text"), text)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _narrow(table(spark, sf_dir, "documents"))
    return docs.mapInArrow(_rows(Rule(), True), _HEAD + "output_sha256 string, restored_sha256 string")


OP13_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id::VARCHAR) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
             ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM t),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS x, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS y FROM u),
p AS (SELECT doc_id, t, n::BIGINT AS n, array_to_string(u[1:x], '') AS prefix, array_to_string(u[x + 1:y], '') AS middle, array_to_string(u[y + 1:], '') AS suffix,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
