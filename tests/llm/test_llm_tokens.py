import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edustar.llm import bpe as B
from edustar.llm import packing as K
from conftest import SF_SMALL
from helpers_llm import docs_of

PATH = P.path("byte_bpe_50k.json")
BITS = ["a", "the", "  ", "\n", " ", "'s", "'ll", "'", "é", "ß", "日本", "<|endoftext|>", "<|endo", "<", "|", "1", "23", "!", "...", "\t", " ",
        "😀", "é", "I'", "re", "_", "²", "½", "xxxxx", "\0", "\0a", " \0"]


@pytest.fixture(scope="module")
def model():
    return B.ByteBPE(PATH)


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def ids_of(model, text, step):
    enc, out = B.Encoder(model), []
    for i in range(0, len(text), step):
        out.append(enc.feed(text[i:i + step]))
    return np.frombuffer(b"".join([*out, enc.finish()]), "<u4").tolist()


def test_random_texts_as_the_library(model, lib):
    r, enc = random.Random(1), B.Encoder(model)
    for _ in range(1500):
        t = "".join(r.choices(BITS, k=r.randint(0, 60)))
        ids = np.concatenate([*enc.encode(t), np.zeros(0, "<u4")]).tolist()
        assert ids == lib.encode(t, add_special_tokens=False).ids, repr(t)
        d = B.Decoder(model)
        assert d.feed(ids) + d.finish() == lib.decode(ids, skip_special_tokens=False) == t


@pytest.mark.parametrize("text", [
    "ab" * 9000, "the" * 5000 + " x", " " * 9000 + "x", "\n" * 6000 + " y", "!" * 7000 + "<|endoftext|>" + "a" * 7000,
    "a" * 5000 + "<|endof" + "b" * 4999, "1" * 9000 + "²" * 100, "é" * 6000 + "'s", "x  " * 300 + " a" * 400, "日本語" * 3000])
def test_open_runs_leave_in_bounded_windows(model, lib, monkeypatch, text):
    monkeypatch.setattr(B, "CHUNK", 50)
    assert ids_of(model, text, 50) == lib.encode(text, add_special_tokens=False).ids


def test_small_chunks_of_random_texts(model, lib, monkeypatch):
    monkeypatch.setattr(B, "CHUNK", 20)
    r = random.Random(3)
    for _ in range(150):
        t = "".join(r.choices(BITS, k=r.randint(1, 120)))
        assert ids_of(model, t, r.randint(1, 30)) == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_window_memory_is_bounded(model):
    run = B.OpenRun(model)
    most = 0
    for _ in range(300):
        run.feed(b"abcdefgh" * 64)
        most = max(most, len(run.held))
    assert most <= 2 * run.window and run.feed(b"", end=True) is not None


def test_lookahead_of_a_small_merge_list():
    # "ab" can lose its end to "bc", and that to "cd": a border needs two further bytes
    assert B.sufficient_lookahead([(b"c", b"d"), (b"b", b"c"), (b"a", b"b")]) == 3
    assert B.sufficient_lookahead([(b"a", b"b")]) == 1


def test_decoder_replaces_broken_bytes(model, lib):
    r = random.Random(2)
    for _ in range(200):
        ids = [r.randrange(50257) for _ in range(r.randint(1, 12))]
        d = B.Decoder(model)
        assert "".join(d.feed([i]) for i in ids) + d.finish() == lib.decode(ids, skip_special_tokens=False)


def test_op7_equals_the_library(spark, lib):
    import hashlib
    got = {r.doc_id: r for r in B.op7_bpe_transducer(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for d in docs:
        ids = lib.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_round_trip_of_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "x" * 200_000), (4, " a\n\n b"), (4, " a\n\n b"), (None, "ß <|endoftext|>")]
    e = B.encode(docs_of(spark, rows, clash=True), PATH)
    back = B.decode(e, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert B.encode(docs_of(spark, []), PATH).count() == 0
    assert [r.text for r in B.decode(spark.createDataFrame([(1, None), (2, [-5, 10**6])], "doc_id long, ids array<int>"), PATH).collect()] == ["", ""]


def check_packing(pieces, texts, lib, length=2048):
    seq, doc = {}, {}
    for p in pieces:
        seq.setdefault(p.sequence_id, []).append(p)
        doc.setdefault(p.doc_id, []).append(p)
    for own in seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= length
    for i, t in texts.items():
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [K.END_ID], "<u4")
        at = 0
        for p in sorted(doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    sizes = [sum(p.length for p in own) for own in seq.values()]
    return sum(length - s for s in sizes if s & (s - 1)), sum(sizes)


def test_op8_packs_every_id_once_with_no_padding(spark, lib):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    padding, total = check_packing(K.op8_cost_packing(spark, SF_SMALL).collect(), {d.doc_id: d.text for d in docs}, lib)
    assert padding == 0 and total > 0


def test_packing_edge_rows(spark, lib):
    rows = [(1, None), (2, ""), (3, "word " * 30_000), (5, "x" * 9000), (6, "a b c")]
    pieces = K.pack(docs_of(spark, rows, clash=True).repartition(2), PATH).collect()
    assert check_packing(pieces, dict(rows), lib)[0] == 0
    assert K.pack(docs_of(spark, []), PATH).count() == 0
    again = K.pack(docs_of(spark, [(None, "a b"), (7, "a b"), (7, "a b")]), PATH).collect()
    assert sum(p.length for p in again) == 9 and {p.doc_id for p in again} == {None, 7}


def test_sequences_are_full_and_balanced():
    r = np.random.default_rng(4)
    p = K.Packer(0, 256)
    total = 0
    for d in range(400):
        n = int(r.integers(1, 256))
        p.add(d, 0, np.arange(n, dtype="<u4"))
        total += n
    p.pack()
    by = {}
    for d, s, n, c, q, o in p.rows:
        by.setdefault(q, []).append(n)
    assert all(sum(v) == 256 for v in by.values()) and len(by) == total // 256 and p.tokens == total % 256
    p.finish()
    cost = [sum(K.cost(n) for n in v) for v in by.values()]
    assert sum(r[2] for r in p.rows) == total and max(cost) < 1.3 * np.mean(cost)


def test_pieces_recomputed_are_the_same(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.col("doc_id") < 60)
    assert sorted(K.public_pack(d).collect()) == sorted(K.public_pack(d).collect())
