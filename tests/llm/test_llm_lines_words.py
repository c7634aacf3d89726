"""Line deduplication, spelling variants and the fill-in-the-middle transformation against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from edustar.llm import fill_middle as M
from edustar.llm import line_dedup as L
from edustar.llm import spelling_fst as S
from edustar.llm.common import chunks, ship, written
from helpers_llm import docs_of
from tools.compare import compare, duck

SHARED = "A line that several documents share"
LINES = [(4, f"{SHARED}\nown words here 1\n  {SHARED.upper()}\t\nshort"), (2, f"head of two\n{SHARED}\n{SHARED}\ntail"), (9, f"\t{SHARED.lower()} \n"), (7, None), (8, ""),
         (3, "short\nshort\nÉTÉ ÉTÉ ÉTÉ"), (5, "été été été\nÉTÉ ÉTÉ ÉTÉ"), (4, "a second text of four\nshort"), (6, "a second text of four"), (None, f"{SHARED}\nno number"),
         (None, "no number here either"), (11, "no number here either"), (12, ("x" * 50 + "\n") * 3000), (13, "y\n" + "x" * 50 + "\r\nz\n\n"), (14, "123456789\n1234567890"),
         (15, "123456789\n1234567890"), (9, f"\t{SHARED.lower()} \n")]


def lines_brute(rows, least=10):
    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(key(x), order(i)) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def applied(docs):
    out = L.apply_bitmaps(docs, L.keep_bitmaps(docs))
    return sorted((str(r.doc_id), r.text or "") for r in out.collect())


@pytest.mark.parametrize("hot", [False, True])
def test_lines_of_edge_rows(spark, monkeypatch, hot):
    if not hot:
        monkeypatch.setattr(L, "detect_hot_keys", lambda rows, keys: __import__("edustar.operators.joins", fromlist=["x"]).HotKeys(keys, None))
    docs = docs_of(spark, LINES, clash=True)
    assert applied(docs) == sorted((str(i), t) for i, _, _, t in lines_brute(LINES))
    assert L.apply_bitmaps(docs, L.keep_bitmaps(docs)).columns == docs.columns


def test_lines_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    assert applied(docs_of(spark, LINES)) == sorted((str(i), t) for i, _, _, t in lines_brute(LINES))


def test_bitmaps_are_runs_of_kept_lines(spark):
    rows = [(1, "common line one\ncommon line two"), (2, "own\ncommon line one\ncommon line two\nown 2\nown 3\ncommon line one"), (3, "common line two")]
    got = {r.doc_id: ([tuple(x) for x in r.keep], r.n_lines, r.n_dropped) for r in L.keep_bitmaps(docs_of(spark, rows)).collect()}
    assert got == {2: ([(0, 1), (3, 2)], 6, 3), 3: ([], 1, 1)}


def test_random_lines_with_a_hot_one(spark):
    r = random.Random(5)
    rows = [(i, "\n".join("the hot line of them all" if r.random() < 0.4 else f"line number {r.randrange(300)}" for _ in range(r.randrange(1, 12)))) for i in range(400)]
    assert applied(docs_of(spark, rows).repartition(7)) == sorted((str(i), t) for i, _, _, t in lines_brute(rows))


def test_one_range_shuffle_and_no_python(spark):
    docs = docs_of(spark, LINES)
    plan = L.dropped_lines(written(L.line_rows(docs), "lines"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("key", ["op11_line_dedup", "op13_fill_middle"])
def test_equals_sql(spark, key):
    con = duck(SF_SMALL)
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert r["ok"], r


def test_empty_tables(spark):
    docs = docs_of(spark, [])
    ship(spark)
    assert applied(docs) == [] and M.fill_middle(docs).count() == 0 and S.variants(written(S.vocabulary(docs), "t")).count() == 0


# --- fill in the middle --------------------------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fim_brute(doc_id, text, rule=M.Rule()):
    text = text or ""
    h = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    u = UNITS.findall(text)
    n = len(u)
    if not text or h3 % 100 >= rule.rate or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:x]), "".join(u[x:y]), "".join(u[y:])
    form = "spm" if h4 % 100 < rule.spm else "psm"
    return doc_id, n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    r = random.Random(3)
    passage = "".join(r.choice("abcdé  \n\t日") for _ in range(9000))
    rows = [(1, None), (2, ""), (3, " "), (4, " \n\t "), (5, "word"), (6, " word "), (7, "a b"), (None, "no id at all"), (8, "has <S> in it"), (9, "x" * 300_000), (10, " " * 200_000 + "x"),
            (11, "<P"), (12, "S><"), (13, "ends in <P" + " <"), (14, "aéb " * 100_000)]
    rows += [(100 + i, "".join(r.choice(("ab", "é", "<", "P>", " ", "\n", " ", "日本")) for _ in range(r.randrange(0, 60)))) for i in range(300)]
    rows += [(500 + i, passage[r.randrange(500):r.randrange(3000, 9000)] + "own" * r.randrange(3)) for i in range(60)]
    return rows + rows[3:8]


def test_fill_middle_equals_the_plain_version(spark):
    rows = fim_rows()
    rule = M.Rule(rate=90)
    ship(spark)
    got = M.fill_middle(docs_of(spark, rows, clash=True), rule)
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got.collect()), key=key) == sorted((fim_brute(i, t, rule) for i, t in rows), key=key)
    back = M.restore(got).select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)


def test_every_cut_and_form_is_taken_back(spark):
    memory = M.Memory(limit=4096)
    for text in [t.encode() for _, t in fim_rows()[:60] if t and len(t) < 5000]:
        c = next(M.counted_texts([text], memory))
        units = UNITS.findall(text.decode())
        assert c.n == len(units)
        for k in range(0, c.n + 1, max(1, c.n // 50)):
            p = "".join(units[:k])
            assert c.cut(k) == (len(p.encode()), len(p))
        for i in range(40):
            form, out, _, _ = M.transformed(text, i, c, M.Rule(rate=100))
            assert M.restored(out, form) == text


def test_shared_passages_are_summarised_once():
    r = random.Random(1)
    passage = bytes(r.choice(b"abcdefgh  ") for _ in range(200_000))
    memory = M.Memory()
    list(M.counted_texts([passage], memory))
    before, known = memory.hits, len(memory.young)
    list(M.counted_texts([b"other words first " + passage, passage[5000:] + b"and last"], memory))
    assert known > 100 and memory.hits - before > 1.9 * known * 0.95 and len(memory.young) <= known + 8


def test_chunks_do_not_depend_on_blocks_or_neighbours(monkeypatch):
    r = np.random.default_rng(2)
    buf = r.integers(97, 123, 300_000, dtype=np.uint8)
    whole = M.hash_cuts(buf).tolist()
    monkeypatch.setattr(M, "BLOCK", 1000)
    assert M.hash_cuts(buf).tolist() == whole
    assert all(M.LEAST <= b - a <= M.MOST for a, b in zip([0, *M.ends_of(300_000, whole)], M.ends_of(300_000, whole)[:-1]))
    assert M.ends_of(200_000, []) == [65536, 131072, 196608, 200_000]


def test_slices_of_batches_are_bounded():
    import pyarrow as pa
    b = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (0, 5, 3, 50, 4, 4, 0)]), pa.array(range(7))], names=["text", "i"]).slice(1)
    got = [(x.column(1).to_pylist(), [len(t) for t in ts]) for x, ts in chunks([b, b.slice(0, 0)], limit=9)]
    assert got == [([1, 2], [5, 3]), ([3], [50]), ([4, 5, 6], [4, 4, 0])]


# --- spelling variants ---------------------------------------------------------------------------

def neighbours(w, letters):
    for i in range(len(w) + 1):
        for c in letters:
            yield w[:i] + c + w[i:]
            if i < len(w):
                yield w[:i] + c + w[i + 1:]
        if i < len(w):
            yield w[:i] + w[i + 1:]


def variants_brute(n):
    letters = sorted(set("".join(n)))
    near = {w: {x for x in neighbours(w, letters) if x in n and x != w} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def words_brute(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if h % 199 == 0 else w] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def listed(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_spelling_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    n = words_brute(rows)
    assert len(n) > 500
    assert listed(E.queries()["op12_spelling_fst"](spark, SF_SMALL)) == variants_brute(n)


@pytest.mark.parametrize("group_rows", [1, 40, 10_000])
def test_spelling_of_a_dense_vocabulary(spark, group_rows):
    r = random.Random(group_rows)
    n = {"".join(r.choice("abé") for _ in range(r.choice((6, 6, 7, 7, 8, 13)))): r.choice((5, 6, 30, 200, 5000)) for _ in range(900)}
    n |= {"aaaaaa" + "".join(r.choice("ab") for _ in range(r.randrange(3))): 7 for _ in range(10)} | {"q" * 3000: 5, "q" * 2999: 50, "q" * 2998 + "r": 5}
    ship(spark)
    brute = {w: c for w, c in n.items() if len(w) < 100}
    got = listed(S.variants(written(spark.createDataFrame(list(n.items()), "word string, n long"), "t"), group_rows=group_rows))
    assert [x for x in got if len(x[0]) < 100] == variants_brute(brute)
    assert sorted((len(x[0]), x[2], x[0][-1], x[3] and len(x[3])) for x in got if len(x[0]) > 100) == [(2999, 1, "r", 2999), (2999, 2, "q", None), (3000, 1, "q", 2999)]


def test_words_of_edge_rows(spark):
    rows = [(None, "Éclair eclair ÉCLAIR " * 3), (1, None), (2, ""), (2, "x×yzab÷ " * 5), (3, "longest" * 40_000 + " " + "repeat " * 200_000), (4, "short five5 sixsix " * 6), (4, "short five5 sixsix " * 6)]
    ship(spark)
    got = {r.word: r.n for r in S.vocabulary(docs_of(spark, rows, clash=True)).collect()}
    assert got == words_brute(rows)


def test_the_acceptor_is_minimal():
    a = S.Acceptor(sorted(x + y for x in ("ab", "cd", "e") for y in ("ing", "ed", "s")))
    assert a.count[a.start] == 9 and len(a.arcs) == 8
