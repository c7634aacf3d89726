import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from edustar.llm import pii_crf as P
from edustar.llm import quality_fm as Q
from edustar.llm import toxicity as X
from conftest import SF_MID, SF_SMALL
from helpers_llm import docs_of

EDGES = [(1, None), (2, ""), (3, "word " * 40_000), (4, "Plain text."), (4, "Plain text."), (None, "Plain text."), (5, "😀 \0 \n\t")]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def accuracy(scores, labels):
    right = [s == y for s, y in zip(scores, labels)]
    return sum(right) / len(right)


def test_squares_identity_equals_all_pairs():
    r = np.random.default_rng(1)
    m = Q.FactorisationMachine(np.zeros(Q.STATS), np.ones(Q.STATS))
    m.ws, m.ww, m.vs, m.vw = r.normal(size=m.ws.shape), r.normal(size=m.ww.shape), r.normal(size=m.vs.shape), r.normal(size=m.vw.shape)
    stats, ids, off = Q.features([b"a b c a", b"", b"one | two"], np.array([7.0, 0, 9]))
    got = m.logit(stats, ids, off)
    for k in range(3):
        own = ids[off[k]:off[k + 1]]
        x = np.concatenate((m.scaled(stats)[k], np.full(len(own), 1 / np.sqrt(max(1, len(own))))))
        w, v = np.concatenate((m.ws, m.ww[own])), np.concatenate((m.vs, m.vw[own]))
        pairs = sum(x[i] * x[j] * (v[i] @ v[j]) for i, j in itertools.combinations(range(len(x)), 2))
        assert np.isclose(got[k], m.w0 + w @ x + pairs)


def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in Q.op1_quality_fm(spark, SF_MID).collect()}
    lab = [r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert accuracy([got[r.doc_id].predicted for r in lab], [r.quality for r in lab]) >= 0.95


def test_quality_edge_rows_and_missing_labels(spark):
    docs = docs_of(spark, EDGES, clash=True)
    for labels in ([], [(1, 1, 0)], [(1, None, None), (None, 1, 1), (4, 0, 0), (4, 1, 1), (3, 1, 0)]):
        m = Q.train(docs, labelled(spark, labels) if labels else labelled(spark, [(9, 1, 1)]).limit(0), F.lit(True))
        s = Q.score(docs, m).collect()
        assert len(s) == len(EDGES) and all(0 <= r.score <= 1 for r in s)
        kept = Q.accepted(docs, m, 0.0)
        assert kept.columns == docs.columns and kept.count() == len(EDGES)
        assert Q.score(docs_of(spark, []), m).count() == 0


def test_a_model_is_the_same_for_another_row_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    a = Q.train(docs, labels, Q.learning_fold())
    b = Q.train(docs.repartition(5), labels.repartition(3), Q.learning_fold())
    assert np.array_equal(a.ww, b.ww) and np.array_equal(a.ws, b.ws)


def test_folding():
    assert X.fold("Ѕtup1d iԁiot! tra$h m0r0n").split() == ["stupid", "idiot", "trash", "moron"]
    assert X.fold("É-ß\na@b") == " é ß aab " and X.fold("e\u0301 ｉｄｉｏｔ a\u0334b") == " é idiot ab "
    assert X.fold("") == "  "


def test_toxicity_on_held_out_rows(spark):
    got = {r.doc_id: r for r in X.op6_toxicity(spark, SF_MID).collect()}
    lab = [r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(got) == 1000 and accuracy([got[r.doc_id].predicted for r in lab], [r.toxic for r in lab]) >= 0.9


def test_lexicon_learns_words_beginnings_and_exceptions(spark):
    r = random.Random(3)
    vocab = ["".join(r.choices("abcdefgh", k=6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = r.choices(vocab, k=40)
        toxic = i % 5 == 0
        if toxic:
            w[r.randrange(30)] = "moron"
            w[r.randrange(30)] = "zzqq" + r.choice(vocab)
        elif i % 41 == 0:
            w[10:12] = ["moron", "island"]  # a clean phrase
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    lex = X.train(docs_of(spark, rows), labelled(spark, labels), F.lit(True))
    assert " zzqq" in lex.patterns and " moron " in lex.patterns and any("moron island" in e for e in lex.exceptions)
    new = [(1, "abc mor0n def zzqqabcabc"), (2, "abc moron island def"), (3, "plain words only"), (4, "МОRОN zzqqefef")]
    got = {x.doc_id: x.score for x in X.score(docs_of(spark, new, clash=True), lex).collect()}
    assert got[1] > 0.5 > got[2] and got[3] < 0.5 < got[4]


def naive_value(lex, text):
    """The lexicon's value by looking for every entry at every place."""
    s = X.fold(text)
    at = lambda p: [(i, i + len(p) - 1) for i in range(len(s)) if s.startswith(p, i)]
    free = [x for e in lex.exceptions for x in at(e)]
    total = 0.0
    for p, w in zip(lex.patterns, lex.weights):
        n = sum(1 for a, b in at(p) if not any(c <= a and b <= d for c, d in free))
        total += w * (1 + np.log(n)) if n else 0
    return total / (1 + np.log1p(len(s.split())))


def test_matches_equal_a_naive_search():
    r = random.Random(8)
    words = ["moron", "moronic", "mor0n", "idiot", "IDIOT", "island", "is", "id", "abc", "ídiot", "x"]
    lex = X.Lexicon({" moron": 2.0, " idiot ": 3.0, " id": 1.0, " is ": 0.5, " moronic ": 1.5}, [" moron island ", " id is "])
    value = lex.matcher()
    for _ in range(3000):
        t = r.choice([" ", ", ", "\n"]).join(r.choices(words, k=r.randrange(0, 12)))
        assert abs(value(t) - naive_value(lex, t)) < 1e-9, t


def test_repetition_never_lowers_a_score_below_one_use():
    value = X.Lexicon({" idiot ": 3.0}).matcher()
    one = value("you idiot")
    scores = [value("you idiot " * n) for n in (1, 2, 5, 20, 200, 5000)]
    assert scores == sorted(scores) and scores[0] >= one * 0.999 and value("you " * 500 + "idiot") < one


def test_toxicity_edge_rows(spark):
    docs = docs_of(spark, EDGES, clash=True)
    for labels in ([(9, 1, 1)], [(1, 1, None), (None, 1, 1), (4, 1, 1), (4, 1, 0), (3, 1, 0)]):
        lex = X.train(docs, labelled(spark, labels), F.lit(True), lexicon={"plain": 5.0})
        s = X.score(docs, lex).collect()
        assert len(s) == len(EDGES) and all(0 <= r.score <= 1 for r in s)
    assert X.score(docs_of(spark, []), lex).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def luhn(s):
    s = [int(c) for c in s][::-1]
    return sum(s[::2]) + sum(sum(divmod(2 * x, 10)) for x in s[1::2])


def brute_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {"email": [x.span() for x in EMAIL.finditer(t)],
            "ip": [x.span() for x in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(y) <= 255 for y in x.group().split("."))],
            "card": [x.span() for x in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(x)) <= 19 and luhn(digits(x)) % 10 == 0],
            "phone": [x.span() for x in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(x)) <= 15]}


def test_base_spans_of_random_texts():
    r = random.Random(2)
    bits = ["a", "b", "@", ".", "-", "+", "1", "22", "255", "256", "(", ")", " ", "\n", "x.y", "@c.d", "+1 ", "4111111111111111", "1.2.3.4", "007", "é", "٣"]
    for _ in range(20_000):
        t = "".join(r.choices(bits, k=r.randint(1, 25)))
        assert P.base_spans(t) == brute_spans(t), t


def test_op4_base_of_every_document(spark):
    import hashlib
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = P.op4_pii_skip_chain(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        b = brute_spans(docs[r.doc_id])
        text = ",".join(f"{k}:{x}:{y}" for k in P.KINDS for x, y in b[k])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(b[k]) for k in P.KINDS]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


@pytest.fixture(scope="module")
def crf(spark):
    r = random.Random(5)
    rows = []
    for i in range(400):
        w = r.choices("the of and a to in is for".split(), k=30)
        w[3] = f"{r.randint(1, 255)}.{r.randint(1, 255)}.{r.randint(1, 255)}.{r.randint(1, 255)}"
        w[9] = f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}"
        w[15] = f"x{r.randint(1, 99)}@mail.example.com"
        w[20] = str(r.randint(1, 3000))
        d = [4, *(r.randrange(10) for _ in range(14))]
        card = next(x for x in range(10) if P.luhn("".join(map(str, [*d, x]))))
        w[12] = "".join(map(str, [*d, card]))
        w[22] = "".join(map(str, [7, *d[1:], (card + 4) % 10]))
        w[25] = w[r.choice([3, 15, 20])]
        w[27] = str(r.randint(1_000_000, 99_999_999))
        rows.append((i, " ".join(w)))
    return P.learn(docs_of(spark, rows))


SPELLINGS = [  # text, what is added
    ("call +1 (415) 555-7713 now, or again (415) 555-7713 or year 1999 and 1999", ["(415) 555-7713"]),
    ("Call +1 415 555 7713 now. My number 415-555-7713", ["415-555-7713"]),
    ("ring (415) 555-7713 by day and then 415-555-7713 or else (415) 555-7713", ["(415) 555-7713", "415-555-7713", "(415) 555-7713"]),
    ("card 4111111111111111 on file, 4111.1111.1111.1111 it was", ["4111.1111.1111.1111"]),
    ("4111/1111/1111/1111 for the trip and 4111.1111.1111.1111 after it", ["4111/1111/1111/1111", "4111.1111.1111.1111"]),
    ("mail joe@example.com or JOE (at) example.com", ["JOE (at) example.com"]),
    ("joe (at) example.com and in short joe[at]example.com", ["joe (at) example.com", "joe[at]example.com"]),
    ("joe (at) example [dot] com and joe@example.com", ["joe (at) example [dot] com"]),
]
CLEAN = ["or again (415) 555-7713 or year 1999", "in 1999 and 1999 and 2001, pages 100-120 and 100-120", "order 7536784127813051 and order 7536784127813051",
         "he was at home (at last) and at home", "version 1.2 and 1.2, 30 40 50 and 30 40 50", "a token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\" twice 9b0b3c6a43eb78aa99cbd7049c572391524f37a8"]


def test_repeated_spellings_get_one_label(crf):
    for text, want in SPELLINGS:
        base = P.base_spans(text)
        added = P.added_spans(text, base, crf)
        assert [text[a:b] for a, b in sorted(x for v in added.values() for x in v)] == want, text
        assert not {x for v in added.values() for x in v} & {x for v in base.values() for x in v}
    for text in CLEAN:
        assert not any(P.added_spans(text, P.base_spans(text), crf).values()), text


def test_tagged_documents_have_the_added_spans(spark, crf):
    texts = [t for t, _ in SPELLINGS] + CLEAN
    got = {r.doc_id: r.spans for r in P.tag(docs_of(spark, list(enumerate(texts))), crf).collect()}
    for i, t in enumerate(texts):
        base = P.base_spans(t)
        assert got[i] == P.joined(P.all_spans(base, P.added_spans(t, base, crf)))
    assert sum(got[i].count(":") // 2 for i in got) > sum(sum(map(len, P.base_spans(t).values())) for t in texts) + 10


def test_nodes_and_their_keys():
    t = "x1@y.zz, (415) 555-7713, 10.0.0.1; 4111-1111-1111-1111 and 7536784127813050 4845168114407329 a12 12b 7 joe [at] x [dot] org"
    assert [t[a:b] for a, b in P.nodes_of(t)] == ["x1@y.zz", "(415) 555-7713", "10.0.0.1", "4111-1111-1111-1111", "7536784127813050", "4845168114407329", "7",
                                                  "joe [at] x [dot] org"]
    assert P.keys_of("Joe [at] x [dot] org") == ["joe@x.org"] and P.keys_of("10.0.0.1") == ["10.0.0.1"] and P.keys_of("1999") == []
    assert P.keys_of("+1 (415) 555-7713") == P.keys_of("415.555.7713") == ["#5557713"]


def test_training_rows_are_bounded_whatever_is_repeated(spark):
    from edustar.llm.common import one_row_each
    rows = [(i, f"text {i}") for i in range(40)] + [(7, f"copy {i % 50}") for i in range(4000)]
    ids = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, y int")
    got = one_row_each(docs_of(spark, rows), ids).collect()
    assert sorted(r.doc_id for r in got) == list(range(30)) and all(r.y == r.doc_id % 2 for r in got)


def test_messages_equal_enumeration_on_a_tree():
    r = np.random.default_rng(1)
    crf = P.SkipChainCRF(r.normal(size=(P.FEATURES, P.LABELS)), r.normal(size=(P.LABELS, P.LABELS)), r.normal(size=(P.LABELS, P.LABELS)))
    crf.chain, crf.skip = crf.chain + crf.chain.T, crf.skip + crf.skip.T
    feats, chain, skip = [[0, 3], [1], [5, 7], [2]], [(0, 1), (1, 2)], [(1, 3)]
    got = crf.marginals(feats, np.full(4, P.OTHER), chain, skip)
    p = np.zeros((4, P.LABELS))
    for y in itertools.product(range(P.LABELS), repeat=4):
        e = sum(crf.unary[f].sum(0)[k] for f, k in zip(feats, y)) + sum(crf.chain[y[a], y[b]] for a, b in chain) + sum(crf.skip[y[a], y[b]] for a, b in skip)
        p[range(4), y] += np.exp(e)
    assert np.allclose(got, p / p.sum(1, keepdims=True), atol=1e-3)


def test_pii_edge_rows_and_masking(spark, crf):
    rows = [*EDGES, (8, "1" * 50_000), (9, "mail a@b.co and a@b.co, 1.2.3.4")]
    docs = docs_of(spark, rows, clash=True).withColumn("n_chars", F.length("text"))
    assert P.tag(docs, crf).count() == len(rows) and P.tag(docs_of(spark, []), crf).count() == 0 and P.learn(docs_of(spark, [])) is None
    assert P.tag(docs, None).count() == len(rows)
    m = P.masked(docs, crf)
    got = {r.doc_id: r for r in m.collect()}
    assert m.columns == docs.columns and got[1].text is None and got[9].text == "mail [EMAIL] and [EMAIL], [IP]" and got[9].n_chars == len(got[9].text)
    assert P.mask_text("ab", {"email": [(0, 2)], "ip": [(1, 2)], "card": [], "phone": []}) == "[EMAIL]"
