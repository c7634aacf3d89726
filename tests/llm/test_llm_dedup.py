import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from edustar.llm import components as C
from edustar.llm import exact_dedup as X
from edustar.llm import ngram_join as N
from edustar.llm.common import shared_dir, shingles
from helpers_llm import docs_of, least_reachable, shingle_set

EDGES = [(5, "a  b\tc"), (3, "a b c"), (9, "a b c "), (7, None), (8, ""), (2, " \n"), (4, "x" * 300_000), (6, "x" * 300_000),
         (3, "a b c"), (None, "a b c"), (None, None), (11, "only once"), (12, "A b c")]


def exact_brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    return sorted((str(i), str(min((x for x in groups[t] if x is not None), default=None)), len(groups[t]),
                   hashlib.sha256(t.encode()).hexdigest().upper()) for (i, _), t in zip(rows, norm))


def test_exact_groups_of_edge_rows(spark):
    g = X.exact_groups(docs_of(spark, EDGES, clash=True)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.digest.hex().upper()) for r in g) == exact_brute(EDGES)
    kept = [r.doc_id for r in g if r.kept]
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in EDGES}) and kept.count(3) == 1


def test_colliding_digests_are_told_apart_by_their_bytes(spark):
    weak = lambda text: F.unhex(F.substring(F.sha2(text, 256), 1, 2))
    rows = [(i, f"text {i % 150}") for i in range(600)]
    g = X.exact_groups(docs_of(spark, rows), digest=weak).collect()
    assert all(r.keep_id == r.doc_id % 150 and r.group_size == 4 and r.kept == (r.doc_id < 150) for r in g) and len(g) == 600


def test_exact_groups_of_an_empty_table(spark):
    assert X.exact_groups(docs_of(spark, [])).count() == 0
    assert X.keep_rows(docs_of(spark, [])).count() == 0


def test_kept_rows_have_all_columns_and_one_row_per_text(spark):
    d = docs_of(spark, EDGES, clash=True)
    k = X.keep_rows(d)
    assert k.columns == d.columns
    rows = k.select("doc_id", "text").collect()
    assert sorted(str(r.doc_id) for r in rows) == ["11", "12", "2", "3", "4", "7", "9"]


def test_the_state_is_taken_up_again(spark, tmp_path):
    src, state = str(tmp_path / "in"), shared_dir(spark, "state")
    X.digest_rows(docs_of(spark, [(5, "a"), (6, "b")])).write.parquet(src)
    read = lambda: spark.readStream.schema("doc_id long, digest binary, row long").parquet(src)
    X.dedup_stream(read(), state)
    X.digest_rows(docs_of(spark, [(2, "a"), (7, "c")])).write.mode("append").parquet(src)
    q = X.dedup_stream(read(), state)
    assert sum(p.numInputRows for p in q.recentProgress) == 2  # only the new files
    with X.state_conf(spark):
        got = {r.keep.doc_id: r.group_size for r in X.read_state(spark, state).collect()}
    assert got == {2: 2, 6: 1, 7: 1}


def near_brute(rows):
    sets = {}
    links = []
    for i, t in rows:
        s = shingle_set(t)
        for j, others in sets.items():
            for o in others:
                if s and o and 100 * len(s & o) >= 85 * len(s | o):
                    links.append((i, j))
        sets.setdefault(i, []).append(s)
    low = least_reachable(list(sets), links)
    return sorted((i, len(shingle_set(t)), low[i]) for i, t in rows)


def near_rows(seed, n=70):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(r.choices(vocab, k=60))
    rows, texts = [], []
    for i in range(n):
        kind = r.random()
        if texts and kind < 0.55:  # a near copy, most often of one text: chains of edits
            w = (texts[-1] if r.random() < 0.5 else texts[0]).split()
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocab)
        elif kind < 0.75:
            w = passage.split() + r.choices(vocab, k=r.randint(3, 40))
        else:
            w = r.choices(vocab, k=r.randint(1, 120))
        texts.append(" ".join(w))
        rows.append((1000 - i * 3, texts[-1].upper() if r.random() < 0.1 else texts[-1].replace(" ", r.choice([" ", "  ", "\n"]))))
    return rows


@pytest.mark.parametrize("seed,tile", [(1, 1024), (2, 5)])
def test_ngram_components_equal_brute_force(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(N, "TILE_ROWS", tile)  # small tiles: one group of near copies takes many
    rows = near_rows(seed)
    got = N.near_groups(docs_of(spark, rows, clash=True)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows)


def test_ngram_edge_rows(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "ONE two"), (6, "one two three"), (8, long), (7, long + " more"),
            (9, "a b c d e"), (9, "p q r s t"), (10, "p q r s t"), (None, "a b c d e"), (None, None), (12, "a b c d"), (12, "a b c d")]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in N.near_groups(docs_of(spark, rows)).collect())
    exp = [(str(a), b, str(c)) for a, b, c in near_brute([x for x in rows if x[0] is not None])] + [("None", 2, "None"), ("None", 0, "None")]
    assert got == sorted(exp)
    kept = N.keep_rows(docs_of(spark, [x for x in rows if x[0] not in (9, None)], clash=True))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 10, 12, 12]
    assert N.near_groups(docs_of(spark, [])).count() == 0


def test_blocked_product_of_random_sets(monkeypatch):
    monkeypatch.setattr(N, "COLUMN_BLOCK", 7)
    r = np.random.default_rng(3)
    for _ in range(30):
        base = r.choice(500, 40, replace=False)
        sets = []
        for _ in range(int(r.integers(2, 30))):
            s = base.copy()
            m = int(r.integers(0, 9))
            s[:m] = r.choice(500, m) + 500
            sets.append(np.unique(s).astype(np.uint64))
        links = [(i, j) for i in range(len(sets)) for j in range(i)
                 if 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - o)]
        low = least_reachable(list(range(len(sets))), links)
        assert N.link_roots(sets).tolist() == [low[i] for i in range(len(sets))]


def test_own_columns_bound_what_linked_rows_may_lack():
    r = np.random.default_rng(5)
    seen = 0
    for _ in range(400):
        n = int(r.integers(1, 80))
        a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[int(len(a) * 0.08):], r.integers(0, 2**64, max(0, len(a) // 20), dtype=np.uint64))))
        o = len(np.intersect1d(a, b))
        if 100 * o >= 85 * (len(a) + len(b) - o):
            seen += 1
            assert len(a) - o < N.own_columns(len(a)) and len(b) - o < N.own_columns(len(b))
            part, whole = N.taken_part(a)
            assert len(np.intersect1d(part, b)) >= len(part) - N.own_columns(len(a)) + 1
            assert whole or len(part) >= 2 * N.own_columns(len(a)) - 1
    assert seen > 50


@pytest.mark.parametrize("flush", [300, 5000])
def test_candidates_of_many_chunks_and_popular_columns(spark, monkeypatch, flush):
    monkeypatch.setattr(N, "FLUSH", flush)
    monkeypatch.setattr(N, "BLOCK_ENTRIES", 2000)  # many column blocks
    rows = near_rows(7, 150)
    d = docs_of(spark, rows).repartition(5)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.near_groups(d).collect()) == near_brute(rows)


def shared_brute(rows, k, num, den):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(i, j) for i in ids for j in ids if i < j and sets[i] and sets[j]
             and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    return least_reachable(ids, links)


@pytest.mark.parametrize("rule", [(5, 80, 100), (3, 6, 10)])
@pytest.mark.parametrize("seed", [1, 7])
def test_components_of_other_rules_equal_brute_force(spark, monkeypatch, seed, rule):
    monkeypatch.setattr(N, "BLOCK_ENTRIES", 2000)
    rows = near_rows(seed, 120)
    low = shared_brute(rows, *rule)
    assert low != shared_brute(rows, 4, 85, 100)
    got = N.near_groups(docs_of(spark, rows), N.Rule(*rule)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, len(shingle_set(t, rule[0])), low[i]) for i, t in rows)


def repeated_rows():
    """One doc_id on a short and a long text, a third document near the short one; and random repetitions."""
    words = [f"w{i}" for i in range(400)]
    rows = [(5, " ".join(words[:40])), (5, " ".join(f"v{i}" for i in range(400))), (7, " ".join([*words[:38], "x", "y"])), (7, "alone " * 30)]
    r = random.Random(12)
    base = [" ".join(r.choices(words, k=r.choice((20, 60, 200)))) for _ in range(12)]
    for _ in range(60):
        w = r.choice(base).split()
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((r.randrange(10, 40), " ".join(w)))
    return rows


def test_one_doc_id_on_several_texts_loses_no_link(spark):
    rows = repeated_rows()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.near_groups(docs_of(spark, rows)).collect())
    assert got == sorted(near_brute(rows))
    assert {c for i, _, c in got if i in (5, 7)} == {5}


def test_rows_are_dropped_by_text_not_by_doc_id(spark):
    rows = repeated_rows()
    kept = sorted((r.doc_id, r.text) for r in N.keep_rows(docs_of(spark, rows, clash=True)).collect())
    # components of texts alone: the same rows under numbers of their own
    own = [(k, t) for k, (_, t) in enumerate(sorted(rows, key=lambda x: x[0]))]
    comp = {i: c for i, _, c in near_brute(own)}
    ids = [i for i, _ in sorted(rows, key=lambda x: x[0])]
    least = {}
    for k, i in enumerate(ids):
        least[comp[k]] = min(least.get(comp[k], i), i)
    groups = {comp[k] for k in comp}
    assert len({(comp[k]) for k, (_, t) in enumerate(own) if (ids[k], t) in kept}) == len(groups)  # one of each group stays
    assert all(any(i == least[comp[k]] and t == own[k][1] for k, j in enumerate(ids) if j == i and own[k][1] == t) for i, t in kept)
    assert (7, "alone " * 30) in kept and (5, rows[1][1]) in kept and (7, rows[2][1]) not in kept


def test_hot_digests_are_split_off(spark, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_ROWS", 3)
    rows = [(i, "hot text") for i in range(300)] + [(1000 + i, f"text {i % 40}") for i in range(200)] + [(2000 + i, f"own {i}") for i in range(50)]
    g = X.exact_groups(docs_of(spark, rows).repartition(6)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.digest.hex().upper()) for r in g) == exact_brute(rows)
    assert len(X.keep_rows(docs_of(spark, rows)).collect()) == 91


def test_the_pipeline_stage_links_five_words_at_four_fifths(spark):
    import corpus_pipeline
    rows = near_rows(3, 150)
    low = shared_brute(rows, 5, 80, 100)
    kept = sorted(i for i in low if low[i] == i)
    assert kept != sorted(i for i, k in shared_brute(rows, 4, 85, 100).items() if i == k)
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    assert sorted(r.doc_id for r in stage(spark, docs_of(spark, rows, clash=True), "").collect()) == kept


def test_lists_joined_with_texts_have_no_more_rows_than_counted(spark, monkeypatch):
    monkeypatch.setattr(N, "TILE_ROWS", 4)
    seen, listed = [], N._listed
    monkeypatch.setattr(N, "_listed", lambda docs, rows, n: seen.append((rows.count(), n)) or listed(docs, rows, n))
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(40)]  # one group, ten tiles wide
    got = N.near_groups(docs_of(spark, rows)).collect()
    assert len(got) == 40 and {r.component_id for r in got} == {0}
    assert seen and all(have <= n for have, n in seen)


def test_components_of_random_graphs(spark):
    r = random.Random(4)
    for n, m in ((1, 0), (60, 30), (200, 180)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1100)] * (n > 100)
        low = least_reachable({x for e in edges for x in e}, edges)
        got = {x.a: x.b for x in C.components(spark.createDataFrame(edges or [(7, 7)], "a long, b long")).collect()}
        assert got == {i: k for i, k in low.items() if i != k}


def test_shingles_follow_the_contract():
    t = "The QUICK\x0bbrown\r\nfox Jumps über ÄÖ"
    assert len(shingles([t.encode()], 4)[0]) == len(shingle_set(t))
    same, other = shingles([b"a b c d", b"A  B\tC d"], 4)
    assert (same == other).all()
    assert [len(s) for s in shingles([b"", b" ", b"a b", b"a b c d e a b c d"], 4)] == [0, 0, 1, 5]
