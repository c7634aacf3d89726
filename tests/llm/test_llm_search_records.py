import gzip
import math
import random
import textwrap

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from edustar.llm import license_scan as L
from edustar.llm import vector_search as V
from edustar.llm import warc as W
from helpers_llm import docs_of


def brute_nearest(rows, is_query, k):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in ok if is_query(i)}):
        qv = min(v for i, v in ok if i == q)
        near = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, tile string, d int")


def test_blocks_equal_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=16)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]                 # ties
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [None] + [1.0] * 15), (305, [float("inf")] * 16),
             (306, [1.0] * 5), (310, [2.0] * 5), (None, [1.0] * 16), (40, rows[40][1]), (41, [9.0] * 16), (311, [1e-30] * 16), (320, [1e30] * 16)]
    exp = brute_nearest(rows, lambda i: i % 10 == 0, 7)
    for q, c in ((1024, 8192), (4, 11)):
        got = V.nearest(vectors(spark, rows).repartition(3), F.col("vec_id") % 10 == 0, 7, q, c).collect()
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)
        assert [g[:3] for g in got] == [e[:3] for e in exp]
        assert all(math.isclose(g[3], e[3], rel_tol=1e-12, abs_tol=1e-300) for g, e in zip(got, exp))


def test_few_candidates_and_empty_tables(spark):
    few = V.nearest(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]), F.col("vec_id") == 0).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in few) == [(1, 2, 2.0), (2, 1, 1.0)]
    assert V.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert V.nearest(vectors(spark, [(20, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold_the_exact_product():
    r = np.random.default_rng(2)
    a, b = r.normal(size=(40, 2100)) * r.lognormal(size=(40, 1)), r.normal(size=(50, 2100))
    qa, sa, na, ea = V.quantised(a)
    qb, sb, nb, eb = V.quantised(b)
    near = V.int8_product(qa, qb) * sa[:, None] * sb[None, :]
    assert (V.int8_product(qa, qb) == qa.astype(np.int64) @ qb.astype(np.int64).T).all()
    slack = na[:, None] * eb + ea[:, None] * nb + ea[:, None] * eb
    assert (np.abs(a @ b.T - near) <= slack + 1e-9).all()


PAGES = [(1, "http://a.example/x", "<html><head><title> A  title </title><style>p{}</style></head><body><!-- no --><p>One &amp; two</p><script>if (a<b) x();</script>"
          "<div>Three<br>four&nbsp;&lt;five&gt;</div><a class='k' href=\"/l?a=1&amp;b\">link</a><A HREF='/m'>m</A></body></html>"),
         (2, None, "plain text, no tags\n\n and lines"), (3, "http://b.example/", None), (4, "", ""), (4, "", ""), (None, "http://c.example", "<p>é 日本</p>"),
         (5, "http://d.example", "x" * 200_000 + "<b>" + "y" * 10)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id long, url string, html string, record string, key string")


def test_derivatives_of_edge_pages_equal_sql(spark, tmp_path):
    path = str(tmp_path / "pages.parquet")
    pages(spark).select("page_id", "url", "html").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/*.parquet')")
    d = W.op3_warc_derivatives(spark, str(tmp_path))
    cols = sorted(d.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, d.select(*cols).collect()), key=key) == sorted(con.execute(f"SELECT {','.join(cols)} FROM ({W.OP3_SQL})").fetchall(), key=key)
    assert W.derive(W.responses(pages(spark, []))).count() == 0


def test_records_are_linked_and_keep_what_the_source_says(spark):
    r = W.responses(pages(spark))
    d = {(x.key, x.warc_type): x for x in W.derive(r).collect()}
    m, c = d[(1, "metadata")], d[(1, "conversion")]
    source = [x.record for x in r.collect() if x.key == 1][0]
    assert m.refers_to == c.refers_to and f"WARC-Record-ID: {m.refers_to}" in source and m.record_id != c.record_id
    assert c.payload_digest in source and "payload-digest-holds: true" in m.block and "http-Content-Type: text/html; charset=utf-8" in m.block
    assert "title: A title\r\n" in m.block and "outlink: /l?a=1&amp;b\r\n" in m.block and "outlink: /m\r\n" in m.block
    assert c.block == "One & two\nThree\nfour <five>\nlinkm"
    bad = r.withColumn("record", F.replace("record", F.lit("One"), F.lit("Two")))
    assert "payload-digest-holds: false" in [x.block for x in W.derive(bad).collect() if x.key == 1 and x.warc_type == "metadata"][0]
    odd = spark.createDataFrame([(1, None), (2, "no header at all")], "key long, record string")
    assert W.derive(odd).count() == 4


def test_both_records_keep_the_source_headers_and_digests(spark):
    r = W.responses(pages(spark))
    d = [x for x in W.derive(r).collect() if x.key == 1]
    source = [x.record for x in r.collect() if x.key == 1][0]
    head, http = source.split("\r\n\r\n")[:2]
    for x in d:
        own = x.record.split("\r\n\r\n")[0].split("\r\n")
        assert [h for h in own if h.startswith("X-Source-") and not h.startswith("X-Source-HTTP-")] == ["X-Source-" + h for h in head.split("\r\n")[1:]]
        assert [h for h in own if h.startswith("X-Source-HTTP-")] == ["X-Source-HTTP-" + h for h in http.split("\r\n")[1:]]
    other = r.withColumn("record", F.regexp_replace("record", "WARC-Payload-Digest: sha256:[0-9a-f]*", "WARC-Payload-Digest: sha1:ABCDEF"))
    assert all("payload-digest-holds: unknown" in x.block for x in W.derive(other).collect() if x.warc_type == "metadata")


def test_different_pages_have_different_record_ids(spark):
    rows = [(1, "http://a", "one"), (1, "http://a", "two"), (1, "http://b", "one"), (2, "http://a", "one")]
    got = W.derive(W.responses(pages(spark, rows))).collect()
    assert len({x.record_id for x in got}) == 8 and len({x.refers_to for x in got}) == 4


def naive_text(html):
    """The text with every step as a replacement of its own."""
    t = F.regexp_replace(html, W.DROPPED, " ")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", " "), W.BREAKS, "\n")
    t = F.regexp_replace(t, W.TAGS, "")
    for a, b in W.ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(t, r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(t, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def test_text_in_few_passes_equals_one_replacement_a_step(spark):
    r = random.Random(7)
    parts = ["<!--", "-->", "<script>", "</script\n>", "<style>", "</STYLE >", "<head>", "</head>", "<header>", "<p>", "</p>", "<P class='x'\n y>", "<br/>", "<b>", "<", ">",
             "&", *[a for a, _ in W.ENTITIES], "amp;", "lt;", "&copy;", "a", "b", "é", "日本", "$1", "\\", " ", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\x85", "\u2028", "\xa0"]
    rows = [("".join(r.choice(parts) for _ in range(r.randint(0, r.choice([4, 12, 60])))),) for _ in range(4000)]
    rows += [(None,), (" " * 50_000,), ("<p>" * 20_000,), ("\n " * 20_000 + "x",), ("&" * 20_000,), ("&amp;lt;" * 5_000,)]
    d = spark.createDataFrame(rows, "html string").select("html", naive_text(F.col("html")).alias("a"), W.plain_text(F.col("html")).alias("b"))
    assert d.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_text_is_passed_over_few_times(spark):
    plan = spark.createDataFrame([("x",)], "html string").select(W.plain_text(F.col("html")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    # four patterns over the whole text, and one over the few texts with a special end
    patterns = plan.count("regexp_replace(")
    assert patterns <= 5 and plan.count("replace(") - patterns <= 1


def test_written_members_are_gzip_records(spark):
    d = W.derive(W.responses(pages(spark)))
    got = sorted(gzip.decompress(bytes(r.member)).decode() for r in spark.read.parquet(W.write_warc(d)).collect())
    assert got == sorted(r.record for r in d.collect())


LICENSED = [(1, "Some words.\nReleased under the MIT License.\nMore"), (2, "released UNDER the mit license"), (3, None), (4, ""), (5, "MIT"),
            (6, "Licensed under the Apache License, Version 2.0"), (6, "Licensed under the Apache License, Version 2.0"),
            (7, "This work is licensed under the GNU General Public License, version 3, of the Free Software Foundation"), (None, "Licensed under CC BY-NC 4.0."),
            (8, "no licence here\n" * 500), (9, "word " * 40_000), (10, "\n\n\n")]


def test_licences_of_edge_rows_equal_sql(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs_of(spark, LICENSED, clash=True).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    d = L.op5_license_dice(spark, str(tmp_path))
    cols = sorted(d.columns)
    got = sorted(map(str, map(tuple, d.select(*cols).collect())))
    assert got == sorted(map(str, con.execute(f"SELECT {','.join(cols)} FROM ({L.OP5_SQL})").fetchall())) and len(got) >= 6
    assert L.scan(docs_of(spark, [])).count() == 0 and L.scan(docs_of(spark, LICENSED), templates=[]).count() == 0


def test_size_bounds_lose_nothing():
    r = random.Random(1)
    for _ in range(3000):
        a, b, t = r.randint(1, 60), r.randint(1, 60), r.choice([0.5, 0.8, 0.9])
        shared = r.randint(0, min(a, b))
        low, high = L.bounds(b, t)
        if 2 * shared / (a + b) >= t:
            assert low <= a <= high


def test_wrapped_and_embedded_notices_are_spans(spark):
    def wrap(text, width):
        return "\n".join(textwrap.wrap(text, width))
    code = "\n".join(f"value_{i} = compute(x{i}, y{i})" for i in range(40))
    mit, gpl = L.BODIES[0][1], L.TEMPLATES[6][1]
    rows = [(1, "Copyright (c) 2020 Some Body\n\n" + wrap(mit, 79) + "\n" + code), (2, wrap(gpl, 60) + "\n" + code),
            (3, code + "\nThe code is released under the MIT License and may be read by all who like it.\n" + code),
            (4, "words before\n" + "Released under the MIT License.\n" + code), (5, code + "\nThe software is copyright of its maker, a license is not given."),
            (6, code + "\n" + wrap(gpl, 50) + "\n" + code + "\n" + wrap(gpl, 70)), (None, None), (7, ""), (8, wrap(gpl, 60))]
    found = [(r.doc_id, r.template, r.license, round(r.dice, 6)) for r in L.spans(docs_of(spark, rows)).collect()]
    assert {(1, 19, "MIT", 1.0), (2, 6, "GPL-3.0", 1.0), (3, 0, "MIT", 1.0)} <= set(found)
    assert found.count((6, 6, "GPL-3.0", 1.0)) == 2
    assert not {i for i, *_ in found} & {4, 5, 7, 8}  # 4 and 8 are reported as line and whole text
    assert not {r.doc_id for r in L.scan(docs_of(spark, rows)).collect()} & {1, 2, 3, 6}


def test_spans_query_has_the_lines_and_a_native_plan(spark, tmp_path):
    rows = [*LICENSED, (11, "Some maker's words\nare released under\nthe MIT License and go on\nfor a while.")]
    docs_of(spark, rows).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    d = L.op5_license_spans(spark, str(tmp_path))
    got = set(map(tuple, d.collect()))
    assert got - set(map(tuple, L.op5_license_dice(spark, str(tmp_path)).collect())) == {(11, -6, 0, "MIT", 1.0)}
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_license_plan_is_native(spark):
    from conftest import SF_SMALL
    plan = L.op5_license_dice(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("fn", [V.op2_block_join])
def test_registered_query_equals_its_sql(spark, fn):
    from conftest import SF_SMALL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in fn(spark, SF_SMALL).collect())
    assert got == sorted(con.execute(V.OP2_SQL).fetchall()) and got
