"""A hot key holding a third of the rows: results stay exact and no step
funnels the hot group through a single window partition."""

import random

import pandas as pd
from pyspark.sql import functions as F

from edustar.operators import reports as R
from edustar.operators import silver as S
from edustar.operators import star
from edustar.schemas import ASSESSMENTS, STUDENT_ASSESSMENT, STUDENT_INFO


def _silver(spark, n=6000):
    rnd = random.Random(3)
    sa, info = [], set()
    for i in range(n):
        # one assessment (100) and one student (1) each hold a third of all submissions
        asm = 100 if i % 3 == 0 else 100 + rnd.randrange(1, 40)
        sid = 1 if i % 3 == 1 else rnd.randrange(2, 400)
        score = None if rnd.random() < 0.05 else float(rnd.randrange(0, 101))
        sa.append((asm, sid * 1000 + i if sid != 1 else 1, 1, 0, score))
    # (assessment, student) must be unique: the hot student takes distinct assessments
    seen, rows = set(), []
    for asm, sid, d, b, sc in sa:
        key = (asm, sid)
        if sid == 1:
            asm = 1000 + len(seen)
            key = (asm, sid)
        if key in seen:
            continue
        seen.add(key)
        rows.append((asm, sid, d, b, sc))
        info.add(sid)
    asms = sorted({r[0] for r in rows})
    assessments = spark.createDataFrame([("AAA", "2013J", a, "TMA", 1, 1.0) for a in asms], ASSESSMENTS)
    student_info = spark.createDataFrame(
        [("AAA", "2013J", s, "M", "r", "e", None, "0-35", 0, 60, "N", "Pass" if s % 2 else "Fail")
         for s in sorted(info) if s % 7], STUDENT_INFO)
    sa_df = spark.createDataFrame(rows, STUDENT_ASSESSMENT).repartition(8)
    courses = spark.createDataFrame([("AAA", "2013J", 200)],
                                    "code_module string, code_presentation string, module_presentation_length int")
    clicks = spark.createDataFrame([], "id_student int, code_module string, code_presentation string, total_clicks long")
    return {"student_assessment": sa_df, "assessments": assessments, "student_info": student_info,
            "vle_clicks": clicks, "courses": courses}, rows


def test_hot_assessment_average_is_exact(spark):
    silver, rows = _silver(spark)
    got = star.with_score_vs_avg(star.fact_base(silver)).select("id_student", "id_assessment", "score_vs_avg")
    pdf = pd.DataFrame(rows, columns=["id_assessment", "id_student", "d", "b", "score"])
    pdf["score_vs_avg"] = pdf.score - pdf.groupby("id_assessment").score.transform("mean")
    want = {(r.id_student, r.id_assessment): r.score_vs_avg for r in pdf.itertuples()}
    g = {(r.id_student, r.id_assessment): r.score_vs_avg for r in got.collect()}
    assert g.keys() == want.keys()
    assert all((pd.isna(want[k]) and g[k] is None) or abs(g[k] - want[k]) < 1e-9 for k in want)
    hot = sum(1 for r in rows if r[0] == 100)
    assert hot >= len(rows) // 4


def test_hot_student_counts_are_exact(spark):
    silver, rows = _silver(spark)
    dims = {"dim_time": star.dim_time(spark), "dim_course": star.dim_course(silver["courses"]),
            "dim_student": star.dim_student(silver["student_info"]),
            "dim_assessment": star.dim_assessment(silver["assessments"])}
    fact = star.fact_performance(silver, dims)
    hot_rows = fact.join(dims["dim_student"].filter("id_student = 1"), "student_key").count()
    assert hot_rows == sum(1 for r in rows if r[1] == 1) >= len(rows) // 4
    funnel = {r.step: r.students for r in R.student_funnel(fact, dims["dim_student"]).collect()}
    scored = {r[1] for r in rows if r[4] is not None and r[1] % 7}
    assert funnel["Submitted >= 1"] == len(scored)
    plan = star.with_score_vs_avg(star.fact_base(silver))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_avg" in plan


def _hot_tables(spark, n=6000):
    rnd = random.Random(11)
    big = [(0 if i % 3 == 0 else rnd.randrange(1, 300), i, float(i % 17)) for i in range(n)]
    small = [(k, f"v{k}") for k in range(0, 250)] + [(0, "v0b"), (5, "v5b"), (5, "v5c"), (None, "vn")]
    b = spark.createDataFrame(big + [(None, -1, 0.0)], "k int, id int, x double").repartition(8)
    s = spark.createDataFrame(small, "k int, v string")
    return b, s


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_salted_join_equals_plain_join(spark):
    from edustar.operators.joins import detect_hot_keys, skew_join

    big, small = _hot_tables(spark)
    hot = detect_hot_keys(big, ["k"])
    assert hot.any
    hot_rows = {r["k"]: r["_buckets"] for r in hot.table.collect()}
    assert list(hot_rows) == [0] and hot_rows[0] >= 2
    for how in ("inner", "left", "left_anti", "left_semi"):
        got = skew_join(big, small, ["k"], how, hot=hot)
        assert got.columns == big.join(small, ["k"], how).columns
        assert _sorted(got) == _sorted(big.join(small, ["k"], how)), how


def test_salted_join_spreads_hot_key(spark):
    from edustar.operators.joins import skew_join

    big, small = _hot_tables(spark)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        j = skew_join(big, small, ["k"], "inner").filter("k = 0")
        per_task = [r["n"] for r in j.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    hot_out = 2 * 2000  # 2000 hot rows, each meets the two small rows of key 0
    assert sum(per_task) == hot_out
    assert len(per_task) >= 2 and max(per_task) < hot_out


def test_no_hot_key_keeps_plain_join(spark):
    from edustar.operators.joins import detect_hot_keys

    df = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    assert not detect_hot_keys(df, ["k"]).any


def test_fact_build_shuffle_path_equals_broadcast_path(spark, monkeypatch):
    from edustar.operators import joins

    silver, _ = _silver(spark)

    def build():
        dims = {"dim_time": star.dim_time(spark), "dim_course": star.dim_course(silver["courses"]),
                "dim_student": star.dim_student(silver["student_info"]),
                "dim_assessment": star.dim_assessment(silver["assessments"])}
        return star.fact_performance(silver, dims)

    want = _sorted(build())
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)
    fact = build()
    with monkeypatch.context() as m:  # the joins are behind the key's checkpoint: look at them without it
        m.setattr(star, "dense_key", lambda df, order, key, n=None: df.withColumn(key, F.lit(0)))
        plan = build()._jdf.queryExecution().executedPlan().toString()
    # Dimensions go through shuffle joins; the hot student and assessment are salted.
    assert "SortMergeJoin [id_student" in plan and "_salt" in plan
    assert _sorted(fact) == want


def test_copied_enrolments_fan_out_exactly(spark):
    """One enrolment copied 300 times (a copy group holding most of the table),
    another with two different rows: the fact base equals the plain left joins."""
    silver, rows = _silver(spark, n=900)
    info = silver["student_info"]
    one = info.orderBy("id_student").limit(1)
    copies = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(300))).alias("_c")).drop("_c")
    variant = info.orderBy(F.col("id_student").desc()).limit(1).withColumn("final_result", F.lit("Withdrawn"))
    silver = {**silver, "student_info": info.unionByName(copies).unionByName(variant)}
    got = star.fact_base(silver)
    sa = star.submissions_with_course(silver["student_assessment"], silver["assessments"])
    want = (sa.join(silver["student_info"].select(*star.ENROLMENT, "final_result"), star.ENROLMENT, "left")
            .join(silver["vle_clicks"], star.ENROLMENT, "left"))
    assert got.columns == want.columns
    g, w = _sorted(got), _sorted(want)
    assert len(g) == len(w) > len(rows)
    assert g == w


def test_expand_copies_in_chunks(spark):
    from edustar.operators import joins

    df = spark.createDataFrame([(1, 2500), (2, 1), (3, None), (4, 1024)], "k int, _copies long")
    got = {r["k"]: r["n"] for r in joins.expand_copies(df, joins.most_copies(df)).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {1: 2500, 2: 1, 3: 1, 4: 1024}


def test_a_repeated_enrolment_fans_out_over_all_tasks(spark):
    """The right side's key holds a third of its rows: the rows it makes are spread evenly."""
    from edustar.operators import joins

    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "-1")
    try:
        left = spark.range(3000).select((F.col("id") % 300).alias("k"))
        right = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 300).alias("k"), F.lit("Pass").alias("r"))
        c = joins.collapse_copies(right)
        j = joins.expand_copies(left.join(c, "k", "left"), joins.most_copies(c))
        per_task = [r["n"] for r in j.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(per_task) == left.join(right, "k", "left").count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(per_task) == 8 and max(per_task) <= 2 * sum(per_task) / 8


def test_every_hot_key_is_split_however_many_there_are(spark):
    from edustar.operators.joins import detect_hot_keys

    df = spark.range(80_000).select(F.when(F.col("id") % 2 == 0, (F.col("id") / 2).cast("long") % 400).otherwise(F.col("id") + 1000).alias("k"))
    hot = detect_hot_keys(df, ["k"], partitions=2000)  # 400 keys of 0.125 % each, above a share of 0.05 %
    assert sorted(r["k"] for r in hot.table.collect()) == list(range(400))


def test_salt_does_not_depend_on_row_order(spark):
    """A recomputed task sees the same rows of its partition, maybe in another
    order: every row must get the same bucket again (copies included)."""
    from edustar.operators.joins import detect_hot_keys

    big, _ = _hot_tables(spark)
    big = big.unionByName(big.filter("k = 0").limit(50))  # exact copies of hot rows
    hot = detect_hot_keys(big, ["k"], partitions=8)
    parted = big.repartition(4, "id")

    def salts(df):
        rows = hot.salt(df).select("k", "id", "x", "_salt", F.spark_partition_id().alias("p")).collect()
        return sorted(map(tuple, rows), key=repr)

    a = salts(parted.sortWithinPartitions("id"))
    b = salts(parted.sortWithinPartitions(F.col("id").desc()))
    assert a == b
    assert len({r[3] for r in a if r[0] == 0}) > 1  # the hot key really is spread


def test_landing_join_shuffle_path_equals_broadcast_path(spark, monkeypatch):
    from conftest import SF_SMALL
    from edustar.operators import joins
    from edustar.sources import fixtures

    t = fixtures.read_tables(spark, SF_SMALL, ["lineitem", "orders"])
    want = _sorted(fixtures.line_grain(fixtures.base_lines(t)))
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)  # orders above the bound, as at scale
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")  # and Spark's own size-based broadcast off
        got_df = fixtures.line_grain(fixtures.base_lines(t))
        got = _sorted(got_df)
        plan = got_df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert got == want and len(want) > 1000
