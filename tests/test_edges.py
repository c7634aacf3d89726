"""Hand-made rows for what the generated tables cannot show."""

import math

from pyspark.sql import functions as F

from edustar.functions.expr import credit_band, moment_corr, risk_band, round_dec
from edustar.operators import quality as Q
from edustar.operators import silver as S
from edustar.operators import star
from edustar.operators.keys import dense_key, first_per_key
from edustar.schemas import ASSESSMENTS, STUDENT_ASSESSMENT, STUDENT_INFO, STUDENT_VLE


def test_risk_band_edges(spark):
    scores = [0.0, 49.99, 50.0, 69.99, 70.0, 100.0, None]
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    got = [r[0] for r in df.select(risk_band()).collect()]
    assert got == ["High", "High", "Medium", "Medium", "Low", "Low", "Unknown"]


def test_score_and_weight_filters_with_nan(spark):
    sa = spark.createDataFrame(
        [(1, 1, 0, 0, s) for s in [-1.0, 100.01, float("nan"), 0.0, 100.0, None]], STUDENT_ASSESSMENT)
    kept = sorted((r.score for r in S.clean("student_assessment", sa).collect()), key=lambda x: (x is None, x))
    assert kept == [0.0, 100.0, None]
    a = spark.createDataFrame([("AAA", "2013J", i, "TMA", 1, w) for i, w in
                               enumerate([-1.0, float("nan"), None, 0.0])], ASSESSMENTS)
    ws = [r.weight for r in S.clean("assessments", a).collect()]
    assert len(ws) == 3 and any(w is not None and math.isnan(w) for w in ws)


def test_unknown_presentation_kept_in_silver_dropped_from_fact(spark):
    info = spark.createDataFrame([("AAA", "2012J", 1, "M", "r", "e", None, "0-35", 0, 60, "N", "Pass")],
                                 STUDENT_INFO)
    assert S.clean("student_info", info).count() == 0
    a = spark.createDataFrame([("AAA", "2012J", 7, "TMA", 1, 1.0)], ASSESSMENTS)
    assert S.clean("assessments", a).count() == 1


def test_first_enrolment_wins_at_any_partitioning(spark):
    rows = [("BBB", "2014J", 1, "M", "r1", "e1", None, "0-35", 3, 90, "N", "Pass"),
            ("AAA", "2014J", 1, "M", "r2", "e2", None, "0-35", 1, 60, "N", "Fail"),
            ("CCC", "2013B", 1, "M", "r3", "e3", None, "0-35", 2, 30, "N", "Pass")]
    df = spark.createDataFrame(rows, STUDENT_INFO)
    for n in (1, 4, 50):
        d = star.dim_student(df.repartition(n))
        r = d.collect()
        assert len(r) == 1 and r[0].region == "r3" and r[0].num_of_prev_attempts == 2


def test_first_per_key_breaks_ties_on_remaining_columns(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "a", 3), (2, "b", 5)], "k int, o string, v int")
    got = {r.k: r.v for r in first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {1: 3, 2: 5}


def test_dense_key_is_permutation_independent(spark):
    import random
    ids = random.Random(7).sample(range(10_000_000), 20_000)
    base = spark.createDataFrame([(i,) for i in ids], "id long")
    expect = {v: i + 1 for i, v in enumerate(sorted(ids))}
    for n, shuffle in ((1, 3), (4, 11), (50, 2)):
        got = dense_key(base.repartition(shuffle), ["id"], "k", n).collect()
        assert {r.id: r.k for r in got} == expect


def test_null_credits_fall_to_top_bin(spark):
    df = spark.createDataFrame([(30,), (60,), (119,), (120,), (180,), (None,)], "studied_credits int")
    got = [r[0] for r in df.select(credit_band()).collect()]
    assert got == ["< 60", "60 - 119", "60 - 119", "120 - 179", ">= 180", ">= 180"]


def test_constant_clicks_give_null_correlation(spark):
    df = spark.createDataFrame([(5, 10.0), (5, 80.0), (5, 50.0)], "total_clicks long, score double")
    assert df.agg(moment_corr("total_clicks", "score")).first()[0] is None


def test_moment_corr_uses_each_average_own_rows(spark):
    rows = [(1, 10.0), (2, 20.0), (None, 90.0), (4, 30.0)]
    df = spark.createDataFrame(rows, "x long, y double")
    got = df.agg(moment_corr("x", "y")).first()[0]
    xs, ys = [1, 2, 4], [10.0, 20.0, 90.0, 30.0]
    exy = (10 + 40 + 120) / 3
    ex, ey = sum(xs) / 3, sum(ys) / 4
    sx = math.sqrt(sum((x - ex) ** 2 for x in xs) / 3)
    sy = math.sqrt(sum((y - ey) ** 2 for y in ys) / 4)
    assert abs(got - (exy - ex * ey) / (sx * sy)) < 1e-12


def test_clicks_only_positive_and_missing_student_gets_null(spark):
    vle = spark.createDataFrame([("AAA", "2013J", 1, 1, 1, c) for c in (0, None, 3, 4)]
                                + [("AAA", "2013J", 2, 1, 1, 0)], STUDENT_VLE)
    got = {r.id_student: r.total_clicks for r in S.vle_clicks(vle).collect()}
    assert got == {1: 7}


def test_round_half_up_through_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double")
    got = [r[0] for r in df.select(round_dec("x", 2)).collect()]
    assert got == [1.01, 2.68, -1.01]


def test_average_taken_before_dimension_joins(spark):
    sa = spark.createDataFrame([(7, 1, 1, 0, 80.0), (7, 2, 1, 0, 40.0)], STUDENT_ASSESSMENT)
    a = spark.createDataFrame([("AAA", "2013J", 7, "TMA", 1, 1.0)], ASSESSMENTS)
    info = spark.createDataFrame([("AAA", "2013J", 1, "M", "r", "e", None, "0-35", 0, 60, "N", "Pass")],
                                 STUDENT_INFO)
    vle = spark.createDataFrame([], STUDENT_VLE)
    courses = spark.createDataFrame([("AAA", "2013J", 200)], "code_module string, code_presentation string, module_presentation_length int")
    silver = {"student_assessment": sa, "assessments": a, "student_info": info,
              "vle_clicks": S.vle_clicks(vle), "courses": courses}
    dims = {"dim_time": star.dim_time(spark), "dim_course": star.dim_course(courses),
            "dim_student": star.dim_student(info), "dim_assessment": star.dim_assessment(a)}
    f = star.fact_performance(silver, dims).collect()
    # student 2 has no enrolment, so no Dim_Student row: dropped, but counted in the mean (60)
    assert len(f) == 1 and f[0].score_vs_avg == 20.0 and f[0].total_clicks is None


def _tables(spark, fact_rows):
    fact = spark.createDataFrame(fact_rows, "student_key long, course_key long, assessment_key long, "
                                            "time_key long, score double, final_result string, risk_group string")
    return {"fact_performance": fact}


def test_empty_table_row_count_fails_null_rate_warns(spark):
    t = _tables(spark, [])
    checks = [Q.Check("row_count", "dwh", "Fact_Performance"),
              Q.Check("null_rate", "dwh", "Fact_Performance", "score", warn_pct=25, fail_pct=60)]
    got = {r.check_name: (r.status, r.detail) for r in Q.run_health_checks(spark, t, checks).collect()}
    assert got["dwh.Fact_Performance.row_count"] == ("FAIL", "rows=0 min=1")
    assert got["dwh.Fact_Performance.score.null_rate"] == ("WARN", "table empty")


def test_null_rate_at_threshold_passes(spark):
    rows = [(1, 1, 1, 1, None if i == 0 else 50.0, "Pass", "Medium") for i in range(4)]
    c = Q.Check("null_rate", "dwh", "Fact_Performance", "score", warn_pct=25, fail_pct=60)
    r = Q.run_health_checks(spark, _tables(spark, rows), [c]).first()
    assert (r.status, r.detail) == ("PASS", "null=1/4 (25.00%)")


def test_accepted_values_lists_sorted_offenders(spark):
    rows = [(1, 1, 1, 1, 50.0, v, "Low") for v in ("Pass", "zz", "Bad", None, "Bad")]
    c = Q.Check("accepted_values", "dwh", "Fact_Performance", "final_result",
                accepted=("Pass", "Fail", "Withdrawn", "Distinction"))
    r = Q.run_health_checks(spark, _tables(spark, rows), [c]).first()
    assert (r.status, r.detail) == ("FAIL", "unexpected=['Bad', 'zz']")


def test_missing_column_is_error_other_tables_still_run(spark):
    t = _tables(spark, [(1, 1, 1, 1, 50.0, "Pass", "Low")])
    t["dim_time"] = star.dim_time(spark)
    checks = [Q.Check("null_rate", "dwh", "Fact_Performance", "no_such_column"),
              Q.Check("row_count", "dwh", "Fact_Performance"),
              Q.Check("row_count", "dwh", "Dim_Time", exact=4)]
    got = {r.check_name: r.status for r in Q.run_health_checks(spark, t, checks).collect()}
    assert got["dwh.Fact_Performance.no_such_column.null_rate"] == "ERROR"
    assert got["dwh.Fact_Performance.row_count"] == "PASS"
    assert got["dwh.Dim_Time.row_count"] == "PASS"


def test_a_missing_column_is_exactly_one_error_of_the_suite(spark):
    t = _tables(spark, [(1, 1, 1, 1, 50.0, "Pass", "Low")])
    t["fact_performance"] = t["fact_performance"].drop("score")
    checks = [c for c in Q.health_suite() if c.table == "Fact_Performance"]
    for got in (Q.run_health_checks(spark, t, checks).collect(), Q.collect_health_checks(spark, t, checks)):
        status = {r[0]: r[1] for r in got}
        assert len(status) == 8
        assert [k for k, v in status.items() if v == "ERROR"] == ["dwh.Fact_Performance.score.null_rate"]
    missing = Q.run_health_checks(spark, {}, [Q.Check("row_count", "dwh", "Dim_Time")]).first()
    assert missing.status == "ERROR" and "Dim_Time" in missing.detail


def test_a_check_that_fails_to_run_is_its_own_error(spark):
    broken = F.when(F.lit(True), F.raise_error(F.lit("x" * 900)).cast("double"))
    t = _tables(spark, [(1, 1, 1, 1, 50.0, "Pass", "Low")])
    t["fact_performance"] = t["fact_performance"].withColumn("score", broken)
    checks = [Q.Check("row_count", "dwh", "Fact_Performance"), Q.Check("null_rate", "dwh", "Fact_Performance", "score"),
              Q.Check("null_rate", "dwh", "Fact_Performance", "time_key")]
    got = Q.collect_health_checks(spark, t, checks)
    assert [r[0] for r in got] == [c.name for c in checks]
    assert [r[1] for r in got] == ["PASS", "ERROR", "PASS"] and len(got[1][2]) == Q.ERROR_DETAIL_CHARS


def test_building_the_checks_runs_nothing(spark):
    bomb = spark.range(1).select(F.raise_error(F.lit("ran")).cast("long").alias("time_key"))
    Q.run_health_checks(spark, {"dim_time": bomb, "fact_performance": _tables(spark, [])["fact_performance"]})
    names = [c.name for c in Q.health_suite("warehouse", "marts")]
    assert names[0] == "warehouse.Dim_Time.row_count" and names[-1].startswith("marts.")


def test_offending_values_are_the_twenty_smallest(spark):
    rows = [(1, 1, 1, 1, 50.0, f"v{i:03d}", "Low") for i in range(60)]
    c = Q.Check("accepted_values", "dwh", "Fact_Performance", "final_result", accepted=("Pass",))
    r = Q.run_health_checks(spark, _tables(spark, rows), [c]).first()
    assert r.detail == "unexpected=[" + ", ".join(f"'v{i:03d}'" for i in range(20)) + "]"


def _star_tables(spark):
    """Every table of the declared tests, empty, with the columns they need."""
    kinds = {"string": "code_presentation code_module gender disability assessment_type final_result risk_group highest_education".split()}
    out = {}
    for t, c, _ in [x for k in ("not_null", "unique", "accepted_values") for x in Q.declared(k)]:
        out.setdefault(t, {})[c] = "string" if c in kinds["string"] else "long"
    return {t: spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in cols.items())) for t, cols in out.items()}


def test_declared_tests_that_fail(spark):
    t = _star_tables(spark)
    fact = t["fact_performance"]
    t["fact_performance"] = spark.createDataFrame(
        [{"fact_id": i, "student_key": s, "course_key": 1, "assessment_key": 1, "time_key": 1, "final_result": r, "risk_group": "Low"}
         for i, s, r in ((1, 1, "Pass"), (1, None, "Lost"), (2, 3, "Gone"), (2, 3, "Lost"), (2, 3, None), (None, 3, "Pass"))], fact.schema)
    uq = {r.test_name: (r.failures, r.status) for r in Q.declared_unique(t).collect()}
    assert len(uq) == 8 and uq["unique_fact_performance_fact_id"] == (2, "FAIL") and uq["unique_dim_student_id_student"] == (0, "PASS")
    nn = {r.test_name: r.failures for r in Q.declared_not_null(t).collect()}
    assert len(nn) == 41 and nn["not_null_fact_performance_fact_id"] == 1 and nn["not_null_fact_performance_student_key"] == 1
    av = {r.test_name: r.failures for r in Q.declared_accepted_values(t).collect()}
    assert len(av) == 23 and av["accepted_values_fact_performance_final_result"] == 2 and sum(av.values()) == 2


def test_duplicated_business_keys_and_orphans(spark):
    dims = {"dim_time": star.dim_time(spark),
            "dim_course": spark.createDataFrame([(1, "AAA", "2013J"), (2, "AAA", "2013J"), (3, "AAA", None)],
                                                "course_key long, code_module string, code_presentation string"),
            "dim_student": spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 8), (5, None), (6, None)], "student_key long, id_student long"),
            "dim_assessment": spark.createDataFrame([(1, 70)], "assessment_key long, id_assessment long")}
    fact = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 1, 1), (9, 1, 1, 1), (9, 4, 2, 9)], "student_key long, course_key long, assessment_key long, time_key long")
    got = {r.table_name: r.duplicates for r in Q.unique_keys({**dims, "fact_performance": fact}).collect()}
    assert got == {"dim_time": 0, "dim_course": 1, "dim_student": 2, "dim_assessment": 0, "fact_performance": 1}
    fk = {r.constraint_name: r.orphans for r in Q.fk_orphans(fact, dims).collect()}
    assert fk == {"fk_fact_student_key": 2, "fk_fact_course_key": 1, "fk_fact_assessment_key": 1, "fk_fact_time_key": 1}


def test_unique_checks_shuffle_words_not_keys(spark):
    from conftest import SF_SMALL
    from edustar.plans.catalog import QUERIES
    for name in ("dq_declared_unique", "dq_unique", "dq_fk_orphans"):
        df = QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        # the only shuffles of single keys are behind the filter that asks whether any word is bad
        assert "bit_or" in plan and plan.count("Subquery subquery") >= 1 and "> 0)" in plan, name
        assert all(r[-1] == 0 or r[-2] == 0 for r in df.select("*").collect() if name != "dq_declared_unique")


def test_ties_keep_values_before_nulls(spark):
    df = spark.createDataFrame([("AAA", "2013J", None), ("AAA", "2013J", 200), ("BBB", "2013J", None)],
                               "code_module string, code_presentation string, module_presentation_length int")
    got = {r.code_module: r.module_presentation_length for r in star.dim_course(df).collect()}
    assert got == {"AAA": 200, "BBB": None}


def test_repeated_enrolments_get_their_own_fact_ids(spark):
    sa = spark.createDataFrame([(7, 1, 1, 0, 80.0), (7, 1, 1, 0, 80.0), (8, 1, 1, 0, None)], STUDENT_ASSESSMENT)
    a = spark.createDataFrame([("AAA", "2013J", i, "TMA", 1, 1.0) for i in (7, 8)], ASSESSMENTS)
    info = spark.createDataFrame([("AAA", "2013J", 1, "M", "r", "e", None, "0-35", 0, 60, "N", r) for r in ("Pass", "Pass", "Fail")], STUDENT_INFO)
    courses = spark.createDataFrame([("AAA", "2013J", 200)], "code_module string, code_presentation string, module_presentation_length int")
    silver = {"student_assessment": sa, "assessments": a, "student_info": info, "vle_clicks": S.vle_clicks(spark.createDataFrame([], STUDENT_VLE))}
    dims = {"dim_time": star.dim_time(spark), "dim_course": star.dim_course(courses), "dim_student": star.dim_student(info),
            "dim_assessment": star.dim_assessment(a)}
    f = star.fact_performance(silver, dims).collect()
    assert len(f) == 9 and sorted(r.fact_id for r in f) == list(range(1, 10))
    assert [r.final_result for r in sorted(f, key=lambda r: r.fact_id)] == ["Fail"] * 2 + ["Pass"] * 4 + ["Fail"] + ["Pass"] * 2


def test_summary_raises_on_fail(spark):
    import pytest
    assert Q.raise_on_failure([("a", "PASS", ""), ("b", "WARN", "")]) == {"PASS": 1, "WARN": 1}
    with pytest.raises(RuntimeError):
        Q.raise_on_failure([("a", "FAIL", "")])


def test_dim_time_seed_is_idempotent(spark):
    existing = star.dim_time(spark).filter(F.col("time_key") <= 2)
    once = star.dim_time(spark, existing)
    twice = star.dim_time(spark, once)
    assert once.count() == 4 and sorted(twice.collect()) == sorted(once.collect())
