"""What crosses the network, and how much a task holds, as the tables grow."""

import itertools

from pyspark.sql import functions as F

from conftest import SF_SMALL
from edustar.operators import reports as R
from edustar.operators import star
from edustar.plans.catalog import QUERIES
from edustar.plans.warehouse import Warehouse
from edustar.sources import fixtures


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_line_join_shuffles_whole_numbers_only(spark):
    t = fixtures.read_tables(spark, SF_SMALL, ["lineitem", "orders"])
    li = fixtures.base_lines(t)
    assert {f.dataType.simpleString() for f in li.schema} <= {"bigint", "int", "double", "boolean"}
    plan = li._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("dayofmonth")  # the measures are worked out below the join
    assert plan.index("Join") < plan.index("year(")


def _grain(spark):
    cells = itertools.product((1, 2, None), (0, 3, 6, 13, -1, -2, -7, -14, None), (0, 1, 2, 3, -1, -2, None))
    rows = [(s, k, p, 10 * i % 70, i % 3 and 20 * i) for i, (s, k, p) in enumerate(cells)]
    g = spark.createDataFrame(rows, "id_student long, k int, p int, min_reg int, max_unreg int")
    m = (F.col("k") % 7).cast("int")
    return g.select("id_student", "k", "p", m.alias("m"), fixtures._module(m).alias("code_module"),
                    fixtures.presentation_of(F.col("p")).alias("code_presentation"), "min_reg", "max_unreg")


def test_enrolment_grain_keeps_every_enrolment_in_one_shuffle(spark):
    g = _grain(spark)
    e = fixtures.enrolment_grain(g)
    assert _plan(e).count("Exchange hashpartitioning") == 1
    cols = ["id_student", "m", "p", "code_module", "code_presentation"]
    assert _rows(fixtures.enrolments_of(e), *cols) == _rows(g.select(*cols).distinct(), *cols)
    by = ["code_module", "code_presentation", "id_student"]
    want = g.groupBy(*by).agg(F.min("min_reg").alias("date_registration"), F.max("max_unreg").alias("date_unregistration"))
    got = fixtures.raw_student_registration(e)
    assert _rows(got, *want.columns) == _rows(want, *want.columns)


def test_average_and_band_join_after_the_numbering(spark):
    w = Warehouse.of(spark, SF_SMALL)
    p = _plan(star.fact_performance(w.silver(), w.dims(), w.sizes, fb=w.fact_base(), per_student=w.fact_rows_per_student()))
    shuffled = p[p.index("Exchange hashpartitioning(_b"):]
    assert "_avg_score" not in shuffled.split("BroadcastExchange")[0] and "risk_group" not in shuffled


def test_staging_is_written_unsorted_and_shuffles_the_fact_alone(spark, monkeypatch):
    from edustar.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 20_000)  # Dim_Student no longer fits
    w = Warehouse(spark, SF_SMALL)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        dims = {**w.dims()}
        plan = _plan(star.staging(w.fact(), dims, {**w.sizes, "dim_course": 1, "dim_assessment": 1, "dim_time": 1}))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.index("BroadcastHashJoin") < plan.index("SortMergeJoin")  # the dimensions are looked up above the shuffle
    from edustar.plans.warehouse import SORTED_WITHIN
    assert "stg_fact_performance" not in SORTED_WITHIN


def test_cube_rolls_up_a_word_of_students_in_one_task(spark):
    w = Warehouse.of(spark, SF_SMALL)
    d = w.dims()
    p = _plan(R.report_cube(w.fact(), d["dim_student"], d["dim_course"], w.sizes))
    assert "Exchange hashpartitioning(_word" in p and "REPARTITION_BY_COL" in p
    assert not any("course_key" in line for line in p.splitlines() if "Exchange hashpartitioning" in line)


def test_checks_and_reports_build_no_table_they_do_not_read(spark, tmp_path):
    link = tmp_path / "sf"
    link.symlink_to(SF_SMALL)
    QUERIES["dq_accepted_values"](spark, str(link)).collect()
    w = Warehouse.of(spark, str(link))
    assert "fact_performance" in w.sizes and not any(n.startswith(("mart_", "stg_")) for n in w._tables)
    want = sorted(map(tuple, QUERIES["top20_at_risk"](spark, SF_SMALL).collect()))
    assert sorted(map(tuple, QUERIES["top20_at_risk"](spark, str(link)).collect())) == want
    assert [n for n in w._tables if n.startswith(("mart_", "stg_"))] == ["mart_at_risk_students"]


def test_narrow_rows_are_not_merged_into_few_large_tasks(spark, monkeypatch):
    from edustar.operators import joins
    from edustar.operators.keys import histogram_key
    t = fixtures.read_tables(spark, SF_SMALL, ["lineitem", "orders"])
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 500)
    assert "l_orderkey" in _plan(fixtures.base_lines(t)) and "12), REPARTITION_BY_NUM" in _plan(fixtures.base_lines(t))  # 6,000 lines
    rows = spark.range(100).select((F.col("id") + 1).alias("a"), F.lit(1).cast("long").alias("b"))
    assert "REPARTITION_BY_NUM" in _plan(histogram_key(rows, "a", "b", [], "key"))
