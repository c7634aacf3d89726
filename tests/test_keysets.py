"""Sets of keys against plain counting; the report cube against the cards' own aggregates."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from edustar.functions.expr import credit_band
from edustar.operators import keysets as K
from edustar.operators import reports as R
from edustar.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    data = [(r.choice(["a", "b", None]), r.choice("xy"), r.choice([None, *range(200), 64, -1, -64, -65, 2**40 + 3])) for _ in range(3000)]
    data += [("hot", "x", 7)] * 2000
    return spark.createDataFrame(data, "g string, h string, k long").repartition(6).checkpoint(), data


def _distinct(data, by):
    out = {}
    for row in data:
        out.setdefault(tuple(row[i] for i in by), set()).add(row[2])
    return {g: len(s - {None}) for g, s in out.items()}


def test_distinct_counts_and_roll_up(rows):
    df, data = rows
    sets = K.key_sets(df, ["g", "h"], "k")
    got = {(r.g, r.h): r.n for r in sets.groupBy("g", "h").agg(K.size().alias("n")).collect()}
    assert got == _distinct(data, (0, 1))
    up = {(r.g,): r.n for r in K.union(sets, ["g"]).groupBy("g").agg(K.size().alias("n")).collect()}
    assert up == _distinct(data, (0,))
    assert K.union(sets, []).agg(F.sum(K.ROWS)).first()[0] == sum(1 for x in data if x[2] is not None)


def test_count_joined_to_groups(rows):
    df, data = rows
    df = df.unionByName(df.limit(1).select(F.lit("only nulls").alias("g"), "h", F.lit(None).cast("long").alias("k")))
    got = K.with_totals(df, ["g"], "k", "n", {"rows": F.count("*"), **K.moments("k")}).select("g", "n", "rows", K.mean("k").alias("m"), K.deviation("k").alias("d")).collect()
    assert {r.g: r.n for r in got} == {g: n for (g,), n in _distinct(data, (0,)).items()} | {"only nulls": 0}
    want = {r.g: r for r in df.groupBy("g").agg(F.count("*").alias("rows"), F.avg("k").alias("m"), F.stddev_pop("k").alias("d")).collect()}
    for r in got:
        assert r.rows == want[r.g].rows
        assert (r.m is None and want[r.g].m is None) or abs(r.m - want[r.g].m) <= 1e-9 * abs(want[r.g].m) and abs(r.d - want[r.g].d) <= 1e-6 * abs(want[r.g].d) + 1e-9
    assert {r.g: r.d for r in got}["hot"] == 0.0


def test_no_single_key_is_shuffled(rows):
    plan = K.distinct_count(rows[0], ["g"], "k", "n")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_bit_or" in plan and "hashpartitioning(g" in plan and "count(distinct" not in plan


def test_duplicated_and_missing(spark):
    keys = spark.createDataFrame([(0, k) for k in (1, 2, 3, 64, 65)] + [(1, k) for k in (5, 5, 5, 6, 6, 7, None, None, -3, 1000)], "i int, k long")
    assert {r.i: r.failures for r in K.duplicated(keys, "i", "k").collect()} == {1: 2}
    known = spark.createDataFrame([(0, k) for k in range(70)] + [(1, 5), (1, 7), (2, 6)], "i int, k long")
    assert {r.i: r.failures for r in K.missing(keys, known, "i", "k").collect()} == {1: 6}
    none = keys.limit(0)
    assert K.duplicated(none, "i", "k").count() == 0 and K.missing(none, known, "i", "k").count() == 0
    assert K.missing(keys, none, "i", "k").agg(F.sum("failures")).first()[0] == 15


def test_cube_equals_each_card_by_itself(spark):
    w = Warehouse.of(spark, SF_SMALL)
    d, cube = w.dims(), w.cube()
    f = w.fact().join(d["dim_student"].withColumn("credit_band", credit_band()), "student_key").join(d["dim_course"], "course_key")
    for name, by in R.CUBE_SETS.items():
        want = f.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("final_result").isin("Pass", "Distinction")).alias("passed"),
                                  F.count_distinct("student_key").alias("students"), F.sum("total_clicks").alias("clicks"),
                                  F.sum("module_presentation_length").alias("days"))
        got = cube.where(F.col("grouping") == name).select(*by, "n", "passed", "students", F.col("clicks_sum").alias("clicks"), "days")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_cube_keeps_facts_without_a_dimension_row_apart(spark):
    fact = spark.createDataFrame([(1, 1, "Pass", 3), (1, 9, "Fail", None), (8, 1, "Pass", 2)], "student_key long, course_key long, final_result string, total_clicks long")
    ds = spark.createDataFrame([(1, "10-20%", "A", "r", "N", "0-35", 0, 60)],
                               "student_key long, imd_band string, highest_education string, region string, disability string, age_band string, num_of_prev_attempts int, studied_credits int")
    dc = spark.createDataFrame([(1, "AAA", "2013J", 200)], "course_key long, code_module string, code_presentation string, module_presentation_length int")
    cube = R.report_cube(fact, ds, dc).checkpoint()
    assert [tuple(r) for r in R.pass_rate_by_region(cube).collect()] == [("r", 50.0)]
    assert [tuple(r) for r in R.pass_rate_by_module(cube).collect()] == [("AAA", 100.0)]
    assert [tuple(r) for r in R.pass_rate_by_education(cube).select("num_students").collect()] == [(1,)]
    assert R.report_cube(fact.limit(0), ds, dc).count() == 0


def test_cards_read_the_cube_not_the_fact(spark):
    from edustar.plans.catalog import QUERIES
    for name in ("pass_rate_by_imd", "credits_by_result", "clicks_per_module", "best_module"):
        files = QUERIES[name](spark, SF_SMALL).inputFiles()
        assert files and all("/report_cube/" in f for f in files), name
