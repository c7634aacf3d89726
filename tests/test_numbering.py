"""Numbering of the fact: equal to one row_number over everything, whatever is hot."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from edustar.operators import keys as K

SCHEMA = "student_key long, assessment_key long, score double, total_clicks long, note string"


def plain(df):
    w = Window.orderBy("student_key", "assessment_key", "score", "total_clicks")
    return sorted(map(str, df.select(F.row_number().over(w).alias("fact_id"), "*").collect()))


def numbered(df):
    out = K.histogram_key(df, "student_key", "assessment_key", ["score", "total_clicks"], "fact_id")
    return sorted(map(lambda r: str(r.asDict()), out.collect())), out


def rows_of(kind):
    r = random.Random(kind)
    rows = [(r.randrange(1, 300), r.randrange(1, 20), r.choice([None, 1.0, 55.5, 80.0]), r.randrange(4)) for _ in range(1500)]
    if kind in ("student", "both"):
        rows += [(s, r.randrange(1, 20), float(r.randrange(50)), r.randrange(4)) for s, n in ((40, 900), (41, 700), (299, 500), (1, 400)) for _ in range(n)]
    if kind in ("pair", "both"):
        rows += [(42, 7, 60.0, 1)] * 3000 + [(42, 7, None, 2)] * 1100 + [(42, 8, 9.0, 0)] * 40
    return [(*x, f"{x}") for x in rows]


@pytest.mark.parametrize("kind", ["even", "student", "pair", "both"])
def test_equals_one_row_number(spark, kind):
    df = spark.createDataFrame(rows_of(kind), SCHEMA).repartition(5).checkpoint()
    got, _ = numbered(df)
    assert got == sorted(str(r.asDict()) for r in df.select(
        F.row_number().over(Window.orderBy("student_key", "assessment_key", "score", "total_clicks")).alias("fact_id"), "*").collect())


def test_empty_and_single(spark):
    assert K.histogram_key(spark.createDataFrame([], SCHEMA), "student_key", "assessment_key", ["score"], "i").count() == 0
    one = spark.createDataFrame([(1, 1, 2.0, 3, "x")], SCHEMA)
    assert K.histogram_key(one, "student_key", "assessment_key", ["score"], "i").first().i == 1


def test_one_shuffle_and_no_range(spark):
    df = spark.createDataFrame(rows_of("even"), SCHEMA).checkpoint()
    plan = numbered(df)[1]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("score") and "Exchange hashpartitioning(_b" in plan


def test_hot_rows_are_split(spark):
    df = spark.createDataFrame(rows_of("student"), SCHEMA).checkpoint()
    plan = numbered(df)[1]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_b" in plan and "_s2" in plan
