"""Named catalog tables: bucketed joins without a shuffle, tables that outlive the session's catalog."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from edustar.operators import star
from edustar.operators.joins import SALT, HotKeys, detect_hot_keys
from edustar.plans.catalog import QUERIES
from edustar.plans.tables import Buckets, EnrolmentTables, attach, save
from edustar.plans.warehouse import Warehouse


def _executed(df):
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def test_bucketed_joins_do_not_shuffle(spark):
    w = Warehouse.of(spark, SF_SMALL)
    for name, key in (("enrolments", "left_join_enrolment"), ("clicks", "left_join_clicks")):
        plan = _executed(w.enrolment_tables().left_join(name))
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan, name
        got = QUERIES[f"{key}_bucketed"](spark, SF_SMALL)
        want = QUERIES[key](spark, SF_SMALL)
        assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))


def test_hot_enrolment_lies_in_several_buckets(spark, tmp_dir):
    n = 6000
    subs = spark.range(n).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id_student"), F.lit("AAA").alias("code_module"),
                                 F.lit("2013J").alias("code_presentation"), F.col("id").alias("id_assessment"))
    keys = star.ENROLMENT
    enrolled = subs.select(*keys).distinct().where("id_student % 5 != 0").withColumn("final_result", F.lit("Pass"))
    hot = detect_hot_keys(subs, keys, n)
    assert hot.any
    t = EnrolmentTables.save(spark, os.path.join(tmp_dir, "t"), f"db_{uuid.uuid4().hex[:8]}", subs, enrolled, enrolled.withColumn("total_clicks", F.lit(1)), keys, hot, 8)
    got = t.left_join("enrolments")
    assert "Exchange" not in _executed(got)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, subs.join(enrolled, keys, "left").select(*got.columns).collect()), key=str)
    files = t.table("submissions").where("id_student = 1").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 3 and max(f["count"] for f in files) < n / 3
    assert t.table("submissions").where("id_student = 1").select(SALT).distinct().count() >= 2


def test_saved_tables_are_attached_again(spark, tmp_dir):
    w = Warehouse.of(spark, SF_SMALL)
    a, b = f"dwh_{uuid.uuid4().hex[:8]}", f"dwh_{uuid.uuid4().hex[:8]}"
    names = w.save_tables(a, os.path.join(tmp_dir, a))
    assert f"{a}.mart_at_risk_students" in names and f"{a}.fact_performance" in names
    spark.sql(f"DROP DATABASE {a} CASCADE")  # the catalog forgets them; external files stay
    assert sorted(n.split(".")[1] for n in attach(spark, b, os.path.join(tmp_dir, a))) == sorted(n.split(".")[1] for n in names)
    for t, want in (("fact_performance", w.fact()), ("mart_vle_engagement", w.mart("mart_vle_engagement"))):
        assert sorted(map(str, spark.table(f"{b}.{t}").select(*want.columns).collect())) == sorted(map(str, want.collect()))
    j = spark.sql(f"SELECT region, count(*) AS n FROM {b}.fact_performance f JOIN {b}.dim_student s USING (student_key) GROUP BY 1")
    want = w.fact().join(w.dims()["dim_student"], "student_key").groupBy("region").count()
    assert sorted(map(tuple, j.collect())) == sorted(map(tuple, want.collect()))
    plan = spark.table(f"{b}.fact_performance").hint("merge").join(spark.table(f"{b}.dim_student").hint("merge"), "student_key")
    assert "Exchange" not in _executed(plan)


def test_saving_again_replaces_the_rows(spark, tmp_dir):
    db = f"again_{uuid.uuid4().hex[:8]}"
    for n in (10, 4):
        save(spark, db, os.path.join(tmp_dir, db), {"t": spark.range(n), "e": spark.range(0)}, {"t": Buckets(["id"], 3)})
    assert spark.table(f"{db}.t").count() == 4 and spark.table(f"{db}.e").count() == 0


def test_unsalted_tables(spark, tmp_dir):
    subs = spark.createDataFrame([(1, "A", "J", 5), (2, "A", "J", 5), (None, "A", "J", 6)], "id_student long, code_module string, code_presentation string, x int")
    en = spark.createDataFrame([(1, "A", "J", "Pass"), (1, "A", "J", "Fail")], "id_student long, code_module string, code_presentation string, final_result string")
    t = EnrolmentTables.save(spark, os.path.join(tmp_dir, "u"), f"db_{uuid.uuid4().hex[:8]}", subs, en, en, star.ENROLMENT, HotKeys(star.ENROLMENT, None), 4)
    assert sorted((r.id_student or 0, str(r.final_result)) for r in t.left_join("enrolments").collect()) == [(0, "None"), (1, "Fail"), (1, "Pass"), (2, "None")]
