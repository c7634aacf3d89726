"""Report SQL runs unchanged in spirit through ``spark.sql`` on the registered views
and agrees with the DataFrame implementation of the same card."""

from pyspark.sql import functions as F

from edustar.operators import reports as R
from edustar.plans.warehouse import Warehouse
from conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_dashboard_sql_on_views(spark):
    w = Warehouse.of(spark, SF_SMALL)
    views = w.register_views()
    assert {"Fact_Performance", "Dim_Student", "mart_at_risk_students", "monitoring_log"} <= set(views)
    region = spark.sql("""
        SELECT ds.region AS region,
               CAST(ROUND(CAST(AVG(CASE WHEN fp.final_result IN ('Pass','Distinction') THEN 100.0D ELSE 0.0D END)
                               AS DECIMAL(28,10)), 1) AS DOUBLE) AS pass_rate_pct
        FROM Fact_Performance fp JOIN Dim_Student ds ON fp.student_key = ds.student_key
        GROUP BY ds.region ORDER BY pass_rate_pct DESC""")
    d = w.dims()
    assert _rows(region) == _rows(R.pass_rate_by_region(w.cube()))
    at_risk = spark.sql("SELECT COUNT(DISTINCT id_student) AS at_risk_count FROM mart_at_risk_students")
    assert _rows(at_risk) == _rows(R.at_risk_count(w.mart("mart_at_risk_students")))
    recent = spark.sql("""SELECT COUNT(*) AS recent_failures FROM monitoring_log
        WHERE status IN ('FAIL','ERROR')
          AND checked_at > (SELECT MAX(checked_at) FROM monitoring_log) - INTERVAL 7 DAY""")
    newest = w.log().select(F.max("checked_at")).scalar()
    assert _rows(recent) == _rows(R.log_recent_failures(w.log(), as_of=newest))
    now = R.log_recent_failures(w.log())  # by the wall clock
    assert "current_timestamp" in now._jdf.queryExecution().analyzed().toString()


def test_fact_written_sorted_for_data_skipping(spark):
    w = Warehouse.of(spark, SF_SMALL)
    high = w.fact().filter("risk_group = 'High'")
    plan = high._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(risk_group), EqualTo(risk_group,High)]" in plan
