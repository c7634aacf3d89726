"""The five marts over the staging table (one aggregate each).

Rules kept from the report definitions: STDDEV is the population one; the
clicks/score correlation is the moment formula (``moment_corr``); rounded
values go through ``round_dec``; the result-share window runs over the
already-aggregated groups (a handful of rows per course), not the fact.
Distinct students are counted as sets of dense student keys (``keysets``),
so no student ids are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edustar.functions.expr import round_dec
from edustar.operators.keysets import deviation, mean, moments, with_totals

col = F.col


def _grouped(stg: DataFrame, by: list[str], totals: dict) -> DataFrame:
    return with_totals(stg, by, "student_key", "num_students", {"num_submissions": F.count(F.lit(1)), **totals})


def _hits(*values: str) -> dict:
    """Rows with each final result."""
    return {f"hit_{v}": F.count_if(col("final_result") == v) for v in values}


def _rate(value: str):
    return round_dec(col(f"hit_{value}").cast("double") / col("num_submissions").cast("double") * 100, 2)


def result_by_module(stg: DataFrame) -> DataFrame:
    g = _grouped(stg, ["code_module", "code_presentation", "presentation_label", "final_result"], {})
    course = Window.partitionBy("code_module", "code_presentation")
    share = col("num_submissions").cast("double") * 100.0 / F.sum("num_submissions").over(course)
    return g.withColumn("pct_submissions", round_dec(share, 2))


def score_by_gender(stg: DataFrame) -> DataFrame:
    by = ["gender", "assessment_type", "code_presentation", "presentation_label"]
    return _grouped(stg.filter(col("score").isNotNull()), by, moments("score")).select(
        *by, "num_students", "num_submissions",
        round_dec(mean("score"), 2).alias("avg_score"),
        round_dec(col("min_score"), 2).alias("min_score"),
        round_dec(col("max_score"), 2).alias("max_score"),
        round_dec(deviation("score"), 2).alias("stddev_score"))


def education_impact(stg: DataFrame) -> DataFrame:
    by = ["highest_education", "assessment_type", "code_presentation", "presentation_label"]
    return _grouped(stg, by, {**moments("score"), **_hits("Pass", "Distinction", "Withdrawn")}).select(
        *by, "num_students", "num_submissions",
        round_dec(mean("score"), 2).alias("avg_score"),
        _rate("Pass").alias("pass_rate_pct"),
        _rate("Distinction").alias("distinction_rate_pct"),
        _rate("Withdrawn").alias("withdrawn_rate_pct"))


def vle_engagement(stg: DataFrame) -> DataFrame:
    by = ["risk_group", "code_presentation", "presentation_label"]
    both = col("total_clicks").cast("double") * col("score").cast("double")
    g = _grouped(stg.filter(col("score").isNotNull()), by, {**moments("score"), **moments("total_clicks"), "n_both": F.count(both), "s_both": F.sum(both)})
    corr = (mean("both") - mean("total_clicks") * mean("score")) / F.nullif(deviation("total_clicks") * deviation("score"), F.lit(0.0))
    return g.select(
        *by, "num_students", "num_submissions",
        round_dec(mean("total_clicks"), 2).alias("avg_total_clicks"),
        round_dec(mean("score"), 2).alias("avg_score"),
        round_dec(deviation("total_clicks"), 2).alias("stddev_clicks"),
        round_dec(corr, 3).alias("corr_clicks_score"))


def risk_order():
    """Low, Medium, then everything else."""
    return F.when(col("risk_group") == "Low", 1).when(col("risk_group") == "Medium", 2).otherwise(3)


AT_RISK_KEYS = ["id_student", "gender", "region", "highest_education", "age_band", "disability",
                "code_module", "code_presentation", "presentation_label"]


def at_risk_students(stg: DataFrame) -> DataFrame:
    return (stg.filter(col("risk_group") == "High")
            .groupBy(*AT_RISK_KEYS)
            .agg(F.count(F.lit(1)).alias("num_high_risk_submissions"),
                 round_dec(F.avg("score"), 2).alias("avg_score"),
                 round_dec(F.avg("total_clicks"), 2).alias("avg_total_clicks"),
                 F.max("final_result").alias("final_result")))


MARTS = {
    "mart_result_by_module": result_by_module,
    "mart_score_by_gender": score_by_gender,
    "mart_education_impact": education_impact,
    "mart_vle_engagement": vle_engagement,
    "mart_at_risk_students": at_risk_students,
}

# The order each mart is built in, then its remaining key columns.
MART_ORDER = {
    "mart_result_by_module": ["code_module", "code_presentation", "final_result"],
    "mart_score_by_gender": ["code_presentation", "gender", "assessment_type"],
    "mart_education_impact": ["code_presentation", "highest_education", "assessment_type"],
    "mart_vle_engagement": ["code_presentation", risk_order, "risk_group"],
    "mart_at_risk_students": ["id_student", "code_presentation", "code_module"],
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    """The mart in its order: a range shuffle, so also the one that grows is sorted by many tasks."""
    return df.orderBy(*[c() if callable(c) else c for c in MART_ORDER[name]])
