"""Registry of runnable queries: name -> fn(spark, sf_dir) -> DataFrame.

Each query runs its own operator lazily on top of the layer below it, which
``Warehouse`` writes once per session and input folder:

  bronze (derived from the test tables) → silver_* keys
  silver (written)  → dim_* keys, fact-build keys
  star (written)    → staging, fact reports, checks
  staging (written) → marts; marts (written) → mart reports
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar.functions.expr import moment_corr, round_dec
from edustar.operators import marts as M
from edustar.operators import quality as Q
from edustar.operators import reports as R
from edustar.operators import silver as S
from edustar.operators import star
from edustar.operators.joins import detect_hot_keys, expand_copies, most_copies, skew_join
from edustar.operators.keysets import mean, moments, with_totals
from edustar.plans.warehouse import DIMS, Warehouse
from edustar.sources.log import newest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def W(spark, sf_dir) -> Warehouse:
    return Warehouse.of(spark, sf_dir)


# --- silver -----------------------------------------------------------------
def _silver_key(table: str, clean):
    def run(spark, sf_dir):
        return clean(W(spark, sf_dir).bronze()[table])
    return run


for _t, _fn in S.CLEANERS.items():
    QUERIES[f"silver_{_t}"] = _silver_key(_t, _fn)
QUERIES["silver_vle_clicks"] = _silver_key("student_vle", S.vle_clicks)


# --- star ---------------------------------------------------------------------
@query("dim_time")
def _dim_time(spark, sf_dir):
    # Seeding is idempotent: over the rows of the presentations that the courses use, it adds the others.
    w = W(spark, sf_dir)
    used = w.silver()["courses"].select("code_presentation").distinct()
    return star.dim_time(spark, existing=w.dims()["dim_time"].join(used, "code_presentation", "left_semi")
                         .select(*w.dims()["dim_time"].columns))


@query("dim_course")
def _dim_course(spark, sf_dir):
    w = W(spark, sf_dir)
    return star.dim_course(w.silver()["courses"], w.sizes.get("silver_courses"))


@query("dim_student")
def _dim_student(spark, sf_dir):
    w = W(spark, sf_dir)
    return star.dim_student(w.silver()["student_info"], w.sizes.get("silver_student_info"))


@query("dim_assessment")
def _dim_assessment(spark, sf_dir):
    w = W(spark, sf_dir)
    return star.dim_assessment(w.silver()["assessments"], w.sizes.get("silver_assessments"))


def _submissions(w: Warehouse):
    s, z = w.silver(), w.sizes
    return star.submissions_with_course(s["student_assessment"], s["assessments"], z.get("silver_assessments"),
                                        z.get("silver_student_assessment"))


@query("left_join_enrolment")
def _left_join_enrolment(spark, sf_dir):
    # Enrolment rows are not deduplicated upstream: copies fan out, as in the source. They are
    # joined collapsed (a written layer) and expanded after the join.
    w = W(spark, sf_dir)
    e = w.enrolments()
    return expand_copies(skew_join(_submissions(w), e, star.ENROLMENT, "left", hot=w.enrolment_hot_keys()), most_copies(e))


@query("left_join_clicks")
def _left_join_clicks(spark, sf_dir):
    # Click totals are an aggregate by enrolment: one row per key by construction.
    w = W(spark, sf_dir)
    clicks = w.silver()["vle_clicks"].select(*star.ENROLMENT, "total_clicks")
    return skew_join(_submissions(w), clicks, star.ENROLMENT, "left", hot=w.enrolment_hot_keys())


@query("left_join_enrolment_bucketed")
def _left_join_enrolment_bucketed(spark, sf_dir):
    # The same join over catalog tables bucketed by enrolment: no shuffle of either side.
    w = W(spark, sf_dir)
    return expand_copies(w.enrolment_tables().left_join("enrolments"), most_copies(w.enrolments()))


@query("left_join_clicks_bucketed")
def _left_join_clicks_bucketed(spark, sf_dir):
    return W(spark, sf_dir).enrolment_tables().left_join("clicks")


@query("score_vs_avg")
def _score_vs_avg(spark, sf_dir):
    # Over the written fact base (the enrolment joins are the left_join_* keys).
    w = W(spark, sf_dir)
    fb = w.fact_base()
    n = w.sizes.get("fact_base")
    return (star.with_score_vs_avg(fb, w.sizes.get("silver_assessments"),
                                   hot=lambda: detect_hot_keys(fb, ["id_assessment"], n))
            .select("id_student", "id_assessment", "score", "score_vs_avg"))


@query("fact_performance")
def _fact(spark, sf_dir):
    w = W(spark, sf_dir)
    return star.fact_performance(w.silver(), w.dims(), w.sizes, fb=w.fact_base(), per_student=w.fact_rows_per_student())


@query("risk_group_distribution")
def _risk(spark, sf_dir):
    f = W(spark, sf_dir).fact()
    g = with_totals(f, ["risk_group"], "student_key", "num_students", {"num_submissions": F.count(F.lit(1)), **moments("score")})
    return g.select("risk_group", "num_submissions", "num_students", round_dec(mean("score"), 2).alias("avg_score"))


@query("stg_fact_performance")
def _stg(spark, sf_dir):
    w = W(spark, sf_dir)
    return star.staging(w.fact(), w.dims(), w.sizes)


# --- marts ------------------------------------------------------------------------
def _mart_key(name: str):
    def run(spark, sf_dir):
        return M.ordered(name, M.MARTS[name](W(spark, sf_dir).staging()))
    return run


for _m in M.MARTS:
    QUERIES[_m] = _mart_key(_m)


@query("corr_clicks_score")
def _corr(spark, sf_dir):
    stg = W(spark, sf_dir).staging().filter(F.col("score").isNotNull())
    return (stg.groupBy("code_presentation")
            .agg(F.count(F.lit(1)).alias("num_submissions"),
                 round_dec(moment_corr("total_clicks", "score"), 3).alias("corr_clicks_score")))


# --- reports ----------------------------------------------------------------------
def _cube_card(fn):
    def run(spark, sf_dir):
        return fn(W(spark, sf_dir).cube())
    return run


for _n in ("pass_rate_by_imd", "pass_rate_by_education", "pass_rate_by_region", "disability_by_result",
           "pass_rate_age_education", "pass_rate_prior_attempts", "credits_by_result",
           "pass_rate_by_module", "best_module", "worst_module", "pass_rate_module_presentation",
           "module_length_vs_pass", "clicks_per_module"):
    QUERIES[_n] = _cube_card(getattr(R, _n))


@query("score_by_assessment_type_module")
def _score_type_module(spark, sf_dir):
    w = W(spark, sf_dir)
    d = w.dims()
    return R.score_by_assessment_type_module(w.fact(), d["dim_course"], d["dim_assessment"], w.sizes)


@query("total_students")
def _total_students(spark, sf_dir):
    return R.total_students(W(spark, sf_dir).dims()["dim_student"])


@query("overall_rates")
def _overall(spark, sf_dir):
    return R.overall_rates(W(spark, sf_dir).fact())


@query("student_funnel")
def _funnel(spark, sf_dir):
    w = W(spark, sf_dir)
    return R.student_funnel(w.fact(), w.dims()["dim_student"])


def _mart_report(fn, mart: str):
    def run(spark, sf_dir):
        return fn(W(spark, sf_dir).mart(mart))
    return run


for _n, _m in [("at_risk_count", "mart_at_risk_students"), ("top20_at_risk", "mart_at_risk_students"),
               ("top100_at_risk", "mart_at_risk_students"),
               ("result_by_module_rollup", "mart_result_by_module"),
               ("avg_score_gender_rollup", "mart_score_by_gender"),
               ("pass_rate_education_rollup", "mart_education_impact"),
               ("engagement_scatter", "mart_vle_engagement")]:
    QUERIES[_n] = _mart_report(getattr(R, _n), _m)


def _log_report(fn):
    def run(spark, sf_dir):
        return fn(W(spark, sf_dir).log())
    return run


for _n in ("log_totals", "log_status_distribution", "log_latest20",
           "log_hourly_status", "log_failure_leaderboard"):
    QUERIES[_n] = _log_report(getattr(R, _n))


@query("log_recent_failures")
def _log_recent(spark, sf_dir):
    # The registered key counts back from the newest entry, so its result is reproducible.
    log = W(spark, sf_dir).log()
    return R.log_recent_failures(log, as_of=newest(log))


@query("log_by_quarter")
def _log_by_quarter(spark, sf_dir):
    from edustar.sources.log import partition_label
    log = W(spark, sf_dir).log()
    return (log.groupBy(partition_label("checked_at").alias("partition_name"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min("checked_at").alias("first_checked_at"),
                 F.max("checked_at").alias("last_checked_at")))


# Every card in its display order.
def _in_order(name: str, fn):
    def run(spark, sf_dir):
        return R.ordered(name, fn(spark, sf_dir))
    return run


for _n in R.CARD_ORDER:
    QUERIES[_n] = _in_order(_n, QUERIES[_n])


# --- quality ----------------------------------------------------------------------
def _tables(w: Warehouse, names) -> dict[str, DataFrame]:
    """The warehouse's tables among ``names``; others aren't built."""
    return {t: w.table(t) for t in dict.fromkeys(names) if t in (*DIMS, "fact_performance", "stg_fact_performance", *M.MARTS)}


def _declared_tables(w: Warehouse, kind: str) -> dict[str, DataFrame]:
    return _tables(w, [t for t, _, _ in Q.declared(kind)])


def _suite_subset(kinds: tuple[str, ...]):
    def run(spark, sf_dir):
        checks = [c for c in Q.health_suite() if c.kind in kinds]
        return Q.run_health_checks(spark, _tables(W(spark, sf_dir), [c.table.lower() for c in checks]), checks)
    return run


QUERIES["dq_row_counts"] = _suite_subset(("row_count",))
QUERIES["dq_null_rate"] = _suite_subset(("null_rate",))
QUERIES["dq_accepted_values"] = _suite_subset(("accepted_values",))
QUERIES["dq_suite"] = _suite_subset(("row_count", "null_rate", "accepted_values"))


@query("dq_summary")
def _dq_summary(spark, sf_dir):
    return Q.summary(QUERIES["dq_suite"](spark, sf_dir))


@query("dq_declared_not_null")
def _dq_nn(spark, sf_dir):
    return Q.declared_not_null(_declared_tables(W(spark, sf_dir), "not_null"))


@query("dq_declared_unique")
def _dq_uq(spark, sf_dir):
    return Q.declared_unique(_declared_tables(W(spark, sf_dir), "unique"))


@query("dq_declared_accepted_values")
def _dq_av(spark, sf_dir):
    return Q.declared_accepted_values(_declared_tables(W(spark, sf_dir), "accepted_values"))


@query("dq_unique")
def _dq_unique(spark, sf_dir):
    return Q.unique_keys(_tables(W(spark, sf_dir), [t for t, _ in Q.UNIQUE_KEYS]))


@query("dq_fk_orphans")
def _dq_fk(spark, sf_dir):
    w = W(spark, sf_dir)
    return Q.fk_orphans(w.fact(), w.dims(), w.sizes)
