"""Report cards over the fact, the dimensions, the marts and the check log.

The cards that group the fact by attributes of the student or the course read one cube (``report_cube``): the fact is
reduced to one row per (student, final result) for the groupings by student and per (course, word of 64 students) for those
by course, both map-side aggregates over its runs of student keys, and each is rolled up in one grouping-sets pass, the
students' with the rows of a word in one task. Distinct students are sets of dense student keys (``keysets``), which add up. The rates come out exactly as avg(CASE ... 100.0 ELSE 0.0)
would: 100 * k / n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edustar.functions.expr import PASSED, credit_band, pass_rate_pct, rate_pct, round_dec
from edustar.operators.joins import sized_broadcast
from edustar.operators.keysets import BITS, WORD, bit_of, key_sets, size, word_of
from edustar.sources.log import recent

col = F.col


# The order in which each card shows its rows ("-" descending), then the business
# key, so that ties can't reorder it. Nulls come first ascending and last descending.
CARD_ORDER = {
    "pass_rate_by_imd": ["imd_band"],
    "pass_rate_by_module": ["-pass_rate_pct", "code_module"],
    "pass_rate_by_education": ["-pass_rate_pct", "highest_education"],
    "pass_rate_by_region": ["-pass_rate_pct", "region"],
    "result_by_module_rollup": ["code_module", "final_result"],
    "avg_score_gender_rollup": ["gender", "assessment_type"],
    "pass_rate_education_rollup": ["-avg_pass_rate_pct", "highest_education"],
    "log_hourly_status": ["hour_bucket", "status"],
    "log_failure_leaderboard": ["-fail_count", "-total_runs", "check_name"],
    "student_funnel": ["sort_order"],
    "disability_by_result": ["disability", "final_result"],
    "pass_rate_age_education": ["age_band", "highest_education"],
    "pass_rate_prior_attempts": ["num_of_prev_attempts"],
    "credits_by_result": ["credit_band", "final_result"],
    "pass_rate_module_presentation": ["code_module", "code_presentation"],
    "score_by_assessment_type_module": ["code_module", "assessment_type"],
    "module_length_vs_pass": ["avg_length_days", "code_module"],
    "clicks_per_module": ["-avg_clicks_per_record", "code_module"],
}


def ordered(name: str, card: DataFrame) -> DataFrame:
    """The card in its display order (a sort of its few rows)."""
    keys = CARD_ORDER.get(name, ())
    return card.orderBy(*[col(k[1:]).desc() if k[0] == "-" else col(k).asc() for k in keys]) if keys else card


# --- the cube ------------------------------------------------------------------
# Groupings of the cards over the fact.
CUBE_SETS = {
    "imd": ["imd_band"],
    "education": ["highest_education"],
    "region": ["region"],
    "disability_result": ["disability", "final_result"],
    "age_education": ["age_band", "highest_education"],
    "attempts": ["num_of_prev_attempts"],
    "credits_result": ["credit_band", "final_result"],
    "module": ["code_module"],
    "module_presentation": ["code_module", "code_presentation"],
}
CUBE_COLUMNS = list(dict.fromkeys(c for s in CUBE_SETS.values() for c in s))


COURSE_SETS = {k: s for k, s in CUBE_SETS.items() if s[0] == "code_module"}
STUDENT_SETS = {k: s for k, s in CUBE_SETS.items() if k not in COURSE_SETS}
CUBE_SUMS = ["n", "passed", "course_n", "course_passed", "clicks_sum", "clicks_n", "days"]


def _rolled_up(df: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """The groupings ``sets`` of rows with CUBE_SUMS, ``_word`` and ``_bit``.

    First per word of 64 students, then without: the sets of students are counted in between.
    """
    columns = list(dict.fromkeys(c for s in sets.values() for c in s))
    # grouping_id(): a bit per column that is rolled up, the first column's highest; the word never is
    ids = {name: sum(1 << (len(columns) - i) for i, c in enumerate(columns) if c not in s) for name, s in sets.items()}
    part = df.groupingSets([[*s, WORD] for s in sets.values()], *columns, WORD).agg(
        F.grouping_id().alias("_g"), F.bit_or("_bit").alias("_bits"), *[F.sum(c).alias(c) for c in CUBE_SUMS])
    name = F.create_map(*[F.lit(x) for k, v in ids.items() for x in (v, k)])
    return part.groupBy(name[col("_g").cast("int")].alias("grouping"), *columns).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in CUBE_SUMS], F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).alias("students"))


def report_cube(fact: DataFrame, dim_student: DataFrame, dim_course: DataFrame, sizes: dict | None = None) -> DataFrame:
    """A row per grouping (``grouping``, a name in CUBE_SETS) and group.

    n, passed: fact rows with a student, and those that passed; students: different students; course_n, course_passed: the
    same over rows with a course; clicks_sum, clicks_n: clicks of those; days: course length summed over them.
    """
    sizes = sizes or {}
    dc = dim_course.select("course_key", F.lit(True).alias("_c"), "code_module", "code_presentation", "module_presentation_length")
    f = fact.join(sized_broadcast(dc, known_rows=sizes.get("dim_course")), "course_key", "left")
    of_course = lambda c: F.when(col("_c"), c)
    passed = col("final_result").isin(*PASSED)
    sums = [F.count(F.lit(1)).alias("n"), F.count_if(passed).alias("passed"), F.count("_c").alias("course_n"), F.count_if(of_course(passed)).alias("course_passed"),
            F.sum(of_course(col("total_clicks"))).alias("clicks_sum"), F.count(of_course(col("total_clicks"))).alias("clicks_n"),
            F.sum("module_presentation_length").alias("days")]
    known = lambda flag: [F.when(flag, col(c)).alias(c) for c in CUBE_SUMS[:2]] + CUBE_SUMS[2:]

    ds = dim_student.select("student_key", F.lit(True).alias("_s"), "imd_band", "highest_education", "region", "disability", "age_band",
                            "num_of_prev_attempts", credit_band().alias("credit_band"))
    by_student = f.groupBy("student_key", "final_result").agg(*sums).join(sized_broadcast(ds, known_rows=sizes.get("dim_student")), "student_key", "left")
    by_student = by_student.select(*dict.fromkeys(c for s in STUDENT_SETS.values() for c in s), word_of("student_key").alias(WORD),
                                   F.when(col("_s"), bit_of("student_key")).alias("_bit"), *known(col("_s")))

    # which students the dimension has, as sets: whether a fact row has one needs no lookup by student
    has = key_sets(dim_student, [], "student_key").select(WORD, col(BITS).alias("_known"))
    words = None if "dim_student" not in sizes else sizes["dim_student"] // 64 + 1  # of dense keys
    by_course = f.withColumn(WORD, word_of("student_key")).join(sized_broadcast(has, known_rows=words), WORD, "left") \
        .withColumn("_s", F.coalesce(col("_known").bitwiseAND(bit_of("student_key")) != 0, F.lit(False)))
    by_course = by_course.groupBy("code_module", "code_presentation", WORD, "_s").agg(*sums, F.bit_or(bit_of("student_key")).alias("_bit"))
    by_course = by_course.select("code_module", "code_presentation", WORD, F.when(col("_s"), col("_bit")).alias("_bit"), *known(col("_s")))
    return _rolled_up(by_student.repartition(WORD), STUDENT_SETS).unionByName(_rolled_up(by_course, COURSE_SETS), allowMissingColumns=True) \
        .select("grouping", *CUBE_COLUMNS, *CUBE_SUMS, "students")


def _groups(cube: DataFrame, name: str) -> DataFrame:
    """The rows of one grouping that have facts."""
    n = "course_n" if CUBE_SETS[name][0] == "code_module" else "n"
    return cube.where((col("grouping") == name) & (col(n) > 0))


def _share(k: str, n: str) -> Column:
    return col(k).cast("double") * 100.0 / col(n).cast("double")


def _rate1(c: Column, name: str = "pass_rate_pct") -> Column:
    return round_dec(c, 1).alias(name)


def _passing(cube: DataFrame, name: str, *more: Column | str) -> DataFrame:
    """The pass rate of each group of a grouping by student attributes."""
    return _groups(cube, name).select(*CUBE_SETS[name], *more, _rate1(_share("passed", "n")))


# --- executive / demographic cards over fact and Dim_Student ---------------
def total_students(dim_student: DataFrame) -> DataFrame:
    return key_sets(dim_student, [], "id_student").agg(size().alias("total_students"))


def overall_rates(fact: DataFrame) -> DataFrame:
    fr = col("final_result")
    return fact.agg(_rate1(pass_rate_pct(), "pass_rate"),
                    _rate1(rate_pct(fr == "Distinction"), "distinction_rate"),
                    _rate1(rate_pct(fr == "Withdrawn"), "withdrawn_rate"))


def pass_rate_by_imd(cube):
    return _passing(cube.where(col("imd_band").isNotNull() & (col("imd_band") != "")), "imd")


def pass_rate_by_education(cube):
    return _passing(cube, "education", col("students").alias("num_students"))


def pass_rate_by_region(cube):
    return _passing(cube, "region")


def disability_by_result(cube):
    return _groups(cube, "disability_result").select("disability", "final_result", "n")


def pass_rate_age_education(cube):
    return _passing(cube, "age_education")


def pass_rate_prior_attempts(cube):
    return _passing(cube, "attempts", col("students").alias("num_students"))


def credits_by_result(cube):
    return _groups(cube, "credits_result").select("credit_band", "final_result", "n")


def student_funnel(fact: DataFrame, dim_student: DataFrame) -> DataFrame:
    """Registered → submitted ≥ 1 → passed → distinction, one row per step.

    One pass over the fact: three sets of student keys (words of 64 keys, a map-side aggregate), whose sizes
    are added up; the registered count is a scalar subquery on the dimension. ``stack`` unpivots the single row
    into the four steps.
    """
    fr, bit = col("final_result"), bit_of("student_key")
    sets = (fact.groupBy(word_of("student_key"))
            .agg(F.bit_or(F.when(col("score").isNotNull(), bit)).alias("s"),
                 F.bit_or(F.when(fr.isin(*PASSED), bit)).alias("p"),
                 F.bit_or(F.when(fr == "Distinction", bit)).alias("d")))
    registered = dim_student.select(F.count(F.lit(1))).scalar()
    totals = sets.agg(*[F.coalesce(F.sum(F.bit_count(c)), F.lit(0)).cast("long").alias(c) for c in "spd"])
    totals = totals.withColumn("r", registered)
    return totals.select(F.expr(
        "stack(4, 'Registered', 1, r, 'Submitted >= 1', 2, s, 'Passed', 3, p, 'Distinction', 4, d)"
        " AS (step, sort_order, students)"))


# --- module cards ------------------------------------------------------------
def _module_rate() -> Column:
    return _share("course_passed", "course_n")


def pass_rate_by_module(cube):
    return _groups(cube, "module").select("code_module", _rate1(_module_rate()))


def _module_label(cube, ascending: bool, name: str) -> DataFrame:
    g = _groups(cube, "module").select("code_module", _module_rate().alias("_rate"))
    label = F.concat(col("code_module"), F.lit(" ("),
                     round_dec(col("_rate"), 1).cast("decimal(5,1)").cast("string"),
                     F.lit("% pass)"))
    order = col("_rate").asc() if ascending else col("_rate").desc()
    # Top-1 by rate; the module name breaks ties so the card is deterministic.
    return g.orderBy(order, col("code_module").asc()).limit(1).select(label.alias(name))


def best_module(cube):
    return _module_label(cube, False, "best_module")


def worst_module(cube):
    return _module_label(cube, True, "worst_module")


def pass_rate_module_presentation(cube):
    return _groups(cube, "module_presentation").select("code_module", "code_presentation", _rate1(_module_rate()))


def module_length_vs_pass(cube):
    # Length averaged per fact row: each course is weighted by its row count.
    length = col("days").cast("double") / col("course_n").cast("double")
    return _groups(cube, "module").select("code_module", round_dec(length, 0).alias("avg_length_days"), _rate1(_module_rate()))


def clicks_per_module(cube):
    clicks = col("clicks_sum").cast("double") / F.nullif(col("clicks_n"), F.lit(0)).cast("double")
    return _groups(cube, "module").select("code_module", round_dec(clicks, 0).alias("avg_clicks_per_record"))


def score_by_assessment_type_module(fact, dim_course, dim_assessment, sizes=None):
    sizes = sizes or {}
    rolled = (fact.filter(col("score").isNotNull())
              .groupBy("course_key", "assessment_key")
              .agg(F.sum("score").alias("s"), F.count(F.lit(1)).alias("c")))
    dc = sized_broadcast(dim_course.select("course_key", "code_module"), known_rows=sizes.get("dim_course"))
    da = sized_broadcast(dim_assessment.select("assessment_key", "assessment_type"),
                         known_rows=sizes.get("dim_assessment"))
    return (rolled.join(dc, "course_key").join(da, "assessment_key")
            .groupBy("code_module", "assessment_type")
            .agg(round_dec(F.sum("s") / F.sum("c").cast("double"), 1).alias("avg_score")))


# --- cards over the marts ----------------------------------------------------
def at_risk_count(mart_at_risk: DataFrame) -> DataFrame:
    return key_sets(mart_at_risk, [], "id_student").agg(size().alias("at_risk_count"))


def _top_at_risk(mart_at_risk: DataFrame, n: int, with_education: bool) -> DataFrame:
    cols = ["id_student", "code_module", "code_presentation"]
    if with_education:
        cols.append("highest_education")
    cols.append("num_high_risk_submissions")
    # The card's order, then the business key so ties cannot reorder the cut.
    ordered = mart_at_risk.orderBy(col("num_high_risk_submissions").desc_nulls_last(),
                                   col("avg_score").asc_nulls_first(),
                                   "id_student", "code_module", "code_presentation")
    return ordered.limit(n).select(*cols, round_dec(col("avg_score"), 1).alias("avg_score"),
                                   "final_result")


def top20_at_risk(mart_at_risk):
    return _top_at_risk(mart_at_risk, 20, True)


def top100_at_risk(mart_at_risk):
    return _top_at_risk(mart_at_risk, 100, False)


def result_by_module_rollup(mart_result_by_module):
    return (mart_result_by_module.groupBy("code_module", "final_result")
            .agg(F.sum("num_submissions").alias("submissions")))


def avg_score_gender_rollup(mart_score_by_gender):
    """Unweighted average of the mart's averages, as the card defines it."""
    return (mart_score_by_gender.groupBy("gender", "assessment_type")
            .agg(round_dec(F.avg("avg_score"), 2).alias("avg_score")))


def pass_rate_education_rollup(mart_education_impact):
    return (mart_education_impact.groupBy("highest_education")
            .agg(round_dec(F.avg("pass_rate_pct"), 2).alias("avg_pass_rate_pct")))


def engagement_scatter(mart_vle_engagement):
    return (mart_vle_engagement.filter(col("avg_total_clicks").isNotNull())
            .select("risk_group", "avg_total_clicks", "avg_score"))


# --- pipeline-health cards over the check log ------------------------------
FAILED = ("FAIL", "ERROR")


def log_totals(log: DataFrame) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("total_checks"))


def log_recent_failures(log: DataFrame, as_of: Column | str | None = None, days: int = 7) -> DataFrame:
    """Failures within ``days`` before ``as_of`` (default: now, by the wall clock in UTC).

    A fixed time, or a column such as the newest entry's time, makes the card reproducible. Folders of
    earlier quarters are left out where the log has its folder columns.
    """
    if as_of is None:
        as_of = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    elif isinstance(as_of, str):
        as_of = F.lit(as_of).cast("timestamp_ntz")
    since = as_of - F.make_dt_interval(F.lit(days))
    late = recent(log, since) if {"year", "quarter"} <= set(log.columns) else log.where(col("checked_at") > since)
    return (late.where(col("status").isin(*FAILED))
            .agg(F.count(F.lit(1)).alias("recent_failures")))


def log_status_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def log_latest20(log: DataFrame) -> DataFrame:
    return (log.orderBy(col("checked_at").desc(), col("id").desc()).limit(20)
            .select("check_name", "status", "detail", "checked_at"))


def log_hourly_status(log: DataFrame) -> DataFrame:
    return (log.groupBy(F.date_format("checked_at", "yyyy-MM-dd HH:00").alias("hour_bucket"), "status")
            .agg(F.count(F.lit(1)).alias("n")))


def log_failure_leaderboard(log: DataFrame) -> DataFrame:
    st = col("status")
    return (log.groupBy("check_name")
            .agg(F.count_if(st == "PASS").alias("pass_count"),
                 F.count_if(st.isin(*FAILED)).alias("fail_count"),
                 F.count_if(st == "WARN").alias("warn_count"),
                 F.count(F.lit(1)).alias("total_runs")))
