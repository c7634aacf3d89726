"""Star schema: four dimensions and the submission-grain fact.

Fact build order (the order carries meaning):
  submissions ⋈ assessments (inner, id_assessment)
  ⟕ enrolments (3 keys)  ⟕ click totals (3 keys)
  score_vs_avg = score − avg(score) per assessment, computed HERE, before the
                 dimension joins drop students without a Dim_Student row
  risk_group banding
  ⋈ Dim_Time / Dim_Course / Dim_Assessment / Dim_Student (inner) → keys.

The per-assessment average is an aggregate (map-side partial, so a hot
assessment is reduced before the shuffle) joined back by broadcast when the
assessment count is within the size bound, instead of a window that would
buffer a whole assessment in one task.

Hot keys: the two enrolment left joins are shuffle joins on (student,
module, presentation); enrolments holding more than one partition's share
of submissions are salted (``joins.HotKeys``), found from a sample of the
submissions. Dimension lookups broadcast within the size bound and fall
back to the same salted shuffle join above it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar.functions.expr import risk_band
from edustar.operators.joins import (HOT_SEED, HotKeys, collapse_copies, detect_hot_keys, expand_copies,
                                     fits_broadcast, lookup_join, most_copies)
from edustar.operators.keys import Histogram, dense_key, first_per_key, histogram_key, partitions_for

ENROLMENT = ["id_student", "code_module", "code_presentation"]

# The seeded time dimension (key, presentation, year, semester, label).
DIM_TIME_ROWS = [
    (1, "2013J", 2013, "J", "Kỳ 1 - 2013"),
    (2, "2013B", 2013, "B", "Kỳ 2 - 2013"),
    (3, "2014J", 2014, "J", "Kỳ 1 - 2014"),
    (4, "2014B", 2014, "B", "Kỳ 2 - 2014"),
]
DIM_TIME_SCHEMA = "time_key long, code_presentation string, year int, semester_type string, presentation_label string"


def dim_time(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """Seeded time dimension; like INSERT IGNORE, rows whose presentation
    already exists in ``existing`` are kept as they are and only new ones added."""
    seed = spark.createDataFrame(DIM_TIME_ROWS, DIM_TIME_SCHEMA)
    if existing is None:
        return seed
    new = seed.join(existing.select("code_presentation"), "code_presentation", "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def dim_course(silver_courses: DataFrame, rows_hint: int | None = None) -> DataFrame:
    d = first_per_key(silver_courses.select("code_module", "code_presentation",
                                            "module_presentation_length"),
                      ["code_module", "code_presentation"], ["module_presentation_length"])
    return dense_key(d, ["code_module", "code_presentation"], "course_key", partitions_for(rows_hint))


STUDENT_ATTRS = ["id_student", "gender", "region", "highest_education", "imd_band", "age_band",
                 "disability", "num_of_prev_attempts", "studied_credits"]


def dim_student(silver_student_info: DataFrame, rows_hint: int | None = None) -> DataFrame:
    """One row per student: the attributes of the first enrolment by
    (code_presentation, code_module); attempts and credits are per enrolment."""
    d = first_per_key(silver_student_info.select(*STUDENT_ATTRS, "code_presentation", "code_module"),
                      ["id_student"], ["code_presentation", "code_module"])
    return dense_key(d.select(*STUDENT_ATTRS), ["id_student"], "student_key", partitions_for(rows_hint))


def dim_assessment(silver_assessments: DataFrame, rows_hint: int | None = None) -> DataFrame:
    d = silver_assessments.select("id_assessment", "code_module", "assessment_type",
                                  F.col("weight").cast("double").alias("weight"),
                                  F.col("date").alias("day_due"))
    d = first_per_key(d, ["id_assessment"], ["code_module", "assessment_type", "weight", "day_due"])
    return dense_key(d, ["id_assessment"], "assessment_key", partitions_for(rows_hint))


def submissions_with_course(sa: DataFrame, assessments: DataFrame, n_assessments: int | None = None,
                            n_submissions: int | None = None) -> DataFrame:
    """Submissions ⋈ assessment metadata (module, presentation)."""
    meta = assessments.select("id_assessment", "code_module", "code_presentation")
    subs = sa.select("id_student", "id_assessment", F.col("score").cast("double").alias("score"))
    return lookup_join(subs, meta, ["id_assessment"], small_rows=n_assessments,
                       hot=lambda: detect_hot_keys(sa, ["id_assessment"], n_submissions))


def submission_sampler(silver: dict[str, DataFrame]) -> Callable[[float], DataFrame]:
    """Submission keys with their course from a sample of the submissions,
    taken before the join to the assessments: hot-key detection then joins
    about 200k sampled rows, not every submission."""
    meta = silver["assessments"].select("id_assessment", "code_module", "code_presentation")

    def sample(frac: float) -> DataFrame:
        s = silver["student_assessment"].select("id_student", "id_assessment")
        if frac < 1.0:
            s = s.sample(False, frac, seed=HOT_SEED)
        return s.join(meta, "id_assessment")
    return sample


def enrolments(silver: dict[str, DataFrame]) -> DataFrame:
    """Enrolments with their result, identical ones collapsed to one row and a copy count."""
    return collapse_copies(silver["student_info"].select(*ENROLMENT, "final_result"))


def fact_base(silver: dict[str, DataFrame], n_assessments: int | None = None,
              n_submissions: int | None = None, hot: HotKeys | None = None,
              enrolled: DataFrame | None = None) -> DataFrame:
    """Submissions with enrolment result and click total (left joins, may be null).

    ``hot``: hot enrolments of the submissions if already known (e.g. kept by
    the warehouse as statistics of its silver layer); detected here otherwise.
    ``enrolled``: ``enrolments`` already written.
    """
    sa_meta = submissions_with_course(silver["student_assessment"], silver["assessments"], n_assessments,
                                      n_submissions)
    # Enrolment rows are not deduplicated (a repeated enrolment fans out, as in
    # the source); identical copies are collapsed before the shuffle and
    # expanded after the join.
    base = enrolments(silver) if enrolled is None else enrolled
    clicks = silver["vle_clicks"].select(*ENROLMENT, "total_clicks")
    # Both left joins use the same three keys (plus the salt of hot enrolments):
    # one exchange of the big side serves both.
    hot = hot or detect_hot_keys(sa_meta, ENROLMENT, n_submissions, sampler=submission_sampler(silver))
    j = hot.join(hot.join(hot.salt(sa_meta), base, "left"), clicks, "left")
    return expand_copies(HotKeys.unsalt(j), most_copies(base))


def with_score_vs_avg(fb: DataFrame, n_assessments: int | None = None,
                      hot: Callable[[], HotKeys] | None = None, rows: DataFrame | None = None,
                      key: str = "id_assessment") -> DataFrame:
    """``hot`` finds hot assessments on a cheap source (used only if the
    per-assessment averages are too many to broadcast). ``rows``: the rows to score, by default those of
    ``fb``, over all of which the averages are taken. ``key``: the assessment's id or its surrogate key."""
    means = fb.groupBy(key).agg(F.avg("score").alias("_avg_score"))
    return (lookup_join(fb if rows is None else rows, means, [key], small_rows=n_assessments, hot=hot)
            .withColumn("score_vs_avg", F.col("score") - F.col("_avg_score"))
            .drop("_avg_score"))


FACT_COLUMNS = ["fact_id", "student_key", "course_key", "assessment_key", "time_key", "score",
                "total_clicks", "final_result", "score_vs_avg", "risk_group"]


LOOKUPS = [("dim_time", ["code_presentation"], "time_key"),
           ("dim_course", ["code_module", "code_presentation"], "course_key"),
           ("dim_assessment", ["id_assessment"], "assessment_key"),
           ("dim_student", ["id_student"], "student_key")]


def with_keys(fb: DataFrame, dims: dict[str, DataFrame], sizes: dict[str, int], hot_on: Callable) -> DataFrame:
    """``fact_base`` with its four surrogate keys, null where a dimension has no row."""
    for dim, keys, out in LOOKUPS:
        fb = lookup_join(fb, dims[dim].select(*keys, out), keys, "left", small_rows=sizes.get(dim), hot=hot_on(*keys))
    return fb


def _all_keys() -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for _, _, k in LOOKUPS])


def fact_rows_per_student(fb: DataFrame) -> Histogram:
    """Rows of the fact per student_key, from the fact base with its keys."""
    return Histogram.of(fb.where(_all_keys()), "student_key")


FACT_ORDER = ["student_key", "assessment_key", "score", "total_clicks", "final_result"]


def fact_performance(silver: dict[str, DataFrame], dims: dict[str, DataFrame],
                     sizes: dict[str, int] | None = None, fb: DataFrame | None = None, per_student: Histogram | None = None) -> DataFrame:
    """The fact. ``fb`` is ``fact_base`` already written, best with its keys (the warehouse writes
    it once): the per-assessment average, the join back and the numbering's counts then all
    read it, instead of running the enrolment joins, the largest shuffle of the build,
    and the dimension lookups once for each branch. ``per_student``: ``fact_rows_per_student`` of it."""
    sizes = sizes or {}
    n_asm = sizes.get("dim_assessment")
    n_sub = sizes.get("silver_student_assessment")
    if fb is None:
        fb = fact_base(silver, n_asm, n_sub)

        def hot_on(*keys):
            # Key distribution of the submissions, from a sample joined to the
            # assessments; only used if a dimension is too large to broadcast.
            return lambda: detect_hot_keys(None, list(keys), n_sub, sampler=submission_sampler(silver))
    else:
        def hot_on(*keys):
            return lambda: detect_hot_keys(fb, list(keys), sizes.get("fact_base"))

    if "student_key" not in fb.columns:
        fb = with_keys(fb, dims, sizes, hot_on)
    # The average comes before the rows without a dimension row go. Its join to the rows waits until they are numbered
    # where it is a broadcast, so that neither it nor the band crosses the network.
    late = n_asm is not None and fits_broadcast(fb.select("assessment_key", "score"), known_rows=n_asm)
    rows = fb if late else with_score_vs_avg(fb, n_asm, hot_on("id_assessment"))
    # fact_id: a dense key over the grain. A repeated enrolment or submission fans out to rows
    # that agree in both keys, so the measures decide among them. The counting pass reads the keys only.
    numbered = histogram_key(rows.where(_all_keys()).select(*[c for c in FACT_COLUMNS if c in rows.columns]), *FACT_ORDER[:2], FACT_ORDER[2:],
                             "fact_id", keys=fb.where(_all_keys()), known=per_student)
    if late:
        numbered = with_score_vs_avg(fb, n_asm, rows=numbered, key="assessment_key")
    return numbered.withColumn("risk_group", risk_band()).select(*FACT_COLUMNS)


def staging(fact: DataFrame, dims: dict[str, DataFrame], sizes: dict[str, int] | None = None) -> DataFrame:
    """Fact joined to all four dimensions on surrogate keys (29 columns)."""
    sizes = sizes or {}

    def hot_on(key):
        return lambda: detect_hot_keys(fact, [key], sizes.get("fact_performance"))

    # The one dimension that grows comes first: if its join shuffles, only the fact's own columns are shuffled.
    j = fact
    for dim, key, drop in [("dim_student", "student_key", None), ("dim_course", "course_key", None),
                           ("dim_assessment", "assessment_key", "code_module"), ("dim_time", "time_key", "code_presentation")]:
        d = dims[dim].drop(drop) if drop else dims[dim]
        j = lookup_join(j, d, [key], small_rows=sizes.get(dim), hot=hot_on(key))
    return j.select(
        *FACT_COLUMNS,
        *STUDENT_ATTRS,
        "code_module", "code_presentation", "module_presentation_length",
        "id_assessment", "assessment_type", "weight", "day_due",
        "year", "semester_type", "presentation_label",
    )
