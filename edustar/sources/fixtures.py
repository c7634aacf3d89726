"""Bronze layer derived from the shared test tables.

The learning-analytics source files are not available offline, so the
seven raw tables (and the monitoring log) are derived from the TPC-H-like
test tables by a fixed rule (FIXTURES.md §3). Everything is a lazy
DataFrame over the whole input tables. Students, enrolments, submissions and
click rows grow with them; assessments (840), courses (28) and VLE sites stay
as many at any scale, as the mapping folds parts and events onto them.

base relation ``li`` = lineitem ⋈ orders, with
  id_student = o_custkey, k = l_partkey % 210, m = k % 7 (= l_partkey % 7),
  p = (year % 2) * 2 + (month > 6), code_module = letter m three times,
  code_presentation = ('2013' if year odd else '2014') + ('B' if month <= 6 else 'J').
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar import schemas
from edustar.operators.joins import detect_hot_keys, fits_broadcast, sized_broadcast, skew_join

# Fixed values of the mapping: module letters and event-type -> check status.
MODULE_LETTERS = "ABCDEFG"
LOG_STATUS = {"purchase": "WARN", "signup": "FAIL", "error": "ERROR"}  # anything else: PASS
ROWS_PER_TASK = 1_000_000  # line items that a task joins and reduces


def _module(idx) -> F.Column:
    return F.repeat(F.substring(F.lit(MODULE_LETTERS), (idx + 1).cast("int"), F.lit(1)), 3)


def read_tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def presentation_of(p) -> F.Column:
    """p = (year % 2) * 2 + (month > 6): odd years are 2013, first halves are B."""
    return F.concat(F.when(p >= 2, "2013").otherwise("2014"), F.when(p % 2 == 0, "B").otherwise("J"))


def base_lines(t: dict[str, DataFrame]) -> DataFrame:
    """li: one row per line item with its order's customer and date attributes, item and measures."""
    # Measures and date attributes are worked out before the join, so a shuffle carries small whole numbers.
    score = F.when(F.col("l_tax") > 0.075, F.lit(None)).otherwise(
        2 * F.col("l_quantity") + F.when(F.col("l_discount") > 0.095, 3).otherwise(0))
    l = t["lineitem"].select("l_orderkey", (F.col("l_partkey") % 210).cast("int").alias("k"), "l_linenumber",
                             F.dayofmonth("l_shipdate").alias("day"), score.alias("score"), (F.col("l_tax") > 0.065).alias("is_late"))
    y, mo = F.year("o_orderdate"), F.month("o_orderdate")
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("long").alias("id_student"),
                           ((y % 2) * 2 + F.when(mo <= 6, 0).otherwise(1)).cast("int").alias("p"))
    # Orders are unique per key: broadcast while within the row bound, else a
    # shuffle join where an order holding a large share of the line items is
    # salted rather than joined in one task.
    if fits_broadcast(o):
        j = l.join(F.broadcast(o), ["l_orderkey"])
    else:
        n = t["lineitem"].count()
        j = skew_join(l, o, ["l_orderkey"], hot=detect_hot_keys(l, ["l_orderkey"], n), big_rows=n, rows_per_task=ROWS_PER_TASK)
    return j.select("id_student", "k", "p", "l_linenumber", "day", "score", "is_late")


def line_grain(li: DataFrame) -> DataFrame:
    """One row per (student, item k, half-year p): every line-derived raw table
    is a roll-up of this grain, so lineitem ⋈ orders is scanned and shuffled once.

    (student, k, p) is exactly (student, id_assessment); module and
    presentation are functions of (k, p); the registration measures are
    min/max, which combine across the finer grain.
    """
    ln = F.col("l_linenumber")
    g = (li.groupBy("id_student", "k", "p")
         .agg(F.max("day").alias("max_day"),
              F.max("score").alias("max_score"),
              F.min(-30 + 10 * ln).alias("min_reg"),
              F.max(F.when(F.col("is_late"), 20 * ln)).alias("max_unreg")))
    # Module and presentation are functions of (k, p): derived after the shuffle.
    m = (F.col("k") % 7).cast("int")
    return g.select("id_student", "k", "p", m.alias("m"), _module(m).alias("code_module"),
                    presentation_of(F.col("p")).alias("code_presentation"),
                    "max_day", "max_score", "min_reg", "max_unreg")


def enrolment_grain(grain: DataFrame) -> DataFrame:
    """One row per (student, module, presentation): both tables of enrolments come from it, so the line grain is
    shuffled for them once, as whole numbers, and a student's enrolments come to lie in one file.

    A student has few rows in the line grain (an item and half-year each), so dealing them by student makes no
    large task. ``variants``: a bit for each (m, p) that occurs, as a null p reads like p = 1 and a negative m like
    another one; a module has one m of either sign.
    """
    m, p = F.col("m"), F.col("p")
    letter = F.when(m == -1, 0).when(m < 0, m + len(MODULE_LETTERS) + 1).otherwise(m)  # as _module reads m
    half = F.when(p >= 2, 2).otherwise(0) + F.when(p % 2 == 0, 0).otherwise(1)  # as presentation_of reads p
    at = F.coalesce(p - P_VALUES[0], F.lit(len(P_VALUES) - 1)) + F.when(m < 0, len(P_VALUES)).otherwise(0)
    e = (grain.select("id_student", letter.alias("letter"), half.alias("half"), "min_reg", "max_unreg",
                      F.call_function("shiftleft", F.lit(1), at.cast("int")).alias("variant"))
         .repartition("id_student").groupBy("id_student", "letter", "half")
         .agg(F.min("min_reg").alias("min_reg"), F.max("max_unreg").alias("max_unreg"), F.bit_or("variant").alias("variants")))
    return e.select("id_student", "letter", _module(F.col("letter")).alias("code_module"), presentation_of(F.col("half")).alias("code_presentation"),
                    "min_reg", "max_unreg", "variants")


P_VALUES = (-2, -1, 0, 1, 2, 3, None)  # of p; the remainder of a year before 1 is negative


def enrolments_of(enrolled: DataFrame) -> DataFrame:
    """The different (student, m, p) of an ``enrolment_grain`` with their module and presentation."""
    v, n = F.col("variants"), len(P_VALUES)
    # nearly all rows have one bit: its place needs no array of all of them
    one = F.array(F.round(F.log2(v)).cast("int"))
    places = F.array_compact(F.array(*[F.when(v.bitwiseAND(F.lit(1 << i)) != 0, F.lit(i)) for i in range(2 * n)]))
    at, letter = F.col("_at"), F.col("letter")
    below = F.when(letter == 0, -1).otherwise(letter - len(MODULE_LETTERS) - 1)
    return (enrolled.withColumn("_at", F.explode(F.when(F.bit_count(v) == 1, one).otherwise(places)))
            .select("id_student", F.when(at >= n, below).otherwise(letter).cast("int").alias("m"),
                    F.when(at % n < n - 1, at % n + P_VALUES[0]).cast("int").alias("p"), "code_module", "code_presentation"))


def raw_student_assessment(grain: DataFrame) -> DataFrame:
    df = grain.select("id_student", (10000 + 4 * F.col("k") + F.col("p")).alias("id_assessment"),
                      F.col("max_day").alias("date_submitted"), F.col("max_score").alias("score"),
                      F.lit(0).alias("is_banked"))
    return schemas.conform(df, schemas.STUDENT_ASSESSMENT)


def raw_assessments(grain: DataFrame) -> DataFrame:
    k = F.col("k")
    df = (grain.select("code_module", "code_presentation", "k", "p").distinct()
          .select("code_module", "code_presentation",
                  (10000 + 4 * k + F.col("p")).alias("id_assessment"),
                  F.when(k % 3 == 0, "TMA").when(k % 3 == 1, "CMA").otherwise("Exam")
                   .alias("assessment_type"),
                  F.when((k % 3 == 2) & (k % 5 == 0), F.lit(None)).otherwise(20 + k % 200)
                   .alias("date"),
                  F.when(k == 17, F.lit(-1)).otherwise(k % 41).alias("weight")))
    return schemas.conform(df, schemas.ASSESSMENTS)


def raw_courses(grain: DataFrame) -> DataFrame:
    df = (grain.select("code_module", "code_presentation", "m", "p").distinct()
          .withColumn("module_presentation_length", 234 + (7 * F.col("m") + F.col("p")) % 36))
    return schemas.conform(df, schemas.COURSES)


def raw_student_info(enrolled: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    sid, m, p = F.col("id_student"), F.col("m"), F.col("p")
    enrol = enrolments_of(enrolled)
    c = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    j = (enrol.join(c, enrol.id_student == c.c_custkey)
         .join(sized_broadcast(n), F.col("c_nationkey") == n.n_nationkey))
    ck, bal = F.col("c_custkey"), F.col("c_acctbal")
    band = F.floor(bal / 1000).cast("long") * 10
    fr = (7 * ck + 3 * m + p) % 10
    df = j.select(
        # Some enrolments carry a presentation outside the valid four; silver's cleaning rule
        # removes them, and their submissions then exercise the left joins of the fact build.
        F.when((sid % 97 == 3) | (sid % 50 == 0) | ((sid + 3 * m + p) % 29 == 0), "2012J")
         .otherwise(F.col("code_presentation")).alias("code_presentation"),
        "code_module", "id_student",
        F.when(ck % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("n_name").alias("region"),
        F.col("c_mktsegment").alias("highest_education"),
        F.when(bal < 0, F.lit(None)).when(bal >= 9000, "90-100%")
         .otherwise(F.concat(band.cast("string"), F.lit("-"), (band + 10).cast("string"), F.lit("%")))
         .alias("imd_band"),
        F.when(ck % 10 < 7, "0-35").when(ck % 10 < 9, "35-55").otherwise("55<=").alias("age_band"),
        ((ck + p) % 4).alias("num_of_prev_attempts"),
        (30 + 30 * ((ck + m + p) % 7)).alias("studied_credits"),
        F.when(ck % 11 == 0, "Y").otherwise("N").alias("disability"),
        F.when(fr < 4, "Pass").when(fr < 5, "Distinction").when(fr < 8, "Fail")
         .otherwise("Withdrawn").alias("final_result"),
    )
    return schemas.conform(df, schemas.STUDENT_INFO)


def raw_student_registration(enrolled: DataFrame) -> DataFrame:
    df = enrolled.select("code_module", "code_presentation", "id_student", F.col("min_reg").alias("date_registration"),
                         F.col("max_unreg").alias("date_unregistration"))
    return schemas.conform(df, schemas.STUDENT_REGISTRATION)


def raw_student_vle(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    q = F.floor(eid / 7)
    et = F.col("event_type")
    df = events.select(
        _module(eid % 7).alias("code_module"),
        F.concat(F.when(q % 4 >= 2, "2013").otherwise("2014"),
                 F.when(q % 2 == 0, "B").otherwise("J")).alias("code_presentation"),
        (10 * F.col("user_id") + eid % 10).alias("id_student"),
        (eid % 100).alias("id_site"),
        F.dayofmonth("ts").alias("date"),
        F.when(et == "error", F.lit(None)).when(et == "signup", 0).otherwise(1 + eid % 9)
         .alias("sum_click"),
    )
    return schemas.conform(df, schemas.STUDENT_VLE)


def raw_vle(events: DataFrame) -> DataFrame:
    site = F.col("event_id") % 100
    df = (events.select(site.alias("id_site"), _module(site % 7).alias("code_module"),
                        F.lit(None).cast("string").alias("code_presentation"),
                        F.col("event_type").alias("activity_type"),
                        F.lit(None).cast("int").alias("week_from"),
                        F.lit(None).cast("int").alias("week_to"))
          .distinct())
    return schemas.conform(df, schemas.VLE)


def monitoring_log(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    status = F.lit("PASS")
    for k, v in reversed(LOG_STATUS.items()):
        status = F.when(et == k, v).otherwise(status)
    df = events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("check_"), (F.col("event_id") % 18).cast("string")).alias("check_name"),
        status.alias("status"),
        F.col("props").alias("detail"),
        # quarters spread over five years, so the log fills every one of its range partitions
        (F.col("ts") + F.make_ym_interval(F.lit(0), (3 * (F.col("event_id") % 20)).cast("int"))).alias("checked_at"),
    )
    return schemas.conform(df, schemas.MONITORING_LOG)


def bronze(spark: SparkSession, sf_dir: str, grain: DataFrame | None = None, enrolled: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven raw tables plus the monitoring log, as lazy DataFrames.

    ``grain`` is ``line_grain`` of the inputs and ``enrolled`` its ``enrolment_grain``, passed in when they have
    been written already (the warehouse writes them once and derives from the copies).
    """
    t = read_tables(spark, sf_dir, ["lineitem", "orders", "customer", "nation", "events"])
    if grain is None:
        grain = line_grain(base_lines(t))
    if enrolled is None:
        enrolled = enrolment_grain(grain)
    return {
        "courses": raw_courses(grain),
        "assessments": raw_assessments(grain),
        "vle": raw_vle(t["events"]),
        "student_info": raw_student_info(enrolled, t["customer"], t["nation"]),
        "student_registration": raw_student_registration(enrolled),
        "student_assessment": raw_student_assessment(grain),
        "student_vle": raw_student_vle(t["events"]),
        "monitoring_log": monitoring_log(t["events"]),
    }
