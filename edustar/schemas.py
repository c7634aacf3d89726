"""Declared schemas of the seven raw (bronze) tables and the log.

Every field is nullable; nothing is inferred. CSV columns bind by name
(``enforceSchema=false``), so a file whose header does not match fails
instead of loading shifted columns.
"""

from pyspark.sql.types import (
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The four valid course presentations and the result/risk domains.
VALID_PRESENTATIONS = ("2013J", "2013B", "2014J", "2014B")
FINAL_RESULTS = ("Pass", "Fail", "Withdrawn", "Distinction")
RISK_GROUPS = ("Low", "Medium", "High", "Unknown")
GENDERS = ("M", "F")
DISABILITY = ("Y", "N")
ASSESSMENT_TYPES = ("TMA", "CMA", "Exam")
CHECK_STATUSES = ("PASS", "WARN", "FAIL", "ERROR")


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, F = StringType(), IntegerType(), LongType(), FloatType()  # ids are long: they grow with the data

COURSES = _s(("code_module", S), ("code_presentation", S), ("module_presentation_length", I))
ASSESSMENTS = _s(("code_module", S), ("code_presentation", S), ("id_assessment", L),
                 ("assessment_type", S), ("date", I), ("weight", F))
VLE = _s(("id_site", L), ("code_module", S), ("code_presentation", S), ("activity_type", S),
         ("week_from", I), ("week_to", I))
STUDENT_INFO = _s(("code_module", S), ("code_presentation", S), ("id_student", L), ("gender", S),
                  ("region", S), ("highest_education", S), ("imd_band", S), ("age_band", S),
                  ("num_of_prev_attempts", I), ("studied_credits", I), ("disability", S),
                  ("final_result", S))
STUDENT_REGISTRATION = _s(("code_module", S), ("code_presentation", S), ("id_student", L),
                          ("date_registration", I), ("date_unregistration", I))
STUDENT_ASSESSMENT = _s(("id_assessment", L), ("id_student", L), ("date_submitted", I),
                        ("is_banked", I), ("score", F))
STUDENT_VLE = _s(("code_module", S), ("code_presentation", S), ("id_student", L), ("id_site", L),
                 ("date", I), ("sum_click", I))

MONITORING_LOG = StructType([
    StructField("id", LongType(), True),
    StructField("check_name", StringType(), False),
    StructField("status", StringType(), False),
    StructField("detail", StringType(), True),
    StructField("checked_at", TimestampNTZType(), False),
])

# Raw table name -> (source file name, schema). The file list doubles as the
# expected inventory for the ingest gate.
RAW_TABLES = {
    "courses": ("courses.csv", COURSES),
    "assessments": ("assessments.csv", ASSESSMENTS),
    "vle": ("vle.csv", VLE),
    "student_info": ("studentInfo.csv", STUDENT_INFO),
    "student_registration": ("studentRegistration.csv", STUDENT_REGISTRATION),
    "student_assessment": ("studentAssessment.csv", STUDENT_ASSESSMENT),
    "student_vle": ("studentVle.csv", STUDENT_VLE),
}


def conform(df, schema: StructType):
    """Select ``schema``'s columns in order, cast to the declared types."""
    from pyspark.sql import functions as F_

    return df.select([F_.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
