"""Data-quality checks.

Two families, both declared as data and compiled to lazy plans:

* health checks (row count, null rate, accepted values) -> (check_name, status, detail) rows for
  the check log: all checks of a table that can be resolved are one aggregate and one ``stack``; a check
  whose table or column is missing is an ERROR row of its own, the others still run. ``collect_health_checks``
  is the job's side: where running a table fails, its checks are run one by one, so one broken
  check is one ERROR;
* declared tests (not_null, unique, accepted_values) on the warehouse and mart tables -> failure counts per
  test, with the usual semantics: unique and accepted_values ignore nulls; failures of unique are duplicated
  values, of accepted_values the distinct unexpected values.

Building a query runs nothing. Only the check results (a row per check) reach the driver, and only in the job.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from edustar.operators.keysets import duplicated, missing
from edustar.schemas import (ASSESSMENT_TYPES, DISABILITY, FINAL_RESULTS, GENDERS, RISK_GROUPS,
                             VALID_PRESENTATIONS)

col = F.col

# Database names in the log, thresholds of the score null rate, and the 18 checks.
DWH, MART = "dwh", "mart"
SCORE_NULL_WARN_PCT = 25.0
SCORE_NULL_FAIL_PCT = 60.0
MAX_OFFENDING = 20
ERROR_DETAIL_CHARS = 500

# (database, table, column, kind, settings)
SUITE = [
    ("dwh", "Dim_Time", None, "row_count", {"exact": 4}),
    ("dwh", "Dim_Student", None, "row_count", {}),
    ("dwh", "Dim_Course", None, "row_count", {}),
    ("dwh", "Dim_Assessment", None, "row_count", {}),
    ("dwh", "Fact_Performance", None, "row_count", {}),
    ("dwh", "Fact_Performance", "student_key", "null_rate", {}),
    ("dwh", "Fact_Performance", "course_key", "null_rate", {}),
    ("dwh", "Fact_Performance", "assessment_key", "null_rate", {}),
    ("dwh", "Fact_Performance", "time_key", "null_rate", {}),
    ("dwh", "Fact_Performance", "score", "null_rate", {"warn_pct": SCORE_NULL_WARN_PCT, "fail_pct": SCORE_NULL_FAIL_PCT}),
    ("dwh", "Fact_Performance", "final_result", "accepted_values", {"accepted": FINAL_RESULTS}),
    ("dwh", "Fact_Performance", "risk_group", "accepted_values", {"accepted": RISK_GROUPS}),
    ("mart", "stg_fact_performance", None, "row_count", {}),
    ("mart", "mart_result_by_module", None, "row_count", {}),
    ("mart", "mart_score_by_gender", None, "row_count", {}),
    ("mart", "mart_education_impact", None, "row_count", {}),
    ("mart", "mart_vle_engagement", None, "row_count", {}),
    ("mart", "mart_at_risk_students", None, "row_count", {}),
]

RESULT_SCHEMA = StructType([StructField("check_name", StringType(), False),
                            StructField("status", StringType(), False),
                            StructField("detail", StringType(), True)])


@dataclass(frozen=True)
class Check:
    kind: str                 # row_count | null_rate | accepted_values
    database: str
    table: str
    column: str | None = None
    min_rows: int = 1
    exact: int | None = None
    warn_pct: float = 0.0
    fail_pct: float = 0.0
    accepted: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return ".".join(filter(None, (self.database, self.table, self.column, self.kind)))

    def verdict(self) -> tuple[Column, Column]:
        """Status and detail over the columns of the table's rows (an aggregate)."""
        rows = F.count(F.lit(1))
        if self.kind == "row_count":
            goal, word, want = ((rows == self.exact, "expected", self.exact) if self.exact is not None
                                else (rows >= self.min_rows, "min", self.min_rows))
            return F.when(goal, "PASS").otherwise("FAIL"), F.format_string(f"rows=%d {word}={want}", rows)
        nulls = F.count_if(col(self.column).isNull())
        pct = nulls * F.lit(100.0) / rows
        status = (F.when(rows == 0, "WARN").when(pct > self.fail_pct, "FAIL").when(pct > self.warn_pct, "WARN")
                  .otherwise("PASS"))
        return status, F.when(rows == 0, "table empty").otherwise(F.format_string("null=%d/%d (%.2f%%)", nulls, rows, pct))


def health_suite(dwh: str = DWH, mart: str = MART) -> list[Check]:
    """The 18 runtime checks, under the given database names."""
    return [Check(kind, {"dwh": dwh, "mart": mart}[db], table, column, **settings)
            for db, table, column, kind, settings in SUITE]


def _aggregated(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Row counts and null rates of one table from one aggregate."""
    parts = [v for c in checks for v in c.verdict()]
    row = df.agg(*[v.alias(f"v{i}") for i, v in enumerate(parts)])
    items = ", ".join(f"'{c.name}', v{2 * i}, v{2 * i + 1}" for i, c in enumerate(checks))
    return row.selectExpr(f"stack({len(checks)}, {items}) AS (check_name, status, detail)")


def _accepted(df: DataFrame, c: Check) -> DataFrame:
    """Accepted values: the 20 smallest distinct offending values (a top-k, bounded per task) in one row."""
    v = col(c.column).cast("string")
    bad = (df.select(v.alias("v")).where(col("v").isNotNull() & ~col("v").isin(*c.accepted)).distinct()
           .orderBy("v").limit(MAX_OFFENDING).agg(F.array_sort(F.collect_list("v")).alias("bad")))
    listed = F.concat(F.lit("unexpected=["), F.array_join(F.transform("bad", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    none = F.size("bad") == 0
    return bad.select(F.lit(c.name).alias("check_name"), F.when(none, "PASS").otherwise("FAIL").alias("status"),
                      F.when(none, f"all values in {sorted(c.accepted)}").otherwise(listed).alias("detail"))


def _errors(spark: SparkSession, rows: list[tuple[Check, str]]) -> DataFrame:
    return spark.createDataFrame([(c.name, "ERROR", msg[:ERROR_DETAIL_CHARS]) for c, msg in rows], RESULT_SCHEMA)


def run_health_checks(spark: SparkSession, tables: dict[str, DataFrame],
                      checks: list[Check] | None = None) -> DataFrame:
    """The results of ``checks`` (default: the suite) over ``tables`` keyed by lower-case name, as one lazy DataFrame."""
    parts, broken = [], []
    by_table: dict[str, list[Check]] = {}
    for c in health_suite() if checks is None else checks:
        df = tables.get(c.table.lower())
        if df is None:
            broken.append((c, f"table not found: {c.table}"))
        elif c.column is not None and c.column not in df.columns:
            broken.append((c, f"column not found: {c.table}.{c.column}; there are {', '.join(df.columns)}"))
        elif c.kind == "accepted_values":
            parts.append(_accepted(df, c))
        else:
            by_table.setdefault(c.table.lower(), []).append(c)
    parts = [_aggregated(tables[t], cs) for t, cs in by_table.items()] + parts
    if broken:
        parts.append(_errors(spark, broken))
    return reduce(DataFrame.unionByName, parts)


def collect_health_checks(spark: SparkSession, tables: dict[str, DataFrame],
                          checks: list[Check] | None = None) -> list[tuple[str, str, str]]:
    """Run the checks, in their order. Where a table's checks fail to run, each is run alone and what
    fails is its own ERROR."""
    checks = health_suite() if checks is None else checks

    def rows(some: list[Check]) -> list[tuple]:
        try:
            return [tuple(r) for r in run_health_checks(spark, tables, some).collect()]
        except Exception as e:  # noqa: BLE001 - whatever a check runs into is its result
            if len(some) == 1:
                return [(some[0].name, "ERROR", str(e)[:ERROR_DETAIL_CHARS])]
            return [r for c in some for r in rows([c])]

    found = {}
    for t in dict.fromkeys(c.table for c in checks):
        found.update({r[0]: r for r in rows([c for c in checks if c.table == t])})
    return [found[c.name] for c in checks]


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def raise_on_failure(results: list[tuple[str, str, str]]) -> dict[str, int]:
    """Job exit rule over check results: FAIL or ERROR fails the run, WARN passes."""
    counts: dict[str, int] = {}
    for _, status, _ in results:
        counts[status] = counts.get(status, 0) + 1
    if counts.get("FAIL", 0) + counts.get("ERROR", 0):
        raise RuntimeError(f"checks failed: {counts}")
    return counts


# --- declared tests ----------------------------------------------------------
P, FR, RG, AT = VALID_PRESENTATIONS, FINAL_RESULTS, RISK_GROUPS, ASSESSMENT_TYPES

# Fixed values: (table, column, tests); an accepted_values test carries its domain.
DECLARED = [
    ("fact_performance", "fact_id", ["not_null", "unique"]),
    ("fact_performance", "student_key", ["not_null"]),
    ("fact_performance", "course_key", ["not_null"]),
    ("fact_performance", "assessment_key", ["not_null"]),
    ("fact_performance", "time_key", ["not_null"]),
    ("fact_performance", "final_result", [("accepted_values", FR)]),
    ("fact_performance", "risk_group", [("accepted_values", RG)]),
    ("dim_student", "student_key", ["not_null", "unique"]),
    ("dim_student", "id_student", ["not_null", "unique"]),
    ("dim_student", "gender", [("accepted_values", GENDERS)]),
    ("dim_student", "disability", [("accepted_values", DISABILITY)]),
    ("dim_course", "course_key", ["not_null", "unique"]),
    ("dim_course", "code_module", ["not_null"]),
    ("dim_course", "code_presentation", ["not_null", ("accepted_values", P)]),
    ("dim_assessment", "assessment_key", ["not_null", "unique"]),
    ("dim_assessment", "id_assessment", ["not_null", "unique"]),
    ("dim_assessment", "assessment_type", [("accepted_values", AT)]),
    ("dim_time", "time_key", ["not_null", "unique"]),
    ("dim_time", "code_presentation", ["not_null", ("accepted_values", P)]),
    ("stg_fact_performance", "fact_id", ["not_null", "unique"]),
    ("stg_fact_performance", "id_student", ["not_null"]),
    ("stg_fact_performance", "gender", [("accepted_values", GENDERS)]),
    ("stg_fact_performance", "code_module", ["not_null"]),
    ("stg_fact_performance", "code_presentation", ["not_null", ("accepted_values", P)]),
    ("stg_fact_performance", "assessment_type", [("accepted_values", AT)]),
    ("stg_fact_performance", "final_result", [("accepted_values", FR)]),
    ("stg_fact_performance", "risk_group", ["not_null", ("accepted_values", RG)]),
    ("mart_result_by_module", "code_module", ["not_null"]),
    ("mart_result_by_module", "code_presentation", ["not_null", ("accepted_values", P)]),
    ("mart_result_by_module", "final_result", ["not_null", ("accepted_values", FR)]),
    ("mart_result_by_module", "num_students", ["not_null"]),
    ("mart_result_by_module", "num_submissions", ["not_null"]),
    ("mart_result_by_module", "pct_submissions", ["not_null"]),
    ("mart_score_by_gender", "gender", ["not_null", ("accepted_values", GENDERS)]),
    ("mart_score_by_gender", "assessment_type", ["not_null", ("accepted_values", AT)]),
    ("mart_score_by_gender", "code_presentation", [("accepted_values", P)]),
    ("mart_score_by_gender", "avg_score", ["not_null"]),
    ("mart_score_by_gender", "num_students", ["not_null"]),
    ("mart_education_impact", "highest_education", ["not_null"]),
    ("mart_education_impact", "assessment_type", ["not_null", ("accepted_values", AT)]),
    ("mart_education_impact", "code_presentation", [("accepted_values", P)]),
    ("mart_education_impact", "pass_rate_pct", ["not_null"]),
    ("mart_education_impact", "distinction_rate_pct", ["not_null"]),
    ("mart_education_impact", "withdrawn_rate_pct", ["not_null"]),
    ("mart_vle_engagement", "risk_group", ["not_null", ("accepted_values", RG)]),
    ("mart_vle_engagement", "code_presentation", [("accepted_values", P)]),
    ("mart_vle_engagement", "avg_total_clicks", ["not_null"]),
    ("mart_vle_engagement", "avg_score", ["not_null"]),
    ("mart_at_risk_students", "id_student", ["not_null"]),
    ("mart_at_risk_students", "code_module", ["not_null"]),
    ("mart_at_risk_students", "code_presentation", ["not_null", ("accepted_values", P)]),
    ("mart_at_risk_students", "num_high_risk_submissions", ["not_null"]),
    ("mart_at_risk_students", "final_result", [("accepted_values", FR)]),
]


def declared(kind: str) -> list[tuple[str, str, tuple]]:
    """(table, column, domain) for every declared test of ``kind``."""
    out = []
    for table, column, tests in DECLARED:
        for t in tests:
            name, dom = (t, ()) if isinstance(t, str) else t
            if name == kind:
                out.append((table, column, tuple(dom)))
    return out


def _unpivot(agg_row: DataFrame, table: str, kind: str, cols: list[str]) -> DataFrame:
    """One row per test from a one-row aggregate with a column per test.

    A single ``stack`` expression (parsed once by Spark) rather than a struct
    of literals per test, so building the plan is one call per table.
    """
    items = ", ".join(f"'{kind}_{table}_{c}', '{table}', '{c}', CAST(`{c}` AS BIGINT)" for c in cols)
    return agg_row.selectExpr(f"stack({len(cols)}, {items}) AS (test_name, model, column_name, failures)")


def _with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(col("failures") == 0, "PASS").otherwise("FAIL"))


def _sql_in(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def declared_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """All not_null tests: one count_if aggregate per table."""
    parts = []
    by_table: dict[str, list[str]] = {}
    for t, c, _ in declared("not_null"):
        by_table.setdefault(t, []).append(c)
    for t, cols in by_table.items():
        agg = tables[t].agg(*[F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in cols])
        parts.append(_unpivot(agg, t, "not_null", cols))
    return _with_status(reduce(DataFrame.unionByName, parts))


def declared_accepted_values(tables: dict[str, DataFrame]) -> DataFrame:
    """All accepted_values tests. Failures = distinct unexpected non-null values.

    Rows with any unexpected value are filtered first (pushed to the scan),
    so the distinct counts run over the offending rows only.
    """
    parts = []
    by_table: dict[str, list[tuple]] = {}
    for t, c, dom in declared("accepted_values"):
        by_table.setdefault(t, []).append((c, dom))
    for t, tests in by_table.items():
        bads = {c: f"(`{c}` IS NOT NULL AND `{c}` NOT IN ({_sql_in(dom)}))" for c, dom in tests}
        off = tables[t].filter(" OR ".join(bads.values()))
        agg = off.agg(*[F.expr(f"count(DISTINCT CASE WHEN {bads[c]} THEN `{c}` END) AS `{c}`")
                        for c, _ in tests])
        parts.append(_unpivot(agg, t, "accepted_values", [c for c, _ in tests]))
    return _with_status(reduce(DataFrame.unionByName, parts))


def _numbered(found: DataFrame, n: int) -> DataFrame:
    """One row with the failures of part 0..n-1 as f0..; parts without a row have none."""
    return found.agg(*[F.coalesce(F.max(F.when(col("_i") == i, col("failures"))), F.lit(0)).cast("long").alias(f"f{i}") for i in range(n)])


def declared_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """All unique tests. Every tested column is a number: sets of keys against row counts (``keysets.duplicated``)."""
    tests = [(t, c) for t, c, _ in declared("unique")]
    parts = [tables[t].select(F.lit(i).alias("_i"), col(c).cast("long").alias("_k")) for i, (t, c) in enumerate(tests)]
    items = ", ".join(f"'unique_{t}_{c}', '{t}', '{c}', f{i}" for i, (t, c) in enumerate(tests))
    found = duplicated(reduce(DataFrame.unionByName, parts), "_i", "_k")
    return _with_status(_numbered(found, len(tests)).selectExpr(
        f"stack({len(tests)}, {items}) AS (test_name, model, column_name, failures)"))


# Business keys that must be unique (the warehouse's unique constraints and the fact grain).
UNIQUE_KEYS = [
    ("dim_time", ["code_presentation"]),
    ("dim_course", ["code_module", "code_presentation"]),
    ("dim_student", ["id_student"]),
    ("dim_assessment", ["id_assessment"]),
    ("fact_performance", ["student_key", "assessment_key"]),
]


def _pair_number(df: DataFrame, a: str, b: str) -> Column:
    """Two whole-number keys as one: neighbouring values of ``b`` stay neighbours."""
    ends = df.select(F.min(b).alias("low"), F.max(b).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    return col(a) * (high - low + 1) + col(b) - low


def unique_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicated business keys per table: number keys as sets, text keys (few rows) counted by value."""
    numbers, texts = [], []
    for i, (t, ks) in enumerate(UNIQUE_KEYS):
        kind = {c: k for c, k in tables[t].dtypes}
        df = tables[t].where(reduce(Column.__and__, [col(c).isNotNull() for c in ks]))
        if any(kind[c] == "string" for c in ks):
            texts.append(df.select(F.lit(i).alias("_i"), F.to_json(F.array(*[col(c).cast("string") for c in ks])).alias("_k")))
        else:
            key = col(ks[0]) if len(ks) == 1 else _pair_number(tables[t], *ks)
            numbers.append(df.select(F.lit(i).alias("_i"), key.cast("long").alias("_k")))
    found = duplicated(reduce(DataFrame.unionByName, numbers), "_i", "_k")
    by_value = reduce(DataFrame.unionByName, texts).groupBy("_i", "_k").agg(F.count(F.lit(1)).alias("_n"))
    found = found.unionByName(by_value.groupBy("_i").agg(F.count_if(col("_n") > 1).alias("failures")))
    items = ", ".join(f"'{t}', '{','.join(ks)}', f{i}" for i, (t, ks) in enumerate(UNIQUE_KEYS))
    return _numbered(found, len(UNIQUE_KEYS)).selectExpr(
        f"stack({len(UNIQUE_KEYS)}, {items}) AS (table_name, key_columns, duplicates)")


FOREIGN_KEYS = [("student_key", "dim_student"), ("course_key", "dim_course"),
                ("assessment_key", "dim_assessment"), ("time_key", "dim_time")]


def fk_orphans(fact: DataFrame, dims: dict[str, DataFrame], sizes: dict | None = None) -> DataFrame:
    """Fact rows whose surrogate key has no dimension row, per foreign key.

    One scan of the fact makes the sets of its keys (``keysets``), which must lie within the dimensions' sets;
    only keys of words with a gap are counted and looked up.
    """
    each = lambda df, keys: df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_i"), col(k).cast("long").alias("_k")) for i, k in keys])).alias("x")).select("x.*")
    keys = each(fact, [(i, k) for i, (k, _) in enumerate(FOREIGN_KEYS)])
    known = reduce(DataFrame.unionByName, [each(dims[d], [(i, k)]) for i, (k, d) in enumerate(FOREIGN_KEYS)])
    items = ", ".join(f"'fk_fact_{k}', '{d}', f{i}" for i, (k, d) in enumerate(FOREIGN_KEYS))
    return _numbered(missing(keys, known, "_i", "_k"), len(FOREIGN_KEYS)).selectExpr(
        f"stack({len(FOREIGN_KEYS)}, {items}) AS (constraint_name, ref_table, orphans)")
