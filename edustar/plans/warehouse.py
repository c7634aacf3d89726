"""Layered build: bronze → silver → star → staging + marts.

Each layer is written once as Parquet under the session's shared checkpoint
folder and read back by the next one, as the medallion layout prescribes
(silver Parquet, warehouse tables, mart tables). Writing a layer also cuts
the lineage, so a lost executor recomputes from the last written layer, not
from the raw tables. Query functions then run their own operator over the
layer below (e.g. a mart over the written staging table).
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from edustar.operators import marts as M
from edustar.operators import reports as R
from edustar.operators import silver as S
from edustar.operators import star
from edustar.operators.joins import HotKeys, detect_hot_keys, fits_broadcast
from edustar.operators.keys import Histogram
from edustar.plans.tables import Buckets, EnrolmentTables, bucket_count, save
from edustar.session import ensure_checkpoint_dir
from edustar.sources import fixtures
from edustar.sources.log import append_log, read_log
from edustar.sources.sinks import write_parquet_counted

_LOCK = threading.Lock()
_CACHE: dict[tuple, "Warehouse"] = {}

DIMS = ("dim_time", "dim_course", "dim_student", "dim_assessment")

# Independent tables of one layer are written by concurrent Spark jobs, so
# small tables do not leave most task slots idle while one job runs.
CONCURRENT_WRITES = 4

# Tables written sorted within each partition, for data skipping on common filters. Staging, when written, isn't:
# a task's 29 columns are far wider than the fact it read, and sorting them spilled several times the table.
SORTED_WITHIN = {"fact_performance": ["risk_group", "final_result"]}

# SQL names of the warehouse tables, as the report SQL refers to them.
SQL_NAMES = {
    "dim_time": "Dim_Time", "dim_course": "Dim_Course", "dim_student": "Dim_Student",
    "dim_assessment": "Dim_Assessment", "fact_performance": "Fact_Performance",
    "stg_fact_performance": "stg_fact_performance", "monitoring_log": "monitoring_log",
}


def _locked(fn):
    def run(self, *a, **k):
        with self._lock:
            return fn(self, *a, **k)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


class Warehouse:
    """Lazily materialised layers for one input folder and one session."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None,
                 bronze: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse-{uuid.uuid4().hex}"
        self._bronze = bronze
        self._tables: dict[str, DataFrame] = {}
        self.sizes: dict[str, int] = {}
        self._hot: dict[str, HotKeys] = {}
        self._enrolment_tables: EnrolmentTables | None = None
        self._per_student: Histogram | None = None
        # One builder per layer at a time: callers on other threads wait for it.
        self._lock = threading.RLock()

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        # The application id changes when a stopped session is replaced (a
        # Python id alone may be reused by the new session's object).
        key = (spark.sparkContext.applicationId, id(spark._jsparkSession), sf_dir)
        with _LOCK:
            if key not in _CACHE:
                _CACHE[key] = cls(spark, sf_dir)
            return _CACHE[key]

    # -- plumbing ----------------------------------------------------------
    def _put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        if name in SORTED_WITHIN:
            # Local sort per task (no shuffle): Parquet min/max statistics then let
            # filters such as risk_group = 'High' skip row groups, the columnar
            # counterpart of the single-column indexes on the warehouse fact.
            df = df.sortWithinPartitions(*SORTED_WITHIN[name])
        self.sizes[name] = write_parquet_counted(df, path)
        self._tables[name] = self.spark.read.parquet(path)
        return self._tables[name]

    def _put_many(self, frames: dict) -> None:
        """Write several tables of one layer concurrently (values: DataFrame or thunk)."""
        def one(item):
            name, df = item
            self._put(name, df() if callable(df) else df)
        with ThreadPoolExecutor(max_workers=CONCURRENT_WRITES) as pool:
            list(pool.map(one, frames.items()))

    @_locked
    def bronze(self) -> dict[str, DataFrame]:
        """Raw tables, written once (the landing layer) and read back."""
        if self._bronze is None:
            t = fixtures.read_tables(self.spark, self.sf_dir, ["lineitem", "orders"])
            grain = self._put("bronze_line_grain", fixtures.line_grain(fixtures.base_lines(t)))
            enrolled = self._put("bronze_enrolment_grain", fixtures.enrolment_grain(grain))
            lazy = fixtures.bronze(self.spark, self.sf_dir, grain=grain, enrolled=enrolled)
            log = lazy.pop("monitoring_log")
            columns_of = {"student_registration": lazy.pop("student_registration")}  # nothing but columns of a written table
            self._put_many({f"bronze_{n}": df for n, df in lazy.items()})
            self._bronze = {**{n: self._tables[f"bronze_{n}"] for n in lazy}, **columns_of}
            append_log(log, f"{self.root}/monitoring_log", run="bronze")  # a layer: a rerun replaces it
            self._bronze["monitoring_log"] = read_log(self.spark, f"{self.root}/monitoring_log")
        return self._bronze

    # -- layers ------------------------------------------------------------
    @_locked
    def silver(self) -> dict[str, DataFrame]:
        names = list(S.CLEANERS) + ["vle_clicks"]
        if not all(f"silver_{n}" in self._tables for n in names):
            self._put_many({f"silver_{n}": df for n, df in S.build(self.bronze()).items()})
        return {n: self._tables[f"silver_{n}"] for n in names}

    @_locked
    def dims(self) -> dict[str, DataFrame]:
        if not all(d in self._tables for d in DIMS):
            s = self.silver()
            z = self.sizes
            # Thunks: each dense key checkpoints while it is built, inside its own job.
            self._put_many({
                "dim_time": lambda: star.dim_time(self.spark),
                "dim_course": lambda: star.dim_course(s["courses"], z.get("silver_courses")),
                "dim_student": lambda: star.dim_student(s["student_info"], z.get("silver_student_info")),
                "dim_assessment": lambda: star.dim_assessment(s["assessments"], z.get("silver_assessments")),
            })
        return {d: self._tables[d] for d in DIMS}

    @_locked
    def enrolment_hot_keys(self) -> HotKeys:
        """Hot enrolments of the submissions: statistics of the written silver
        layer, detected once and shared by every join on the enrolment key."""
        if "enrolment" not in self._hot:
            s, z = self.silver(), self.sizes
            self._hot["enrolment"] = detect_hot_keys(None, star.ENROLMENT, z.get("silver_student_assessment"),
                                                     sampler=star.submission_sampler(s))
        return self._hot["enrolment"]

    @_locked
    def enrolments(self) -> DataFrame:
        """Collapsed enrolments, written once: the join reads them and their largest copy count."""
        if "enrolments" not in self._tables:
            self._put("enrolments", star.enrolments(self.silver()))
        return self._tables["enrolments"]

    @_locked
    def fact_base(self) -> DataFrame:
        """Submissions ⋈ assessments ⟕ enrolments ⟕ clicks with the dimensions' keys, written once: the
        fact build reads it three times (average per assessment, join back, rows per student)."""
        if "fact_base" not in self._tables:
            s, z = self.silver(), self.sizes
            fb = star.fact_base(s, z.get("silver_assessments"), z.get("silver_student_assessment"),
                                hot=self.enrolment_hot_keys(), enrolled=self.enrolments())
            hot_on = lambda *keys: lambda: detect_hot_keys(
                None, list(keys), z.get("silver_student_assessment"), sampler=star.submission_sampler(s))
            self._put("fact_base", star.with_keys(fb, self.dims(), z, hot_on))
        return self._tables["fact_base"]

    @_locked
    def fact_rows_per_student(self) -> Histogram:
        """Statistics of the written fact base, counted once."""
        if self._per_student is None:
            self._per_student = star.fact_rows_per_student(self.fact_base())
        return self._per_student

    @_locked
    def fact(self) -> DataFrame:
        if "fact_performance" not in self._tables:
            dims = self.dims()
            self._put("fact_performance",
                      star.fact_performance(self.silver(), dims, self.sizes, fb=self.fact_base(), per_student=self.fact_rows_per_student()))
        return self._tables["fact_performance"]

    @_locked
    def staging(self) -> DataFrame:
        """Fact ⋈ the four dimensions. Written only when a dimension is above the
        broadcast bound, i.e. when the join would shuffle the fact: with all four
        broadcast it is a map-side join, and each reader (a mart, a check)
        redoes it over just the fact columns it needs, far cheaper than
        writing a copy of the fact three times as wide."""
        if "stg_fact_performance" not in self._tables:
            f, dims, z = self.fact(), self.dims(), self.sizes
            stg = star.staging(f, dims, z)
            if all(fits_broadcast(dims[d], known_rows=z.get(d)) for d in DIMS):
                self._tables["stg_fact_performance"] = stg
            else:
                self._put("stg_fact_performance", stg)
        return self._tables["stg_fact_performance"]

    @_locked
    def mart(self, name: str) -> DataFrame:
        """A mart, written once; over staging if that is there already, else over a join of just the rows and columns it needs."""
        if name not in self._tables:
            stg = self._tables.get("stg_fact_performance")
            if stg is None:
                stg = star.staging(self.fact(), self.dims(), self.sizes)
            self._put(name, M.ordered(name, M.MARTS[name](stg)))
        return self._tables[name]

    @_locked
    def cube(self) -> DataFrame:
        """The report cards' groupings of the fact, rolled up in one pass and written once (a few hundred rows)."""
        if "report_cube" not in self._tables:
            d = self.dims()
            self._put("report_cube", R.report_cube(self.fact(), d["dim_student"], d["dim_course"], self.sizes).coalesce(1))
        return self._tables["report_cube"]

    @_locked
    def enrolment_tables(self) -> "EnrolmentTables":
        """Submissions, enrolments and clicks as catalog tables bucketed by enrolment, for joins without a shuffle."""
        if self._enrolment_tables is None:
            s, z = self.silver(), self.sizes
            subs = star.submissions_with_course(s["student_assessment"], s["assessments"], z.get("silver_assessments"), z.get("silver_student_assessment"))
            clicks = s["vle_clicks"].select(*star.ENROLMENT, "total_clicks")
            n = bucket_count(self.spark, z.get("silver_student_assessment", 0))
            self._enrolment_tables = EnrolmentTables.save(self.spark, f"{self.root}/tables", f"edustar_{uuid.uuid4().hex[:12]}",
                                                          subs, self.enrolments(), clicks, star.ENROLMENT, self.enrolment_hot_keys(), n)
        return self._enrolment_tables

    def save_tables(self, database: str, location: str | None = None) -> list[str]:
        """All warehouse tables and marts as named catalog tables (see ``tables.save``); they outlive the session."""
        frames = {**self.dims(), "fact_performance": self.fact(), "stg_fact_performance": self.staging(), **{m: self.mart(m) for m in M.MARTS}}
        if "monitoring_log" in self.bronze():
            frames["monitoring_log"] = self.log()
        return save(self.spark, database, location or f"{self.root}/{database}", frames,
                    {"fact_performance": Buckets(["student_key"], bucket_count(self.spark, self.sizes.get("fact_performance", 0))),
                     "dim_student": Buckets(["student_key"], bucket_count(self.spark, self.sizes.get("fact_performance", 0)))})

    def log(self) -> DataFrame:
        """The check log, written by the append sink in year/quarter folders."""
        return self.bronze()["monitoring_log"]

    def table(self, name: str) -> DataFrame:
        """Any materialised table by name."""
        if name.startswith("silver_"):
            return self.silver()[name[len("silver_"):]]
        if name in DIMS:
            return self.dims()[name]
        if name == "fact_performance":
            return self.fact()
        if name == "fact_base":
            return self.fact_base()
        if name == "stg_fact_performance":
            return self.staging()
        if name in M.MARTS:
            return self.mart(name)
        if name == "monitoring_log":
            return self.log()
        raise KeyError(name)

    @_locked
    def register_views(self) -> list[str]:
        """Expose every built table as a temporary SQL view (views over the
        written Parquet, so ``spark.sql`` report queries read the same layer)."""
        names = []
        tables = dict(self.dims())
        tables["fact_performance"] = self.fact()
        tables["stg_fact_performance"] = self.staging()
        tables.update({m: self.mart(m) for m in M.MARTS})
        if "monitoring_log" in self.bronze():
            tables["monitoring_log"] = self.log()
        for n, df in tables.items():
            view = SQL_NAMES.get(n, n)
            df.createOrReplaceTempView(view)
            names.append(view)
        return names

    @_locked
    def build_all(self) -> dict[str, int]:
        stg = self.staging()
        self._put_many({n: M.ordered(n, fn(stg)) for n, fn in M.MARTS.items() if n not in self._tables})
        if "monitoring_log" in self.bronze():
            self.log()
        return dict(self.sizes)
