"""CSV binding and malformed rows, ingest gate, JDBC round trip, partitioned log."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edustar.schemas import COURSES, MONITORING_LOG, RAW_TABLES, STUDENT_ASSESSMENT
from edustar.sources import csv as C
from edustar.operators import reports as R
from edustar.sources import jdbc as J
from edustar.sources.inventory import EXPECTED_FILES, missing_sources, require_sources
from edustar.sources.log import LOG_PARTITIONS, append_log, newest, partition_label, read_log, recent, run_id
from edustar.sources.sinks import write_parquet_counted


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_binds_by_header_name(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "sa.csv"),
               "id_assessment,id_student,date_submitted,is_banked,score\n1,2,3,0,55.5\n")
    r = C.read_csv(spark, p, STUDENT_ASSESSMENT).first()
    assert (r.id_assessment, r.id_student, r.score) == (1, 2, 55.5)
    swapped = _write(os.path.join(tmp_dir, "sw.csv"),
                     "id_student,id_assessment,date_submitted,is_banked,score\n1,2,3,0,55.5\n")
    with pytest.raises(Exception):
        C.read_csv(spark, swapped, STUDENT_ASSESSMENT).collect()


def test_csv_malformed_and_short_rows(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "c.csv"),
               'code_module,code_presentation,module_presentation_length\n'
               'AAA,2013J,x\nBBB,2014B\nCCC,"",240\n"D,D",2013B,100\n')
    df = C.read_csv(spark, p, COURSES, keep_corrupt=True).cache()
    rows = {r.code_module: r for r in df.collect()}
    assert rows["AAA"].module_presentation_length is None
    assert rows["BBB"].module_presentation_length is None
    assert rows["CCC"].code_presentation is None  # "" is null
    assert rows["D,D"].module_presentation_length == 100
    c = C.count_corrupt(df).first()
    assert (c.rows, c.corrupt_rows) == (4, 2)


def test_ingest_gate_names_missing_file(spark, tmp_dir):
    for fname in EXPECTED_FILES[:-1]:
        _write(os.path.join(tmp_dir, fname), "a\n")
    missing = [r.file_name for r in missing_sources(spark, tmp_dir).collect()]
    assert missing == [EXPECTED_FILES[-1]]
    with pytest.raises(FileNotFoundError, match=EXPECTED_FILES[-1]):
        require_sources(spark, tmp_dir)
    _write(os.path.join(tmp_dir, EXPECTED_FILES[-1]), "a\n")
    require_sources(spark, tmp_dir)


def test_parquet_write_counts_in_same_pass(spark, tmp_dir):
    df = spark.range(1234).withColumn("x", F.col("id") % 7)
    assert write_parquet_counted(df, os.path.join(tmp_dir, "t")) == 1234
    assert spark.read.parquet(os.path.join(tmp_dir, "t")).count() == 1234


def test_jdbc_full_refresh_and_partitioned_read(spark, tmp_dir):
    url = f"jdbc:derby:memory:edustar{os.getpid()};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    dim = spark.range(1, 101).select(F.col("id").alias("course_key"),
                                     F.concat(F.lit("M"), F.col("id").cast("string")).alias("code_module"))
    J.full_refresh({"dim_course": dim}, url, props)
    J.full_refresh({"dim_course": dim.filter("course_key <= 40")}, url, props)  # rerun replaces rows
    back = J.read_table(spark, url, "dim_course", props, partition_column="course_key",
                        lower=1, upper=100, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 40
    J.append(dim.filter("course_key > 90"), url, "dim_course", props)
    assert J.read_table(spark, url, "dim_course", props).count() == 50
    # Bounds fetched from the table itself: 1..40 and 91..100, all rows read in 5 ranges.
    auto = J.read_table(spark, url, "dim_course", props, partition_column="course_key", num_partitions=5)
    assert auto.rdd.getNumPartitions() == 5
    assert sorted(r[0] for r in auto.select("course_key").collect()) == list(range(1, 41)) + list(range(91, 101))


def test_log_partitions_and_pruning(spark, tmp_dir):
    rows = [(1, "c", "PASS", None, datetime(2025, 6, 1)), (2, "c", "FAIL", None, datetime(2026, 5, 2)),
            (3, "c", "ERROR", None, datetime(2026, 11, 3)), (4, "c", "PASS", None, datetime(2030, 1, 1))]
    df = spark.createDataFrame(rows, "id long, check_name string, status string, detail string, "
                                     "checked_at timestamp_ntz")
    labels = [r[0] for r in df.select(partition_label("checked_at")).collect()]
    assert labels == ["p_2025", "p_2026_q2", "p_2026_q4", "p_max"]
    assert [b for _, b in LOG_PARTITIONS] == sorted(b for _, b in LOG_PARTITIONS)
    path = os.path.join(tmp_dir, "log")
    append_log(df, path, "first")
    log = read_log(spark, path)
    assert log.select(newest(log)).first()[0] == datetime(2030, 1, 1)
    r = recent(log, F.lit(datetime(2026, 6, 1)).cast("timestamp_ntz"))
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    assert sorted(x.id for x in r.collect()) == [3, 4]


def test_recent_reads_only_the_folders_it_needs(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    rows = [(100 * q + i, f"c{i}", "FAIL" if i % 2 else "PASS", None, datetime(2024 + q // 4, 3 * (q % 4) + 2, 1 + i)) for q in range(12) for i in range(20)]
    append_log(spark.createDataFrame(rows, MONITORING_LOG), path, "all")
    log = read_log(spark, path)
    df = R.log_recent_failures(log, as_of=newest(log))
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "Subquery" in plan.split("PartitionFilters")[1]
    assert df.first().recent_failures == sum(1 for r in rows if r[2] == "FAIL" and r[4] > datetime(2026, 11, 13))
    # files that a scan of the folders from the newest quarter on lists
    folders = {f.split("/log/")[1].split("/run=")[0] for f in recent(log, F.lit(datetime(2026, 11, 2)).cast("timestamp_ntz")).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert folders == {"year=2026/quarter=4"}


def test_full_refresh_empties_the_fact_first():
    steps = J.refresh_steps({"fact_performance", "dim_student", "dim_course", "dim_assessment"})
    assert steps == [("empty", "fact_performance"), ("empty", "dim_assessment"), ("empty", "dim_student"), ("empty", "dim_course"),
                     ("load", "dim_course"), ("load", "dim_student"), ("load", "dim_assessment"), ("load", "fact_performance")]
    assert J.refresh_steps(["dim_course"]) == [("empty", "dim_course"), ("load", "dim_course")]


def test_a_run_appends_its_rows_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    when = datetime(2026, 1, 1)
    rows = lambda run, n: spark.createDataFrame([(run_id(run, i), f"c{i}", "PASS", None, when) for i in range(n)], MONITORING_LOG)
    append_log(rows("a", 18), path, "a")
    append_log(rows("a", 18), path, "a")  # the same run again
    assert read_log(spark, path).count() == 18
    append_log(rows("b", 18), path, "b")  # another run at the same time
    log = read_log(spark, path)
    assert log.count() == 36 and log.select("id").distinct().count() == 36
    assert log.columns == [*MONITORING_LOG.fieldNames(), "year", "quarter"]
    assert [run_id("a", i) - run_id("a", 0) for i in range(3)] == [0, 1, 2] and 0 <= run_id("a", 1023) < 1 << 63
    with pytest.raises(ValueError):
        run_id("a", 1024)


# --- two-phase load ----------------------------------------------------------------------------------

PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _url(name):
    return f"jdbc:derby:memory:{name}{os.getpid()};create=true"  # a database that only this process sees


def _star(spark, n, facts):
    dim = spark.range(1, n + 1).select(F.col("id").alias("course_key"), F.concat(F.lit("M"), F.col("id").cast("string")).alias("code_module"))
    fact = spark.range(1, facts + 1, numPartitions=7).select(F.col("id").alias("fact_id"), (F.col("id") % n + 1).alias("course_key"), F.rand(1).alias("score"))
    return {"dim_course": dim, "fact_performance": fact}


def _rows(spark, url, table):
    return sorted(map(tuple, J.read_table(spark, url, table, PROPS).collect()))


def test_load_replaces_rows_in_one_transaction(spark):
    url = _url("two")
    J.full_refresh(_star(spark, 10, 500), url, PROPS)
    assert len(_rows(spark, url, "fact_performance")) == 500
    again = _star(spark, 20, 700)
    J.full_refresh(again, url, PROPS)
    assert _rows(spark, url, "fact_performance") == sorted(map(tuple, again["fact_performance"].collect()))
    assert len(_rows(spark, url, "dim_course")) == 20 and _rows(spark, url, "fact_performance_load") == []


def test_copies_of_retried_tasks_are_staged_once(spark):
    url = _url("copies")
    fact = _star(spark, 10, 500)["fact_performance"]
    s = J.Staged(fact, url, "fact_performance", PROPS, 1000, "run1")
    s.stage()
    parts = sorted(s.expected)
    s._write(s.rows.where(F.col(J.PART) == parts[0]))  # a speculative copy that ended as well
    s._write(s.rows.where(F.col(J.PART) == parts[2]).limit(3))  # a copy of some of a part's rows
    with J.connection(spark, url, PROPS) as conn:
        assert s.wrong(conn) == [parts[0], parts[2]]
        with pytest.raises(RuntimeError, match="expected"):  # nothing goes on with copies in it
            J.switch(conn, {"fact_performance": s}, [("load", "fact_performance")])
    s.mend()
    with J.connection(spark, url, PROPS) as conn:
        assert s.wrong(conn) == []
        J.switch(conn, {"fact_performance": s}, [("load", "fact_performance")])
    assert _rows(spark, url, "fact_performance") == sorted(map(tuple, fact.collect()))


def test_a_failure_half_way_leaves_the_old_rows(spark):
    url = _url("half")
    old = _star(spark, 10, 300)
    J.full_refresh(old, url, PROPS)
    with J.connection(spark, url, PROPS) as conn:
        J._update(conn, 'ALTER TABLE fact_performance ADD CONSTRAINT positive CHECK ("course_key" < 15)')
        conn.commit()
    with pytest.raises(Exception):
        J.full_refresh(_star(spark, 20, 400), url, PROPS)  # fails in the fact's rows, the dimension was already emptied and filled
    assert len(_rows(spark, url, "dim_course")) == 10 and _rows(spark, url, "fact_performance") == sorted(map(tuple, old["fact_performance"].collect()))
    J.full_refresh(_star(spark, 12, 50), url, PROPS)  # what the failed run staged does no harm
    assert len(_rows(spark, url, "fact_performance")) == 50 and len(_rows(spark, url, "dim_course")) == 12


def test_an_append_that_runs_again_replaces_its_own_rows(spark):
    url = _url("log")
    log = lambda when, n: spark.createDataFrame([(f"c{i}", when) for i in range(n)], "check_name string, checked_at timestamp")
    for when, n in ((datetime(2026, 1, 1, 12), 18), (datetime(2026, 1, 2), 18), (datetime(2026, 1, 1, 12), 17)):
        J.append(log(when, n), url, "monitoring_log", PROPS, instead_of=("checked_at", f"TIMESTAMP('{when:%Y-%m-%d %H:%M:%S}')"))
    got = [r[1] for r in _rows(spark, url, "monitoring_log")]
    assert len(got) == 35 and got.count(datetime(2026, 1, 1, 12)) == 17


def test_empty_tables_are_loaded_too(spark):
    url = _url("none")
    J.full_refresh(_star(spark, 10, 30), url, PROPS)
    J.full_refresh({k: v.limit(0) for k, v in _star(spark, 10, 30).items()}, url, PROPS)
    assert _rows(spark, url, "fact_performance") == [] and _rows(spark, url, "dim_course") == []


# --- ranges of equal depth -----------------------------------------------------------------------------

def _skewed(spark, url):
    """Ids in three clusters far apart, most of them in the narrowest; one id a tenth of all rows."""
    ids = [*range(1000, 1900), *range(10_000_000, 10_000_000 + 500_000, 5000), *range(9_000_000_000, 9_000_000_000 + 10**9, 10**7), -5, 2**40, *[1500] * 150]
    df = spark.createDataFrame([(i, f"r{k}") for k, i in enumerate(ids)] + [(None, "null")], "id_student long, v string")
    J.append(df, url, "visits", PROPS)
    return ids


def test_ranges_of_equal_depth_on_skewed_ids(spark):
    url = _url("depth")
    ids = _skewed(spark, url)
    even = J.read_table(spark, url, "visits", PROPS, partition_column="id_student", num_partitions=6)
    deep = J.read_table(spark, url, "visits", PROPS, partition_column="id_student", num_partitions=6, equi_depth=True)
    sizes = lambda df: [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sorted(r.v for r in deep.collect()) == sorted(r.v for r in even.collect()) and deep.count() == len(ids) + 1
    mean = (len(ids) + 1) / 6
    assert max(sizes(even)) > 4 * mean and max(sizes(deep)) <= 2 * mean and deep.rdd.getNumPartitions() <= 6


def test_predicates_cover_every_value_once():
    assert J.range_predicates("k", [(1, 5), (6, 9), (10, 12)]) == ["(k <= 5) OR k IS NULL", "k >= 6 AND k <= 9", "k >= 10"]
    assert J.range_predicates("k", [(1, 5)]) == ["1 = 1"]


def test_registered_log_fills_every_partition_and_prunes(spark):
    from conftest import SF_SMALL
    from edustar.plans.catalog import QUERIES
    from edustar.plans.warehouse import Warehouse
    got = {r.partition_name: r.rows for r in QUERIES["log_by_quarter"](spark, SF_SMALL).collect()}
    assert set(got) == {label for label, _ in LOG_PARTITIONS} | {"p_max"} and all(got.values())
    plan = recent(Warehouse.of(spark, SF_SMALL).log(), F.lit(datetime(2027, 1, 1)).cast("timestamp_ntz"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_raw_table_inventory_has_seven_files():
    assert len(RAW_TABLES) == 7 and len(set(EXPECTED_FILES)) == 7


def test_cluster_conf_scales_shuffle_partitions():
    from edustar.session import cluster_conf

    small, big = cluster_conf(10 * 1024 ** 3), cluster_conf(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    # 100 TB, half of it shuffled at 200 MB per partition: no cap, so the promised size holds.
    assert int(big["spark.sql.shuffle.partitions"]) == 262_144
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "spark.checkpoint.dir" not in big


def test_cluster_conf_sql_settings_are_known_to_spark(spark):
    from edustar.session import cluster_conf

    conf = {k: v for k, v in cluster_conf(100 * 1024 ** 4).items() if k.startswith("spark.sql.")}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
            assert spark.conf.isModifiable(k), k  # a runtime SQL setting Spark knows
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
