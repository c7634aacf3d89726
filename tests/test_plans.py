"""Physical plan shape: pruned scans, no Python UDFs, no single-task window on the fact."""

from edustar.plans.catalog import QUERIES
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    for name in ("fact_performance", "mart_vle_engagement", "student_funnel", "dq_declared_accepted_values"):
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_fact_is_numbered_without_sampling_or_a_global_sort(spark):
    p = _plan(QUERIES["fact_performance"](spark, SF_SMALL))
    # one shuffle of the fact, by arithmetic bucket; the other window adds up the buckets' counts
    assert "rangepartitioning" not in p and p.count("Exchange hashpartitioning(_b") == 1 and p.count("Window [") == 2
    from edustar.plans.warehouse import Warehouse
    w = Warehouse.of(spark, SF_SMALL)
    p = _plan(QUERIES["score_vs_avg"](spark, SF_SMALL))
    assert "Window" not in p and "BroadcastHashJoin" in p and w.sizes["fact_performance"] > 0


def test_scans_are_pruned(spark):
    p = _plan(QUERIES["pass_rate_by_region"](spark, SF_SMALL))
    assert "ReadSchema: struct<grouping:string,region:string,n:bigint,passed:bigint>" in p  # of the cube's row
    p = _plan(QUERIES["overall_rates"](spark, SF_SMALL))
    assert "ReadSchema: struct<final_result:string>" in p  # of the fact's


def test_silver_filters_are_pushed_to_scan(spark):
    p = _plan(QUERIES["silver_student_assessment"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(id_assessment), IsNotNull(id_student)" in p


def test_plan_invariants_for_every_query(spark):
    """No Python evaluation, no cross/nested-loop join anywhere; windows only
    over already-aggregated rows (dense-key offsets, the mart's course shares)."""
    from tools.plan_audit import audit
    window_ok = {"dim_course", "dim_student", "dim_assessment", "mart_result_by_module", "fact_performance"}
    for name, fn in QUERIES.items():
        a = audit(fn(spark, SF_SMALL))
        assert a["python"] == 0 and a["nested_loop_or_cartesian"] == 0, name
        assert a["windows"] == 0 or name in window_ok, name


def test_staging_written_only_when_a_dimension_is_too_big(spark, monkeypatch):
    from edustar.operators import joins
    from edustar.plans.warehouse import Warehouse

    small = Warehouse(spark, SF_SMALL)
    lazy = small.staging()
    assert "stg_fact_performance" not in small.sizes  # map-side joins, left lazy
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 20_000)  # Dim_Student (146 rows) no longer fits
    big = Warehouse(spark, SF_SMALL)
    written = big.staging()
    assert big.sizes["stg_fact_performance"] == lazy.count()
    cols = sorted(lazy.columns)
    assert sorted(map(tuple, written.select(*cols).collect())) == sorted(map(tuple, lazy.select(*cols).collect()))
