"""Plan shape: pruning reaches the scan, no Python in the plan, no
nested-loop or cartesian joins in the multi-slide plans."""

import pytest
from conftest import SF0001

import __spark_entry__ as E
from tidewatch.operators import extract_window, kpi_daily
from tidewatch.plans import kpi_global_slides, state_row
from tidewatch.session import scratch_path
from tidewatch.sources import read_raw, tx, write_raw


def _plan(df):
    """The formatted physical plan as text."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def stored_raw(spark):
    path = scratch_path(spark, "raw")
    write_raw(tx(spark, SF0001), path)
    return read_raw(spark, path)


def test_window_extract_prunes_months_and_columns(spark, stored_raw):
    w = kpi_daily(extract_window(stored_raw, "1995-03-04", "1995-04-03"))
    plan = _plan(w)
    assert "(block_timestamp_month#" in plan and ">= 1995-03-01)" in plan and "<= 1995-04-01)" in plan
    assert "PartitionFilters: [isnotnull(block_timestamp_month" in plan
    assert "GreaterThanOrEqual(block_timestamp,1995-03-04 00:00:00.0)" in plan
    assert "LessThan(block_timestamp,1995-04-04 00:00:00.0)" in plan
    # column pruning, and nested pruning: only the addresses leaf is read
    schemas = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert schemas and all("hash" not in s and "size" not in s for s in schemas)
    assert any("inputs:array<struct<addresses:array<string>>>" in s for s in schemas)


def test_slides_plan_has_no_nested_loop_or_cartesian(spark, stored_raw):
    st = state_row(spark, "1995-01-01", "1995-01-31")
    plan = _plan(kpi_global_slides(stored_raw, st, 15))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["kpi_daily", "kpi_global", "kpi_global_slides", "kpi_daily_slides",
                                  "kpi_sliding_eventtime", "tx_window", "check_window_verdict"])
def test_no_python_udf_in_plan(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in plan, (name, op)


def test_median_spreads_a_day_over_its_values(spark, stored_raw):
    plan = _plan(kpi_daily(extract_window(stored_raw, "1995-03-04", "1995-04-03")))
    exchanges = [ln for ln in plan.splitlines() if ln.startswith("Arguments: hashpartitioning(")]
    assert any("jour" in e and "out_sat" in e for e in exchanges)
    assert "percentile" not in plan and "kll" not in plan


def test_address_edges_reads_its_input_once(spark, stored_raw):
    from tidewatch.operators import address_edges
    plan = _plan(address_edges(stored_raw))
    assert sum(ln.startswith("(") and "Scan parquet" in ln for ln in plan.splitlines()) == 1


def test_tx_lines_meet_once_and_own_address_is_made_before_the_join(spark):
    """Lines are shuffled as they are; an order's address is no work for each of its lines."""
    plan = tx(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    lines = plan[plan.index("ObjectHashAggregate"):]
    assert "Aggregate" not in lines[lines.index("Exchange"):]
    assert "o_custkey" not in plan[plan.index("transform("):plan.index("Join")]


def test_tx_state_reads_orders_alone(spark):
    plan = E._state(tx(spark, SF0001))._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" in plan and "lineitem" not in plan
