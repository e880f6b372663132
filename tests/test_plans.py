"""Physical-plan checks: one data shuffle for the indicator plan (plain and
chunked), pruned scans, no Python evaluation in the batch feature path."""

import re

from conftest import SF01

from tickforge.catalog import QUERIES


def executed(df):
    """The final plan of a run (adaptive execution included)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


def data_exchanges(plan: str):
    """Hash exchanges that move tick rows (not the small statistics tables)."""
    return re.findall(r"(?<!\], )Exchange hashpartitioning\(([^)]*)\)", plan)  # a reused one does no work


def row_scans(plan: str) -> int:
    return len(re.findall(r"FileScan parquet .*events\.parquet", plan))


def test_plain_indicator_plan(spark):
    plan = executed(QUERIES["indicators_full"](spark, SF01))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    parts = data_exchanges(plan)
    assert len(parts) == 1 and parts[0].startswith("symbol"), parts
    assert row_scans(plan) == 1


def test_chunked_indicator_plan(spark, small_chunks):
    plan = executed(QUERIES["indicators_full"](spark, SF01))
    parts = data_exchanges(plan)
    assert len(parts) == 1 and "_chunk" in parts[0], parts     # the single shuffle of rows
    assert row_scans(plan) == 1 and "BroadcastHashJoin" in plan  # placement tables are read from the shared folder


def test_chunked_backtest_stays_in_the_indicator_partitions(spark, small_chunks):
    plan = executed(QUERIES["backtest_metrics"](spark, SF01))
    assert row_scans(plan) <= 4
    # rows are shuffled once (a second use of that shuffle is a ReusedExchange); the rest is carry and metrics
    assert len([p for p in data_exchanges(plan) if "_chunk" in p]) == 1, data_exchanges(plan)


def test_lags_do_not_build_histories(spark):
    for name in ("rsi", "volatility", "momentum", "price_change_lags"):
        assert "collect_list" not in QUERIES[name](spark, SF01)._jdf.queryExecution().optimizedPlan().toString(), name


def test_serving_cuts_ticks_first(spark):
    plan = executed(QUERIES["latest_snapshot"](spark, SF01))
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_scan_is_pruned(spark):
    df = QUERIES["price_transforms"](spark, SF01)
    p = df._jdf.queryExecution().executedPlan().toString()
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "props" not in schema and "value:double" in schema
