"""Driver contract and a DuckDB oracle spot check at sf0.001."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from conftest import SF001  # noqa: E402


def test_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "macd_signal" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracles_spot_check(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from compare import compare, duck
    con = duck(SF001)
    qs, os_ = E.queries(), E.oracle_sql()
    for name in ["indicators_full", "backtest_metrics", "rule_signals", "stateless_feature_record",
                 "latest_snapshot", "signal_classification_report"]:
        res = compare(spark, con, name, qs[name], os_[name], SF001)
        assert res.startswith("OK"), res


def test_entry_without_the_training_data_subpackage(monkeypatch):
    """The optional subpackage and the pipeline may be absent."""
    for gone in ("corpus_pipeline", "tickforge.llm.queries"):
        with monkeypatch.context() as m:
            m.setitem(sys.modules, gone, None)
            assert "indicators_full" in E.queries() and "pipeline" not in E.queries()
            assert set(E.oracle_sql()) <= set(E.queries())
