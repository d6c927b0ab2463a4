"""Spark query vs DuckDB oracle on a representative subset at sf0.001
(the full set runs with ``python tests/oracle_harness.py``)."""

import pytest

from small import SF_SMALL
from oracle_harness import compare, duck

KEYS = ["r17_portfolio_analytics", "r18_backtest", "r11_risk_metrics", "r12_risk_attribution", "s23_indicator_table",
        "c02_forward_fill", "c03_interpolate", "c07_resample_weekly", "j07_macro_asof", "f01_screen", "a05_screener_summary",
        "a16_correlation_matrix", "a14_covariance_matrix", "w10_rolling_portfolio_metrics", "u06_source_precedence",
        "s09_parse_vendor_bars", "s21_upsert_prices", "st10_hourly_bars", "st05_sustained_condition", "m02_chronological_split",
        "o10_strategy_weights"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_parity(spark, con, key):
    from tickframe.plans import catalog
    r = compare(spark, con, key, catalog.queries()[key], catalog.oracle_sql()[key], SF_SMALL)
    assert r["cols"] and r["rows"] == r["orows"] and r["exact"], r


def test_every_query_has_docstring_or_oracle():
    from tickframe.plans import catalog
    qs, os_ = catalog.queries(), catalog.oracle_sql()
    assert set(os_) <= set(qs)
    assert len(qs) >= 200
