"""Vendor documents with gaps, errors and repeated entries; medians against pandas."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickframe.operators import clean as C
from tickframe.sources import vendor as V


def documents(spark, rows):
    return spark.createDataFrame([(s, p if p is None or isinstance(p, str) else json.dumps(p), 1) for s, p in rows], "symbol string, payload string, reason_code int")


def test_reasons(spark):
    docs = documents(spark, [("a", None), ("b", "{cut"), ("c", "[1]"), ("d", {"Note": "slow down"}), ("e", {"Error Message": "no such"}), ("f", {}), ("f", {})])
    assert {r.symbol: r.reason for r in V.rejected(docs).collect()} == {
        "a": "empty answer", "b": "not a JSON object", "c": "not a JSON object", "d": "slow down", "e": "no such"}
    assert [r.symbol for r in V.accepted(docs).collect()] == ["f", "f"]


def test_adjusted_bars(spark):
    full = {n: str(i + 1) for i, (n, _) in enumerate(V.ADJUSTED_FIELDS)}
    odd = {"1. open": "x", "2. high": "NaN", "3. low": "Infinity", "4. close": None, "6. volume": "1e3"}
    docs = documents(spark, [("a", {V.VENDOR_SERIES_KEY: {"2024-01-02": full, "2024-01-03": odd, "soon": full}}), ("b", {V.VENDOR_SERIES_KEY: {}}), ("c", {})])
    rows = {str(r.date): r for r in V.adjusted_bars(docs).collect()}
    assert set(rows) == {"2024-01-02", "2024-01-03"}
    assert [rows["2024-01-02"][c] for _, c in V.ADJUSTED_FIELDS] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [rows["2024-01-03"][c] for _, c in V.ADJUSTED_FIELDS] == [None, None, None, None, None, 1000, None, None]
    assert V.adjusted_bars(docs.limit(0)).count() == 0


def test_actions_and_earnings(spark):
    docs = documents(spark, [("a", {"dividends": {"2024-01-02": 0.5, "2024-04-02": "x"}, "splits": {"2024-01-02": 2}}), ("b", {"splits": {}}), ("c", {"dividends": None})])
    assert sorted((r.symbol, str(r.date), r.action, r.value) for r in V.corporate_actions(docs).fillna(-1.0).collect()) == [
        ("a", "2024-01-02", "dividend", 0.5), ("a", "2024-01-02", "split", 2.0), ("a", "2024-04-02", "dividend", -1.0)]
    docs = documents(spark, [("a", {"annualEarnings": [{"fiscalDateEnding": "2023-12-31", "reportedEPS": "4.5"}],
                                    "quarterlyEarnings": [{"fiscalDateEnding": "2023-12-31", "reportedEPS": "1", "estimatedEPS": "None", "surprise": "-0.5"}] * 2})])
    assert sorted(tuple(r)[:2] + (str(r.fiscal_date), r.reported_eps, r.estimated_eps, r.surprise) for r in V.earnings(docs).collect()) == [
        ("a", "annual", "2023-12-31", 4.5, None, None)] + [("a", "quarterly", "2023-12-31", 1.0, None, -0.5)] * 2


def test_overview_and_fundamentals(spark):
    o = V.company_overview(documents(spark, [("a", {"Name": "A", "Sector": "-", "PERatio": "None", "Beta": "1.5", "extra": {}})])).first()
    assert (o.name, o.sector, o.pe_ratio, o.beta, o.market_cap) == ("A", None, None, 1.5, None)
    docs = documents(spark, [("a", {"marketCap": 5e9, "currentPrice": None, "regularMarketPrice": 7, "volume": "1e30", "beta": "NaN", "longName": None}),
                             ("b", {"currentPrice": 3, "regularMarketPrice": 7, "fullTimeEmployees": 12.0, "currency": "EUR"}), ("c", None)])
    rows = {r.symbol: r for r in V.fundamentals(docs, F.lit("2024-01-31 10:00:00").cast("timestamp")).collect()}
    assert set(rows) == {"a", "b"} and len(rows["a"]) == 44
    a, b = rows["a"], rows["b"]
    assert (a.current_price, a.volume, a.beta, a.name, a.market_cap_category, a.currency, a.last_updated) == (7.0, 0, 0.0, "", "Mid Cap", "USD", "2024-01-31T10:00:00")
    assert (b.current_price, b.employees, b.currency, b.market_cap_category, b["52_week_high"]) == (3.0, 12, "EUR", "Unknown", 0.0)


@pytest.mark.parametrize("parts", [2, 256])
def test_median_fill(spark, parts):
    x = [1.0, 9.0, 9.0, 9.0, 4.0, 2.0, None, 7.0, 9.0]
    y = [None, 3.0, None, 1.0, 2.0, 10.0, None, -5.0, 0.5]
    pdf = pd.DataFrame({"x": x, "y": y, "z": [None] * 9, "name": list("abcdefghi")})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)], "x double, y double, z double, name string")
    assert {r.name: r["median"] for r in C.medians(df, ["x", "y", "z"], parts).select(F.col("name"), "median").collect()} == {
        "x": pdf.x.median(), "y": pdf.y.median()}
    filled = {r["name"]: (r.x, r.y, r.z) for r in C.median_fill(df, ["x", "y", "z"]).collect()}
    assert filled["g"] == (pdf.x.median(), pdf.y.median(), None) and filled["a"] == (1.0, pdf.y.median(), None)
    assert C.median_fill(df.limit(0), ["x"]).count() == 0
