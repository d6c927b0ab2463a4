"""Vendor documents in full: adjusted daily bars (S-09), rejects (S-11), dividends, splits, overview and earnings (S-16), the
fundamentals row of 44 fields (S-17).

A frame of documents has the columns ``symbol`` (that of the request) and ``payload`` (JSON text).  Every value is read as text
and cast with ``try_cast``: a number that does not parse is null, as ``to_numeric(errors='coerce')`` leaves it.  A null payload,
text that is no JSON object and the vendor's error and limit notes are rejects with a reason, never an exception; ``accepted``
and ``rejected`` part a frame without reading it twice in one branch.  All functions are expressions and explodes: no shuffle,
so a source or symbol that holds a third of the documents is spread as its files are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.operators.screen import cap_category_collector
from tickframe.sources.files import VENDOR_ERROR_KEYS, VENDOR_SERIES_KEY

# fixed values: vendor field names of the adjusted daily payload
ADJUSTED_FIELDS = [("1. open", "open"), ("2. high", "high"), ("3. low", "low"), ("4. close", "close"), ("5. adjusted close", "adjusted_close"),
                   ("6. volume", "volume"), ("7. dividend amount", "dividend_amount"), ("8. split coefficient", "split_coefficient")]

# fixed values: fundamentals columns, the vendor's field names (the first that is not null counts) and the defaults
FUNDAMENTALS = [
    ("name", ("longName",), ""), ("sector", ("sector",), ""), ("industry", ("industry",), ""), ("market_cap", ("marketCap",), 0.0),
    ("current_price", ("currentPrice", "regularMarketPrice"), 0.0), ("previous_close", ("previousClose",), 0.0),
    ("day_change", ("regularMarketChange",), 0.0), ("day_change_percent", ("regularMarketChangePercent",), 0.0),
    ("volume", ("volume",), 0), ("avg_volume", ("averageVolume",), 0), ("pe_ratio", ("trailingPE",), 0.0), ("forward_pe", ("forwardPE",), 0.0),
    ("peg_ratio", ("pegRatio",), 0.0), ("price_to_book", ("priceToBook",), 0.0), ("price_to_sales", ("priceToSalesTrailing12Months",), 0.0),
    ("dividend_yield", ("dividendYield",), 0.0), ("dividend_rate", ("dividendRate",), 0.0), ("beta", ("beta",), 0.0),
    ("debt_to_equity", ("debtToEquity",), 0.0), ("return_on_equity", ("returnOnEquity",), 0.0), ("profit_margins", ("profitMargins",), 0.0),
    ("revenue_growth", ("revenueGrowth",), 0.0), ("earnings_growth", ("earningsGrowth",), 0.0), ("52_week_high", ("fiftyTwoWeekHigh",), 0.0),
    ("52_week_low", ("fiftyTwoWeekLow",), 0.0), ("enterprise_value", ("enterpriseValue",), 0.0), ("shares_outstanding", ("sharesOutstanding",), 0),
    ("float_shares", ("floatShares",), 0), ("short_ratio", ("shortRatio",), 0.0), ("short_percent", ("shortPercentOfFloat",), 0.0),
    ("institutional_ownership", ("institutionOwnership",), 0.0), ("insider_ownership", ("insiderOwnership",), 0.0),
    ("analyst_recommendation", ("recommendationMean",), 0.0), ("target_price", ("targetMeanPrice",), 0.0), ("currency", ("currency",), "USD"),
    ("exchange", ("exchange",), ""), ("country", ("country",), ""), ("website", ("website",), ""), ("business_summary", ("longBusinessSummary",), ""),
    ("employees", ("fullTimeEmployees",), 0), ("founded_year", ("founded",), 0)]

# fixed values: overview fields, the columns they become and their types
OVERVIEW_FIELDS = [("Name", "name", "string"), ("Sector", "sector", "string"), ("Industry", "industry", "string"),
                   ("MarketCapitalization", "market_cap", "double"), ("PERatio", "pe_ratio", "double"), ("PEGRatio", "peg_ratio", "double"),
                   ("DividendYield", "dividend_yield", "double"), ("Beta", "beta", "double")]
MISSING_WORDS = ("None", "-", "")  # fixed values: what the vendor writes for a missing overview or earnings value
EARNINGS_KEYS = {"annual": "annualEarnings", "quarterly": "quarterlyEarnings"}  # fixed values
EARNINGS_FIELDS = [("reportedEPS", "reported_eps"), ("estimatedEPS", "estimated_eps"), ("surprise", "surprise")]  # fixed values


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _number(text: Column) -> Column:
    """Text as a double; what does not parse and what is not finite is null."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def _labelled(name: str, label: str):
    """Array elements as structs of the label and the element."""
    return lambda r: F.struct(F.lit(label).alias(name), r.alias("r"))


def with_reason(docs: DataFrame) -> DataFrame:
    """S-11: ``reason`` is null for a document to parse, else the vendor's error or limit note, or why it can't be read."""
    notes = [F.get_json_object("payload", f"$['{k}']") for k in VENDOR_ERROR_KEYS]
    return docs.withColumn("reason", F.when(F.col("payload").isNull(), "empty answer").when(F.json_object_keys("payload").isNull(), "not a JSON object")
                           .otherwise(F.coalesce(*notes)))


def accepted(docs: DataFrame) -> DataFrame:
    return with_reason(docs).where("reason IS NULL").drop("reason")


def rejected(docs: DataFrame) -> DataFrame:
    return with_reason(docs).where("reason IS NOT NULL")


def adjusted_bars(docs: DataFrame, source: str = "alpha_vantage") -> DataFrame:
    """S-09: (symbol, date, the eight fields, data_source) of every dated entry; a document without a series gives no rows, an entry
    without a readable date is left out, a repeated date stays as often as it comes."""
    schema = T.StructType([T.StructField(VENDOR_SERIES_KEY, T.MapType(T.StringType(), _texts(*[n for n, _ in ADJUSTED_FIELDS])))])
    d = accepted(docs).select("symbol", F.explode(F.from_json("payload", schema)[VENDOR_SERIES_KEY]).alias("_d", "_v"))
    return (d.select("symbol", F.try_to_timestamp("_d", F.lit("yyyy-MM-dd")).cast("date").alias("date"),
                     *[_number(F.col("_v")[n]).alias(c) for n, c in ADJUSTED_FIELDS], F.lit(source).alias("data_source"))
            .where("date IS NOT NULL"))


def corporate_actions(docs: DataFrame) -> DataFrame:
    """S-16: (symbol, date, action, value), one row per dividend and per split of the documents."""
    series = T.MapType(T.StringType(), T.StringType())
    kinds = {"dividend": "dividends", "split": "splits"}
    p = accepted(docs).select("symbol", F.from_json("payload", T.StructType([T.StructField(k, series) for k in kinds.values()])).alias("_p"))
    every = F.flatten(F.array(*[F.transform(F.coalesce(F.map_entries(F.col("_p")[key]), F.array()), _labelled("action", action))
                                 for action, key in kinds.items()]))
    e = p.select("symbol", F.explode(every).alias("e"))
    return e.select("symbol", F.try_to_timestamp("e.r.key", F.lit("yyyy-MM-dd")).cast("date").alias("date"), "e.action",
                    _number(F.col("e.r.value")).alias("value")).where("date IS NOT NULL")


def company_overview(docs: DataFrame) -> DataFrame:
    """S-16: one typed row per overview document; the vendor's words for a missing value are null."""
    p = accepted(docs).select("symbol", F.from_json("payload", _texts(*[n for n, _, _ in OVERVIEW_FIELDS])).alias("p"))
    text = {n: F.when(~F.col("p")[n].isin(*MISSING_WORDS), F.col("p")[n]) for n, _, _ in OVERVIEW_FIELDS}
    return p.select("symbol", *[(_number(text[n]) if t == "double" else text[n]).alias(c) for n, c, t in OVERVIEW_FIELDS])


def earnings(docs: DataFrame) -> DataFrame:
    """S-16: (symbol, period, fiscal_date, reported_eps, estimated_eps, surprise) of both arrays of an earnings document."""
    record = T.ArrayType(_texts("fiscalDateEnding", *[n for n, _ in EARNINGS_FIELDS]))
    p = accepted(docs).select("symbol", F.from_json("payload", T.StructType([T.StructField(k, record) for k in EARNINGS_KEYS.values()])).alias("_p"))
    every = F.flatten(F.array(*[F.transform(F.coalesce(F.col("_p")[key], F.array()), _labelled("period", period))
                                 for period, key in EARNINGS_KEYS.items()]))
    e = p.select("symbol", F.explode(every).alias("e"))
    return e.select("symbol", "e.period", F.try_to_timestamp("e.r.fiscalDateEnding", F.lit("yyyy-MM-dd")).cast("date").alias("fiscal_date"),
                    *[_number(F.col(f"e.r.{n}")).alias(c) for n, c in EARNINGS_FIELDS])


def fundamentals(docs: DataFrame, collected_at: Column) -> DataFrame:
    """S-17: the row of 44 fields per document.  Numbers that are missing, null or unreadable become 0 and texts '' ('USD' for the
    currency), so a column keeps one type; the price falls back to the regular market's; the category follows the collector's
    rule; ``last_updated`` is ``collected_at`` as ISO text."""
    fields = [f for _, names, _ in FUNDAMENTALS for f in names]
    p = accepted(docs).select("symbol", collected_at.alias("_at"), F.from_json("payload", _texts(*fields)).alias("p"))

    def value(names: tuple[str, ...], default: str | float | int) -> Column:
        if isinstance(default, str):
            return F.coalesce(*[F.col("p")[n] for n in names], F.lit(default))
        kind = "double" if isinstance(default, float) else "bigint"
        return F.coalesce(*[_number(F.col("p")[n]).try_cast(kind) for n in names], F.lit(default).cast(kind))
    out = p.select("symbol", "_at", *[value(names, default).alias(c) for c, names, default in FUNDAMENTALS])
    out = out.withColumn("market_cap_category", cap_category_collector("market_cap"))
    out = out.withColumn("last_updated", F.date_format("_at", "yyyy-MM-dd'T'HH:mm:ss")).drop("_at")
    head = ["symbol", "name", "sector", "industry", "market_cap", "market_cap_category"]
    return out.select(*head, *[c for c in out.columns if c not in head])
