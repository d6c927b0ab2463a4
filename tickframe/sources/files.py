"""Sources and sinks S-08 .. S-29: landing files, vendor JSON, appends, upserts, change feeds.

Every write goes to a folder under the shared scratch root (``spark.checkpoint.dir``
unless ``tickframe.scratch.dir`` is set) -- never a machine-local folder.  Reads use
explicit schemas (no inference); writes are set-based and partitioned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.session import checkpoint_dir

BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("adjusted_close", T.DoubleType()), T.StructField("volume", T.LongType()),
    T.StructField("data_source", T.StringType())])

# fixed values: vendor field names of the daily-bar payloads
VENDOR_FIELDS = [("1. open", "open"), ("2. high", "high"), ("3. low", "low"), ("4. close", "close"),
                 ("5. volume", "volume")]
VENDOR_SERIES_KEY = "Time Series (Daily)"
VENDOR_ERROR_KEYS = ("Error Message", "Note")
INDICATOR_KEY_PREFIX = "Technical Analysis: "


JSON_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared scratch root."""
    root = spark.conf.get("tickframe.scratch.dir", None) or checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"


# ---- S-08 / S-22 / S-23 / S-25: files -------------------------------------------------

def write_landing_csv(df: DataFrame, path: str, partition_by=("data_source", "symbol")) -> str:
    """S-08 sink: CSV landing files partitioned by source and symbol."""
    df.write.mode("overwrite").partitionBy(*partition_by).option("header", True).csv(path)
    return path


def read_landing_csv(spark: SparkSession, path: str, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    """S-08 source: explicit schema; partition columns come back from the folder names.  Lines that do not fit the
    schema stay, with their text in ``corrupt``: see ``landing_rows`` and ``landing_rejects``."""
    data_schema = T.StructType([f for f in schema.fields if f.name not in ("data_source", "symbol")] + [T.StructField("corrupt", T.StringType())])
    return (spark.read.schema(data_schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "corrupt").csv(path).withColumn("source_file", F.input_file_name()))


def _parsed(landed: DataFrame):
    """Always true; the CSV reader judges a line only if some of its fields are asked for."""
    return F.xxhash64(*[c for c in landed.columns if c not in ("corrupt", "source_file", "data_source", "symbol")]) % 2 < 2


def landing_rows(landed: DataFrame) -> DataFrame:
    """Rows of a landing read that fit the schema."""
    return landed.where(F.col("corrupt").isNull() & _parsed(landed)).drop("corrupt")


def landing_rejects(landed: DataFrame) -> DataFrame:
    """(source_file, line) of the lines that did not."""
    return landed.where(F.col("corrupt").isNotNull() & _parsed(landed)).select("source_file", F.col("corrupt").alias("line"))


def stream_landing_csv(spark: SparkSession, path: str, table: str, rejects: str, progress: str, schema: T.StructType = BAR_SCHEMA) -> None:
    """S-08 as a file stream: the files that came to the landing folder since the last call go to table, lines that do not fit the
    schema to rejects.  ``progress`` remembers the files, so a call after a restart repeats none; a repeated micro-batch
    overwrites the folder of its epoch.  data_source and symbol come back from the folder names."""
    kept = [f for f in schema.fields if f.name not in ("data_source", "symbol")] + [T.StructField("corrupt", T.StringType())]
    folders = [f for f in schema.fields if f.name in ("data_source", "symbol")]
    lines = (spark.readStream.schema(T.StructType(kept + folders)).option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "corrupt").csv(path).withColumn("source_file", F.input_file_name()))

    def land(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()  # parsed once for both outputs; a lost part is parsed again from the files
        try:
            landing_rows(batch).drop("source_file").write.mode("overwrite").parquet(f"{table}/epoch={epoch}")
            landing_rejects(batch).write.mode("overwrite").parquet(f"{rejects}/epoch={epoch}")
        finally:
            batch.unpersist()
    lines.writeStream.foreachBatch(land).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> str:
    """S-20 / S-22 / S-23 / S-29: set-based write (append or replace), optional partitioning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def json_roundtrip(df: DataFrame, path: str) -> DataFrame:
    """S-25 / S-26: JSON records out and back in with the same schema; timestamps keep their microseconds."""
    df.write.mode("overwrite").options(**JSON_TIMES).json(path)
    return df.sparkSession.read.schema(df.schema).options(**JSON_TIMES).json(path)


# ---- S-09 .. S-12, S-16, S-17: vendor payloads -----------------------------------------

def vendor_payloads(bars: DataFrame) -> DataFrame:
    """Daily-bar payloads in the vendor's layout, one JSON document per (symbol, month)
    -- the shape S-09 parses.  Values are strings, as the vendor sends them."""
    entry = F.struct(*[F.col(src).cast("string").alias(name) for name, src in VENDOR_FIELDS])
    per = bars.groupBy("symbol", F.date_trunc("month", "date").alias("_m")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), entry))).alias("_ts"))
    doc = F.to_json(F.struct(F.create_map(F.lit("2. Symbol"), F.col("symbol")).alias("Meta Data"),
                             F.col("_ts").alias(VENDOR_SERIES_KEY)))
    return per.select("symbol", doc.alias("payload"))


def split_errors(payloads: DataFrame, col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """S-11: (good, rejected) by the presence of an error or rate-limit note."""
    bad = None
    for k in VENDOR_ERROR_KEYS:
        e = F.get_json_object(F.col(col), f"$['{k}']").isNotNull()
        bad = e if bad is None else (bad | e)
    return payloads.filter(~bad), payloads.filter(bad).withColumn(
        "reason", F.coalesce(*[F.get_json_object(F.col(col), f"$['{k}']") for k in VENDOR_ERROR_KEYS]))


def parse_daily_bars(payloads: DataFrame, col: str = "payload", source: str = "alpha_vantage") -> DataFrame:
    """S-09 + S-12 + S-13: map of date -> fields, exploded; numbers via try_cast (unparseable
    -> null, like ``to_numeric(errors='coerce')``); null volume -> 0; rows whose date does
    not parse are skipped; lineage columns added."""
    fields = T.StructType([T.StructField(name, T.StringType()) for name, _ in VENDOR_FIELDS])
    schema = T.StructType([T.StructField(VENDOR_SERIES_KEY, T.MapType(T.StringType(), fields))])
    d = payloads.select("symbol", F.explode(F.from_json(F.col(col), schema)[VENDOR_SERIES_KEY]).alias("d", "v"))
    out = d.select("symbol", F.try_to_timestamp("d", F.lit("yyyy-MM-dd")).cast("date").alias("date"),
                   *[F.col("v")[name].try_cast("double").alias(src) for name, src in VENDOR_FIELDS[:4]],
                   F.coalesce(F.col("v")["5. volume"].try_cast("double").cast("bigint"), F.lit(0)).alias("volume"))
    return out.filter(F.col("date").isNotNull()).withColumn("data_source", F.lit(source))


def indicator_payloads(ind: DataFrame, name: str, col: str) -> DataFrame:
    """Vendor indicator documents (dynamic key 'Technical Analysis: NAME') per (symbol, month)."""
    per = ind.filter(F.col(col).isNotNull()).groupBy("symbol", F.date_trunc("month", "date").alias("_m")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"),
                                                   F.create_map(F.lit(name), F.col(col).cast("string"))))).alias("_ts"))
    doc = F.to_json(F.struct(F.create_map(F.lit("2: Indicator"), F.lit(name)).alias("Meta Data"),
                             F.col("_ts").alias(INDICATOR_KEY_PREFIX + name)))
    return per.select("symbol", doc.alias("payload"))


def parse_indicator(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """S-10: find the 'Technical Analysis: X' key, explode its date map, one row per value."""
    top = F.from_json(F.col(col), T.MapType(T.StringType(), T.StringType()))
    d = payloads.select("symbol", top.alias("_top"))
    key = F.filter(F.map_keys("_top"), lambda k: k.startswith(INDICATOR_KEY_PREFIX))[0]
    d = d.select("symbol", F.substring_index(key, ": ", -1).alias("indicator"),
                 F.from_json(F.col("_top")[key], T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))
                 .alias("_ts"))
    d = d.select("symbol", "indicator", F.explode("_ts").alias("d", "v"))
    return d.select("symbol", F.to_date("d").alias("date"), "indicator",
                    F.col("v")[F.col("indicator")].try_cast("double").alias("value"))


def company_info(info_json: DataFrame, col: str = "payload") -> DataFrame:
    """S-16 / S-17: fundamentals row from nested vendor info with fallbacks and typed defaults
    (Q-12 fixed: numeric gaps become typed values, not '')."""
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("symbol", T.StringType()), ("longName", T.StringType()), ("shortName", T.StringType()),
        ("sector", T.StringType()), ("industry", T.StringType()), ("marketCap", T.DoubleType()),
        ("currentPrice", T.DoubleType()), ("regularMarketPrice", T.DoubleType()), ("trailingPE", T.DoubleType()),
        ("pegRatio", T.DoubleType()), ("dividendYield", T.DoubleType()), ("beta", T.DoubleType()),
        ("volume", T.LongType()))])
    j = info_json.select(F.from_json(F.col(col), schema).alias("i")).select("i.*")
    return j.select("symbol", F.coalesce("longName", "shortName", F.col("symbol")).alias("name"),
                    F.coalesce("sector", F.lit("Unknown")).alias("sector"),
                    F.coalesce("industry", F.lit("Unknown")).alias("industry"),
                    F.col("marketCap").alias("market_cap"),
                    F.coalesce("currentPrice", "regularMarketPrice", F.lit(0.0)).alias("current_price"),
                    F.col("trailingPE").alias("pe_ratio"), F.col("pegRatio").alias("peg_ratio"),
                    F.coalesce("dividendYield", F.lit(0.0)).alias("dividend_yield"),
                    F.coalesce("beta", F.lit(1.0)).alias("beta"), F.coalesce("volume", F.lit(0)).alias("volume"))


# ---- S-14 / S-15: macro and multi-column datasets ---------------------------------------

def normalise_series(wide: DataFrame, date: str = "date", start=None, end=None) -> DataFrame:
    """S-14 / S-15: wide per-series columns -> long (series_id, date, value), range filtered."""
    cols = [c for c in wide.columns if c != date]
    long = wide.unpivot([date], cols, "series_id", "value").filter(F.col("value").isNotNull())
    if start is not None:
        long = long.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        long = long.filter(F.col(date) <= F.lit(end).cast("date"))
    return long


# ---- S-18 .. S-21, S-27, S-28: appends, upserts, portfolios ------------------------------

def append_batch(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """S-18: union batches by name (missing columns -> typed nulls), project the canonical
    schema (F-14), cast dates."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = []
    for fld in schema.fields:
        if fld.name in u.columns:
            cols.append(F.col(fld.name).cast(fld.dataType).alias(fld.name))
        else:
            cols.append(F.lit(None).cast(fld.dataType).alias(fld.name))
    return u.select(*cols)


def upsert(current: DataFrame, updates: DataFrame, keys=("symbol", "date"), version: str = "loaded_at") -> DataFrame:
    """S-21 / ST-09: keep, per key, the row with the newest version (updates win ties).

    A ``max_by`` aggregate over (version, batch rank): partial aggregation, so a hot
    key is combined map-side; idempotent when applied twice.
    """
    cur = current.withColumn("_rank", F.lit(0))
    upd = updates.withColumn("_rank", F.lit(1))
    u = cur.unionByName(upd, allowMissingColumns=True)
    payload = [c for c in u.columns if c not in keys and c != "_rank"]
    best = F.max_by(F.struct(*payload), F.struct(F.col(version), F.col("_rank")))
    return u.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, partition: str, keys=("symbol", "date"), version: str = "loaded_at") -> None:
    """S-21 / ST-09 on a stored table: reads and rewrites the partitions that the updates touch, and no others.

    Dynamic partition overwrite replaces their files; files of all other partitions stay as they are.  Applied again, the
    same updates leave the same rows, so a repeated batch does no harm.  updates carries the partition column, which must be
    a function of the keys."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)
    merged = updates
    if stored:
        touched = [r[0] for r in updates.select(partition).distinct().collect()]  # partitions of one batch, for static pruning
        if not touched:
            return
        current = spark.read.schema(updates.schema).parquet(path).where(F.col(partition).isin(touched))
        merged = upsert(current, updates, (*keys, partition), version)
    merged = upsert(updates.limit(0), updates, (*keys, partition), version) if not stored else merged
    merged.select(*updates.columns).hint("rebalance", F.col(partition)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition).parquet(path)


PORTFOLIO_JSON_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("symbols", T.StringType()), T.StructField("weights", T.StringType()),
    T.StructField("strategy", T.StringType())])


def portfolio_rows(df: DataFrame) -> DataFrame:
    """S-27: parse the JSON-text symbol and weight arrays and explode them to holdings by position."""
    d = df.select("id", "name", "strategy",
                  F.from_json("symbols", T.ArrayType(T.StringType())).alias("s"),
                  F.from_json("weights", T.ArrayType(T.DoubleType())).alias("w"))
    return d.select("id", "name", "strategy",
                    F.posexplode(F.arrays_zip(F.col("s").alias("symbol"), F.col("w").alias("weight"))).alias("pos", "h")
                    ).select("id", "name", "strategy", (F.col("pos") + 1).alias("pos"), "h.symbol", "h.weight")


def apply_changes(current: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """S-28 / J-12: apply a change feed (op in insert / update / delete) in the order of its column ``sequence`` (one
    change per key if there is none): inserts add rows, updates overwrite the fields they carry (non-null), deletes remove
    the key, updates and deletes of unknown keys do nothing.  The changes of a key are folded to its last state by an
    aggregate, then joined once."""
    data_cols = [c for c in current.columns if c != key]
    seq = F.col("sequence") if "sequence" in changes.columns else F.lit(0)
    rank = F.struct(seq.alias("s"), F.col("op").alias("o"))
    # what came before the last insert or delete of a key no longer counts
    ch = changes.withColumn("_rank", rank)
    last = ch.where(F.col("op") != "update").groupBy(key).agg(F.max("_rank").alias("_reset"))
    ch = ch.join(last, key, "left").where(F.col("_reset").isNull() | (F.col("_rank") >= F.col("_reset")))
    newest = [F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(f"_n_{c}") for c in data_cols]
    folded = ch.groupBy(key).agg(F.max("_reset.o").alias("_reset"), F.max_by("op", "_rank").alias("_op"), *newest)
    j = current.withColumn("_old", F.lit(True)).join(folded, key, "full_outer")
    lives = F.when(F.col("_reset") == "insert", True).when(F.col("_reset") == "delete", False).otherwise(F.col("_old"))
    fresh = F.col("_reset") == "insert"
    return j.where(F.coalesce(lives, F.lit(False))).select(
        key, *[F.coalesce(F.col(f"_n_{c}"), F.when(F.coalesce(fresh, F.lit(False)), F.lit(None)).otherwise(F.col(c))).alias(c) for c in data_cols])


# fixed values: tolerance of the weights' sum, bounds of a weight and of the number of symbols
WEIGHT_TOLERANCE, WEIGHT_BOUNDS, SYMBOL_BOUNDS = 0.01, (0.01, 1.0), (1, 50)


def validated_portfolios(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S-28 with F-09 and F-10: (rows fit to be written, rejects with reasons) of portfolio writes.

    rows carries name and the JSON texts symbols and weights; rejects keep their columns and gain ``reasons``, all that apply:
    no_name, symbols_unreadable, weights_unreadable, length_mismatch, symbol_count, null_entry, weights_sum, weight_bounds.
    Weights of unreadable or unequal arrays are not judged further.  The two outputs share one pass."""
    symbols, weights = F.from_json("symbols", "array<string>"), F.from_json("weights", "array<double>")
    # JSON that is no array of the kind comes back as null or, inside an otherwise good array, as null entries
    d = rows.withColumns({"_s": symbols, "_w": weights})
    both = F.col("_s").isNotNull() & F.col("_w").isNotNull()
    fit = both & (F.size("_s") == F.size("_w"))
    null_in = F.exists("_s", lambda x: x.isNull()) | F.exists("_w", lambda x: x.isNull())
    whole = fit & ~F.coalesce(null_in, F.lit(False))
    total = F.aggregate("_w", F.lit(0.0), lambda a, x: a + x)
    checks = [("no_name", F.col("name").isNull() | (F.trim("name") == "")), ("symbols_unreadable", F.col("_s").isNull()),
              ("weights_unreadable", F.col("_w").isNull()), ("length_mismatch", both & ~fit), ("symbol_count", both & ~F.size("_s").between(*SYMBOL_BOUNDS)),
              ("null_entry", both & null_in), ("weights_sum", whole & (F.abs(total - 1.0) > WEIGHT_TOLERANCE)),
              ("weight_bounds", whole & F.exists("_w", lambda x: (x < WEIGHT_BOUNDS[0]) | (x > WEIGHT_BOUNDS[1])))]
    judged = d.withColumn("reasons", F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in checks)))).drop("_s", "_w")
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def history_entries(name: str, criteria: dict, result_count_df: DataFrame, at) -> DataFrame:
    """S-24: one history row (filter_name, filter_criteria JSON, result_count, created_at)."""
    crit = F.to_json(F.struct(*[F.lit(v if not isinstance(v, (list, tuple)) else list(v)).alias(k)
                                for k, v in sorted(criteria.items())]))
    return result_count_df.select(F.lit(name).alias("filter_name"), crit.alias("filter_criteria"),
                                  F.col("result_count").cast("bigint").alias("result_count"),
                                  F.lit(at).cast("timestamp").alias("created_at"))
