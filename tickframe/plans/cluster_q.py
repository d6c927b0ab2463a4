"""Clustering queries M-15 .. M-24 (feature table has an oracle; labels are checked by invariants)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import cluster as CL
from tickframe.plans.catalog import ORACLES, QUERIES, query  # noqa: F401
from tickframe.plans.common import materialise, oround, rounded

CLUSTER_FEATURES = ["mean_return", "volatility", "skewness", "kurtosis", "sharpe_like", "volatility_5d",
                    "volatility_20d", "volatility_60d", "volatility_of_volatility", "last_price_sma20_ratio",
                    "last_price_sma50_ratio", "avg_correlation", "max_correlation", "min_correlation",
                    "high_corr_count"]
PARTS = ["a17_asset_moments", "w21_volatility_profile", "w19_last_ratio_snapshot", "a18_correlation_features"]


def _m15_sql():
    subs = [f"({ORACLES[k]}) t{i}" for i, k in enumerate(PARTS)]
    j = subs[0] + "".join(f" JOIN {s} USING (symbol)" for s in subs[1:])
    return f"SELECT symbol, {', '.join(CLUSTER_FEATURES)} FROM {j}"


def cluster_features(spark, sf):
    """M-15: per-symbol moments (A-17), volatility profile (W-21), last price / SMA ratios (W-19)
    and correlation features (A-18) joined on the symbol -- all from one set of views, each
    part rounded as its own query is."""
    from tickframe.operators import matrices as M
    from tickframe.operators import windows as W
    from tickframe.operators.returns import with_returns
    from tickframe.plans.common import Views
    from tickframe.plans.windows_q import _ratios
    v = Views(spark, sf)
    r = with_returns(v.bars.select("symbol", "date", "close"), "close", out="r", ffill=False)
    parts = [
        rounded(M.moments(r), 9),
        rounded(W.vol_profile(r.withColumnRenamed("r", "returns")), 6),
        rounded(_ratios(v).groupBy("symbol").agg(F.max_by("price_sma20_ratio", "date").alias("last_price_sma20_ratio"),
                                                F.max_by("price_sma50_ratio", "date").alias("last_price_sma50_ratio"))),
        rounded(M.correlation_features(M.covariance(r)), 9)]
    out = parts[0]
    for d in parts[1:]:
        out = out.join(d, "symbol")
    return out.select("symbol", *CLUSTER_FEATURES).withColumn("high_corr_count", F.col("high_corr_count").cast("double"))


def m15(spark, sf):
    return cluster_features(spark, sf)


def register():
    """The feature oracle joins the oracles of its four parts, so it is built after them."""
    if "m15_cluster_features" not in QUERIES:
        query("m15_cluster_features", _m15_sql())(m15)
        query("m19_silhouette_of_bands", oround(_m19_sql(), ["silhouette"]))(m19)
        query("m18_dbscan", _m18_sql(0.5, 2))(m18)
        query("m18_dbscan_wide", _m18_sql(2.5, 3))(m18_wide)


def _prepared(spark, sf):
    f = materialise(cluster_features(spark, sf))
    return materialise(CL.scaled_features(f, CLUSTER_FEATURES)), f.count()


def m19(spark, sf):
    """M-19: exact silhouette of every symbol in bands of scaled volatility (below -0.5, below 0.5, the rest)."""
    x, _ = _prepared(spark, sf)
    z = F.col("x")[CLUSTER_FEATURES.index("volatility")]
    banded = x.withColumn("band", F.when(z < -0.5, 0).when(z < 0.5, 1).otherwise(2))
    return rounded(CL.silhouettes(banded, ["band"]).select("symbol", F.col("cluster").alias("band"), "silhouette"))


def _m19_sql():
    fs = CLUSTER_FEATURES
    gap = " + ".join(f"POWER(p.{c} - q.{c}, 2)" for c in fs)
    return f"""
WITH f AS ({_m15_sql()}),
med AS (SELECT {', '.join(f'MEDIAN({c}) AS {c}' for c in fs)} FROM f),
g AS (SELECT f.symbol, {', '.join(f'COALESCE(f.{c}, med.{c}) AS {c}' for c in fs)} FROM f, med),
z AS (SELECT symbol, {', '.join(f'COALESCE(({c} - AVG({c}) OVER ()) / NULLIF(STDDEV_POP({c}) OVER (), 0), 0) AS {c}' for c in fs)} FROM g),
b AS (SELECT *, CASE WHEN volatility < -0.5 THEN 0 WHEN volatility < 0.5 THEN 1 ELSE 2 END AS band FROM z),
d AS (SELECT p.symbol, p.band, q.band AS c, SUM(SQRT({gap})) AS s, COUNT(*) AS n FROM b p, b q GROUP BY p.symbol, p.band, q.band),
ab AS (SELECT symbol, band, MAX(CASE WHEN c = band AND n > 1 THEN s / (n - 1) END) AS own,
              MIN(CASE WHEN c <> band THEN s / n END) AS other FROM d GROUP BY symbol, band)
SELECT symbol, band, CASE WHEN own IS NULL OR other IS NULL OR GREATEST(own, other) = 0 THEN 0.0
                          ELSE (other - own) / GREATEST(own, other) END AS silhouette FROM ab"""


WIDE_EPS = 2.5  # at the reference's 0.5 the scaled features leave nearly every symbol noise


def m18_wide(spark, sf):
    """M-18 / J-11 with a distance wide enough for clusters, border points and noise."""
    x, _ = _prepared(spark, sf)
    return CL.dbscan(x, eps=WIDE_EPS, min_samples=3)


def _m18_sql(eps, least):
    fs = CLUSTER_FEATURES
    gap = " + ".join(f"POWER(p.{c} - q.{c}, 2)" for c in fs)
    return f"""
WITH RECURSIVE f AS ({_m15_sql()}),
med AS (SELECT {', '.join(f'MEDIAN({c}) AS {c}' for c in fs)} FROM f),
g AS (SELECT f.symbol, {', '.join(f'COALESCE(f.{c}, med.{c}) AS {c}' for c in fs)} FROM f, med),
z AS (SELECT symbol, {', '.join(f'COALESCE(({c} - AVG({c}) OVER ()) / NULLIF(STDDEV_POP({c}) OVER (), 0), 0) AS {c}' for c in fs)} FROM g),
e AS (SELECT p.symbol AS a, q.symbol AS b FROM z p, z q WHERE SQRT({gap}) <= {eps}),
core AS (SELECT a AS symbol FROM e GROUP BY a HAVING COUNT(*) >= {least}),
reach AS (SELECT symbol AS a, symbol AS b FROM core
          UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a JOIN core c ON c.symbol = e.b),
root AS (SELECT a AS symbol, MIN(b) AS root FROM reach GROUP BY a),
number AS (SELECT root, ROW_NUMBER() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM root) d),
own AS (SELECT z.symbol, COALESCE(MAX(r.root), MIN(near.root)) AS root FROM z LEFT JOIN root r ON r.symbol = z.symbol
        LEFT JOIN e ON e.a = z.symbol LEFT JOIN root near ON near.symbol = e.b GROUP BY z.symbol)
SELECT own.symbol, CAST(COALESCE(n.cluster, -1) AS INTEGER) AS cluster FROM own LEFT JOIN number n ON n.root = own.root"""


@query("m16_kmeans")
def m16(spark, sf):
    """M-16 + M-19 + M-20: k-means with k chosen by silhouette, labels with the fit's metrics."""
    x, n = _prepared(spark, sf)
    k, m, sil = CL.search(x, n)
    p = m.transform(x)
    ch = CL.calinski_harabasz(p, len(CLUSTER_FEATURES)).first()[0]
    return rounded(p.select("symbol", F.col("cluster").cast("int").alias("cluster"), F.lit(k).alias("k"),
                            F.lit(sil).alias("silhouette"), F.lit(ch).alias("calinski_harabasz")), 9)


@query("m17_hierarchical_bisecting")
def m17(spark, sf):
    """M-17 (re-aimed): top-down bisecting k-means in place of Ward linkage."""
    x, n = _prepared(spark, sf)
    k, m, _ = CL.search(x, n, method="bisecting")
    p = m.transform(x)
    return p.select("symbol", F.col("cluster").cast("int").alias("cluster"), F.lit(k).alias("k"))


def m18(spark, sf):
    """M-18: density clusters (eps 0.5, min 2 points with self), noise -1."""
    x, _ = _prepared(spark, sf)
    return CL.dbscan(x)


@query("m21_cluster_profile")
def m21(spark, sf):
    """M-21 + M-23: members, size, feature means / stds and 1 / size weights per k-means cluster."""
    x, n = _prepared(spark, sf)
    p = CL.search(x, n)[1].transform(x)
    return rounded(CL.profile(p, CLUSTER_FEATURES), 9)


@query("m22_centre_importance")
def m22(spark, sf):
    """M-22: spread (population std) of the k-means centres per feature."""
    x, n = _prepared(spark, sf)
    return rounded(CL.centre_importance(CL.search(x, n)[1], CLUSTER_FEATURES, spark), 9)


@query("m24_pca_projection")
def m24(spark, sf):
    """M-24: two principal components of the standardised (centred) features + explained variance."""
    x, _ = _prepared(spark, sf)
    proj, ev = CL.pca2(x)
    return rounded(proj.withColumn("explained_variance_1", F.lit(ev[0])).withColumn("explained_variance_2", F.lit(ev[1])), 9)
