"""M-15 .. M-24: asset clustering with Spark ML.

The feature table has one row per symbol.  K-means (best of ``n_init`` seeds by
training cost, k chosen by silhouette), bisecting k-means for the hierarchical
grouping, and DBSCAN as an exact grid-bucketed range self-join (cells of size eps
on two principal directions: points within eps differ by at most one cell there) followed
by connected components through iterative min-label propagation, checkpointed in
the shared checkpoint folder.  Silhouettes are exact (Euclidean distances of all
points, tile by tile; sums per point and cluster leave a task, never pairs);
Calinski-Harabasz from per-cluster sums.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.clean import median_fill
from tickframe.session import checkpoint_dir

# fixed values: clustering parameters of the reference
SEED, N_INIT, MAX_K = 42, 10, 10
DBSCAN_EPS, DBSCAN_MIN_SAMPLES = 0.5, 2


def scaled_features(features: DataFrame, cols, key: str = "symbol") -> DataFrame:
    """Median-filled (C-11) and standardised (population std, as sklearn) feature vectors."""
    f = median_fill(features, cols)
    va = VectorAssembler(inputCols=list(cols), outputCol="raw").transform(f)
    n = f.count()
    sc = StandardScaler(inputCol="raw", outputCol="_s", withMean=True, withStd=True).fit(va)
    # Spark scales by the sample std; sklearn by the population std: multiply by sqrt(n / (n - 1))
    factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    out = sc.transform(va).withColumn("x", F.transform(vector_to_array("_s"), lambda v: v * factor))
    return out.select(key, *cols, array_to_vector("x").alias("features"), "x")


def _fit(df: DataFrame, k: int, seed: int, method: str):
    if method == "kmeans":
        return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(df)
    return BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(df)


def search(df: DataFrame, n_rows: int, method: str = "kmeans", max_k: int = MAX_K, n_init: int = N_INIT,
           threads: int = 8):
    """M-16 + M-20: for every k in 2 .. min(10, n - 1) the best of ``n_init`` seeds by training
    cost, then the k with the best silhouette.  The independent fits are submitted as
    concurrent Spark jobs from a small thread pool.  Returns (k, model, silhouette)."""
    from concurrent.futures import ThreadPoolExecutor
    ks = list(range(2, min(max_k + 1, n_rows)))
    seeds = range(SEED, SEED + (n_init if method == "kmeans" else 1))
    grid = [(k, s) for k in ks for s in seeds]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        models = list(pool.map(lambda ks_: (ks_[0], _fit(df, ks_[0], ks_[1], method)), grid))
    best = {}
    for k, m in models:
        cost = m.summary.trainingCost
        if k not in best or cost < best[k][0]:
            best[k] = (cost, m)

    labelled = df
    for k in ks:
        labelled = best[k][1].copy().setPredictionCol(f"_k{k}").transform(labelled)
    scores = silhouette_scores(labelled, [f"_k{k}" for k in ks]).collect()  # one row per k, at most 9
    k, sil = max(((int(r.labelling[2:]), r.silhouette) for r in scores), key=lambda t: (t[1], -t[0]))
    return k, best[k][1], sil


def kmeans_best(df: DataFrame, k: int, n_init: int = N_INIT, seed: int = SEED):
    """M-16: best of ``n_init`` k-means|| runs by training cost."""
    best = None
    for i in range(n_init):
        m = _fit(df, k, seed + i, "kmeans")
        cost = m.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, m)
    return best[1]


def silhouettes(df: DataFrame, labellings, key: str = "symbol", x: str = "x", tile_rows: int = 2048) -> DataFrame:
    """M-19: exact Euclidean silhouette of every point under each of the label columns ``labellings``:
    (key, labelling, cluster, silhouette).

    ``key`` is unique and not null.  Points are dealt to tiles of about ``tile_rows`` by a hash of the key;
    every unordered pair of tiles is one group, which computes each distance once for all labellings and
    emits sums per (point, labelling, cluster) of the other tile.  A point alone in its cluster, or one whose
    two distances are both 0, has 0; with a single cluster there is no other one and every silhouette is 0.
    Points without a label take no part in that labelling.
    """
    labellings = list(labellings)
    pts = df.select(F.col(key).alias("_key"), F.col(x).alias("_x"),
                    F.array(*[F.col(c).cast("int") for c in labellings]).alias("_labels"))
    tiles = max(1, -(-pts.count() // tile_rows))
    tile = F.pmod(F.xxhash64("_key"), F.lit(tiles)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("_other")
    dealt = pts.select("*", tile.alias("_tile")).select("*", other)
    dealt = dealt.select("_key", "_x", "_labels", "_tile", F.least("_tile", "_other").alias("_lo"),
                         F.greatest("_tile", "_other").alias("_hi"))

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["_lo"].iloc[0]), int(pdf["_hi"].iloc[0])
        a, b = pdf[pdf["_tile"] == lo], pdf[pdf["_tile"] == hi]
        out = []
        if len(a) and len(b):
            xa, xb = (np.stack([np.asarray(v, float) for v in t["_x"]]) for t in (a, b))
            la, lb = ([[None if v is None or v != v else int(v) for v in r] for r in t["_labels"]] for t in (a, b))
            to_b, of_b = _one_hot(lb)
            to_a, of_a = _one_hot(la)
            sa, sb = np.zeros((len(a), to_b.shape[1])), np.zeros((len(b), to_a.shape[1]))
            step = max(1, (1 << 20) // len(b))
            for i in range(0, len(a), step):
                d = np.zeros((len(xa[i:i + step]), len(b)))
                for t in range(xa.shape[1]):
                    d += (xa[i:i + step, t, None] - xb[None, :, t]) ** 2
                d = np.sqrt(d)
                sa[i:i + step] = d @ to_b
                if lo != hi:
                    sb += d.T @ to_a[i:i + step]
            out.append(_long(a["_key"], sa, of_b))
            if lo != hi:
                out.append(_long(b["_key"], sb, of_a))
        out = [t for t in out if len(t)]
        return pd.concat(out) if out else pd.DataFrame({"_key": [], "l": [], "c": [], "s": []})

    kind = pts.schema["_key"].dataType.simpleString()
    part = dealt.groupBy("_lo", "_hi").applyInPandas(sums, f"_key {kind}, l INT, c INT, s DOUBLE")
    total = part.groupBy("_key", "l", "c").agg(F.sum("s").alias("s"))
    own = pts.select("_key", F.posexplode("_labels").alias("l", "own")).filter(F.col("own").isNotNull())
    size = own.groupBy("l", F.col("own").alias("c")).agg(F.count("*").alias("n"))
    d = total.join(size, ["l", "c"]).join(own, ["_key", "l"])
    is_own = F.col("c") == F.col("own")
    d = d.groupBy("_key", "l", "own").agg(
        F.max(F.when(is_own & (F.col("n") > 1), F.col("s") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~is_own, F.col("s") / F.col("n"))).alias("b"))
    sil = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    names = F.array(*[F.lit(c) for c in labellings])
    return d.select(F.col("_key").alias(key), F.element_at(names, F.col("l") + 1).alias("labelling"),
                    F.col("own").alias("cluster"),
                    F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise(sil).alias("silhouette"))


def _one_hot(labels):
    """0/1 columns for every (labelling, cluster) that occurs, and these pairs."""
    pairs = sorted({(i, c) for row in labels for i, c in enumerate(row) if c is not None})
    at = {p: k for k, p in enumerate(pairs)}
    hot = np.zeros((len(labels), len(pairs)))
    for r, row in enumerate(labels):
        for i, c in enumerate(row):
            if c is not None:
                hot[r, at[i, c]] = 1.0
    return hot, pairs


def _long(keys, sums, pairs) -> pd.DataFrame:
    n = len(keys)
    return pd.DataFrame({"_key": np.repeat(keys.to_numpy(), len(pairs)), "l": np.tile([p[0] for p in pairs], n),
                         "c": np.tile([p[1] for p in pairs], n), "s": sums.reshape(-1)})


def silhouette_scores(df: DataFrame, labellings, key: str = "symbol", x: str = "x") -> DataFrame:
    """M-19: the mean silhouette of each labelling."""
    return silhouettes(df, labellings, key, x).groupBy("labelling").agg(F.avg("silhouette").alias("silhouette"))


def calinski_harabasz(pred: DataFrame, dims: int) -> DataFrame:
    """M-19: between / within dispersion ratio from per-cluster sums (one row).

    Global means come from a window over the k cluster rows, weighted by size."""
    x = F.col("x")
    per = pred.groupBy("cluster").agg(F.count("*").alias("n_c"), *[F.avg(x[i]).alias(f"m{i}") for i in range(dims)])
    wc = (pred.join(per, "cluster").groupBy("cluster")
          .agg(F.sum(sum((x[i] - F.col(f"m{i}")) ** 2 for i in range(dims))).alias("w_c")))
    g = Window.partitionBy()
    pc = per.join(wc, "cluster").select(
        "n_c", "w_c", *[F.col(f"m{i}") for i in range(dims)],
        *[(F.sum(F.col("n_c") * F.col(f"m{i}")).over(g) / F.sum("n_c").over(g)).alias(f"g{i}") for i in range(dims)])
    r = pc.agg(F.sum(F.col("n_c") * sum((F.col(f"m{i}") - F.col(f"g{i}")) ** 2 for i in range(dims))).alias("b"),
               F.sum("w_c").alias("w"), F.sum("n_c").alias("n"), F.count("*").alias("k"))
    return r.select(((F.col("b") / (F.col("k") - 1)) / (F.col("w") / (F.col("n") - F.col("k")))).alias("calinski_harabasz"))


def profile(pred: DataFrame, cols, key: str = "symbol") -> DataFrame:
    """M-21 / M-23: members, size, feature mean and std per cluster, and 1 / size weights."""
    aggs = [F.array_sort(F.collect_list(key)).alias("assets"), F.count("*").cast("bigint").alias("size")]
    for c in cols:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    return pred.groupBy("cluster").agg(*aggs).withColumn("weight_per_asset", 1.0 / F.col("size"))


def centre_importance(model, cols, spark) -> DataFrame:
    """M-22: population std of the cluster centres per feature."""
    rows = [(c, float(v)) for ctr in model.clusterCenters() for c, v in zip(cols, ctr)]
    d = spark.createDataFrame(rows, "feature STRING, value DOUBLE")
    return d.groupBy("feature").agg(F.stddev_pop("value").alias("importance"))


def _plane(pts: DataFrame) -> DataFrame:
    """``pts`` with ``_p``: two coordinates whose differences never exceed the distance of two points: the leading
    principal directions, or the points themselves when they have no more than two dimensions."""
    size = pts.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    if size["n"] > 1 and size["d"] > 2:
        vec = pts.withColumn("_v", array_to_vector("x"))
        model = PCA(k=2, inputCol="_v", outputCol="_pc").fit(vec)
        return model.transform(vec).select(*pts.columns, vector_to_array("_pc").alias("_p"))
    return pts.withColumn("_p", F.array(*[F.coalesce(F.get("x", F.lit(i)), F.lit(0.0)) for i in (0, 1)]))


def dbscan(df: DataFrame, key: str = "symbol", eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES) -> DataFrame:
    """M-18 / J-11: labels 0.. in order of each cluster's first core point by key, noise -1.

    Candidates are points of neighbouring cells of a grid on the two leading principal directions, where the
    points spread most; the distance itself is exact.  The key is the id: no global numbering of points, only
    the clusters are ranked."""
    pts = df.select(F.col(key).alias("_id"), "x")
    width = eps * (1 + 1e-9)  # rounding of the projection must not part two points at a distance of just eps
    cells = _plane(pts).select("_id", "x", F.floor(F.col("_p")[0] / width).alias("_c0"), F.floor(F.col("_p")[1] / width).alias("_c1"))
    offsets = F.explode(F.expr("flatten(transform(array(-1, 0, 1), a -> transform(array(-1, 0, 1), "
                               "b -> named_struct('d0', a, 'd1', b))))")).alias("_d")
    probe = cells.select(F.col("_id").alias("a"), F.col("x").alias("xa"), "_c0", "_c1", offsets).select(
        "a", "xa", (F.col("_c0") + F.col("_d.d0")).alias("_c0"), (F.col("_c1") + F.col("_d.d1")).alias("_c1"))
    cand = probe.join(cells.select(F.col("_id").alias("b"), F.col("x").alias("xb"), "_c0", "_c1"), ["_c0", "_c1"])
    dist = F.sqrt(F.aggregate(F.zip_with("xa", "xb", lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, t: s + t))
    edges = cand.filter(dist <= eps).select("a", "b")
    deg = edges.groupBy("a").agg(F.count("*").alias("deg"))
    core = deg.filter(F.col("deg") >= min_samples).select(F.col("a").alias("_id"))
    ce = (edges.join(core.withColumnRenamed("_id", "a"), "a").join(core.withColumnRenamed("_id", "b"), "b")
          .select("a", "b"))
    checkpoint_dir(df.sparkSession)
    ce = ce.checkpoint()
    labels = core.select("_id", F.col("_id").alias("label")).checkpoint()
    while True:  # the least label among neighbours, then the label of that label: rounds grow with the logarithm of a chain
        prop = ce.join(labels.withColumnRenamed("_id", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        near = (labels.join(prop.withColumnRenamed("a", "_id"), "_id", "left")
                .select("_id", "label", F.least("label", F.coalesce("m", "label")).alias("near")))
        jump = near.select(F.col("_id").alias("near"), F.col("near").alias("far"))
        new = near.join(jump, "near").select("_id", "label", F.least("near", "far").alias("new")).checkpoint()
        changed = new.filter(F.col("label") != F.col("new")).limit(1).count()
        labels = new.select("_id", F.col("new").alias("label"))
        if not changed:
            break
    # border points: the smallest label among core neighbours
    border = (edges.join(labels.withColumnRenamed("_id", "b"), "b").groupBy("a")
              .agg(F.min("label").alias("blabel")).withColumnRenamed("a", "_id"))
    lab = pts.join(labels, "_id", "left").join(border, "_id", "left").select(
        F.col("_id").alias(key), F.coalesce("label", "blabel").alias("_root"))
    ranked = labels.select(F.col("label").alias("_root")).distinct().withColumn(
        "cluster", F.row_number().over(Window.orderBy("_root")) - 1)
    return lab.join(ranked, "_root", "left").select(key, F.coalesce("cluster", F.lit(-1)).cast("int").alias("cluster"))


def pca2(df: DataFrame, key: str = "symbol"):
    """M-24: two principal components of the centred, scaled features + explained variance."""
    m = PCA(k=2, inputCol="features", outputCol="pc").fit(df)
    out = m.transform(df).select(key, vector_to_array("pc").alias("pc"))
    return out.select(key, F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2")), [float(v) for v in m.explainedVariance]
