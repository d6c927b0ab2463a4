"""Bounded lookback of the moving averages, exact silhouettes."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tickframe.functions.ema import block_rows, lookback_blocks, with_ema, with_emas
from tickframe.operators import cluster as CL


def _series(spark, x):
    rows = [("A", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), v) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "symbol string, date timestamp, x double")


@pytest.mark.parametrize("span,block", [(9, 40), (26, 300), (9, None)])
def test_ema_over_many_blocks_equals_pandas(spark, span, block):
    rng = np.random.default_rng(5)
    x = (np.cumsum(rng.normal(size=9000)) + 200).tolist()
    for i in (0, 1, 39, 40, 41, 300, 8999):
        x[i] = None
    got = with_ema(_series(spark, x), "x", span, "e", block=block).orderBy("date").toPandas()["e"].to_numpy()
    exp = pd.Series(x, dtype=float).ewm(span=span, adjust=True).mean().to_numpy()
    ok = ~np.isnan(exp)
    assert np.allclose(got[ok], exp[ok], rtol=1e-11) and np.isnan(got[~ok].astype(float)).all()


def test_ema_carries_over_blocks_of_nulls(spark):
    x = [float(v) for v in range(1, 101)] + [None] * 400 + [7.0]
    got = with_ema(_series(spark, x), "x", 9, "e", block=50).orderBy("date").toPandas()["e"].to_numpy()
    exp = pd.Series(x, dtype=float).ewm(span=9, adjust=True).mean().to_numpy()
    assert np.allclose(got[:501], exp[:501], rtol=1e-9)


def test_lookback_does_not_grow_with_the_series():
    assert lookback_blocks(9, block_rows(9)) <= 5 and lookback_blocks(200, block_rows(200)) <= 5
    assert 0.8 ** (lookback_blocks(9, 40) * 40) == 0.0


def test_emas_share_one_sort(spark):
    plan = with_emas(_series(spark, [1.0, 2.0, 3.0]), "x", (9, 12, 26))._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if " Sort [" in line and "Exchange" not in line]
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Sort [") == 2, sorts  # by date for the row numbers, by block and date for all averages


def _plain_silhouettes(x, labels):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i, c in enumerate(labels):
        same = [j for j in range(len(x)) if labels[j] == c and j != i]
        others = [np.mean([d[i, j] for j in range(len(x)) if labels[j] == o]) for o in set(labels) - {c}]
        if not same or not others:
            out.append(0.0)
            continue
        a, b = np.mean(d[i, same]), min(others)
        out.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return out


@pytest.mark.parametrize("tile_rows", [7, 2048])
def test_silhouettes_equal_a_plain_count(spark, tile_rows):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3))
    x[10] = x[11]
    one = [int(v) for v in rng.integers(0, 3, 59)] + [9]  # 9 stands alone
    two = [int(v) for v in rng.integers(0, 2, 60)]
    same = [4] * 60
    df = spark.createDataFrame([(f"p{i}", x[i].tolist(), one[i], two[i], same[i]) for i in range(60)],
                               "symbol string, x array<double>, one int, two int, same int")
    got = {(r.labelling, r.symbol): r.silhouette for r in CL.silhouettes(df, ["one", "two", "same"], tile_rows=tile_rows).collect()}
    assert len(got) == 180
    for name, labels in (("one", one), ("two", two), ("same", same)):
        exp = _plain_silhouettes(x, labels)
        assert np.allclose([got[name, f"p{i}"] for i in range(60)], exp, atol=1e-12)


def test_silhouettes_of_no_points_and_of_missing_labels(spark):
    schema = "symbol string, x array<double>, c int"
    assert CL.silhouettes(spark.createDataFrame([], schema), ["c"]).count() == 0
    df = spark.createDataFrame([("a", [0.0], 0), ("b", [1.0], 0), ("c", [5.0], 1), ("d", [50.0], None)], schema)
    got = {r.symbol: r.silhouette for r in CL.silhouettes(df, ["c"]).collect()}
    assert got == pytest.approx({"a": 0.8, "b": 0.75, "c": 0.0})


@pytest.mark.parametrize("method", ["kmeans", "bisecting"])
def test_search_takes_the_best_exact_silhouette(spark, method):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.05, size=(6, 2)) for c in (0.0, 4.0, 9.0)])
    df = spark.createDataFrame([(f"p{i:02d}", x[i].tolist()) for i in range(len(x))], "symbol string, x array<double>")
    df = df.withColumn("features", array_to_vector("x")).cache()
    k, model, sil = CL.search(df, len(x), method, max_k=4, n_init=2)
    labels = {r.symbol: r.cluster for r in model.transform(df).select("symbol", "cluster").collect()}
    assert k == 3
    assert sil == pytest.approx(np.mean(_plain_silhouettes(x, [labels[f"p{i:02d}"] for i in range(len(x))])))
    df.unpersist()


def _plain_dbscan(x, eps, min_samples):
    near = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= min_samples
    label, free = np.full(len(x), -1), 0
    for i in range(len(x)):
        if not core[i] or label[i] >= 0:
            continue
        stack = [i]
        while stack:
            p = stack.pop()
            if label[p] < 0:
                label[p] = free
                if core[p]:
                    stack += list(np.flatnonzero(near[p] & (label < 0)))
        free += 1
    return label.tolist()


@pytest.mark.parametrize("dims,eps,min_samples", [(6, 0.9, 4), (1, 0.05, 3), (3, 0.5, 2)])
def test_dbscan_equals_a_plain_version(spark, dims, eps, min_samples):
    x = np.random.default_rng(8).normal(size=(80, dims))
    df = spark.createDataFrame([(f"p{i:03d}", x[i].tolist()) for i in range(80)], "symbol string, x array<double>")
    got = {r.symbol: r.cluster for r in CL.dbscan(df, eps=eps, min_samples=min_samples).collect()}
    assert [got[f"p{i:03d}"] for i in range(80)] == _plain_dbscan(x, eps, min_samples)


def test_dbscan_of_one_point_and_of_none(spark):
    schema = "symbol string, x array<double>"
    assert CL.dbscan(spark.createDataFrame([], schema)).count() == 0
    assert CL.dbscan(spark.createDataFrame([("a", [1.0, 2.0, 3.0])], schema)).collect()[0].cluster == -1
