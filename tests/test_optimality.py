"""The optimality checks say no to weights and coefficients that are near the best ones but not them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators import models as MD
from tickframe.operators import optimize as O


def test_weights(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4)) * [1, 2, 3, 4] * 0.01 + [0.002, 0.001, 0.003, -0.004]
    cov, mean, names = np.cov(x.T), x.mean(axis=0), "abcd"
    c = spark.createDataFrame([("p", names[i], names[j], float(cov[i, j])) for i in range(4) for j in range(4)], "g string, symbol_a string, symbol_b string, covariance double")
    m = spark.createDataFrame([("p", names[i], float(mean[i])) for i in range(4)], "g string, symbol string, expected_return double")
    w = None
    for method in ("max_sharpe", "min_variance", "risk_parity"):
        s = O.optimise(c, m, "g", method)
        w = s if w is None else w.unionByName(s)
    w = w.cache()
    assert [r.optimal for r in O.optimality(w, c, m, "g").collect()] == [True] * 3
    moved = w.withColumn("weight", F.col("weight") + F.when(F.col("symbol") == "a", -0.01).when(F.col("symbol") == "b", 0.01).otherwise(0.0))
    assert [r.optimal for r in O.optimality(moved, c, m, "g").collect()] == [False] * 3


@pytest.mark.parametrize("model", ["linear", "ridge", "lasso", "elastic"])
def test_coefficients(spark, model):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    y = x @ [1.5, -0.5, 0.01] + rng.normal(size=60) * 0.1
    d = spark.createDataFrame([("s", *map(float, r), float(t)) for r, t in zip(x, y)], "symbol string, a double, b double, c double, target double")
    coefs = MD.fit(MD.gram(d, ["a", "b", "c"], ["symbol"]), ["a", "b", "c"], ["symbol"], model).cache()
    assert [r.optimal for r in MD.optimality(d, coefs, ["a", "b", "c"], model).collect()] == [True]
    moved = coefs.withColumn("coef", F.transform("coef", lambda v: v + 0.001))
    assert [r.optimal for r in MD.optimality(d, moved, ["a", "b", "c"], model).collect()] == [False]
