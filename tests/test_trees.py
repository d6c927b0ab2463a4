"""Tree models: cross-validation against folds fitted by hand, the stored pipeline, importances."""

import random
import statistics

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tickframe.operators import models as MD

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    r = random.Random(5)
    rows = []
    for k in range(300):
        a, b, c = r.random(), r.random(), r.random()
        rows.append(("s", k, a, b, c, (3.0 if a > 0.5 else 0.0) + 0.5 * b, k < 240, k // 48 if k < 240 else None))
    return spark.createDataFrame(rows, "symbol string, date int, a double, b double, c double, target double, is_train boolean, fold int").cache()


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_folds_and_stored_model(spark, frame, kind, tmp_path):
    train, test = frame.where("is_train"), frame.where("NOT is_train")
    pipe = MD.tree_pipeline(COLS, kind, rounds=4)
    model, mean, std = MD.cross_validated(train, pipe)
    r2 = RegressionEvaluator(labelCol="target", metricName="r2")
    by_hand = [r2.evaluate(pipe.fit(train.where(F.col("fold") != k)).transform(train.where(F.col("fold") == k))) for k in range(5)]
    assert mean == pytest.approx(statistics.fmean(by_hand), abs=0.02)
    assert std == pytest.approx(statistics.pstdev(by_hand), abs=0.02)
    want = {x.date: x.prediction for x in model.transform(test).collect()}
    got = {x.date: x.prediction for x in MD.score(test, MD.store_model(model, f"{tmp_path}/m")).collect()}
    assert got == want and len(got) == 60
    imp = {x.feature: x.importance for x in MD.tree_importance(spark, model, COLS, kind).collect()}
    assert set(imp) == set(COLS) and sum(imp.values()) == pytest.approx(1.0) and max(imp, key=imp.get) == "a"
