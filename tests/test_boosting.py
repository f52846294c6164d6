"""Poisson trees: fit, both ways of summing, early stop, explanations against all subsets."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import boosting, models


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(3000):
        a, b, k = float(rng.normal()), float(rng.normal()), f"k{int(rng.integers(300))}"
        rows.append((i, a, None if i % 50 == 0 else b, k, float(rng.poisson(math.exp(0.8 * a + (1.0 if int(k[1:]) % 2 else 0.0)))), i % 5 == 0))
    return spark.createDataFrame(rows, "id bigint, price double, lag_1 double, sku_id string, units double, held boolean")


FEATURES = ["sku_id", "price", "lag_1"]
SMALL = {"rounds": 12, "max_depth": 3, "colsample_bytree": 1.0}


def test_trees_fit_rates(frame):
    model = models.boosted_trees(frame, FEATURES, validation="held")
    assert 10 < len(model.trees) < 500
    rows = model.predict(frame.where("held")).select("units", "prediction").toPandas()
    null = np.abs(rows.units - rows.units.mean()).sum()
    assert (rows.prediction > 0).all() and np.abs(rows.units - rows.prediction).sum() < 0.75 * null
    assert abs(rows.prediction.mean() / rows.units.mean() - 1) < 0.15
    assert dict(model.importances())["lag_1"] < 0.2


def test_both_ways_of_summing_grow_the_same_trees(frame, monkeypatch):
    here = models.boosted_trees(frame, FEATURES, params=SMALL, validation="held")
    monkeypatch.setattr(boosting, "LOCAL_CELLS", 0)
    monkeypatch.setattr(boosting, "REFRESH", 5)
    there = models.boosted_trees(frame, FEATURES, params=SMALL, validation="held")
    assert [(t.feature, t.cut) for t in here.trees] == [(t.feature, t.cut) for t in there.trees]
    assert np.allclose([t.leaves for t in here.trees], [t.leaves for t in there.trees])


def by_subsets(model, row):
    """Shapley values from their definition: a feature outside the set follows both branches by their covers."""

    def value(tree, node, known):
        if node >= len(tree.feature):
            return tree.leaves[node - len(tree.feature)]
        f, sides = tree.feature[node], (2 * node + 1, 2 * node + 2)
        if f in known:
            return value(tree, sides[int(row[f] > tree.cut[node])], known)
        return sum(tree.cover[s] / tree.cover[node] * value(tree, s, known) for s in sides if tree.cover[s])

    n = len(row)
    out = np.zeros(n)
    for tree in model.trees:
        worth = {s: value(tree, 0, set(s)) for k in range(n + 1) for s in itertools.combinations(range(n), k)}
        for i in range(n):
            for s in worth:
                if i not in s:
                    w = math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                    out[i] += w * (worth[tuple(sorted((*s, i)))] - worth[s])
    return out


def test_shapley_values_are_exact(frame):
    model = models.boosted_trees(frame, FEATURES, params=SMALL)
    codes = np.random.default_rng(3).integers(0, boosting.BINS, (40, 3)).astype(np.uint8)
    got = model.shap(codes)
    assert np.allclose(got, [by_subsets(model, r) for r in codes])
    assert np.allclose(got.sum(axis=1) + model.expected(), model.margin(codes))


def test_explanations_are_tables(frame):
    model = boosting.Trees.from_json(models.boosted_trees(frame, FEATURES, params=SMALL).to_json())
    sums = model.shap_values(frame.limit(50), ["id"]).groupBy("id").agg(F.sum("shap").alias("s")).join(model.predict(frame), "id").collect()
    assert len(sums) == 50 and all(abs(math.exp(r.s + model.expected()) / r.prediction - 1) < 1e-6 for r in sums)
    assert {r.feature: r.mean_abs_shap for r in model.shap_summary(frame).collect()}.keys() == set(FEATURES)


def test_search_covers_all_parameters(frame, monkeypatch):
    monkeypatch.setattr(models, "SEARCH_ROUNDS", {"rounds": 4, "stop": 2})
    found = models.param_search(frame.withColumn("week", F.col("id") % 20), FEATURES, trials=4, folds=2, rows=800)
    assert len(found) == 4 and [s for s, _ in found] == sorted(s for s, _ in found)
    assert len(found[0][1]) == 8 and found[0][1].keys() < boosting.DEFAULTS.keys()
