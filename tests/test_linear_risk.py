"""The linear score: its fit against plain numpy, its Shapley values against their definition, edge cases."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import explain, linear_risk
from quayside.operators.features import SUPPLIER_FEATURES

NAMES = list(SUPPLIER_FEATURES)


@pytest.fixture(scope="module")
def matrix(warehouse):
    return warehouse.supplier_matrix()


def test_fit_equals_numpy(matrix):
    model = linear_risk.train(matrix)
    rows = matrix.select(*NAMES, "target").toPandas().astype(float)
    x, y = rows[NAMES].to_numpy(), rows["target"].to_numpy()
    m0, m1 = x[y == 0].mean(0), x[y == 1].mean(0)
    within = ((x - np.where(y[:, None] == 1, m1, m0)) ** 2).mean(0)
    weights = np.divide(m1 - m0, within, out=np.zeros(len(within)), where=within > 1e-12)
    assert np.allclose(model.weights, weights) and np.allclose(model.means, x.mean(0))
    odds = (x - (m0 + m1) / 2) @ weights + np.log((y == 1).sum() / (y == 0).sum())
    scored = linear_risk.predict(model, matrix).select("probability_high").toPandas()["probability_high"]
    assert np.allclose(scored, 1 / (1 + np.exp(-odds)))


def test_values_are_shapley_values(matrix):
    model = linear_risk.train(matrix)
    few = matrix.orderBy("supplier_id").limit(3)
    rows = few.select(*NAMES).toPandas().astype(float).to_numpy()
    found = linear_risk.explain(model, few).orderBy("supplier_id").collect()
    m = 5  # the definition over the first inputs; the others only shift both sides of every difference
    weights, means = np.array(model.weights), np.array(model.means)
    for x, row in zip(rows, found):
        for j in range(m):
            value = 0.0
            others = [k for k in range(m) if k != j]
            for size in range(m):
                for known in combinations(others, size):
                    def payoff(subset):
                        return sum(weights[k] * ((x if k in subset else means)[k]) for k in range(m))
                    share = factorial(size) * factorial(m - size - 1) / factorial(m)
                    value += share * (payoff({*known, j}) - payoff(set(known)))
            assert abs(value - row.shap[j]) < 1e-9 * max(1, abs(weights[j] * means[j]))
        chance = row.probability_high
        assert abs(model.base + sum(row.shap) - np.log(chance / (1 - chance))) < 1e-6


def test_no_shuffle_of_the_matrix(matrix):
    plan = linear_risk.explain(linear_risk.train(matrix), matrix)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_one_class_missing_readings_and_constants(spark, matrix):
    ones = matrix.filter("target = 1")
    model = linear_risk.train(ones)
    assert set(model.weights) == {0.0}
    assert {r.probability_high for r in linear_risk.predict(model, ones).collect()} == {1.0}
    zeros = matrix.filter("target = 0")
    assert {r.probability_high for r in linear_risk.predict(linear_risk.train(zeros), zeros).collect()} == {0.0}
    holes = matrix.withColumn("reliability_score", F.when(F.col("target") == 1, F.col("reliability_score"))) \
        .withColumn("lead_time_days", F.lit(7))
    model = linear_risk.train(holes)
    assert model.weights[0] == 0.0 and model.weights[1] == 0.0
    wide = explain.shap_explanations(linear_risk.explain(model, holes))
    assert wide.filter(F.col("`Reliability Score`") != 0).count() == 0
    empty = linear_risk.explain(linear_risk.train(matrix.limit(0)), matrix.limit(0))
    assert empty.count() == 0


def test_repeated_rows_keep_their_weights(matrix):
    a, b = linear_risk.train(matrix), linear_risk.train(matrix.unionByName(matrix))
    assert np.allclose(a.weights, b.weights) and np.allclose(a.base, b.base)
