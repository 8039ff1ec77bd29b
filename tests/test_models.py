"""Explanations and anomalies against brute force and stated properties."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import anomalies, explain, features, risk_model
from test_features import COLUMNS, fixture_rows


@pytest.fixture(scope="module")
def trained(spark):
    matrix = features.supplier_matrix(spark.createDataFrame(fixture_rows(), COLUMNS)).cache()
    return risk_model.train(matrix, trees=5), matrix


def known_value(leaves, x, known):
    """Value of the trees when only some inputs are known, leaf by leaf."""
    total = 0.0
    for i, value in enumerate(leaves["value"]):
        for j, feature in enumerate(leaves["feature"][i]):
            if feature < 0:
                continue
            if feature in known:
                value *= leaves["low"][i, j] < x[feature] <= leaves["high"][i, j]
            else:
                value *= leaves["share"][i, j]
        total += value
    return total


def test_shapley_values_match_the_definition(spark, trained):
    model, _ = trained
    leaves = explain.leaf_table(spark, model, risk_model.DEPTH)
    used = sorted({int(f) for f in leaves["feature"].ravel() if f >= 0})[:5]
    keep = np.isin(leaves["feature"], [*used, -1]).all(axis=1)
    leaves = {name: values[keep] for name, values in leaves.items()}
    x = np.random.default_rng(0).uniform(0, 50, (3, 12))
    got = explain.shapley_values(x, leaves)
    for row, values in zip(x, got):
        expected = np.zeros(12)
        orders = list(permutations(used))
        for order in orders:
            known: set[int] = set()
            for feature in order:
                before = known_value(leaves, row, known)
                known.add(feature)
                expected[feature] += known_value(leaves, row, known) - before
        assert np.allclose(values, expected / len(orders))


def test_attributions_add_up_to_the_log_odds(spark, trained):
    model, matrix = trained
    base = explain.base_value(explain.leaf_table(spark, model, risk_model.DEPTH))
    rows = explain.explain(model, matrix, risk_model.DEPTH).collect()
    assert len(rows) == 20
    for r in rows:
        assert base + sum(r.shap) == pytest.approx(np.log(r.probability_high / (1 - r.probability_high)), abs=1e-6)


def test_drivers_and_text(spark):
    shap = [0.0] * 12
    shap[3], shap[1], shap[7], shap[5] = -0.5, 0.5, 0.25, 0.2
    df = spark.createDataFrame([("S", "N", "LOW", 0.1, shap), ("Z", "N", "LOW", 0.1, [0.0] * 12)],
                               "supplier_id string, supplier_name string, risk_tier string, risk_probability double, "
                               "shap array<double>")
    row, zero = explain.shap_explanations(df).orderBy("supplier_id").collect()
    assert (row.top_risk_driver, row.top_driver_impact) == ("Lead Time (Days)", 0.5)
    assert row.explanation == ("Lead Time (Days) increases risk by 0.500 | Annual Spend (USD) reduces risk by 0.500 | "
                               "Max Delay (Days) increases risk by 0.250")
    assert zero.top_risk_driver == "Reliability Score" and "Reliability Score reduces risk by 0.000" in zero.explanation


def shipment_rows(spark, n=3000):
    base = spark.range(n).select(
        F.concat(F.lit("H"), "id").alias("shipment_id"), F.lit("S1").alias("supplier_id"),
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 100.0).alias(c)
          for i, c in enumerate(features.SHIPMENT_FEATURES)], (F.col("id") % 100 == 0).alias("odd"))
    return base.withColumn("delay_days", F.when(F.col("odd"), 500.0).otherwise(F.col("delay_days")))


def test_isolation_forest_finds_the_odd_ones(spark):
    matrix = anomalies.number_rows(shipment_rows(spark))
    flagged = anomalies.isolation_forest(matrix, trees=60).cache()
    rows = flagged.collect()
    assert len(rows) == 3000
    assert sum(r.is_anomaly for r in rows) == 150
    assert all(r.is_anomaly == (r.anomaly_label == -1) for r in rows)
    odd = [r.anomaly_score for r in rows if r.odd]
    assert np.mean(odd) < np.quantile([r.anomaly_score for r in rows], 0.05)
    severe = anomalies.anomaly_severity(flagged).agg(
        F.min("anomaly_severity").alias("low"), F.max("anomaly_severity").alias("high")).first()
    assert (severe.low, severe.high) == (0.0, 1.0)


def test_forest_is_repeatable(spark):
    matrix = anomalies.number_rows(shipment_rows(spark, 500))
    one, two = (sorted((r.shipment_id, r.anomaly_score) for r in anomalies.isolation_forest(matrix, trees=10).collect())
                for _ in range(2))
    assert one == two


def test_scores_follow_the_paths():
    """One tree, one split: the far point is alone after one step."""
    nodes = [dict(tree=0, node=0, feature=0, threshold=5.0, child=1, length=0.0),
             dict(tree=0, node=1, feature=-1, threshold=0.0, child=1, length=1 + anomalies.expected_path(7)),
             dict(tree=0, node=2, feature=-1, threshold=0.0, child=2, length=1.0)]
    scores = anomalies.isolation_scores(np.array([[1.0], [9.0]]), anomalies.pack_forest(nodes), 8)
    expected = [-2 ** -((1 + anomalies.expected_path(7)) / anomalies.expected_path(8)),
                -2 ** -(1 / anomalies.expected_path(8))]
    assert np.allclose(scores, expected)


@pytest.mark.parametrize("rows", [2000, 40_000])
def test_samples_have_the_wanted_size(spark, rows):
    numbered = spark.range(rows).withColumnRenamed("id", "row_number")
    drawn = anomalies.draw_samples(numbered, rows, trees=20, sample=64, seed=1).collect()
    per_tree = {t: [r.row_number for r in drawn if r.tree == t] for t in range(20)}
    assert {len(v) for v in per_tree.values()} == {64}
    assert all(len(set(v)) == 64 for v in per_tree.values())


def test_no_shipments(spark):
    matrix = anomalies.number_rows(shipment_rows(spark).limit(0))
    assert anomalies.isolation_forest(matrix).count() == 0


def test_equal_scores_have_no_severity(spark):
    flat = spark.createDataFrame([(0.1,), (0.1,)], "anomaly_score double")
    assert {r.anomaly_severity for r in anomalies.anomaly_severity(flat).collect()} == {0.0}


def test_repeated_shipment_ids_do_not_multiply(spark):
    df = spark.createDataFrame(
        [("H", True, 30, 0.0, 1, 0.0, 0.9, True), ("H", False, 1, 0.0, 1, 0.0, 0.9, False)],
        "shipment_id string, is_anomaly boolean, delay_days int, cost_per_unit double, quantity_shipped int, "
        "delay_ratio double, reliability_score double, is_disrupted boolean")
    out = anomalies.anomaly_reasons(df, {"cost_per_unit": 1.0, "quantity_shipped": 5.0}).collect()
    assert sorted(r.anomaly_reasons for r in out) == ["NORMAL", "SEVERE_DELAY"]


def test_one_sampling_law_at_every_size(spark):
    """Trees get their sample, and a row may join several trees, below and above the old size switch."""
    from pyspark.sql import functions as F

    from quayside.operators.anomalies import draw_samples

    trees, sample = 20, 16
    for rows in (10, 200, 600, 700, 5000):
        numbered = spark.range(rows).withColumnRenamed("id", "row_number")
        drawn = draw_samples(numbered, rows, trees, min(sample, rows), 1)
        per_tree = [r["count"] for r in drawn.groupBy("tree").count().collect()]
        assert len(per_tree) == trees and max(per_tree) <= sample
        assert sum(per_tree) >= 0.9 * trees * min(sample, rows)
        assert drawn.groupBy("tree", "row_number").count().filter(F.col("count") > 1).isEmpty()


def walked(row, forest, tree):
    at = 0
    while forest["child"][tree, at] != at:
        right = row[forest["feature"][tree, at]] > forest["threshold"][tree, at]
        at = forest["child"][tree, at] + right
    return forest["length"][tree, at]


def test_scores_equal_a_walk_through_every_tree():
    """Values at, beside and beyond the thresholds, and none at all; more rows than a chunk."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=5_100), rng.integers(0, 4, 5_100), np.full(5_100, 2.0)])
    x[0, 0], x[1, 0], x[2, 0] = np.nan, np.inf, -np.inf
    nodes = [dict(zip(("node", "feature", "threshold", "child", "length"), n), tree=t) for t in range(7)
             for n in anomalies._grow_tree(x[100 * t + 3:100 * t + 67], 6, np.random.default_rng(t))]
    forest = anomalies.pack_forest(nodes)
    x[3:3 + len(nodes), 0] = [n["threshold"] for n in nodes]
    scores = anomalies.isolation_scores(x, forest, 64)
    for i in [*range(0, 300), 5_099]:
        depth = sum(walked(x[i], forest, t) for t in range(7)) / 7
        assert scores[i] == pytest.approx(-2 ** (-depth / anomalies.expected_path(64)), abs=1e-12)


def test_a_large_table_is_not_dealt_out_and_no_table_is_written_twice(spark, warehouse, monkeypatch):
    """Above the limit the numbered rows come without an exchange by round robin, and keep only what the job reads; the
    writes of whole rows are the numbered ones and the scored ones."""
    from quayside.operators import robust_anomalies

    written = []

    def noting(df):
        written.append((df._jdf.queryExecution().toString(), df.columns))
        return session_cut(df)

    from quayside.session import cut_lineage as session_cut

    for module in (anomalies, robust_anomalies):
        monkeypatch.setattr(module, "cut_lineage", noting)
    enriched = warehouse.enriched_shipments()
    found = anomalies.shipment_anomalies(enriched, anomalies.DEALT_ROWS + 1)
    assert found.columns == list(anomalies.ANOMALY_COLUMNS) and found.count() == enriched.count()
    assert len(written) == 2 and not any("RoundRobin" in plan for plan, _ in written)
    assert all("annual_spend_usd" not in columns for _, columns in written)
    written.clear()
    anomalies.shipment_anomalies(enriched, 6_000)
    assert "RoundRobin" in written[0][0]
    written.clear()
    robust_anomalies.shipment_anomalies(enriched)
    assert len(written) == 1 and "annual_spend_usd" not in written[0][1]


def test_counting_passes_make_no_row_per_value(spark, monkeypatch):
    """Neither the bracket counts nor the dictionaries of a stored table go through a generator, which runs uncompiled."""
    from quayside.operators import encoding, order_statistics

    plans = []
    kind = type(spark.range(1))
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    df = spark.range(5_000).select((F.col("id") % 997).alias("a"), (F.col("id") * 0.5).alias("b"))
    found = order_statistics.exact_quantiles(df, {"a": (F.col("a"), 0.5), "b": (F.col("b"), 0.5)})
    assert found == {"a": 496.5, "b": 1249.75}
    assert plans and not any("Generate" in plan for plan in plans)
    texts = spark.createDataFrame([("x", None), ("x", "u"), (None, "v")], "p string, q string")
    values = encoding.distinct_values(texts, ["p", "q"], stored=True)
    assert "Generate" not in values._jdf.queryExecution().toString()
    assert sorted(map(tuple, values.collect())) == [("p", "x"), ("q", "u"), ("q", "v")]


def test_attributions_by_outcome_equal_the_sum_over_subsets(spark):
    """Few outcomes of a leaf are worked out once; many rows of one partition are dealt out before they are scored."""
    rng = np.random.default_rng(5)
    used = np.arange(4) < rng.integers(1, 5, 30)[:, None]
    feature = np.where(used, [rng.choice(12, 4, replace=False) for _ in range(30)], -1)
    leaves = {"value": rng.normal(size=30), "feature": feature,
              "low": np.where(used & (rng.random((30, 4)) < 0.5), -0.5, -np.inf),
              "high": np.where(used & (rng.random((30, 4)) < 0.5), 0.5, np.inf),
              "share": np.where(used, rng.random((30, 4)), 1.0)}
    x = rng.normal(size=(600, 12))
    values = explain.shapley_values(x, leaves)
    assert explain.leaf_effects(leaves).shape == (4, 16, 30)
    # Together they are what is known of a row beyond the base value.
    inside = (x[:, np.where(used, feature, 0)] > leaves["low"]) & (x[:, np.where(used, feature, 0)] <= leaves["high"])
    known = (leaves["value"] * (inside | ~used).all(axis=2)).sum(axis=1)
    assert np.allclose(values.sum(axis=1), known - explain.base_value(leaves))
