"""Supplier features and predictions on a 20-row fixture."""

import numpy as np
import pytest

from quayside.operators import features, risk_model

COLUMNS = (
    "supplier_id string, supplier_name string, country string, product_category string, risk_level string, "
    "reliability_score double, lead_time_days int, is_active boolean, annual_spend_usd double, total_shipments int, "
    "disrupted_shipments int, avg_delay_days double, max_delay_days int, disruption_rate_pct double")


def fixture_rows():
    rng = np.random.default_rng(42)
    countries = ["Kenya", "China", "India", "Italy", "Vietnam"]
    categories = ["Frames", "Prescription Lenses", "Sunglasses", "Cases", "Lens Coatings"]
    levels = ["LOW", "MEDIUM", "HIGH", "CRITICAL", "LOW"]
    return [(
        f"SUP-{i + 1:03d}", f"Supplier {i + 1}", countries[i % 5], categories[i % 5], levels[i % 5],
        round(float(rng.uniform(0.5, 1)), 2), int(rng.integers(7, 90)), i != 18,
        round(float(rng.uniform(1e4, 2e6)), 2), int(rng.integers(5, 50)), int(rng.integers(0, 10)),
        round(float(rng.uniform(0, 30)), 2), int(rng.integers(0, 60)), round(float(rng.uniform(0, 50)), 2),
    ) for i in range(20)]


@pytest.fixture(scope="module")
def suppliers(spark):
    return spark.createDataFrame(fixture_rows(), COLUMNS)


@pytest.fixture(scope="module")
def matrix(suppliers):
    return features.supplier_matrix(suppliers).cache()


@pytest.fixture(scope="module")
def scores(matrix):
    return risk_model.risk_scores(risk_model.train(matrix, trees=10), matrix, "2024-01-31T00:00:00").cache()


def test_codes_and_target(matrix):
    assert {"country_enc", "category_enc", "risk_enc", "is_active_int", "target"} <= set(matrix.columns)
    assert len(features.SUPPLIER_FEATURES) == 12
    rows = matrix.collect()
    assert {r.target for r in rows} <= {0, 1} and {r.is_active_int for r in rows} == {0, 1}
    assert all(r[c] is not None for r in rows for c in features.SUPPLIER_FEATURES)
    codes = {r.country: r.country_enc for r in rows}
    assert codes == {"China": 0, "India": 1, "Italy": 2, "Kenya": 3, "Vietnam": 4}
    for r in rows:
        assert r.target == int(r.disruption_rate_pct > 20 or r.risk_level in ("HIGH", "CRITICAL"))


def test_predictions(scores, suppliers):
    rows = scores.collect()
    assert len(rows) == suppliers.count() == len({r.supplier_id for r in rows})
    assert all(0 <= r.risk_probability <= 1 for r in rows)
    assert {r.risk_tier for r in rows} <= {"LOW", "MEDIUM", "HIGH", "CRITICAL"}
    assert {r.predicted_risk for r in rows} <= {0, 1}
    assert scores.columns == [*risk_model.SCORE_COLUMNS, "predicted_at"]


def test_integrity(suppliers):
    rows = suppliers.collect()
    assert len({r.supplier_id for r in rows}) == len(rows)
    assert all(0 <= r.reliability_score <= 1 and r.lead_time_days > 0 and 0 <= r.disruption_rate_pct <= 100
               for r in rows)


def test_split_takes_exact_shares(spark):
    df = spark.range(1000).selectExpr("cast(id as string) key", "cast(id % 10 = 0 as int) target")
    parts = features.stratified_split(df, "key", "target").groupBy("target", "is_test").count().collect()
    assert {(r.target, r.is_test): r["count"] for r in parts} == {
        (0, True): 225, (0, False): 675, (1, True): 25, (1, False): 75}


@pytest.mark.parametrize("counts,quotas", [
    ({"0": 5, "1": 5}, {"0": 2, "1": 1}), ({"0": 8}, {"0": 2}), ({"0": 3, "1": 1}, {"0": 1, "1": 0})])
def test_quotas(counts, quotas):
    assert features.class_quotas(counts, 0.25) == quotas


def test_ratios_and_reasons(spark):
    rows = [("all", 25, 100.0, 10, 10, 0.5, True), ("none", 0, 1.0, 10, 10, 0.9, False),
            ("zero", 0, 7.0, 0, 0, 0.9, False), ("null", 3, 1.0, 1, None, None, False)]
    df = features.shipment_ratios(spark.createDataFrame(
        rows, "shipment_id string, delay_days int, freight_cost_usd double, quantity_shipped int, "
              "supplier_lead_time int, reliability_score double, is_disrupted boolean"))
    got = {r.shipment_id: r for r in df.select(
        "*", features.reason_flags({"cost_per_unit": 9.0, "quantity_shipped": 9.0}).alias("reasons")).collect()}
    assert (got["zero"].cost_per_unit, got["zero"].delay_ratio, got["null"].delay_ratio) == (7.0, 0.0, None)
    assert got["all"].reasons == ("SEVERE_DELAY | HIGH_FREIGHT_COST | UNUSUALLY_LARGE_SHIPMENT | "
                                  "DELAY_EXCEEDS_LEAD_TIME_2X | LOW_RELIABILITY_DISRUPTION")
    assert got["zero"].reasons == "MULTIVARIATE_PATTERN" == got["null"].reasons
    assert got["none"].reasons == "UNUSUALLY_LARGE_SHIPMENT"


def test_metrics_by_hand(spark):
    rows = [(1, 1, 0.9)] * 3 + [(1, 0, 0.2)] + [(0, 1, 0.8)] * 2 + [(0, 0, 0.1)] * 4
    predicted = spark.createDataFrame(rows, "target int, predicted_risk int, probability_high double")
    cells = {(r.label, r.prediction): r.suppliers for r in risk_model.confusion_matrix(predicted).collect()}
    assert cells == {(0, 0): 4, (0, 1): 2, (1, 0): 1, (1, 1): 3}
    lines = {r.label: r for r in risk_model.classification_metrics(predicted).collect()}
    assert (lines["High Risk"].precision, lines["High Risk"].recall, lines["High Risk"].support) == (0.6, 0.75, 4)
    assert lines["accuracy"].f1_score == 0.7
    assert lines["macro avg"].recall == pytest.approx((4 / 6 + 0.75) / 2)
    assert lines["weighted avg"].precision == pytest.approx((0.8 * 6 + 0.6 * 4) / 10)
    # 24 pairs: 3 x 6 won by the 0.9 rows, 4 by the 0.2 row.
    assert risk_model.roc_auc(predicted).first().roc_auc == pytest.approx((18 + 4) / 24)
    assert risk_model.roc_auc(predicted.filter("target = 1")).count() == 0


def test_area_with_hot_ties_equals_pairs(spark):
    """Against all pairs, on scores of which one is shared by a third of the rows, over several range partitions."""
    import numpy as np

    rng = np.random.default_rng(8)
    score = np.where(rng.random(3_000) < 0.33, 0.5, rng.integers(0, 400, 3_000) / 400)
    target = (rng.random(3_000) < 0.2 + 0.5 * score).astype(int)
    rows = [(float(s), int(t)) for s, t in zip(score, target)] + [(None, 1), (0.3, None)]
    df = spark.createDataFrame(rows, "probability_high double, target int")
    high, low = score[target == 1], score[target == 0]
    expected = ((high[:, None] > low).sum() + 0.5 * (high[:, None] == low).sum()) / (len(high) * len(low))
    assert risk_model.roc_auc(df).first().roc_auc == pytest.approx(expected, abs=1e-12)
    assert risk_model.roc_auc(df.limit(0)).count() == 0
    same = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 0)], "probability_high double, target int")
    assert risk_model.roc_auc(same).first().roc_auc == 0.5
