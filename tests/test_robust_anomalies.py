"""Distances from the medians against numpy, ties, missing readings, constants and outliers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import robust_anomalies as R
from quayside.operators.anomalies import ANOMALY_COLUMNS

SCHEMA = ("shipment_id string, delay_days int, freight_cost_usd double, quantity_shipped int, cost_per_unit double, "
          "delay_ratio double")


def rows_of(n, seed=1):
    rng = np.random.default_rng(seed)
    cost, units = rng.gamma(2, 500, n).round(2), rng.integers(1, 50, n)
    delay = rng.poisson(3, n)
    return [(f"S{i:05d}", int(delay[i]), float(cost[i]), int(units[i]), round(float(cost[i]) / int(units[i]), 4),
             round(int(delay[i]) / 14, 4)) for i in range(n)]


def plain(rows):
    x = np.array([r[1:] for r in rows], float)
    mid = np.median(x, 0)
    scale = 1.4826 * np.median(abs(x - mid), 0)
    used = scale > 0
    return (abs(x - mid)[:, used] / scale[used]).sum(1) / max(1, used.sum())


def test_scores_equal_numpy(spark):
    rows = rows_of(3_001)
    flagged = R.flag(spark.createDataFrame(rows, SCHEMA)).orderBy("shipment_id").toPandas()
    distance = plain(rows)
    cut = np.quantile(distance, 0.95)
    assert np.allclose(flagged["anomaly_score"], cut - distance, atol=2e-6)
    assert abs(flagged["is_anomaly"].mean() - 0.05) < 0.001
    assert ((flagged["anomaly_label"] == -1) == flagged["is_anomaly"]).all()


def test_outliers_do_not_move_the_scale(spark):
    rows = rows_of(800)
    far = [(f"X{i}", 400, 9e7, 40_000, 5e5, 900.0) for i in range(30)]
    found = R.flag(spark.createDataFrame(rows + far, SCHEMA), contamination=0.03)
    caught = {r.shipment_id for r in found.filter("is_anomaly").collect()}
    assert len(caught & {r[0] for r in far}) == len(caught)  # only planted ones; equal rows tie at the cut-off
    scales = R.centres_and_spreads(spark.createDataFrame(rows + far, SCHEMA))
    clean = R.centres_and_spreads(spark.createDataFrame(rows, SCHEMA))
    assert all(abs(scales[m][1] - clean[m][1]) <= 0.2 * clean[m][1] + 1e-9 for m in R.MEASURES)


def test_missing_constant_and_empty(spark):
    rows = [(None, None, None, None, None, None), ("a", 1, 5.0, 2, 2.5, 0.1), ("a", 1, 5.0, 2, 2.5, 0.1),
            ("b", 1, 9.0, 2, 4.5, 0.1), ("c", 1, 7.0, 2, 3.5, None)]
    found = R.flag(spark.createDataFrame(rows, SCHEMA))
    assert found.count() == 5 and found.filter(F.col("anomaly_score").isNull()).count() == 0
    same = R.flag(spark.createDataFrame([("a", 1, 5.0, 2, 2.5, 0.1)] * 7, SCHEMA))
    assert same.filter("is_anomaly").count() == 0 and {r.anomaly_score for r in same.collect()} == {0.0}
    assert R.flag(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = R.flag(spark.createDataFrame([(None, None, None, None, None, None)], SCHEMA))
    assert nothing.filter("is_anomaly").count() == 0


def test_table_feeds_the_reports(warehouse):
    table = warehouse.robust_anomalies()
    assert tuple(table.columns) == ANOMALY_COLUMNS
    normal = table.filter("NOT is_anomaly").select("anomaly_reasons").distinct().collect()
    assert [r.anomaly_reasons for r in normal] == ["NORMAL"]
    worst = table.orderBy(F.desc("anomaly_severity")).first()
    assert worst.is_anomaly and worst.anomaly_severity == pytest.approx(1.0)
