import datetime as dt

import numpy as np
import pandas as pd
import pytest

from quayside.operators import demand

START = dt.date(2021, 1, 4)


def history(spark, values, sku="A", warehouse="W", start=START):
    rows = [((start + dt.timedelta(days=i)).isoformat(), sku, warehouse, int(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date string, sku string, warehouse string, demand int")


def test_trend_weekday_on_a_line(spark):
    rows = demand.forecast_trend_weekday(history(spark, [5] * 70)).orderBy("ds").collect()
    assert len(rows) == 90 and rows[0].ds == START + dt.timedelta(days=70)
    assert {r.yhat for r in rows} == {5.0}


def test_trend_weekday_fills_gaps_with_zero(spark):
    """Against a dense brute force, on a series with missing days."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 30, 100)
    y[rng.random(100) < 0.6] = 0
    y[0], y[-1] = 4, 9
    full = history(spark, y)
    sparse = full.filter("demand > 0")
    t = np.arange(100)
    slope, intercept = np.polyfit(t, y, 1)
    weekday = np.array([y[t % 7 == k].mean() for k in range(7)]) / y.mean()
    ahead = np.arange(100, 190)
    expected = np.round(np.maximum(0, intercept + slope * ahead) * weekday[ahead % 7], 1)
    rows = demand.forecast_trend_weekday(sparse).orderBy("ds").collect()
    assert np.allclose([r.yhat for r in rows], expected, atol=0.1001)
    assert np.mean(np.isclose([r.yhat for r in rows], expected)) > 0.98


def test_single_day_series(spark):
    rows = demand.forecast_trend_weekday(history(spark, [6])).collect()
    assert len(rows) == 90 and {r.yhat for r in rows} == {6.0}


def test_seasonal_forecast_properties(spark):
    days = np.arange(800)
    y = 50 + 0.02 * days + 10 * np.sin(2 * np.pi * days / 7)
    df = history(spark, y).union(history(spark, [3, 0, 7], sku="B"))
    rows = demand.demand_forecast(df).collect()
    assert len(rows) == 180
    assert all(0 <= r.yhat_lower <= r.yhat <= r.yhat_upper for r in rows)
    a = sorted((r.ds, r.yhat) for r in rows if r.sku == "A")
    ahead = np.arange(800, 890)
    truth = 50 + 0.02 * ahead + 10 * np.sin(2 * np.pi * ahead / 7)
    assert a[0][0] == START + dt.timedelta(days=800)
    assert np.abs(np.array([v for _, v in a]) - truth).mean() < 1.5


def forecast(spark, rows):
    return spark.createDataFrame(rows, "sku string, warehouse string, yhat double")


@pytest.mark.parametrize("yhat,stock,days,tier,soon", [
    ([0.0, 0.0], 5, 5.0, "CRITICAL", True), ([2.0, 2.0], 14, 7.0, "CRITICAL", True),
    ([2.0, 4.0], 40, 13.3, "HIGH", True), ([1.0, 1.0], 100, 100.0, "LOW", False)])
def test_stockout(spark, yhat, stock, days, tier, soon):
    inventory = spark.createDataFrame([("A", "W", stock, 20)],
                                      "sku string, warehouse string, quantity_on_hand int, reorder_point int")
    row = demand.stockout_risk(forecast(spark, [("A", "W", v) for v in yhat]), inventory).first()
    assert (row.days_until_stockout, row.stockout_risk, row.will_stockout_90d) == (days, tier, soon)


def test_stockout_without_inventory(spark):
    inventory = spark.createDataFrame([], "sku string, warehouse string, quantity_on_hand int, reorder_point int")
    row = demand.stockout_risk(forecast(spark, [("A", "W", 2.0)]), inventory).first()
    assert (row.current_stock, row.reorder_point, row.days_until_stockout, row.stockout_risk) == (0, 100.0, 0.0, "CRITICAL")


def test_yearly_terms_at_every_length():
    """The season is modelled below two years, too: one day more or less does not change the model."""
    rng, errors = np.random.default_rng(1), {}
    for n in (365, 729, 730):
        day = np.arange(n + 90)
        truth = 50 + 20 * np.sin(2 * np.pi * day / 365.25)
        rows = pd.DataFrame({"date": pd.Timestamp(2022, 1, 1) + pd.to_timedelta(day[:n], unit="D"), "sku": "s",
                             "warehouse": "w", "demand": truth[:n] + 5 * rng.standard_normal(n)})
        found = demand._fit_series(rows, 90)
        errors[n] = float(np.abs(found["yhat"] - truth[n:]).mean())
        width = (found["yhat_upper"] - found["yhat_lower"]).to_numpy()
        if n == 365:  # the interval widens away from the data
            assert width[-30:].mean() > width[:30].mean()
    assert errors[365] < 15 and errors[729] < 6 and abs(errors[730] - errors[729]) < 1.5, errors


def test_a_mistyped_date_is_reported_and_stops_nothing(spark):
    rows = history(spark, [3, 4, 5]).union(history(spark, [1, 2], sku="B"))
    typo = spark.createDataFrame([("2921-01-04", "B", "W", 7)], "date string, sku string, warehouse string, demand int")
    bad = rows.union(typo)
    assert [(r.sku, r.last_date, r.days > 300_000) for r in demand.refused_series(bad).collect()] == [
        ("B", dt.date(2921, 1, 4), True)]
    assert demand.refused_series(rows).count() == 0
    assert {r.sku for r in demand.demand_forecast(bad).collect()} == {"A"}


def series(values, sku="s"):
    days = pd.Timestamp(2022, 1, 1) + pd.to_timedelta(np.arange(len(values)), unit="D")
    return pd.DataFrame({"date": days, "sku": sku, "warehouse": "w", "demand": values})


def test_a_kink_is_followed():
    """A trend that turns after two thirds of the history goes on with its new slope."""
    rng = np.random.default_rng(4)
    day = np.arange(690)
    truth = np.where(day < 400, 40 + 0.3 * day, 160 - 0.35 * (day - 400)) * (1 + 0.1 * np.sin(2 * np.pi * day / 7))
    found = demand._fit_series(series(truth[:600] + 3 * rng.standard_normal(600)), 90)
    error = np.abs(found["yhat"].to_numpy() - truth[600:].clip(min=0))
    assert error.mean() < 9
    line = np.polyval(np.polyfit(day[:600], truth[:600], 1), day[600:])
    assert error.mean() < 0.3 * np.abs(line - truth[600:]).mean()
    changes, weights, _, _ = demand.fit_trend(truth[:600] / truth[:600].max(), demand._season(day[:600]))
    assert np.abs(weights[2:]).max() > 0.5 and (np.abs(weights[2:]) < 0.05).sum() >= len(changes) // 2


def test_a_line_keeps_its_slope():
    rng = np.random.default_rng(9)
    day = np.arange(590)
    truth = 30 + 0.1 * day
    found = demand._fit_series(series(truth[:500] + 2 * rng.standard_normal(500)), 90)
    assert np.abs(found["yhat"].to_numpy() - truth[500:]).mean() < 5


def test_coverage_of_the_interval():
    """Days to come lie in the 95 % interval about that often where the trend goes on, less often where it bends."""
    lines = []
    for seed in range(12):
        y = 30 + 0.1 * np.arange(590) + 3 * np.random.default_rng(seed).standard_normal(590)
        found = demand._fit_series(series(y[:500], sku=str(seed)), 90)
        lines.append(((y[500:] >= found["yhat_lower"]) & (y[500:] <= found["yhat_upper"])).mean())
    assert 0.92 <= np.mean(lines) <= 0.98, lines
    inside = []
    for seed in range(24):
        rng = np.random.default_rng(seed)
        bends = np.zeros(590)
        bends[rng.integers(50, 590, 6)] = rng.laplace(0, 0.02, 6)
        truth = np.maximum(60 + np.cumsum(0.05 + np.cumsum(bends)), 0)
        y = np.maximum(truth + 5 * rng.standard_normal(590), 0)
        found = demand._fit_series(series(y[:500], sku=str(seed)), 90)
        inside.append(((y[500:] >= found["yhat_lower"]) & (y[500:] <= found["yhat_upper"])).mean())
    assert 0.85 <= np.mean(inside) <= 1.0, inside


def test_forecast_is_repeatable():
    rows = series(np.arange(200) % 9 + 5.0)
    assert demand._fit_series(rows, 30).equals(demand._fit_series(rows.iloc[::-1].reset_index(drop=True), 30))


def test_one_exchange_to_daily_demand(warehouse):
    """The history is grouped by the keys of the daily demand, which is summed without another exchange."""
    plan = demand.demand_daily(warehouse.demand_history())._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "key" not in line]
    assert len(grouped) == 1, plan
