"""Demand series, forecasts and stockout risk."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import tiers
from quayside.functions.rounding import half_away, half_even
from quayside.session import by_key

HORIZON_DAYS = 90
SERIES = ["sku", "warehouse"]
_EPOCH = np.datetime64("1970-01-01")


def demand_daily(history: DataFrame) -> DataFrame:
    """Demand per day and series. A history that is summed and typed already is not exchanged again."""
    return (
        history.groupBy(F.to_date("date").alias("date"), *SERIES).agg(F.sum("demand").alias("demand"))
        .orderBy("sku", "warehouse", "date")
    )


def demand_coverage(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count("*").alias("records"), F.count_distinct("sku").alias("skus"),
        F.count_distinct("warehouse").alias("warehouses"),
    )


def inventory_by_sku_wh(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy(*SERIES).agg(
        F.sum("quantity_on_hand").alias("current_stock"), F.avg("reorder_point").alias("reorder_point"))


# -- forecasts -----------------------------------------------------------------

def forecast_trend_weekday(history: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Linear trend times a weekday index, for the days after each series' last one.

    Days without a row count as zero demand. Only sums over the rows that exist are needed: the sums over the
    day numbers 0..n-1 and the weekday counts are known in closed form, so the gaps are never filled in. One
    exchange on the series key, after map-side combine.
    """
    day = F.unix_date(F.to_date("date"))
    rows = history.select(*SERIES, day.alias("day"), "demand")
    sums = rows.groupBy(*SERIES).agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.sum("demand").alias("y"),
        F.sum(F.col("day") * F.col("demand")).alias("dy"),
        F.array(*[F.coalesce(F.sum(F.when(F.pmod("day", F.lit(7)) == w, F.col("demand"))), F.lit(0))
                  for w in range(7)]).alias("by_weekday"),
    )
    n = (F.col("last") - F.col("first") + 1).cast("double")
    ty = (F.col("dy") - F.col("first") * F.col("y")).cast("double")
    sum_t, sum_tt = n * (n - 1) / 2, (n - 1) * n * (2 * n - 1) / 6
    slope = F.coalesce(
        (n * ty - sum_t * F.col("y")) / F.nullif(n * sum_tt - sum_t * sum_t, F.lit(0.0)), F.lit(0.0))
    fitted = sums.withColumn("n", n).withColumn("slope", slope).withColumn(
        "intercept", (F.col("y") - F.col("slope") * sum_t) / F.col("n"))
    ahead = fitted.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).withColumn("future", F.col("last") + F.col("step")).withColumn("weekday", F.pmod("future", F.lit(7)))
    start = F.pmod(F.col("weekday") - F.pmod("first", F.lit(7)), F.lit(7))
    occurrences = F.floor((F.col("n") - 1 - start) / 7) + 1
    weekday_mean = F.get("by_weekday", F.col("weekday")) / F.nullif(occurrences, F.lit(0))
    index = F.coalesce(weekday_mean / F.nullif(F.col("y") / F.col("n"), F.lit(0.0)), F.lit(1.0))
    trend = F.greatest(F.lit(0.0), F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("step")))
    return ahead.select(
        F.date_from_unix_date("future").alias("ds"), half_even(trend * index, 1).alias("yhat"), *SERIES)


# A series is laid out day by day; a longer span than a century is a mistyped date.
MAX_DAYS = 36_525
# Candidate changes of the trend and the share of the history they lie in, the usual size of a change that the penalty
# expects (of the highest demand over the whole history), futures drawn for the interval.
CHANGES, HISTORY_SHARE, CHANGE_SCALE, FUTURES = 25, 0.8, 0.03, 500
_ROUNDS = 20


def refused_series(history: DataFrame) -> DataFrame:
    """Series that span more than ``MAX_DAYS``, with their first and last day: no forecast is made for them."""
    spans = history.groupBy(*SERIES).agg(F.min(F.to_date("date")).alias("first_date"), F.max(F.to_date("date")).alias("last_date"))
    days = F.datediff("last_date", "first_date") + 1
    return spans.withColumn("days", days).filter(F.col("days") > MAX_DAYS)


def _harmonics(day: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2 * np.pi * np.outer(day / period, np.arange(1, order + 1))
    return np.hstack([np.sin(angle), np.cos(angle)])


def _season(day: np.ndarray) -> np.ndarray:
    return np.hstack([_harmonics(day, 7.0, 3), _harmonics(day, 365.25, 10)])


def _trend_terms(t: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """A line, and a hinge per candidate change that adds to the slope after it. ``t`` is 0..1 over the history."""
    return np.column_stack([np.ones(len(t)), t, np.maximum(t[:, None] - changes, 0)])


def fit_trend(y: np.ndarray, season: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """A piecewise trend with a season that scales with it: change points, trend and season weights, noise variance.

    The slope changes carry an absolute-value penalty, which leaves most of them at zero; it is solved as a ridge whose
    weights follow the last solution. Season weights carry a plain ridge. Level and noise follow from round to round.
    """
    n = len(y)
    t = np.arange(n) / max(n - 1, 1)
    count = min(CHANGES, max(int(HISTORY_SHARE * n) - 1, 0))
    changes = t[np.linspace(0, int(HISTORY_SHARE * n) - 1, count + 1)[1:].astype(int)] if count else np.zeros(0)
    trend = _trend_terms(t, changes)
    weights = np.concatenate([np.linalg.lstsq(trend[:, :2], y, rcond=None)[0], np.zeros(count)])
    held = np.concatenate([[1e-9, 1e-9], np.full(count, CHANGE_SCALE)])
    noise = max(float(np.var(y - trend @ weights)), 1e-8)
    for _ in range(_ROUNDS):
        x = np.hstack([trend, (trend @ weights)[:, None] * season])
        ridge = np.concatenate([[1e-9, 1e-9], noise / CHANGE_SCALE / (held[2:] + 1e-6), np.full(season.shape[1], 1e-2)])
        found = np.linalg.solve(x.T @ x + np.diag(ridge), x.T @ y)
        weights, of_season = found[:2 + count], found[2 + count:]
        held = np.abs(weights)
        noise = max(float(np.mean((y - x @ found) ** 2)), 1e-8)
    return changes, weights, of_season, noise


def _fit_series(rows: pd.DataFrame, horizon: int) -> pd.DataFrame:
    """The forecast of one daily series with a 95 % interval; none where the span tells of a mistyped date.

    The interval holds what may happen to the trend: futures are drawn whose slope changes as often and as strongly as
    in the history, with the noise of the fit on top. The draws depend on the name of the series only. Changes are held
    back, so the interval is too narrow for a trend that bends much more strongly than it did: the tests measure it.
    """
    day = ((rows["date"].to_numpy(dtype="datetime64[D]") - _EPOCH) / np.timedelta64(1, "D")).astype(int)
    first, last = int(day.min()), int(day.max())
    sku, warehouse = rows["sku"].iloc[0], rows["warehouse"].iloc[0]
    if last - first >= MAX_DAYS:
        kinds = {"ds": "datetime64[ns]", **dict.fromkeys(("yhat", "yhat_lower", "yhat_upper"), "float64"),
                 **dict.fromkeys(SERIES, "object")}
        return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in kinds.items()})
    y = np.zeros(last - first + 1)
    np.add.at(y, day - first, rows["demand"].to_numpy(dtype=float))
    n, scale = len(y), max(y.max(), 1.0)
    past, future = np.arange(first, last + 1), np.arange(last + 1, last + 1 + horizon)
    changes, weights, of_season, noise = fit_trend(y / scale, _season(past))
    t = (future - first) / max(n - 1, 1)
    trend = _trend_terms(t, changes) @ weights
    season = 1 + _season(future) @ of_season

    # How uncertain the fitted terms are away from the data, each slope change taken to be of the usual size.
    size = float(np.sqrt(np.mean(weights[2:] ** 2) / 2)) if len(changes) else 0.0  # of a Laplace distribution
    x = np.hstack([_trend_terms(np.arange(n) / max(n - 1, 1), changes), _season(past)])
    ahead = np.hstack([_trend_terms(t, changes), _season(future)])
    held = np.concatenate([[1e-9, 1e-9], np.full(len(changes), noise / max(size, CHANGE_SCALE) ** 2),
                           np.full(x.shape[1] - len(weights), 1e-2)])
    leverage = np.einsum("ij,ji->i", ahead, np.linalg.solve(x.T @ x + np.diag(held), ahead.T)).clip(min=0)

    rng = np.random.default_rng(crc32(f"{sku}|{warehouse}".encode()))
    often = min(1.0, len(changes) / max(n * HISTORY_SHARE, 1))
    bends = rng.laplace(0, size + 1e-12, (FUTURES, horizon)) * (rng.random((FUTURES, horizon)) < often)
    drift = np.cumsum(np.cumsum(bends, axis=1), axis=1) / max(n - 1, 1)
    drawn = (trend + drift) * season + rng.standard_normal((FUTURES, horizon)) * np.sqrt(noise * (1 + leverage))
    yhat = trend * season
    low, high = np.minimum(np.quantile(drawn, 0.025, axis=0), yhat), np.maximum(np.quantile(drawn, 0.975, axis=0), yhat)
    return pd.DataFrame({
        "ds": (_EPOCH + future.astype("timedelta64[D]")).astype("datetime64[ns]"),
        "yhat": (yhat * scale).clip(min=0).round(1), "yhat_lower": (low * scale).clip(min=0).round(1),
        "yhat_upper": (high * scale).clip(min=0).round(1), "sku": sku, "warehouse": warehouse,
    })


def demand_forecast(history: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Forecast by a trend with change points, weekly and yearly terms, and a 95 % interval; series in parallel.

    Demand is summed by day before the series are gathered, so a group holds at most one row per calendar day
    however many orders lie behind it. The series of ``refused_series`` get no rows; the others are not affected.
    """
    daily = history.groupBy(F.to_date("date").alias("date"), *SERIES).agg(F.sum("demand").cast("double").alias("demand"))
    return by_key(daily, *SERIES).groupBy(*SERIES).applyInPandas(
        lambda rows: _fit_series(rows, horizon),
        "ds date, yhat double, yhat_lower double, yhat_upper double, sku string, warehouse string",
    )


# -- stockout --------------------------------------------------------------------

def forecast_summary(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy(*SERIES).agg(
        F.sum("yhat").alias("forecasted_demand_90d"), F.max("yhat").alias("peak_daily_demand"),
        F.avg("yhat").alias("avg_daily_demand"),
    )


def stockout_risk(forecast: DataFrame, inventory: DataFrame) -> DataFrame:
    """Days of stock left per series at the forecast pace, with a tier."""
    stock = inventory_by_sku_wh(inventory)
    joined = forecast_summary(forecast).join(stock, SERIES, "left")
    pace = F.when(F.col("avg_daily_demand") == 0, 1.0).otherwise(F.col("avg_daily_demand"))
    return (
        joined.select(
            *SERIES, "forecasted_demand_90d", "peak_daily_demand", "avg_daily_demand",
            F.coalesce("current_stock", F.lit(0)).alias("current_stock"),
            F.coalesce("reorder_point", F.lit(100.0)).alias("reorder_point"),
        )
        .withColumn("days_until_stockout", half_even(F.col("current_stock") / pace, 1))
        .withColumn("stockout_risk", tiers.STOCKOUT.of("days_until_stockout"))
        .withColumn("will_stockout_90d", F.col("days_until_stockout") < 90)
    )


def stockout_summary(risk: DataFrame) -> DataFrame:
    return (
        risk.groupBy("stockout_risk").agg(
            F.count("*").alias("combinations"),
            half_away(F.avg("days_until_stockout"), 1).alias("avg_days_to_stockout"),
            F.count_if("will_stockout_90d").alias("will_stockout"),
        ).orderBy(F.asc_nulls_last("avg_days_to_stockout"), "stockout_risk")
    )


def closest_to_stockout(risk: DataFrame, rows: int) -> DataFrame:
    return risk.orderBy(F.asc_nulls_last("days_until_stockout"), *SERIES).limit(rows)


def top5_stockout(risk: DataFrame) -> DataFrame:
    return closest_to_stockout(risk, 5).select(
        *SERIES, "current_stock", half_away("avg_daily_demand", 1).alias("avg_daily_demand"),
        "days_until_stockout", "stockout_risk")


def closest_stockout_10(risk: DataFrame) -> DataFrame:
    return closest_to_stockout(risk, 10).select(
        *SERIES, "current_stock", "avg_daily_demand", "days_until_stockout", "forecasted_demand_90d",
        "stockout_risk")
