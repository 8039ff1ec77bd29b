"""Scores from external signals: country indicators, weather, exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import tiers
from quayside.functions.rounding import half_even

# A day is flagged at or beyond these readings.
HEAVY_RAIN_MM = 20
STRONG_WIND_KMH = 50
EXTREME_HEAT_C = 38
EXTREME_COLD_C = -5
HEAVY_SNOW_CM = 5


# -- country indicators ----------------------------------------------------

def minmax_normalise(lpi: DataFrame) -> DataFrame:
    """Scale the index to 0..1 over all countries and invert it to a risk. Equal scores give 0."""
    ends = lpi.agg(F.min("lpi_score").alias("low"), F.max("lpi_score").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    scaled = F.coalesce((F.col("lpi_score") - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))
    return (
        lpi.withColumn("lpi_normalized", half_even(scaled, 3))
        .withColumn("logistics_risk_score", half_even(1 - F.col("lpi_normalized"), 3))
    )


def filter_supplier_countries(indicator: DataFrame, names: DataFrame) -> DataFrame:
    return indicator.join(names.select("country_name"), "country_name", "left_semi")


def country_risk_profile(lpi: DataFrame, gdp: DataFrame | None, names: DataFrame) -> DataFrame:
    """Normalised index rows of the supplier countries with income per head and a logistics tier."""
    rows = lpi.join(names.select("country_name", "our_country_name"), "country_name")
    if gdp is None:
        rows = rows.withColumn("gdp_per_capita_usd", F.lit(None).cast("double"))
    else:
        rows = rows.join(gdp.select("country_name", "gdp_per_capita_usd"), "country_name", "left")
    return rows.select(
        "country_code", "country_name", "lpi_score", "year", "lpi_normalized", "logistics_risk_score",
        "our_country_name", "gdp_per_capita_usd",
        tiers.LOGISTICS.of("logistics_risk_score").alias("logistics_risk_tier"),
    )


# -- weather -----------------------------------------------------------------

def weather_disruption_score(daily: DataFrame) -> DataFrame:
    """Flags, a 0 to 100 score and a tier per day."""
    flags = {
        "heavy_rain": F.col("precipitation_mm") >= HEAVY_RAIN_MM,
        "strong_wind": F.col("windspeed_kmh") >= STRONG_WIND_KMH,
        "extreme_heat": F.col("temp_max_c") >= EXTREME_HEAT_C,
        "extreme_cold": F.col("temp_min_c") <= EXTREME_COLD_C,
        "heavy_snow": F.col("snowfall_cm") >= HEAVY_SNOW_CM,
    }
    flagged = daily.withColumns({name: hit.cast("int") for name, hit in flags.items()})
    # The points of the flags, and of rain and wind on a scale up to a limit.
    score = (
        F.col("heavy_rain") * 30 + F.col("strong_wind") * 25 + F.col("extreme_heat") * 20
        + F.col("extreme_cold") * 20 + F.col("heavy_snow") * 25
        + F.least(F.col("precipitation_mm") / 5, F.lit(20.0)) + F.least(F.col("windspeed_kmh") / 10, F.lit(15.0))
    )
    return flagged.withColumn("weather_disruption_score", half_even(F.least(score, F.lit(100.0)), 2)).withColumn(
        "weather_risk_tier", tiers.WEATHER_DAY.of("weather_disruption_score"))


WINDOW_DAYS = 30


def last_days(rows: DataFrame, key: str, days: int) -> DataFrame:
    """The rows of the last days before each key's latest one; a key has one row per calendar day and place."""
    latest = F.max("date").over(Window.partitionBy(key))
    return rows.withColumn("_latest", latest).filter(
        F.col("date") >= F.date_sub("_latest", days)).drop("_latest")


def _mean(column: str):
    """Mean by way of a decimal sum, which is the same in any order. Readings have few decimals, so their mean
    often lies halfway between two rounded values, where the last bit of a sum of doubles would decide."""
    return F.sum(F.col(column).cast("decimal(28,10)")).cast("double") / F.count(column)


def weather_country_summary(scored: DataFrame, run_ts: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Means, maxima and day counts per country over its last days. The city is that of the earliest of them."""
    return (
        last_days(scored, "country", days).groupBy("country").agg(
            F.min_by("city", "date").alias("city"),
            half_even(_mean("weather_disruption_score"), 2).alias("avg_disruption_score"),
            half_even(F.max("weather_disruption_score"), 2).alias("max_disruption_score"),
            F.count_if(F.col("weather_risk_tier") == "SEVERE").alias("severe_days"),
            F.count_if(F.col("weather_risk_tier") == "WARNING").alias("warning_days"),
            half_even(_mean("precipitation_mm"), 2).alias("avg_precipitation_mm"),
            half_even(_mean("windspeed_kmh"), 2).alias("avg_windspeed_kmh"),
            F.count("date").alias("days_measured"),
        )
        .withColumn("country_weather_risk", tiers.WEATHER_COUNTRY.of("avg_disruption_score"))
        .withColumn("fetched_at", F.lit(run_ts))
    )


# -- exchange rates ------------------------------------------------------------

def fx_daily_returns(history: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Relative change from the day before, per currency, over its last days. A currency has one row per calendar day."""
    history = last_days(history, "currency_code", days)
    by_day = Window.partitionBy("currency_code").orderBy("date")
    before = F.lag("rate_vs_usd").over(by_day)
    return (
        history.withColumn("daily_return", F.col("rate_vs_usd") / F.nullif(before, F.lit(0.0)) - 1)
        .filter(F.col("daily_return").isNotNull())
        .select("date", "currency_code", "rate_vs_usd", "daily_return")
    )


def fx_first_last(history: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Rate at both ends of the last days and the change between them in percent."""
    ends = last_days(history, "currency_code", days).groupBy("currency_code").agg(
        F.min_by("rate_vs_usd", "date").alias("first_rate"), F.max_by("rate_vs_usd", "date").alias("last_rate"),
        F.count("*").alias("points"),
    )
    change = (F.col("last_rate") - F.col("first_rate")) / F.nullif("first_rate", F.lit(0.0)) * 100
    return ends.withColumn("pct_change_30d", half_even(change, 4))


def fx_volatility(current: DataFrame, history: DataFrame, run_ts: str, base: str = "USD") -> DataFrame:
    """Currency risk per country: size of the trend plus volatility of the daily returns."""
    spread = fx_daily_returns(history).groupBy("currency_code").agg(
        F.stddev_samp("daily_return").alias("spread"))
    # Too short a history, and the base currency, count as no movement.
    measured = (
        fx_first_last(history).filter(F.col("points") >= 2).filter(F.col("currency_code") != base)
        .join(spread, "currency_code", "left")
        .select(
            "currency_code", "first_rate", "pct_change_30d",
            half_even(F.coalesce("spread", F.lit(0.0)) * 100, 4).alias("daily_volatility_pct"),
        )
    )
    change, volatility = F.col("pct_change_30d"), F.col("daily_volatility_pct")
    scored = current.join(measured, "currency_code", "left").select(
        "country", "currency_code", F.col("rate_vs_usd").alias("current_rate_vs_usd"),
        F.coalesce("first_rate", "rate_vs_usd").alias("rate_30d_ago"),
        F.coalesce(change, F.lit(0.0)).alias("pct_change_30d"),
        F.coalesce(volatility, F.lit(0.0)).alias("daily_volatility_pct"),
    )
    score = F.least(F.lit(100.0), F.abs("pct_change_30d") * 2 + F.col("daily_volatility_pct") * 10)
    return (
        scored.withColumn("currency_risk_score", half_even(score, 2))
        .withColumn("currency_risk_tier", tiers.CURRENCY.of("currency_risk_score"))
        .withColumn("fetched_at", F.lit(run_ts))
    )


def filter_high_fx(volatility: DataFrame) -> DataFrame:
    return volatility.filter(F.col("currency_risk_tier").isin("HIGH", "CRITICAL"))
