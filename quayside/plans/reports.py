"""Monitoring reports over staged tables, marts and stored predictions.

Fixed values: the columns that each report shows, and their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.rounding import half_even


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first. Null is not a value."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )


def _one_row(spark_of: DataFrame, columns: list[Column]) -> DataFrame:
    """A row of scalars that come from different tables, without joining them."""
    return spark_of.sparkSession.range(1).select(*columns)


def _disruption_pct() -> Column:
    return half_even(F.count_if("is_disrupted") / F.nullif(F.count("*"), F.lit(0)) * 100, 1)


# -- overview ----------------------------------------------------------------

def kpi_overview(suppliers: DataFrame, shipments: DataFrame, inventory: DataFrame,
                 scores: DataFrame | None = None) -> DataFrame:
    """Head counts, disruption rate and stock alerts; with scores, also the suppliers in the top tier."""
    counted = suppliers.agg(F.count("*").alias("n"), F.count_if("is_active").alias("active"))
    alerts = inventory.agg(
        F.count_if(F.col("stock_status") == "STOCKOUT").alias("stockouts"),
        F.count_if(F.col("stock_status").isin("STOCKOUT", "CRITICAL")).alias("alerts"))
    columns = [
        counted.select("n").scalar().alias("total_suppliers"),
        counted.select("active").scalar().alias("active_suppliers"),
        shipments.agg(_disruption_pct().alias("pct")).scalar().alias("disruption_pct"),
        alerts.select("stockouts").scalar().alias("stockouts"),
        alerts.select("alerts").scalar().alias("stock_alerts"),
    ]
    if scores is not None:
        critical = scores.agg(F.count_if(F.col("risk_tier") == "CRITICAL").alias("n"))
        columns.insert(2, critical.scalar().alias("critical_suppliers"))
    return _one_row(suppliers, columns)


# -- supplier risk -------------------------------------------------------------

def filter_tier_country(scores: DataFrame, tier_column: str, tiers_kept: list[str],
                        countries: list[str]) -> DataFrame:
    """Both filters apply; an empty list does not filter."""
    if tiers_kept:
        scores = scores.filter(F.col(tier_column).isin(*tiers_kept))
    if countries:
        scores = scores.filter(F.col("country").isin(*countries))
    return scores


def risk_scatter(filtered: DataFrame) -> DataFrame:
    return filtered.select(
        "disruption_rate_pct", "risk_probability", "risk_tier", "total_shipments", "supplier_name", "country",
        "product_category", "avg_delay_days")


def risk_table(filtered: DataFrame) -> DataFrame:
    return filtered.select(
        "supplier_id", "supplier_name", "country", "product_category", "risk_tier", "risk_probability",
        "disruption_rate_pct", "avg_delay_days", "total_shipments")


def filter_options(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


# -- shipments -------------------------------------------------------------------

def kpi_shipments(shipments: DataFrame, anomalies: DataFrame | None = None) -> DataFrame:
    counted = shipments.agg(
        F.count("*").alias("total_shipments"), F.count_if("is_disrupted").alias("disrupted"),
        half_even(F.avg("delay_days"), 1).alias("avg_delay_days"))
    if anomalies is None:
        return counted
    found = anomalies.agg(F.count_if("is_anomaly").alias("n"))
    return counted.withColumn("anomalies", found.scalar())


def carrier_performance(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("carrier").agg(F.avg("delay_days").alias("avg_delay_days")).orderBy(
        F.asc_nulls_last("avg_delay_days"), "carrier")


# -- inventory -------------------------------------------------------------------

def kpi_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count_distinct("sku").alias("skus"), F.count_distinct("warehouse").alias("warehouses"),
        F.count_if(F.col("stock_status") == "STOCKOUT").alias("stockouts"),
        F.count_if(F.col("stock_status") == "CRITICAL").alias("below_reorder"))


def warehouse_stock_value(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("warehouse").agg(F.sum("stock_value_usd").alias("stock_value_usd")).orderBy(
        F.asc_nulls_last("stock_value_usd"), "warehouse")


# -- external signals ----------------------------------------------------------------

def external_lpi_view(profile: DataFrame, by_risk: bool = False) -> DataFrame:
    """Country profiles under the suppliers' own names, by index ascending or by risk descending."""
    shown = profile.withColumnRenamed("our_country_name", "country")
    if by_risk:
        return shown.orderBy(F.desc("logistics_risk_score"), "country")
    return shown.orderBy(F.asc_nulls_last("lpi_score"), "country")


def external_weather_view(summary: DataFrame) -> DataFrame:
    return summary.select(
        "country", "city", "avg_disruption_score", "max_disruption_score", "severe_days", "warning_days",
        "avg_precipitation_mm", "avg_windspeed_kmh", "country_weather_risk",
    ).orderBy(F.desc("avg_disruption_score"), "country")


def external_fx_view(volatility: DataFrame) -> DataFrame:
    return volatility.select(
        "country", "currency_code", "current_rate_vs_usd", "pct_change_30d", "daily_volatility_pct",
        "currency_risk_score", "currency_risk_tier",
    ).orderBy(F.desc("currency_risk_score"), "country")


def sorted_profiles(profile: DataFrame) -> DataFrame:
    return profile.select(
        "our_country_name", "lpi_score", "logistics_risk_score", "logistics_risk_tier",
    ).orderBy(F.desc("logistics_risk_score"), "our_country_name")


def sorted_weather(summary: DataFrame) -> DataFrame:
    return summary.select(
        "country", "city", "avg_disruption_score", "severe_days", "warning_days", "country_weather_risk",
    ).orderBy(F.desc("avg_disruption_score"), "country")


def sorted_fx(volatility: DataFrame) -> DataFrame:
    """The risk columns alone, with the date they were fetched."""
    return volatility.select(
        "country", "currency_code", "pct_change_30d", "daily_volatility_pct", "currency_risk_score",
        "currency_risk_tier", "fetched_at",
    ).orderBy(F.desc("currency_risk_score"), "country")
