"""Values used when a feed was not landed, and the name maps of the supplier countries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Logistics performance index by country (2023), country name, code, score.
FALLBACK_LOGISTICS = [
    ("China", "CN", 3.65), ("Germany", "DE", 4.20), ("Japan", "JP", 4.03), ("United States", "US", 3.89),
    ("Italy", "IT", 3.72), ("France", "FR", 3.84), ("South Korea", "KR", 3.77), ("India", "IN", 3.18),
    ("Vietnam", "VN", 3.27), ("Kenya", "KE", 2.81), ("Nigeria", "NG", 2.53), ("Ghana", "GH", 2.66),
    ("South Africa", "ZA", 3.38), ("Egypt", "EG", 2.82), ("United Arab Emirates", "AE", 3.96),
]

# Supplier country, its currency, units per USD when no rate was landed.
FALLBACK_RATES = [
    ("China", "CNY", 7.24), ("Vietnam", "VND", 24485.0), ("Italy", "EUR", 0.92), ("Germany", "EUR", 0.92),
    ("Kenya", "KES", 129.50), ("India", "INR", 83.12), ("USA", "USD", 1.0), ("France", "EUR", 0.92),
    ("Japan", "JPY", 149.50), ("South Korea", "KRW", 1325.0),
]

# Supplier country, its name in the indicator feed. South Korea has two spellings there.
INDICATOR_NAMES = [
    ("China", "China"), ("Vietnam", "Vietnam"), ("Italy", "Italy"), ("Germany", "Germany"), ("Kenya", "Kenya"),
    ("India", "India"), ("USA", "United States"), ("France", "France"), ("Japan", "Japan"),
    ("South Korea", "Korea, Rep."), ("South Korea", "South Korea"),
]


def fallback_logistics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FALLBACK_LOGISTICS, "country_name string, country_code string, lpi_score double") \
        .select("country_code", "country_name", "lpi_score", F.lit("2023").alias("year"))


def fallback_rates(spark: SparkSession, date: str) -> DataFrame:
    return spark.createDataFrame(FALLBACK_RATES, "country string, currency_code string, rate_vs_usd double") \
        .withColumn("date", F.lit(date))


def supplier_currencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, k) for c, k, _ in FALLBACK_RATES], "country string, currency_code string")


def indicator_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INDICATOR_NAMES, "our_country_name string, country_name string")
