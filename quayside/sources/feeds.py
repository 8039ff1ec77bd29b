"""Landed JSON documents of the external feeds, flattened to rows.

Every function takes a frame with one document per row in ``payload`` (what
``spark.read.text(path, wholetext=True)`` gives).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.rounding import half_even

_OBSERVATIONS = "array<struct<country: struct<id: string, value: string>, value: double, date: string>>"
# The fields of a landed weather document.
WEATHER_SCHEMA = (
    "country string, city string, daily struct<time: array<string>, precipitation_sum: array<double>, "
    "windspeed_10m_max: array<double>, temperature_2m_max: array<double>, temperature_2m_min: array<double>, "
    "snowfall_sum: array<double>, weathercode: array<int>>"
)


def flatten_indicator(documents: DataFrame, value_name: str, digits: int) -> DataFrame:
    """``[header, [observation, ...]]`` documents to one row per observation that has a value."""
    # The header and the list differ in type, so the second element is taken by path and parsed on its own.
    items = F.from_json(F.get_json_object("payload", "$[1]"), _OBSERVATIONS)
    return (
        documents.select(F.explode(items).alias("o"))
        .filter(F.col("o.value").isNotNull())
        .select(
            F.col("o.country.id").alias("country_code"), F.col("o.country.value").alias("country_name"),
            half_even(F.col("o.value"), digits).alias(value_name), F.col("o.date").alias("year"),
        )
    )


def flatten_fx_history(documents: DataFrame) -> DataFrame:
    """``{rates: {date: {currency: rate}}}`` documents to one row per date and currency."""
    rates = F.from_json("payload", "rates map<string, map<string, double>>")
    return (
        documents.select(F.explode(rates["rates"]).alias("day", "quotes"))
        .select("day", F.explode("quotes").alias("currency_code", "rate_vs_usd"))
        .select(F.to_date("day").alias("date"), "currency_code", "rate_vs_usd")
    )


def fx_current_lookup(documents: DataFrame, countries: DataFrame, base: str = "USD") -> DataFrame:
    """One row per country (country, currency_code) with the rate of a ``{rates: {ccy: rate}, date}`` document.

    The base currency has rate 1; a country whose currency is not quoted is left out. The one document is
    read as scalars, so the countries are not crossed with it.
    """
    latest = documents.select(
        F.from_json("payload", "rates map<string, double>, date string").alias("doc")
    ).agg(F.max_by("doc", "doc.date").alias("doc"))
    rates = latest.select("doc.rates").scalar()
    day = latest.select("doc.date").scalar()
    rate = F.when(F.col("currency_code") == base, 1.0).otherwise(F.try_element_at(rates, F.col("currency_code")))
    return (
        countries.select("country", "currency_code", rate.alias("rate_vs_usd"), day.alias("date"))
        .filter(F.col("rate_vs_usd").isNotNull())
    )


_READINGS = {
    "precipitation_sum": "precipitation_mm", "windspeed_10m_max": "windspeed_kmh", "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c", "snowfall_sum": "snowfall_cm", "weathercode": "weather_code",
}


def flatten_weather(documents: DataFrame) -> DataFrame:
    """``{country, city, daily: {time: [...], ...}}`` documents to one row per day, missing readings as 0.

    A document may lack any of the readings, or hold fewer of one than it has days. Documents that are empty or not
    JSON have no days. A document without a city takes that of the column ``city``, where the frame has one.
    """
    doc = F.from_json("payload", WEATHER_SCHEMA)
    place = F.coalesce("doc.city", "city") if "city" in documents.columns else F.col("doc.city")
    zipped = F.arrays_zip(F.col("doc.daily.time").alias("time"), *[
        F.coalesce(F.col(f"doc.daily.{n}"), F.array()).alias(n) for n in _READINGS])
    days = documents.withColumn("doc", doc).select(
        "doc.country", place.alias("city"), F.explode(zipped).alias("d")).filter(F.col("d.time").isNotNull())
    return days.select(
        F.to_date("d.time").alias("date"), "country", "city",
        *[F.coalesce(F.col(f"d.{n}"), F.lit(0)).alias(name) for n, name in _READINGS.items()])


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as ``payload``, in one scan of a file, a folder, or folders named ``city=...``; the city of such a
    folder is a column. Empty files are skipped."""
    files = spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")
    return files.filter(F.trim(F.translate("payload", "\r\n\t", "   ")) != "")


def concat_weather(spark: SparkSession, path: str) -> DataFrame:
    """The daily weather of all places under a folder, whatever readings their documents have."""
    return flatten_weather(scan_documents(spark, path))


def concat_frames(frames: list[DataFrame | None]) -> DataFrame:
    """Stack per-city frames that are there already; a city whose feed failed has none."""
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("no weather feed was landed")
    stacked = present[0]
    for frame in present[1:]:
        stacked = stacked.unionByName(frame)
    return stacked
