"""The daily batch over a landing folder: load, transform, predict, check. Steps only; a scheduler calls them."""

from __future__ import annotations

import datetime as dt
import posixpath

from pyspark.sql import DataFrame, SparkSession

from quayside.operators import anomalies, demand, explain, external, features, risk_model, shipments, staging
from quayside.plans import marts
from quayside.session import configure, cut_lineage
from quayside.sources import feeds, landing, seeds
from quayside.sources.tables import (
    MARTS, PREDICTIONS, RAW, full_refresh, health_check, materialize, require_healthy, spreads, union_all,
    written_rows,
)

CHECKED = (f"{RAW}.raw_suppliers", f"{RAW}.raw_shipments", f"{RAW}.raw_inventory",
           f"{PREDICTIONS}.supplier_risk_scores")


def load(spark: SparkSession, folder: str, run_ts: str) -> list[str]:
    """Landed CSV files to raw tables. Files that are not there are skipped; returns the tables loaded.

    Lines that do not fit go to ``raw.quarantine`` and stop nothing. Suppliers and shipments are bucketed by supplier,
    so that the joins and groups of the day need no exchange, unless one supplier holds too many of the shipments.
    """
    scanned = landing.scan_landed(spark, folder)
    tables = {name: landing.stamped(rows, run_ts) for name, rows in scanned.items()}
    history = landing.csv_scan(spark, posixpath.join(folder, "demand_history.csv"), landing.DEMAND_SCHEMA)
    if history is not None:
        scanned["demand_history"], tables["demand_history"] = history, landing.good_rows(history).drop("_file")
    if scanned:
        full_refresh(union_all([landing.quarantined(rows, name, run_ts) for name, rows in scanned.items()]),
                     RAW, "quarantine")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    even = "raw_shipments" in tables and spreads(tables["raw_shipments"], "supplier_id", buckets)
    for name, rows in tables.items():
        by = "supplier_id" if even and name in ("raw_suppliers", "raw_shipments") else None
        full_refresh(rows, RAW, name, bucket_by=by)
    return sorted(tables)


def _documents(spark: SparkSession, path: str) -> DataFrame | None:
    return feeds.scan_documents(spark, path) if landing.path_exists(spark, path) else None


def load_external(spark: SparkSession, folder: str, run_ts: str) -> None:
    """Landed feed documents to raw tables, with the fixed values where a feed is missing."""
    def landed(name: str) -> DataFrame | None:
        return _documents(spark, posixpath.join(folder, name))

    index, income = landed("country_lpi.json"), landed("country_gdp.json")
    lpi = external.minmax_normalise(
        seeds.fallback_logistics(spark) if index is None else feeds.flatten_indicator(index, "lpi_score", 3))
    gdp = None if income is None else feeds.flatten_indicator(income, "gdp_per_capita_usd", 2)
    full_refresh(lpi, RAW, "country_lpi")
    if gdp is not None:
        full_refresh(gdp, RAW, "country_gdp")
    full_refresh(external.country_risk_profile(lpi, gdp, seeds.indicator_names(spark)), RAW, "country_risk_profiles")

    latest, past = landed("fx_latest.json"), landed("fx_history.json")
    current = seeds.fallback_rates(spark, run_ts[:10]) if latest is None else feeds.fx_current_lookup(
        latest, seeds.supplier_currencies(spark))
    history = spark.createDataFrame([], "date date, currency_code string, rate_vs_usd double") if past is None \
        else feeds.flatten_fx_history(past)
    full_refresh(current, RAW, "currency_rates_current")
    if past is not None:
        full_refresh(history, RAW, "currency_rates_historical")
    full_refresh(external.fx_volatility(current, history, run_ts), RAW, "currency_volatility")

    places = posixpath.join(folder, "weather")
    if landing.path_exists(spark, places):
        daily = external.weather_disruption_score(feeds.concat_weather(spark, places))
        full_refresh(daily, RAW, "weather_daily")
        summary = external.weather_country_summary(spark.table(f"{RAW}.weather_daily"), run_ts)
        full_refresh(summary, RAW, "weather_country_summary")


def transform(spark: SparkSession, as_of: dt.date | None = None) -> None:
    """Staging views and stored marts."""
    staged = {
        "stg_suppliers": staging.stg_suppliers(spark.table(f"{RAW}.raw_suppliers")),
        "stg_inventory": staging.stg_inventory(spark.table(f"{RAW}.raw_inventory")),
        "stg_shipments": staging.stg_shipments(spark.table(f"{RAW}.raw_shipments")),
    }
    materialize(spark, staged, stored=False)
    materialize(spark, {
        "mart_supplier_risk": marts.mart_supplier_risk(staged["stg_suppliers"], staged["stg_shipments"]),
        "mart_inventory_health": marts.mart_inventory_health(staged["stg_inventory"], staged["stg_suppliers"], as_of),
    }, stored=True)


def predict_risk(spark: SparkSession, run_ts: str, trees: int = risk_model.TREES) -> None:
    """Supplier scores from a model trained on three quarters of the suppliers, explanations from one on all."""
    matrix = cut_lineage(features.supplier_matrix(shipments.supplier_features(
        spark.table("stg_suppliers"), spark.table("stg_shipments"))))
    split = cut_lineage(features.stratified_split(matrix, "supplier_id", "target"))
    model = risk_model.train(split.filter("NOT is_test"), trees=trees)
    full_refresh(risk_model.risk_scores(model, matrix, run_ts), PREDICTIONS, "supplier_risk_scores")
    explained = explain.explain(risk_model.train(matrix, trees=trees), matrix, risk_model.DEPTH)
    full_refresh(explain.shap_explanations(explained), PREDICTIONS, "supplier_shap_explanations")


def predict_demand(spark: SparkSession) -> None:
    forecast = full_refresh(
        demand.demand_forecast(spark.table(f"{RAW}.demand_history")), PREDICTIONS, "demand_forecasts")
    full_refresh(demand.stockout_risk(forecast, spark.table("stg_inventory")), PREDICTIONS, "stockout_risk")


def predict_anomalies(spark: SparkSession) -> None:
    staged = spark.table("stg_shipments")
    enriched = shipments.shipment_supplier_enrich(staged, spark.table("stg_suppliers"))
    full_refresh(anomalies.shipment_anomalies(enriched, staged.count()), PREDICTIONS, "shipment_anomalies")


def check(spark: SparkSession) -> DataFrame:
    """Rows and verdict per required table; raises when one is missing or empty."""
    result = health_check({
        name: spark.table(name) if spark.catalog.tableExists(name) else None for name in CHECKED})
    require_healthy(result)
    return result


def written_counts(spark: SparkSession) -> DataFrame:
    """Rows of every stored table of the mart and prediction layers, as the writes counted them."""
    return written_rows(spark, (MARTS, PREDICTIONS))


def run(spark: SparkSession, folder: str, run_ts: str, as_of: dt.date | None = None,
        trees: int = risk_model.TREES) -> DataFrame:
    configure(spark)
    loaded = load(spark, folder, run_ts)
    load_external(spark, folder, run_ts)
    transform(spark, as_of)
    predict_risk(spark, run_ts, trees)
    if "demand_history" in loaded:
        predict_demand(spark)
    predict_anomalies(spark)
    return check(spark)
