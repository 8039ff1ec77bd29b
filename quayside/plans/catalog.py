"""Every query by name, as a function of a warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators import (
    anomalies, demand, encoding, explain, external, features, quality, risk_model, shipments,
)
from quayside.plans import reports
from quayside.plans.warehouse import Warehouse
from quayside.session import cut_lineage
from quayside.sources import feeds, landing, tables, trade_tables
from quayside.sources.trade_tables import shipment_rules

Query = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Query] = {}
HIGH_TIERS = ["CRITICAL", "HIGH"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def settled(df: DataFrame, **digits: int) -> DataFrame:
    """Round sums and means of doubles, whose last bits depend on the order of addition.

    A sum is rounded to the digits its terms have, so that it never lies near the middle of two results.
    """
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


# -- loading ---------------------------------------------------------------------

@query
def ingest_metadata(w: Warehouse) -> DataFrame:
    return landing.ingest_metadata(w.raw.table("orders"), w.raw.run_ts)


@query
def load_summary(w: Warehouse) -> DataFrame:
    derived = {
        "demand_history": w.demand_history(), "weather_daily": w.weather_scored(),
        "country_lpi": external.minmax_normalise(w.lpi()), "currency_rates_historical": w.fx_history(),
    }
    return tables.load_summary({
        "raw_suppliers": (w.raw.raw_suppliers(["supplier_id"]), len(trade_tables.SUPPLIER_COLUMNS)),
        "raw_inventory": (w.raw.raw_inventory(["inventory_id"]), len(trade_tables.INVENTORY_COLUMNS)),
        "raw_shipments": (w.raw.raw_shipments(["shipment_id"]), len(trade_tables.SHIPMENT_COLUMNS)),
        **{name: (df, len(df.columns)) for name, df in derived.items()},
    })


@query
def preview(w: Warehouse) -> DataFrame:
    return tables.preview(w.raw.raw_suppliers(), ["supplier_id"])


@query
def preview_inventory(w: Warehouse) -> DataFrame:
    return tables.preview(w.raw.raw_inventory(), ["inventory_id"])


@query
def preview_shipments(w: Warehouse) -> DataFrame:
    return tables.preview(w.raw.raw_shipments(), ["shipment_id"])


@query
def indicator_json_flatten(w: Warehouse) -> DataFrame:
    return w.lpi()


@query
def indicator_json_flatten_gdp(w: Warehouse) -> DataFrame:
    return w.gdp()


@query
def fx_json_flatten(w: Warehouse) -> DataFrame:
    return settled(w.fx_history(), rate_vs_usd=6)


@query
def fx_current_lookup(w: Warehouse) -> DataFrame:
    return settled(w.fx_current(), rate_vs_usd=6)


@query
def weather_json_flatten(w: Warehouse) -> DataFrame:
    return settled(w.weather(), windspeed_kmh=6)


@query
def weather_concat(w: Warehouse) -> DataFrame:
    """One scan over the folders of all cities, whose files differ in the readings they have."""
    return settled(feeds.concat_weather(w.spark, w.landed_weather()), windspeed_kmh=6)


# -- staging and marts -----------------------------------------------------------

@query
def stg_suppliers(w: Warehouse) -> DataFrame:
    return w.suppliers()


@query
def stg_inventory(w: Warehouse) -> DataFrame:
    return w.inventory()


@query
def stg_shipments(w: Warehouse) -> DataFrame:
    return w.shipments()


@query
def mart_supplier_risk(w: Warehouse) -> DataFrame:
    return settled(w.supplier_risk(), total_freight_cost=3)


@query
def mart_inventory_health(w: Warehouse) -> DataFrame:
    return w.inventory_health()


@query
def shipment_stats(w: Warehouse) -> DataFrame:
    stats = shipments.shipment_stats(w.shipments("supplier_id", "is_disrupted", "delay_days", "freight_cost_usd"))
    return settled(stats, total_freight_cost=3)


@query
def supplier_rate_stats(w: Warehouse) -> DataFrame:
    return shipments.supplier_rate_stats(w.shipments("supplier_id", "is_disrupted", "delay_days"))


@query
def supplier_features(w: Warehouse) -> DataFrame:
    return w.supplier_features()


@query
def shipment_supplier_enrich(w: Warehouse) -> DataFrame:
    return w.enriched_shipments()


@query
def shipment_derive(w: Warehouse) -> DataFrame:
    """Arrival, status and flag from schedule and delay, as seen on a day inside the order history."""
    as_of = dt.date(1998, 6, 30)
    rows = w.raw.raw_shipments(("shipment_id", "scheduled_date", "delay_days"))
    rules = shipment_rules(F.col("scheduled_date"), F.col("delay_days"), as_of)
    return rows.select("*", *[rule.alias(name) for name, rule in rules.items()])


@query
def inventory_derive(w: Warehouse) -> DataFrame:
    lines = w.raw.raw_inventory(("inventory_id", "quantity_on_hand", "reorder_point"))
    return lines.withColumn("below_reorder", F.col("quantity_on_hand") < F.col("reorder_point"))


# -- external signals --------------------------------------------------------------

@query
def minmax_normalise(w: Warehouse) -> DataFrame:
    return external.minmax_normalise(w.lpi())


@query
def filter_supplier_countries(w: Warehouse) -> DataFrame:
    return external.filter_supplier_countries(w.lpi(), w.raw.country_names())


@query
def country_risk_profile(w: Warehouse) -> DataFrame:
    return w.country_profile()


@query
def sorted_profiles(w: Warehouse) -> DataFrame:
    return reports.sorted_profiles(w.country_profile())


@query
def external_lpi_view(w: Warehouse) -> DataFrame:
    return reports.external_lpi_view(w.country_profile())


@query
def external_lpi_view_by_risk(w: Warehouse) -> DataFrame:
    return reports.external_lpi_view(w.country_profile(), by_risk=True)


@query
def weather_disruption_score(w: Warehouse) -> DataFrame:
    return settled(external.weather_disruption_score(w.weather()), windspeed_kmh=6)


@query
def weather_country_summary(w: Warehouse) -> DataFrame:
    return w.weather_summary()


@query
def sorted_weather(w: Warehouse) -> DataFrame:
    return reports.sorted_weather(w.weather_summary())


@query
def external_weather_view(w: Warehouse) -> DataFrame:
    return reports.external_weather_view(w.weather_summary())


@query
def fx_daily_returns(w: Warehouse) -> DataFrame:
    return settled(external.fx_daily_returns(w.raw.fx_history()), rate_vs_usd=6, daily_return=8)


@query
def fx_first_last(w: Warehouse) -> DataFrame:
    return settled(external.fx_first_last(w.raw.fx_history()), first_rate=6, last_rate=6)


@query
def fx_volatility(w: Warehouse) -> DataFrame:
    return settled(w.fx_volatility(), current_rate_vs_usd=6, rate_30d_ago=6)


@query
def filter_high_fx(w: Warehouse) -> DataFrame:
    return settled(external.filter_high_fx(w.fx_volatility()), current_rate_vs_usd=6, rate_30d_ago=6)


@query
def sorted_fx(w: Warehouse) -> DataFrame:
    return reports.sorted_fx(w.fx_volatility())


@query
def external_fx_view(w: Warehouse) -> DataFrame:
    return settled(reports.external_fx_view(w.fx_volatility()), current_rate_vs_usd=6)


# -- demand and stock ---------------------------------------------------------------

@query
def demand_daily(w: Warehouse) -> DataFrame:
    return demand.demand_daily(w.demand_history())


@query
def demand_coverage(w: Warehouse) -> DataFrame:
    return demand.demand_coverage(w.demand_history())


@query
def inventory_by_sku_wh(w: Warehouse) -> DataFrame:
    return demand.inventory_by_sku_wh(w.inventory("sku", "warehouse", "quantity_on_hand", "reorder_point"))


@query
def forecast_trend_weekday(w: Warehouse) -> DataFrame:
    return w.trend_forecast()


@query
def forecast_summary(w: Warehouse) -> DataFrame:
    return settled(demand.forecast_summary(w.trend_forecast()), forecasted_demand_90d=4, avg_daily_demand=6)


@query
def stockout_risk(w: Warehouse) -> DataFrame:
    return settled(w.stockout(), forecasted_demand_90d=4, avg_daily_demand=6)


@query
def stockout_risk_model(w: Warehouse) -> DataFrame:
    """Stockout risk at the pace of the seasonal model's forecast."""
    return settled(w.model_stockout(), forecasted_demand_90d=4, avg_daily_demand=6)


@query
def stockout_summary(w: Warehouse) -> DataFrame:
    return demand.stockout_summary(w.stockout())


@query
def top5_stockout(w: Warehouse) -> DataFrame:
    return demand.top5_stockout(w.stockout())


@query
def closest_stockout_10(w: Warehouse) -> DataFrame:
    return settled(demand.closest_stockout_10(w.stockout()), forecasted_demand_90d=4, avg_daily_demand=6)


@query
def stockout_tier_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.stockout(), "stockout_risk")


@query
def demand_refused(w: Warehouse) -> DataFrame:
    return demand.refused_series(w.demand_history())


@query
def demand_forecast(w: Warehouse) -> DataFrame:
    return demand.demand_forecast(w.demand_history())


# -- features --------------------------------------------------------------------------

@query
def label_encode(w: Warehouse) -> DataFrame:
    rows = w.suppliers("supplier_id", "country", "product_category", "risk_level")
    return encoding.label_encode(
        rows, {"country": "country_enc", "product_category": "category_enc", "risk_level": "risk_enc"})


@query
def label_encode_shipments(w: Warehouse) -> DataFrame:
    # Stored, because the distinct values are taken in a pass of their own.
    rows = cut_lineage(w.enriched_shipments().select(
        "shipment_id", "origin_country", "destination_warehouse", "carrier", "sku", "supplier_risk_level"))
    return encoding.label_encode(rows, features.SHIPMENT_CODES)


@query
def risk_target(w: Warehouse) -> DataFrame:
    return w.supplier_features().select(
        "supplier_id", "risk_level", "disruption_rate_pct", features.risk_target().alias("target"))


@query
def target_distribution(w: Warehouse) -> DataFrame:
    return features.target_distribution(w.supplier_features())


@query
def supplier_feature_matrix(w: Warehouse) -> DataFrame:
    return w.supplier_matrix().select("supplier_id", *features.SUPPLIER_FEATURES, "target")


@query
def anomaly_features(w: Warehouse) -> DataFrame:
    matrix = features.shipment_codes(cut_lineage(w.shipment_ratios()))
    return matrix.select("shipment_id", *features.SHIPMENT_FEATURES)


@query
def quantile_thresholds(w: Warehouse) -> DataFrame:
    limits = w.reason_thresholds()
    return settled(w.spark.range(1).select(
        F.lit(limits["cost_per_unit"]).cast("double").alias("cost_per_unit_q95"),
        F.lit(limits["quantity_shipped"]).cast("double").alias("quantity_shipped_q97"),
    ), cost_per_unit_q95=6, quantity_shipped_q97=6)


@query
def reason_flags(w: Warehouse) -> DataFrame:
    needed = ("quantity_shipped", "delay_days", "freight_cost_usd", "is_disrupted")
    return w.shipment_ratios(*needed).select(
        "shipment_id", features.reason_flags(w.reason_thresholds()).alias("reasons"))


@query
def stratified_split(w: Warehouse) -> DataFrame:
    return w.split_matrix().select("supplier_id", "target", "is_test")


# -- supplier risk model -------------------------------------------------------------------

@query
def risk_model_scores(w: Warehouse) -> DataFrame:
    return w.risk_scores()


@query
def classification_metrics(w: Warehouse) -> DataFrame:
    return risk_model.classification_metrics(w.test_predictions())


@query
def roc_auc(w: Warehouse) -> DataFrame:
    return risk_model.roc_auc(w.test_predictions())


@query
def confusion_matrix(w: Warehouse) -> DataFrame:
    return risk_model.confusion_matrix(w.test_predictions())


# The same reports on a score in closed form, unreliability, which the check statements can compute.

@query
def rule_confusion_matrix(w: Warehouse) -> DataFrame:
    return risk_model.confusion_matrix(w.rule_scores())


@query
def rule_classification_metrics(w: Warehouse) -> DataFrame:
    return settled(risk_model.classification_metrics(w.rule_scores()), precision=9, recall=9, f1_score=9)


@query
def rule_roc_auc(w: Warehouse) -> DataFrame:
    return settled(risk_model.roc_auc(w.rule_scores()), roc_auc=9)


@query
def rule_risk_tier_summary(w: Warehouse) -> DataFrame:
    return risk_model.risk_tier_summary(w.rule_scores())


@query
def rule_top5_risky_suppliers(w: Warehouse) -> DataFrame:
    return risk_model.top5_risky_suppliers(w.rule_scores())


@query
def rule_risk_tier_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.rule_scores(), "risk_tier")


@query
def feature_importance_top5(w: Warehouse) -> DataFrame:
    return risk_model.feature_importance(w.risk_model(), w.spark).limit(5)


@query
def risk_tier_summary(w: Warehouse) -> DataFrame:
    return risk_model.risk_tier_summary(w.risk_scores())


@query
def sorted_scores(w: Warehouse) -> DataFrame:
    return risk_model.sorted_scores(w.risk_scores())


@query
def top5_risky_suppliers(w: Warehouse) -> DataFrame:
    return risk_model.top5_risky_suppliers(w.risk_scores())


@query
def risk_tier_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.risk_scores(), "risk_tier")


@query
def filter_tier_country(w: Warehouse) -> DataFrame:
    """On the mart's rated level, so that the kept rows can be checked; the score reports filter alike."""
    mart = w.supplier_risk().drop("total_freight_cost")
    return reports.filter_tier_country(mart, "risk_level", HIGH_TIERS, ["NATION_1", "NATION_6", "NATION_12"])


@query
def filter_tier_only(w: Warehouse) -> DataFrame:
    return reports.filter_tier_country(w.supplier_risk().drop("total_freight_cost"), "risk_level", HIGH_TIERS, [])


@query
def risk_scatter(w: Warehouse) -> DataFrame:
    return reports.risk_scatter(reports.filter_tier_country(w.risk_scores(), "risk_tier", HIGH_TIERS, []))


@query
def risk_table(w: Warehouse) -> DataFrame:
    return reports.risk_table(reports.filter_tier_country(w.risk_scores(), "risk_tier", HIGH_TIERS, []))


@query
def shap_explanations(w: Warehouse) -> DataFrame:
    return w.explanations()


@query
def top_driver(w: Warehouse) -> DataFrame:
    return explain.top_driver(w.explanations())


@query
def top3_explanation(w: Warehouse) -> DataFrame:
    return explain.top3_explanation(w.explanations())


@query
def driver_distribution(w: Warehouse) -> DataFrame:
    return explain.driver_distribution(w.explanations())


@query
def global_shap_importance(w: Warehouse) -> DataFrame:
    return explain.global_importance(w.explanations())


@query
def top5_critical_explanations(w: Warehouse) -> DataFrame:
    return explain.top5_critical_explanations(w.explanations())


@query
def filter_tier_driver(w: Warehouse) -> DataFrame:
    return explain.filter_tier_driver(w.explanations(), HIGH_TIERS, ["Risk Level", "Disruption Rate %"])


@query
def explanation_page(w: Warehouse) -> DataFrame:
    return explain.explanation_page(explain.filter_tier_driver(w.explanations(), HIGH_TIERS, []))


@query
def supplier_shap_long(w: Warehouse) -> DataFrame:
    return explain.supplier_shap_long(w.explanations())


@query
def driver_options(w: Warehouse) -> DataFrame:
    return explain.driver_options(w.explanations())


# The same reports on a linear score, whose Shapley values the check statements can compute.

def _linear(w: Warehouse) -> DataFrame:
    return settled(w.linear_explanations(), **{label: 6 for label in explain.LABELS})


@query
def linear_risk_scores(w: Warehouse) -> DataFrame:
    return risk_model.sorted_scores(w.linear_scores())


@query
def linear_shap_explanations(w: Warehouse) -> DataFrame:
    return _linear(w)


@query
def linear_top_driver(w: Warehouse) -> DataFrame:
    return explain.top_driver(_linear(w))


@query
def linear_top3_explanation(w: Warehouse) -> DataFrame:
    return explain.top3_explanation(_linear(w))


@query
def linear_driver_distribution(w: Warehouse) -> DataFrame:
    return explain.driver_distribution(_linear(w))


@query
def linear_global_shap_importance(w: Warehouse) -> DataFrame:
    return settled(explain.global_importance(w.linear_explanations()), mean_abs_shap=6)


@query
def linear_top5_critical_explanations(w: Warehouse) -> DataFrame:
    return explain.top5_critical_explanations(_linear(w))


@query
def linear_filter_tier_driver(w: Warehouse) -> DataFrame:
    return explain.filter_tier_driver(_linear(w), HIGH_TIERS, ["Risk Level", "Disruption Rate %"])


@query
def linear_explanation_page(w: Warehouse) -> DataFrame:
    return explain.explanation_page(explain.filter_tier_driver(_linear(w), HIGH_TIERS, []))


@query
def linear_supplier_shap_long(w: Warehouse) -> DataFrame:
    return explain.supplier_shap_long(_linear(w))


@query
def linear_driver_options(w: Warehouse) -> DataFrame:
    return explain.driver_options(_linear(w))


@query
def linear_risk_scatter(w: Warehouse) -> DataFrame:
    return reports.risk_scatter(reports.filter_tier_country(w.linear_scores(), "risk_tier", HIGH_TIERS, []))


@query
def linear_risk_table(w: Warehouse) -> DataFrame:
    return reports.risk_table(reports.filter_tier_country(w.linear_scores(), "risk_tier", HIGH_TIERS, []))


@query
def linear_kpi_overview(w: Warehouse) -> DataFrame:
    return reports.kpi_overview(
        w.suppliers("supplier_id", "is_active"), w.shipments("is_disrupted"), w.stock(), w.linear_scores())


# -- shipment anomalies ---------------------------------------------------------------------

@query
def isolation_forest(w: Warehouse) -> DataFrame:
    return w.shipment_anomalies().select("shipment_id", "anomaly_score", "is_anomaly")


@query
def anomaly_severity(w: Warehouse) -> DataFrame:
    return w.shipment_anomalies().select("shipment_id", "anomaly_score", "anomaly_severity", "severity_tier")


@query
def anomaly_reasons(w: Warehouse) -> DataFrame:
    return w.shipment_anomalies()


@query
def anomaly_rate(w: Warehouse) -> DataFrame:
    return anomalies.anomaly_rate(w.shipment_anomalies())


@query
def severity_summary(w: Warehouse) -> DataFrame:
    return anomalies.severity_summary(w.shipment_anomalies())


@query
def severity_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.shipment_anomalies(), "severity_tier")


@query
def anomaly_reason_breakdown(w: Warehouse) -> DataFrame:
    return anomalies.reason_breakdown(w.shipment_anomalies())


@query
def top10_anomalies(w: Warehouse) -> DataFrame:
    return anomalies.top10_anomalies(w.shipment_anomalies())


@query
def top15_anomalies(w: Warehouse) -> DataFrame:
    return anomalies.top15_anomalies(w.shipment_anomalies())


@query
def kpi_anomalies(w: Warehouse) -> DataFrame:
    return anomalies.kpi_anomalies(w.shipment_anomalies())


# The same reports on distances from the medians, which the check statements can compute.

@query
def robust_anomaly_severity(w: Warehouse) -> DataFrame:
    return w.robust_anomalies().select(
        "shipment_id", "is_anomaly", "anomaly_score", "anomaly_severity", "severity_tier")


@query
def robust_anomaly_reasons(w: Warehouse) -> DataFrame:
    return w.robust_anomalies()


@query
def robust_anomaly_rate(w: Warehouse) -> DataFrame:
    return anomalies.anomaly_rate(w.robust_anomalies())


@query
def robust_severity_summary(w: Warehouse) -> DataFrame:
    return anomalies.severity_summary(w.robust_anomalies())


@query
def robust_severity_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.robust_anomalies(), "severity_tier")


@query
def robust_anomaly_reason_breakdown(w: Warehouse) -> DataFrame:
    return anomalies.reason_breakdown(w.robust_anomalies())


@query
def robust_top10_anomalies(w: Warehouse) -> DataFrame:
    return anomalies.top10_anomalies(w.robust_anomalies())


@query
def robust_top15_anomalies(w: Warehouse) -> DataFrame:
    return anomalies.top15_anomalies(w.robust_anomalies())


@query
def robust_kpi_anomalies(w: Warehouse) -> DataFrame:
    return anomalies.kpi_anomalies(w.robust_anomalies())


@query
def robust_kpi_shipments(w: Warehouse) -> DataFrame:
    return reports.kpi_shipments(w.shipments("is_disrupted", "delay_days"), w.robust_anomalies())


# -- data quality -----------------------------------------------------------------------------

def _checked_models(w: Warehouse) -> dict[str, DataFrame]:
    """The checked models, with the columns that any check reads."""
    return {
        "stg_suppliers": w.suppliers(),
        "stg_inventory": w.inventory(*quality.NOT_NULL["stg_inventory"]),
        "stg_shipments": w.shipments(*quality.NOT_NULL["stg_shipments"]),
        "mart_supplier_risk": w.supplier_risk(), "mart_inventory_health": w.inventory_health(),
    }


@query
def dq_summary(w: Warehouse) -> DataFrame:
    return quality.check_summary(_checked_models(w))


@query
def dq_unique(w: Warehouse) -> DataFrame:
    models = {**_checked_models(w), "stg_shipments": w.shipments("shipment_id")}
    return tables.union_all([
        quality.unique_violations(models[name], name, key) for name, key in quality.UNIQUE.items()])


@query
def dq_not_null(w: Warehouse) -> DataFrame:
    models = _checked_models(w)
    return tables.union_all([
        quality.null_counts(models[name], name, columns) for name, columns in quality.NOT_NULL.items()])


@query
def dq_accepted_values(w: Warehouse) -> DataFrame:
    models = _checked_models(w)
    return tables.union_all([
        quality.rejected_values(models[name], name, lists) for name, lists in quality.ACCEPTED.items()])


@query
def dq_relationships(w: Warehouse) -> DataFrame:
    return quality.fk_violations(w.shipments("supplier_id"), w.suppliers("supplier_id"), "supplier_id")


@query
def fk_violations(w: Warehouse) -> DataFrame:
    """The same check where it finds something: shipments of suppliers that are no longer active."""
    active = w.suppliers("supplier_id", "is_active").filter("is_active")
    return quality.fk_violations(w.shipments("supplier_id"), active, "supplier_id")


@query
def dq_no_negative_delays(w: Warehouse) -> DataFrame:
    return quality.negative_delays(w.shipments())


@query
def dq_range(w: Warehouse) -> DataFrame:
    return quality.range_violations(w.suppliers(), w.supplier_risk())


@query
def health_check(w: Warehouse) -> DataFrame:
    return tables.health_check({
        "raw.raw_suppliers": w.raw.raw_suppliers(["supplier_id"]),
        "raw.raw_shipments": w.raw.raw_shipments(["shipment_id"]),
        "raw.raw_inventory": w.raw.raw_inventory(["inventory_id"]), "predictions.supplier_risk_scores": w.risk_scores(),
    })


# -- reports ------------------------------------------------------------------------------------

@query
def kpi_overview(w: Warehouse) -> DataFrame:
    return reports.kpi_overview(
        w.suppliers("supplier_id", "is_active"), w.shipments("is_disrupted"), w.stock(), w.risk_scores())


@query
def kpi_overview_without_scores(w: Warehouse) -> DataFrame:
    return reports.kpi_overview(w.suppliers("supplier_id", "is_active"), w.shipments("is_disrupted"), w.stock())


@query
def shipment_status_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.shipments("status"), "status")


@query
def supplier_country_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.suppliers("country"), "country")


@query
def kpi_shipments(w: Warehouse) -> DataFrame:
    return reports.kpi_shipments(w.shipments("is_disrupted", "delay_days"), w.shipment_anomalies())


@query
def kpi_shipments_without_anomalies(w: Warehouse) -> DataFrame:
    return reports.kpi_shipments(w.shipments("is_disrupted", "delay_days"))


@query
def delay_category_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.shipments("delay_category"), "delay_category")


@query
def carrier_performance(w: Warehouse) -> DataFrame:
    return reports.carrier_performance(w.shipments("carrier", "delay_days"))


@query
def kpi_inventory(w: Warehouse) -> DataFrame:
    return reports.kpi_inventory(w.stock())


@query
def stock_status_counts(w: Warehouse) -> DataFrame:
    return reports.value_counts(w.stock(), "stock_status")


@query
def warehouse_stock_value(w: Warehouse) -> DataFrame:
    return settled(reports.warehouse_stock_value(w.stock()), stock_value_usd=2)


@query
def filter_options(w: Warehouse) -> DataFrame:
    return reports.filter_options(w.suppliers("country"), "country")
