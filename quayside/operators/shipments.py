"""Shipment aggregates and joins with suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.rounding import half_away


def shipment_stats(shipments: DataFrame) -> DataFrame:
    """Totals per supplier. All aggregates combine map-side, so a hot supplier costs one row per task."""
    return shipments.groupBy("supplier_id").agg(
        F.count("*").alias("total_shipments"),
        F.count_if("is_disrupted").alias("disrupted_shipments"),
        F.avg("delay_days").alias("avg_delay_days"),
        F.max("delay_days").alias("max_delay_days"),
        F.sum("freight_cost_usd").alias("total_freight_cost"),
    )


def supplier_rate_stats(shipments: DataFrame) -> DataFrame:
    """Totals and disruption rate per supplier."""
    disrupted, total = F.count_if("is_disrupted"), F.count("*")
    return shipments.groupBy("supplier_id").agg(
        total.alias("total_shipments"),
        disrupted.alias("disrupted_shipments"),
        F.avg("delay_days").alias("avg_delay_days"),
        F.max("delay_days").alias("max_delay_days"),
        half_away(disrupted * 100.0 / total, 2).alias("disruption_rate_pct"),
    )


def supplier_features(suppliers: DataFrame, shipments: DataFrame) -> DataFrame:
    """Suppliers with their shipment statistics, zero where they have none."""
    stats = supplier_rate_stats(shipments)
    names = ["total_shipments", "disrupted_shipments", "avg_delay_days", "max_delay_days", "disruption_rate_pct"]
    joined = suppliers.join(stats, "supplier_id", "left")
    return joined.select(
        "supplier_id", "supplier_name", "country", "product_category", "risk_level", "reliability_score",
        "lead_time_days", "is_active", "annual_spend_usd",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names],
    )


ENRICHED = (
    "shipment_id", "supplier_id", "sku", "origin_country", "destination_warehouse", "quantity_shipped", "delay_days",
    "freight_cost_usd", "carrier", "is_disrupted", "status", "reliability_score", "supplier_lead_time",
    "supplier_risk_level", "annual_spend_usd",
)


# Attributes of the supplier under the names they have on a shipment.
ATTRIBUTES = {
    "reliability_score": "reliability_score", "lead_time_days": "supplier_lead_time", "risk_level": "supplier_risk_level",
    "annual_spend_usd": "annual_spend_usd",
}


def with_attribute_names(rows: DataFrame) -> DataFrame:
    """Shipments that carry the attributes of their supplier, in the order and under the names of the enriched table."""
    named = rows.withColumnsRenamed(ATTRIBUTES)
    return named.select([c for c in ENRICHED if c in named.columns])


def shipment_supplier_enrich(shipments: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Shipments, with the columns they come with, and the attributes of their supplier."""
    return with_attribute_names(shipments.join(suppliers.select("supplier_id", *ATTRIBUTES), "supplier_id", "left"))
