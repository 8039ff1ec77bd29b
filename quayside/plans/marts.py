"""Mart models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.rounding import half_away
from quayside.operators.shipments import shipment_stats


def mart_supplier_risk(suppliers: DataFrame, shipments: DataFrame) -> DataFrame:
    """Supplier master data with shipment performance. The rate stays null without shipments."""
    stats = shipment_stats(shipments)

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    level = F.col("risk_level")
    rate = F.coalesce("disrupted_shipments", F.lit(0)).cast("double") / F.nullif("total_shipments", F.lit(0)) * 100
    return suppliers.join(stats, "supplier_id", "left").select(
        "supplier_id", "supplier_name", "country", "product_category", "risk_level", "reliability_score",
        "lead_time_days", "is_active", "annual_spend_usd", or_zero("total_shipments"),
        or_zero("disrupted_shipments"), or_zero("avg_delay_days"), or_zero("max_delay_days"),
        or_zero("total_freight_cost"), half_away(rate, 2).alias("disruption_rate_pct"),
        F.when(level == "CRITICAL", 4).when(level == "HIGH", 3).when(level == "MEDIUM", 2).otherwise(1)
        .alias("risk_score"),
    )


def stock_status():
    """Order matters: an empty shelf is a stockout even where it is also below reorder."""
    return (
        F.when(F.col("quantity_on_hand") == 0, "STOCKOUT").when(F.col("is_below_reorder"), "CRITICAL")
        .when(F.col("quantity_on_hand") < F.col("reorder_point") * 1.5, "LOW").otherwise("HEALTHY")
    )


def mart_inventory_health(inventory: DataFrame, suppliers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Stock lines with supplier context, ages in days and a status."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    source = suppliers.select(
        "supplier_id", "supplier_name", F.col("country").alias("supplier_country"),
        F.col("risk_level").alias("supplier_risk"),
    )
    return inventory.join(source, "supplier_id", "left").select(
        "inventory_id", "sku", "product_category", "warehouse", "supplier_id", "supplier_name",
        "supplier_country", "supplier_risk", "quantity_on_hand", "reorder_point", "is_below_reorder",
        "unit_cost_usd", "stock_value_usd", "last_restocked_date", "expiry_date",
        F.datediff(today, "last_restocked_date").alias("days_since_restock"),
        F.datediff("expiry_date", today).alias("days_to_expiry"),
        stock_status().alias("stock_status"),
    )
