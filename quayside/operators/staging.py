"""Staging: typed and trimmed columns, rows without a key dropped.

Each function takes the staged columns that are wanted (all by default), so a
raw table may carry only the inputs of those.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.rounding import half_away

SUPPLIERS = (
    "supplier_id", "supplier_name", "country", "contact_email", "product_category", "lead_time_days",
    "reliability_score", "risk_level", "is_active", "onboarded_date", "annual_spend_usd", "ingested_at",
)
INVENTORY = (
    "inventory_id", "sku", "product_category", "warehouse", "supplier_id", "quantity_on_hand", "reorder_point",
    "is_below_reorder", "unit_cost_usd", "last_restocked_date", "expiry_date", "stock_value_usd", "ingested_at",
)
SHIPMENTS = (
    "shipment_id", "supplier_id", "sku", "origin_country", "destination_warehouse", "quantity_shipped",
    "scheduled_date", "actual_arrival_date", "delay_days", "status", "freight_cost_usd", "carrier",
    "is_disrupted", "delay_category", "ingested_at",
)
_TRIMMED = {"supplier_name", "country", "product_category", "risk_level", "sku", "warehouse", "origin_country",
            "destination_warehouse", "status", "carrier"}
_TYPES = {
    "lead_time_days": "int", "quantity_on_hand": "int", "reorder_point": "int", "quantity_shipped": "int",
    "delay_days": "int", "reliability_score": "double", "annual_spend_usd": "double", "unit_cost_usd": "double",
    "freight_cost_usd": "double", "onboarded_date": "date", "last_restocked_date": "date", "expiry_date": "date",
    "scheduled_date": "date", "actual_arrival_date": "date",
}
_RENAMED = {
    "is_active": ("active", "boolean"), "is_below_reorder": ("below_reorder", "boolean"),
    "is_disrupted": ("disruption_flag", "boolean"), "ingested_at": ("_ingested_at", "timestamp"),
}
_INPUTS = {"delay_category": ("delay_days",), "stock_value_usd": ("quantity_on_hand", "unit_cost_usd")}


def raw_inputs(key: str, staged: Iterable[str]) -> list[str]:
    """Raw columns behind the staged ones, with the key that staging filters on."""
    names = [key]
    for column in staged:
        if column in _RENAMED:
            names.append(_RENAMED[column][0])
        else:
            names.extend(_INPUTS.get(column, (column,)))
    return list(dict.fromkeys(names))


def _staged(column: str) -> Column:
    if column in _RENAMED:
        source, kind = _RENAMED[column]
        return F.col(source).cast(kind)
    if column == "contact_email":
        return F.lower(F.trim(column))
    if column == "stock_value_usd":
        return half_away(F.col("quantity_on_hand") * F.col("unit_cost_usd"), 2)
    if column == "delay_category":
        return delay_category(F.col("delay_days"))
    if column in _TRIMMED:
        return F.trim(column)
    return F.col(column).cast(_TYPES[column]) if column in _TYPES else F.col(column)


def _stage(raw: DataFrame, key: str, order: tuple[str, ...], wanted: Iterable[str] | None) -> DataFrame:
    keep = set(order if wanted is None else wanted)
    unknown = keep - set(order)
    if unknown:
        raise ValueError(f"not staged: {sorted(unknown)}")
    return raw.filter(F.col(key).isNotNull()).select(*[_staged(c).alias(c) for c in order if c in keep])


def delay_category(delay: Column) -> Column:
    """Null and negative delays fall through to SEVERE, as every delay outside the named ranges does."""
    return (
        F.when(delay == 0, "NO_DELAY").when(delay.between(1, 5), "MINOR")
        .when(delay.between(6, 14), "MODERATE").otherwise("SEVERE")
    )


def stg_suppliers(raw: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return _stage(raw, "supplier_id", SUPPLIERS, columns)


def stg_inventory(raw: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return _stage(raw, "inventory_id", INVENTORY, columns)


def stg_shipments(raw: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return _stage(raw, "shipment_id", SHIPMENTS, columns)


def stg_shipments_of_suppliers(raw: DataFrame, columns: Iterable[str], attributes: Iterable[str]) -> DataFrame:
    """Staged shipments next to staged columns of their supplier, from raw rows that carry both."""
    kept = raw.filter(F.col("shipment_id").isNotNull())
    names = [c for c in SHIPMENTS if c in set(columns)] + [c for c in SUPPLIERS if c in set(attributes)]
    return kept.select(*[_staged(c).alias(c) for c in names])
