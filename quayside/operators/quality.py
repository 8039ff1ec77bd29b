"""Data-quality checks. Each returns the offending rows or values; empty means the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quayside.session import cut_lineage
from quayside.sources.tables import union_all

# Accepted values per model and column.
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
WAREHOUSES = ("Nairobi-KE", "Mombasa-KE", "Lagos-NG", "Accra-GH", "Cairo-EG", "Johannesburg-ZA", "London-UK",
              "Dubai-UAE")
SHIPMENT_STATUSES = ("ON_TIME", "DELAYED", "IN_TRANSIT", "DELIVERED", "CANCELLED")
DELAY_CATEGORIES = ("NO_DELAY", "MINOR", "MODERATE", "SEVERE")
STOCK_STATUSES = ("HEALTHY", "LOW", "CRITICAL", "STOCKOUT")

ACCEPTED = {
    "stg_suppliers": {"risk_level": RISK_LEVELS},
    "stg_inventory": {"warehouse": WAREHOUSES},
    "stg_shipments": {"status": SHIPMENT_STATUSES, "delay_category": DELAY_CATEGORIES},
    "mart_supplier_risk": {"risk_level": RISK_LEVELS},
    "mart_inventory_health": {"stock_status": STOCK_STATUSES},
}
UNIQUE = {
    "stg_suppliers": "supplier_id", "stg_inventory": "inventory_id", "stg_shipments": "shipment_id",
    "mart_supplier_risk": "supplier_id", "mart_inventory_health": "inventory_id",
}
NOT_NULL = {
    "stg_suppliers": ("supplier_id", "supplier_name", "country", "risk_level", "reliability_score", "is_active"),
    "stg_inventory": ("inventory_id", "sku", "warehouse", "quantity_on_hand", "unit_cost_usd"),
    "stg_shipments": ("shipment_id", "supplier_id", "status", "delay_category", "delay_days"),
    "mart_supplier_risk": ("supplier_id", "risk_level", "disruption_rate_pct", "reliability_score"),
    "mart_inventory_health": ("inventory_id", "stock_status", "stock_value_usd"),
}


def unique_violations(df: DataFrame, model: str, column: str) -> DataFrame:
    """Values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("occurrences")).filter(F.col("occurrences") > 1)
        .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "value", "occurrences")
    )


def null_counts(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counted.select(F.lit(model).alias("model"), F.inline(rows))


def rejected_values(df: DataFrame, model: str, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside the list of their column, all columns in one pass. Null is left to the null check."""
    pairs = F.array(*[
        F.when(~F.col(c).isin(*values), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
        for c, values in accepted.items()
    ])
    return (
        df.select(F.explode(F.array_compact(pairs)).alias("bad"))
        .groupBy("bad.column_name", "bad.value").agg(F.count("*").alias("occurrences"))
        .select(F.lit(model).alias("model"), "column_name", "value", "occurrences")
    )


def fk_violations(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys of the child that the parent lacks, with the child rows that carry them.

    Counting before the anti join sends each key once, however often it occurs.
    """
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("occurrences"))
    return keys.join(parent.select(key), key, "left_anti")


def negative_delays(shipments: DataFrame) -> DataFrame:
    return shipments.filter(F.col("delay_days") < 0)


def range_violations(suppliers: DataFrame, risk: DataFrame) -> DataFrame:
    """Rows outside the expected ranges, per check."""
    checks = [
        (risk, "disruption_rate_pct", ~F.col("disruption_rate_pct").between(0, 100)),
        (suppliers, "reliability_score", ~F.col("reliability_score").between(0, 1)),
        (suppliers, "lead_time_days", F.col("lead_time_days") <= 0),
    ]
    return union_all([
        df.agg(F.count_if(bad).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for df, name, bad in checks
    ] + [
        suppliers.groupBy("supplier_id").count().agg(F.count_if(F.col("count") > 1).alias("violations"))
        .select(F.lit("supplier_id_unique").alias("check_name"), "violations")
    ])


# The key of a model that must be found in another's.
RELATIONSHIP = ("stg_shipments", "supplier_id", "stg_suppliers", "supplier_id")


def row_checks(model: str) -> list[tuple[str, str, Column]]:
    """(column, check, condition of a violation) of every check of the model that a row alone can tell."""
    checks = [(c, "not_null", F.col(c).isNull()) for c in NOT_NULL.get(model, ())]
    checks += [(c, "accepted_values", ~F.col(c).isin(*values)) for c, values in ACCEPTED.get(model, {}).items()]
    if model == "stg_shipments":
        checks.append(("delay_days", "no_negative_delays", F.col("delay_days") < 0))
    return checks


def observed_keys(df: DataFrame, model: str) -> tuple[DataFrame, list[tuple[str, str, str, int]]]:
    """One pass over a model: its keys as stored (check, key, parent) rows, and the violations that its rows tell,
    observed while the keys are written."""
    checks = row_checks(model)
    keys = []
    if model in UNIQUE:
        keys.append((f"unique {model}", UNIQUE[model], False))
    child, child_key, parent, parent_key = RELATIONSHIP
    if model == child:
        keys.append(("relationships", child_key, False))
    if model == parent:
        keys.append(("relationships", parent_key, True))
    seen = Observation()
    # One entry per key of the row, so that a row is read once for all of them.
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.col(key).cast("string").alias("key"),
                              F.lit(is_parent).alias("parent")) for check, key, is_parent in keys])
    counts = [F.count_if(bad).alias(f"n{k}") for k, (_, _, bad) in enumerate(checks)]
    stored = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).select(F.inline(rows)))
    found = seen.get
    return stored, [(model, column, check, found.get(f"n{k}", 0)) for k, (column, check, _) in enumerate(checks)]


def check_summary(models: Mapping[str, DataFrame]) -> DataFrame:
    """Violations and verdict of every check, one row each.

    Each model is read once: what a row alone can tell is observed while the keys of the model are stored. All keys,
    those of the uniqueness checks and of both sides of the relationship, are then grouped together, counted per value
    before the exchange, so that a hot key is one row per task.
    """
    spark = next(iter(models.values())).sparkSession
    names = dict.fromkeys([*UNIQUE, *NOT_NULL, *ACCEPTED])
    passes = [observed_keys(models[model], model) for model in names]
    keys = union_all([stored for stored, _ in passes]).filter("key IS NOT NULL")
    grouped = keys.groupBy("check", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.count_if("parent").alias("parents"))
    orphans = F.when(F.col("parents") == 0, F.col("rows"))
    counted = grouped.groupBy("check").agg(
        F.coalesce(F.sum(F.when(F.col("check") == "relationships", orphans).otherwise((F.col("rows") > 1).cast("long"))),
                   F.lit(0)).alias("n"))
    keyed = [(f"unique {model}", model, key, "unique") for model, key in UNIQUE.items()]
    keyed.append(("relationships", RELATIONSHIP[0], RELATIONSHIP[1], "relationships"))
    names = spark.createDataFrame(keyed, "check string, model string, column_name string, check_name string")
    by_key = names.join(counted, "check", "left").select(
        "model", "column_name", "check_name", F.coalesce("n", F.lit(0)).alias("violations"))
    by_row = spark.createDataFrame([row for _, rows in passes for row in rows],
                                   "model string, column_name string, check_name string, violations long")
    return by_row.unionByName(by_key).withColumn("status", F.when(F.col("violations") > 0, "FAIL").otherwise("PASS"))
