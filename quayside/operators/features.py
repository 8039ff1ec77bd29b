"""Feature matrices of the supplier and shipment models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.rounding import half_even
from quayside.operators.encoding import Dictionary, apply_codes, dictionaries, label_encode
from quayside.operators.order_statistics import column_ranges, exact_quantiles, values_at_ranks

# Model inputs in order, with the names shown to people.
SUPPLIER_FEATURES = {
    "reliability_score": "Reliability Score",
    "lead_time_days": "Lead Time (Days)",
    "is_active_int": "Is Active",
    "annual_spend_usd": "Annual Spend (USD)",
    "total_shipments": "Total Shipments",
    "disrupted_shipments": "Disrupted Shipments",
    "avg_delay_days": "Avg Delay (Days)",
    "max_delay_days": "Max Delay (Days)",
    "disruption_rate_pct": "Disruption Rate %",
    "country_enc": "Country",
    "category_enc": "Product Category",
    "risk_enc": "Risk Level",
}
SHIPMENT_FEATURES = (
    "delay_days", "freight_cost_usd", "quantity_shipped", "reliability_score", "supplier_lead_time",
    "cost_per_unit", "delay_ratio", "is_disrupted_int", "country_enc", "warehouse_enc", "carrier_enc",
    "sku_enc", "risk_enc",
)
COST_QUANTILE = 0.95
QUANTITY_QUANTILE = 0.97


def risk_target() -> Column:
    """1 for a supplier that disrupts often or is rated HIGH or CRITICAL."""
    often = F.coalesce(F.col("disruption_rate_pct") > 20, F.lit(False))
    rated = F.coalesce(F.col("risk_level").isin("HIGH", "CRITICAL"), F.lit(False))
    return (often | rated).cast("int")


def supplier_matrix(features: DataFrame) -> DataFrame:
    """Supplier features with codes and the target; the model reads ``SUPPLIER_FEATURES`` in order."""
    coded = label_encode(
        features, {"country": "country_enc", "product_category": "category_enc", "risk_level": "risk_enc"})
    return coded.withColumn("is_active_int", F.col("is_active").cast("int")).withColumn("target", risk_target())


def target_distribution(features: DataFrame) -> DataFrame:
    return features.select(risk_target().alias("target")).groupBy("target").agg(F.count("*").alias("suppliers"))


def _or_one(column: str) -> Column:
    return F.when(F.col(column) == 0, 1).otherwise(F.col(column))


def shipment_ratios(enriched: DataFrame) -> DataFrame:
    """Freight per unit, and delay relative to the supplier's lead time."""
    return (
        enriched
        .withColumn("cost_per_unit", half_even(F.col("freight_cost_usd") / _or_one("quantity_shipped"), 4))
        .withColumn("delay_ratio", half_even(F.col("delay_days") / _or_one("supplier_lead_time"), 4))
    )


SHIPMENT_CODES = {
    "origin_country": "country_enc", "destination_warehouse": "warehouse_enc", "carrier": "carrier_enc",
    "sku": "sku_enc", "supplier_risk_level": "risk_enc",
}


def shipment_dictionaries(ratios: DataFrame, stored: bool = False) -> dict[str, Dictionary]:
    return dictionaries(ratios, list(SHIPMENT_CODES), stored)


def shipment_codes(ratios: DataFrame, books: dict[str, Dictionary] | None = None) -> DataFrame:
    """Shipments with ratios and codes; the model reads ``SHIPMENT_FEATURES`` in order, null as 0."""
    coded = apply_codes(ratios, SHIPMENT_CODES, books or shipment_dictionaries(ratios))
    return coded.withColumn("is_disrupted_int", F.col("is_disrupted").cast("int"))


def reason_thresholds(shipments: DataFrame) -> dict[str, float | None]:
    """Cost and quantity above which a shipment stands out, over all shipments."""
    return exact_quantiles(shipments, {
        "cost_per_unit": (F.col("cost_per_unit"), COST_QUANTILE),
        "quantity_shipped": (F.col("quantity_shipped"), QUANTITY_QUANTILE),
    })


def reason_flags(thresholds: dict[str, float | None]) -> Column:
    """Every rule a shipment meets, in order; a shipment that meets none stands out only as a whole."""
    rules = [
        ("SEVERE_DELAY", F.col("delay_days") > 20),
        ("HIGH_FREIGHT_COST", F.col("cost_per_unit") > F.lit(thresholds["cost_per_unit"])),
        ("UNUSUALLY_LARGE_SHIPMENT", F.col("quantity_shipped") > F.lit(thresholds["quantity_shipped"])),
        ("DELAY_EXCEEDS_LEAD_TIME_2X", F.col("delay_ratio") > 2),
        ("LOW_RELIABILITY_DISRUPTION", (F.col("reliability_score") < 0.6) & F.col("is_disrupted")),
    ]
    met = F.concat_ws(" | ", *[F.when(rule, name) for name, rule in rules])
    return F.when(met == "", "MULTIVARIATE_PATTERN").otherwise(met)


def stratified_split(df: DataFrame, key: str, target: str, share: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``is_test``: an exact share of the rows, in the proportions of the classes.

    A row is in the test set when the hash of its key is among the smallest of its class. The cut-off is
    found as an order statistic, so no class is ever sorted in one task.
    """
    # 13 hexadecimal digits are 52 bits, so that a double holds the hash exactly.
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    hashed = df.withColumn("_hash", number)
    classes = [row[target] for row in df.select(target).distinct().orderBy(target).collect()]  # two classes
    series = {str(c): F.when(F.col(target) == c, F.col("_hash")) for c in classes}
    ranges = column_ranges(hashed, series)
    quotas = class_quotas({name: n for name, (n, _, _) in ranges.items()}, share)
    ranks = {name: {quota} for name, quota in quotas.items() if quota < ranges[name][0]}
    cuts = values_at_ranks(hashed, series, ranks, ranges)
    is_test = F.lit(False)
    for c in classes:
        cut = cuts.get((str(c), quotas[str(c)]))
        is_test = F.when(F.col(target) == c, F.lit(True) if cut is None else F.col("_hash") < cut).otherwise(is_test)
    return hashed.withColumn("is_test", is_test).drop("_hash")


def class_quotas(counts: dict[str, int], share: float) -> dict[str, int]:
    """Test rows per class: the rounded-up total, shared out by largest remainder."""
    total = sum(counts.values())
    wanted = -int(-share * total // 1)
    exact = {name: n * wanted / total for name, n in counts.items()}
    quotas = {name: int(x) for name, x in exact.items()}
    spare = sorted(exact, key=lambda name: (quotas[name] - exact[name], name))
    for name in spare[: wanted - sum(quotas.values())]:
        quotas[name] += 1
    return quotas
