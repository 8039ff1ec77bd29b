"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from quayside import plans
from quayside.plans.catalog import QUERIES
from quayside.plans.warehouse import Warehouse
from quayside.session import local_session

HEADLINE = (
    "stg_shipments", "mart_supplier_risk", "mart_inventory_health", "supplier_features", "shipment_supplier_enrich",
    "country_risk_profile", "weather_country_summary", "fx_volatility", "demand_daily", "forecast_trend_weekday",
    "stockout_risk", "anomaly_features", "quantile_thresholds", "reason_flags", "dq_unique", "dq_not_null",
    "dq_accepted_values", "fk_violations", "kpi_overview_without_scores", "carrier_performance",
    "kpi_inventory", "warehouse_stock_value", "demand_forecast", "risk_model_scores", "shap_explanations",
    "anomaly_reasons",
)


# These store a model or its predictions, so a repeated run would read them: timed once, from nothing.
BUILT = {"risk_model_scores", "shap_explanations", "anomaly_reasons"}
RUNS = 3


def timed(spark, folder: str, name: str) -> float:
    """Seconds of one run. The noop sink computes every column of every row and keeps nothing."""
    plans.warehouse._BUILT.clear()
    began = time.perf_counter()
    QUERIES[name](Warehouse(spark, folder)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    timed(spark, folder, "stg_shipments")  # compile and warm up on the fact before the clock
    seconds = {name: round(median(timed(spark, folder, name) for _ in range(1 if name in BUILT else RUNS)), 3)
               for name in HEADLINE}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
