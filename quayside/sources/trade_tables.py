"""Supply-chain raw tables derived from a trade star schema (suppliers, parts, orders, line items, events).

Each builder takes the raw columns that are wanted and joins only the tables
those columns come from. Every join is a left join onto a unique key, so leaving
one out never changes the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2024, 1, 31)
RUN_TS = "2024-01-31T00:00:00"

SUPPLIER_COLUMNS = (
    "supplier_id", "supplier_name", "country", "contact_email", "product_category", "lead_time_days",
    "reliability_score", "risk_level", "active", "onboarded_date", "annual_spend_usd",
    "_ingested_at", "_source_file",
)
INVENTORY_COLUMNS = (
    "inventory_id", "sku", "product_category", "warehouse", "supplier_id", "quantity_on_hand",
    "reorder_point", "below_reorder", "unit_cost_usd", "last_restocked_date", "expiry_date",
    "_ingested_at", "_source_file",
)
SHIPMENT_COLUMNS = (
    "shipment_id", "supplier_id", "sku", "origin_country", "destination_warehouse", "quantity_shipped",
    "scheduled_date", "actual_arrival_date", "delay_days", "status", "freight_cost_usd", "carrier",
    "disruption_flag", "_ingested_at", "_source_file",
)
_NEEDS_ORDER = {"destination_warehouse", "scheduled_date", "actual_arrival_date", "delay_days", "status",
                "disruption_flag"}


def padded(key: str, digits: int) -> Column:
    """A number as text of at least so many digits; longer ones keep theirs."""
    text = F.col(key).cast("string")
    return F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text)


def supplier_id(key: str) -> Column:
    return F.concat(F.lit("SUP-"), padded(key, 6))


def supplier_columns() -> dict[str, Column]:
    """The raw supplier columns that follow from the supplier row alone."""
    key = F.col("s_suppkey")
    level = (key * 7919) % 10
    return {
        "supplier_id": supplier_id("s_suppkey"),
        "supplier_name": F.concat(F.lit(" "), F.col("s_name"), F.lit("  ")),
        "contact_email": F.concat(F.lit(" "), F.col("s_name"), F.lit("@Example.COM ")),
        "product_category": F.concat(F.lit("CAT-"), (key % 5).cast("string")),
        "lead_time_days": (7 + key % 84).cast("int"),
        "reliability_score": 0.5 + ((key * 37) % 51).cast("double") / 100.0,
        "risk_level": F.when(level < 4, "LOW").when(level < 7, "MEDIUM").when(level < 9, "HIGH")
        .otherwise("CRITICAL"),
        "active": key % 7 != 3,
        "onboarded_date": F.date_add(F.lit(dt.date(2020, 1, 1)), (key % 1000).cast("int")),
        "annual_spend_usd": F.abs("s_acctbal") * 100.0,
    }


class TradeTables:
    """Raw tables over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str, as_of: dt.date = AS_OF, run_ts: str = RUN_TS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.as_of = as_of
        self.run_ts = run_ts

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _load_columns(self, source: str) -> dict[str, Column]:
        return {"_ingested_at": F.lit(self.run_ts), "_source_file": F.lit(source)}

    # -- suppliers, inventory, shipments ---------------------------------

    def raw_suppliers(self, columns: Iterable[str] = SUPPLIER_COLUMNS) -> DataFrame:
        wanted = [c for c in SUPPLIER_COLUMNS if c in set(columns)]
        rows = self.table("supplier")
        if "country" in wanted:
            nation = self.table("nation").select("n_nationkey", "n_name")
            rows = rows.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        exprs = {
            **supplier_columns(),
            "country": F.concat(F.col("n_name"), F.lit(" ")) if "country" in wanted else F.lit(None),
            **self._load_columns("supplier.parquet"),
        }
        return rows.select(*[exprs[c].alias(c) for c in wanted])

    def raw_inventory(self, columns: Iterable[str] = INVENTORY_COLUMNS) -> DataFrame:
        wanted = [c for c in INVENTORY_COLUMNS if c in set(columns)]
        rows = self.table("part")
        if "supplier_id" in wanted:
            # One supplier per part; the minimum is combined map-side before the exchange.
            source = self.table("lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("i_suppkey"))
            rows = rows.join(source, F.col("p_partkey") == F.col("l_partkey"), "left")
        key = F.col("p_partkey")
        on_hand = F.greatest(F.lit(0), (key * 7919) % 5001 - 100).cast("int")
        reorder = (50 + F.col("p_size") * 9).cast("int")
        exprs = {
            "inventory_id": F.concat(F.lit("INV-"), padded("p_partkey", 7)),
            "sku": F.concat(F.lit(" "), F.col("p_brand")),
            "product_category": F.concat(F.col("p_type"), F.lit(" ")),
            "warehouse": F.concat(F.lit("WH-"), (key % 8).cast("string")),
            "supplier_id": supplier_id("i_suppkey"),
            "quantity_on_hand": on_hand,
            "reorder_point": reorder,
            "below_reorder": on_hand < reorder,
            "unit_cost_usd": F.col("p_retailprice") / 10.0,
            "last_restocked_date": F.date_sub(F.lit(dt.date(2024, 1, 1)), (key % 180).cast("int")),
            "expiry_date": F.date_add(F.lit(dt.date(2024, 7, 1)), (key % 900).cast("int")),
            **self._load_columns("part.parquet"),
        }
        return rows.select(*[exprs[c].alias(c) for c in wanted])

    def raw_shipments(self, columns: Iterable[str] = SHIPMENT_COLUMNS, of_supplier: Iterable[str] = ()) -> DataFrame:
        """Raw shipments; with ``of_supplier`` also these raw columns of the supplier, whom the rows meet only once."""
        wanted = [c for c in SHIPMENT_COLUMNS if c in set(columns)]
        rows = self.table("lineitem")
        if _NEEDS_ORDER & set(wanted):
            orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
            if "destination_warehouse" in wanted:
                # Attach the customer to the order, not to the several times longer line table.
                customer = self.table("customer").select("c_custkey", "c_nationkey")
                orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if "sku" in wanted:
            part = self.table("part").select("p_partkey", "p_brand")
            rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        attributes = {f"s_{c}": supplier_columns()[c] for c in of_supplier}
        if "origin_country" in wanted or attributes:
            home = self.table("supplier")
            if "origin_country" in wanted:
                nation = self.table("nation").select("n_nationkey", "n_name")
                home = home.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            home = home.select("s_suppkey", *["n_name"] * ("origin_country" in wanted),
                               *[value.alias(name) for name, value in attributes.items()])
            rows = rows.join(home, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        exprs: dict[str, Column] = {
            "shipment_id": F.concat_ws("-", F.lit("SHP"), *[
                F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]),
            "supplier_id": supplier_id("l_suppkey"),
            "sku": F.concat(F.lit(" "), F.col("p_brand")) if "sku" in wanted else F.lit(None),
            "origin_country": F.concat(F.col("n_name"), F.lit(" ")) if "origin_country" in wanted else F.lit(None),
            "quantity_shipped": F.col("l_quantity").cast("int"),
            "freight_cost_usd": F.col("l_extendedprice") * 0.1,
            "carrier": F.concat(F.lit("CARRIER-"), (F.col("l_orderkey") % 8).cast("string")),
            **self._load_columns("lineitem.parquet"),
        }
        if _NEEDS_ORDER & set(wanted):
            scheduled = F.col("o_orderdate").cast("date")
            delay = F.expr(
                "cast(greatest(0, datediff(l_shipdate, o_orderdate)) div (40 * (1 + l_suppkey % 5)) as int)")
            derived = shipment_rules(scheduled, delay, self.as_of)
            exprs |= {"scheduled_date": scheduled, "delay_days": delay, **derived}
            if "destination_warehouse" in wanted:
                exprs["destination_warehouse"] = F.concat(F.lit("WH-"), (F.col("c_nationkey") % 8).cast("string"))
        return rows.select(*[exprs[c].alias(c) for c in wanted],
                           *[F.col(name).alias(name[2:]) for name in attributes])

    def demand_history(self) -> DataFrame:
        """Units asked for per day, sku and warehouse."""
        lines = self.raw_shipments(("scheduled_date", "sku", "destination_warehouse", "quantity_shipped"))
        # Grouped under the names and types of the result, so that a later sum by the same keys needs no exchange.
        return lines.groupBy(
            F.col("scheduled_date").alias("date"), F.trim("sku").alias("sku"),
            F.col("destination_warehouse").alias("warehouse"),
        ).agg(F.sum("quantity_shipped").alias("demand"))

    # -- external signals -------------------------------------------------

    def fx_history(self) -> DataFrame:
        """Mean event value per event type and day, read as a daily rate per currency."""
        return self.table("events").groupBy(
            F.col("ts").cast("date").alias("date"), F.upper("event_type").alias("currency_code"),
        ).agg(F.avg("value").alias("rate_vs_usd"))

    def fx_countries(self) -> DataFrame:
        """Each nation's currency: six codes, of which USD has no history."""
        codes = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW", "USD", "NONE"]
        picked = F.element_at(F.array(*[F.lit(c) for c in codes]), F.col("n_nationkey") % len(codes) + 1)
        return self.table("nation").select(F.col("n_name").alias("country"), picked.alias("currency_code"))

    def weather_daily(self) -> DataFrame:
        """One observation per country and day; the country is the last digit of the user id."""
        number = (F.col("user_id") % 10).cast("string")
        return (
            self.table("events")
            .groupBy(F.col("ts").cast("date").alias("date"), number.alias("place"))
            .agg(
                (F.max("value") / 5).alias("precipitation_mm"),
                F.avg("value").alias("windspeed_kmh"),
                (F.max("value") / 6).alias("temp_max_c"),
                (F.min("value") - 8).alias("temp_min_c"),
                (F.min("value") / 2).alias("snowfall_cm"),
                (F.count("*") % 100).cast("int").alias("weather_code"),
            )
            .select(
                "date", F.concat(F.lit("COUNTRY_"), "place").alias("country"),
                F.concat(F.lit("CITY_"), "place").alias("city"), "precipitation_mm", "windspeed_kmh",
                "temp_max_c", "temp_min_c", "snowfall_cm", "weather_code",
            )
        )

    def country_indicator(self, indicator: str) -> DataFrame:
        """Country indicator values measured on the trade itself, some of them missing.

        ``logistics`` falls with the mean days from order to shipment of a nation's suppliers, on a
        1 to 5 scale; ``income`` is the mean order value of a nation's customers.
        """
        nation = self.table("nation")
        orders = self.table("orders")
        if indicator == "logistics":
            lag = (
                self.table("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
                .join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
                .groupBy("l_suppkey")
                .agg(F.sum(F.abs(F.datediff("l_shipdate", "o_orderdate"))).alias("days"), F.count("*").alias("lines"))
            )
            measured = (
                lag.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
                .groupBy(F.col("s_nationkey").alias("nationkey"))
                .agg((5 - 4 * F.sum("days") / F.sum("lines") / 1250.0).alias("value"))
            )
            missing = F.col("n_nationkey") % 12 == 11
        elif indicator == "income":
            spend = orders.groupBy("o_custkey").agg(
                F.sum("o_totalprice").alias("spend"), F.count("*").alias("orders"))
            measured = (
                spend.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
                .groupBy(F.col("c_nationkey").alias("nationkey"))
                .agg((F.sum("spend") / F.sum("orders") / 10.0).alias("value"))
            )
            missing = F.col("n_nationkey") % 6 == 5
        else:
            raise ValueError(indicator)
        return nation.join(measured, F.col("n_nationkey") == F.col("nationkey"), "left").select(
            "n_regionkey", F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("country_code"),
            F.col("n_name").alias("country_name"), F.when(~missing, F.col("value")).alias("value"),
            F.lit("2023").alias("date"),
        )

    def country_names(self) -> DataFrame:
        """The suppliers' own country names for ten of the nations."""
        return self.table("nation").filter(F.col("n_nationkey") % 5 < 2).select(
            F.concat(F.lit("LOCAL_"), F.col("n_nationkey").cast("string")).alias("our_country_name"),
            F.col("n_name").alias("country_name"),
        )


def shipment_rules(scheduled: Column, delay: Column, as_of: dt.date) -> dict[str, Column]:
    """Arrival date, status and disruption flag that follow from the schedule and the delay."""
    return {
        "actual_arrival_date": F.date_add(scheduled, delay),
        "status": F.when(delay > 5, "DELAYED").when(delay == 0, "ON_TIME")
        .when(scheduled > F.lit(as_of), "IN_TRANSIT").otherwise("DELIVERED"),
        "disruption_flag": delay > 14,
    }
