"""The models by name over one folder of tables: what a report asks for is built lazily, predictions once."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import (
    anomalies, demand, explain, external, features, linear_risk, risk_model, robust_anomalies, shipments, staging,
)
from quayside.plans import marts
from quayside.session import checkpoint_dir, configure, cut_lineage
from quayside.sources import feeds
from quayside.sources.trade_tables import TradeTables

# Trained models and prediction tables of this process, by application, run, state of the tables and name.
_BUILT: dict[tuple, object] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.raw = TradeTables(spark, folder)
        self._state: int | None = None

    # -- staging ---------------------------------------------------------

    def suppliers(self, *columns: str) -> DataFrame:
        wanted = columns or staging.SUPPLIERS
        raw = self.raw.raw_suppliers(staging.raw_inputs("supplier_id", wanted))
        return staging.stg_suppliers(raw, wanted)

    def inventory(self, *columns: str) -> DataFrame:
        wanted = columns or staging.INVENTORY
        raw = self.raw.raw_inventory(staging.raw_inputs("inventory_id", wanted))
        return staging.stg_inventory(raw, wanted)

    def shipments(self, *columns: str) -> DataFrame:
        wanted = columns or staging.SHIPMENTS
        raw = self.raw.raw_shipments(staging.raw_inputs("shipment_id", wanted))
        return staging.stg_shipments(raw, wanted)

    # -- marts -------------------------------------------------------------

    def _stats_input(self) -> DataFrame:
        return self.shipments("supplier_id", "is_disrupted", "delay_days", "freight_cost_usd")

    def supplier_risk(self) -> DataFrame:
        return marts.mart_supplier_risk(self.suppliers(), self._stats_input())

    def inventory_health(self) -> DataFrame:
        return marts.mart_inventory_health(self.inventory(), self.suppliers(), self.raw.as_of)

    def stock(self) -> DataFrame:
        """Status per stock line, for the reports that need no supplier."""
        lines = self.inventory("sku", "warehouse", "quantity_on_hand", "reorder_point", "is_below_reorder",
                               "stock_value_usd")
        return lines.withColumn("stock_status", marts.stock_status())

    # -- features ------------------------------------------------------------

    def supplier_features(self) -> DataFrame:
        return shipments.supplier_features(self.suppliers(), self._stats_input())

    def enriched_shipments(self, *columns: str) -> DataFrame:
        """Shipments, all columns or the named ones, with their supplier's attributes. The rows meet the suppliers once,
        by number, for the country of origin and the attributes alike."""
        wanted = ("shipment_id", "supplier_id", *(columns or shipments.ENRICHED[2:11]))
        raw = self.raw.raw_shipments(staging.raw_inputs("shipment_id", wanted), shipments.ATTRIBUTES)
        return shipments.with_attribute_names(
            staging.stg_shipments_of_suppliers(raw, wanted, shipments.ATTRIBUTES))

    def shipment_ratios(self, *columns: str) -> DataFrame:
        return features.shipment_ratios(self.enriched_shipments(*columns))

    def reason_thresholds(self) -> dict[str, float | None]:
        # Cost per unit needs neither supplier nor order, so the passes read the line table alone.
        lines = self.shipments("quantity_shipped", "freight_cost_usd").withColumns(
            {"delay_days": F.lit(0), "supplier_lead_time": F.lit(1)})
        return features.reason_thresholds(features.shipment_ratios(lines))

    # -- external signals -------------------------------------------------------

    def indicator_documents(self, indicator: str) -> DataFrame:
        """The indicator as landed: one ``[header, [observations]]`` document per region."""
        values = self.raw.country_indicator(indicator)
        observation = F.struct(
            F.struct(F.col("country_code").alias("id"), F.col("country_name").alias("value")).alias("country"),
            "value", "date")
        keep_nulls = {"ignoreNullFields": "false"}
        # A document holds the nations of one region.
        items = F.to_json(F.array_sort(F.collect_list(observation)), keep_nulls)
        return values.groupBy("n_regionkey").agg(items.alias("items"), F.count("*").alias("n")).select(
            F.format_string('[{"page": 1, "total": %d}, %s]', "n", "items").alias("payload"))

    def lpi(self) -> DataFrame:
        return feeds.flatten_indicator(self.indicator_documents("logistics"), "lpi_score", 3)

    def gdp(self) -> DataFrame:
        return feeds.flatten_indicator(self.indicator_documents("income"), "gdp_per_capita_usd", 2)

    def country_profile(self) -> DataFrame:
        return external.country_risk_profile(
            external.minmax_normalise(self.lpi()), self.gdp(), self.raw.country_names())

    def weather_documents(self) -> DataFrame:
        """The weather as landed: one document of parallel arrays per country, a few readings missing."""
        # The names of the readings in a landed document.
        names = {
            "precipitation_mm": "precipitation_sum", "windspeed_kmh": "windspeed_10m_max",
            "temp_max_c": "temperature_2m_max", "temp_min_c": "temperature_2m_min",
            "snowfall_cm": "snowfall_sum", "weather_code": "weathercode",
        }
        daily = self.raw.weather_daily().withColumn(
            "snowfall_cm", F.when(F.dayofmonth("date") % 10 != 0, F.col("snowfall_cm")))
        day = F.struct("date", *names)
        # One list entry per calendar day.
        grouped = daily.groupBy("country", "city").agg(F.array_sort(F.collect_list(day)).alias("days"))
        arrays = [F.transform("days", lambda d: d["date"].cast("string")).alias("time")]
        arrays += [F.col(f"days.{column}").alias(name) for column, name in names.items()]
        return grouped.select(F.to_json(
            F.struct("country", "city", F.struct(*arrays).alias("daily")), {"ignoreNullFields": "false"},
        ).alias("payload"))

    def landed_weather(self) -> str:
        """A folder with the weather as landed by city: ``city=.../`` files that do not name the city, of which some
        lack the snowfall, others the weather code, and one is empty."""
        def land() -> str:
            path = f"{checkpoint_dir(self.spark)}/weather-{uuid4().hex}"
            parsed = self.weather_documents().select(F.from_json("payload", feeds.WEATHER_SCHEMA).alias("doc"))
            number = F.substring("doc.city", -1, 1).cast("int")
            whole = F.to_json(F.struct("doc.country", "doc.daily"), {"ignoreNullFields": "false"})
            no_snow = F.to_json(F.struct("doc.country", F.col("doc.daily").dropFields("snowfall_sum").alias("daily")))
            no_code = F.to_json(F.struct("doc.country", F.col("doc.daily").dropFields("weathercode").alias("daily")))
            payload = F.when(number % 3 == 0, no_snow).when(number % 3 == 1, no_code).otherwise(whole)
            files = parsed.select(payload.alias("value"), F.col("doc.city").alias("city"))
            files = files.unionByName(files.limit(1).select(F.lit("").alias("value"), F.lit("CITY_SILENT").alias("city")))
            files.write.partitionBy("city").text(path)
            return path
        return self._once("landed_weather", land)

    def weather(self) -> DataFrame:
        return feeds.flatten_weather(self.weather_documents())

    def weather_scored(self) -> DataFrame:
        return external.weather_disruption_score(self.weather())

    def weather_summary(self) -> DataFrame:
        return external.weather_country_summary(self.weather_scored(), self.raw.run_ts)

    def fx_documents(self) -> DataFrame:
        """The rate history as landed: one ``{rates: {date: {currency: rate}}}`` document per month."""
        by_day = self.raw.fx_history().groupBy("date").agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("currency_code", "rate_vs_usd"))))
            .alias("quotes"))
        month = F.date_format("date", "yyyy-MM")
        entries = F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("d"),
                                                       F.map_entries("quotes").alias("q"))))
        rates = F.map_from_entries(F.transform(
            "days", lambda e: F.struct(e["d"], F.map_from_entries(e["q"]))))
        return by_day.groupBy(month.alias("month")).agg(entries.alias("days")).select(
            F.to_json(F.struct(rates.alias("rates"))).alias("payload"))

    def fx_history(self) -> DataFrame:
        return feeds.flatten_fx_history(self.fx_documents())

    def fx_latest_document(self) -> DataFrame:
        """The latest rates as landed: ``{rates: {currency: rate}, date}``."""
        daily = self.raw.fx_history()
        last = daily.groupBy("currency_code").agg(
            F.max_by("rate_vs_usd", "date").alias("rate"), F.max("date").alias("date"))
        return last.agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("currency_code", "rate")))).alias("rates"),
            F.max("date").cast("string").alias("date"),
        ).select(F.to_json(F.struct("rates", "date")).alias("payload"))

    def fx_current(self) -> DataFrame:
        return feeds.fx_current_lookup(self.fx_latest_document(), self.raw.fx_countries())

    def fx_volatility(self) -> DataFrame:
        return external.fx_volatility(self.fx_current(), self.fx_history(), self.raw.run_ts)

    # -- demand --------------------------------------------------------------------

    def demand_history(self) -> DataFrame:
        return self.raw.demand_history()

    def trend_forecast(self) -> DataFrame:
        return demand.forecast_trend_weekday(self.demand_history())

    def stockout(self) -> DataFrame:
        stock = self.inventory("sku", "warehouse", "quantity_on_hand", "reorder_point")
        return demand.stockout_risk(self.trend_forecast(), stock)

    def model_stockout(self) -> DataFrame:
        stock = self.inventory("sku", "warehouse", "quantity_on_hand", "reorder_point")
        return demand.stockout_risk(demand.demand_forecast(self.demand_history()), stock)

    # -- predictions, built once and stored -------------------------------------------

    def _once(self, name: str, build: Callable[[], object]):
        key = (self.spark.sparkContext.applicationId, self.raw.folder, str(self.raw.as_of), self.raw.run_ts,
               self._tables_state(), name)
        if key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]

    def _tables_state(self) -> int:
        """A hash of the paths, sizes and times of the tables' files; their content is not read."""
        if self._state is None:
            files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
                "recursiveFileLookup", "true").load(self.raw.folder)
            self._state = files.agg(F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()[0]
        return self._state

    def supplier_matrix(self) -> DataFrame:
        return self._once("supplier_matrix", lambda: cut_lineage(
            features.supplier_matrix(self.supplier_features())))

    def rule_scores(self) -> DataFrame:
        """Suppliers scored by their unreliability instead of a model."""
        score = F.round(1 - F.col("reliability_score"), 2)
        target = self.supplier_matrix().select("supplier_id", "target")
        return self.supplier_features().join(target, "supplier_id").withColumn("risk_probability", score).withColumns({
            "probability_high": F.col("risk_probability"),
            "predicted_risk": (F.col("risk_probability") > 0.25).cast("int"),
            "risk_tier": F.when(F.col("risk_probability") > 0.4, "HIGH").when(
                F.col("risk_probability") > 0.2, "MEDIUM").otherwise("LOW"),
        })

    def split_matrix(self) -> DataFrame:
        return self._once("split_matrix", lambda: cut_lineage(
            features.stratified_split(self.supplier_matrix(), "supplier_id", "target")))

    def risk_model(self):
        return self._once("risk_model", lambda: risk_model.train(self.split_matrix().filter("NOT is_test")))

    def test_predictions(self) -> DataFrame:
        return self._once("test_predictions", lambda: cut_lineage(
            risk_model.predict(self.risk_model(), self.split_matrix().filter("is_test"))))

    def risk_scores(self) -> DataFrame:
        return self._once("risk_scores", lambda: cut_lineage(
            risk_model.risk_scores(self.risk_model(), self.supplier_matrix(), self.raw.run_ts)))

    def explanations(self) -> DataFrame:
        def build() -> DataFrame:
            model = risk_model.train(self.supplier_matrix())
            return cut_lineage(explain.shap_explanations(
                explain.explain(model, self.supplier_matrix(), risk_model.DEPTH)))
        return self._once("explanations", build)

    def linear_model(self) -> linear_risk.LinearModel:
        return self._once("linear_model", lambda: linear_risk.train(self.supplier_matrix()))

    def linear_scores(self) -> DataFrame:
        return linear_risk.risk_scores(self.linear_model(), self.supplier_matrix(), self.raw.run_ts)

    def linear_explanations(self) -> DataFrame:
        return explain.shap_explanations(linear_risk.explain(self.linear_model(), self.supplier_matrix()))

    def shipment_anomalies(self) -> DataFrame:
        return self._once("shipment_anomalies", lambda: anomalies.shipment_anomalies(
            self.enriched_shipments(), self.raw.table("lineitem").count()))

    def robust_anomalies(self) -> DataFrame:
        return self._once("robust_anomalies", lambda: robust_anomalies.shipment_anomalies(self.enriched_shipments()))
