"""Check SQL per query name. Queries that train a model have none."""

from __future__ import annotations

from oracle.views import with_views

_SCORED_WEATHER = (
    "date, country, city, precipitation_mm, round(windspeed_kmh, 6) AS windspeed_kmh, temp_max_c, temp_min_c, "
    "snowfall_cm, weather_code")
_FLAGS = ("heavy_rain, strong_wind, extreme_heat, extreme_cold, heavy_snow, weather_disruption_score, "
          "weather_risk_tier")
_FX_VIEW = """SELECT country, currency_code, round(current_rate_vs_usd, 6) AS current_rate_vs_usd, pct_change_30d,
daily_volatility_pct, currency_risk_score, currency_risk_tier FROM fx_volatility"""
_FX_ALL = """SELECT country, currency_code, round(current_rate_vs_usd, 6) AS current_rate_vs_usd,
round(rate_30d_ago, 6) AS rate_30d_ago, pct_change_30d, daily_volatility_pct, currency_risk_score,
currency_risk_tier, fetched_at FROM fx_volatility"""
_MART_KEPT = """SELECT supplier_id, supplier_name, country, product_category, risk_level, reliability_score,
lead_time_days, is_active, annual_spend_usd, total_shipments, disrupted_shipments, avg_delay_days, max_delay_days,
disruption_rate_pct, risk_score FROM mart_supplier_risk WHERE risk_level IN ('CRITICAL', 'HIGH')"""
_STOCKOUT = """sku, warehouse, round(forecasted_demand_90d, 4) AS forecasted_demand_90d, peak_daily_demand,
round(avg_daily_demand, 6) AS avg_daily_demand, current_stock, reorder_point, days_until_stockout, stockout_risk,
will_stockout_90d"""
_RAW = ("raw_suppliers", "raw_inventory", "raw_shipments")


def _counts(source: str, column: str) -> str:
    return (f"SELECT {column}, count(*) AS count FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 "
            f"ORDER BY 2 DESC, 1")


def _nulls(model: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM {model}"
        for c in columns.split())


def _duplicates(model: str, key: str) -> str:
    return (f"SELECT '{model}' AS model, '{key}' AS column_name, {key} AS value, count(*) AS occurrences "
            f"FROM {model} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1")


def _rejected(model: str, column: str, accepted: str) -> str:
    listed = ", ".join(f"'{v}'" for v in accepted.split())
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, {column} AS value, count(*) AS occurrences "
            f"FROM {model} WHERE {column} NOT IN ({listed}) GROUP BY {column}")


_LEVELS = "LOW MEDIUM HIGH CRITICAL"
_DUPLICATES = " UNION ALL ".join([
    _duplicates("stg_suppliers", "supplier_id"), _duplicates("stg_inventory", "inventory_id"),
    _duplicates("stg_shipments", "shipment_id"), _duplicates("mart_supplier_risk", "supplier_id"),
    _duplicates("mart_inventory_health", "inventory_id")])
_NULLS = " UNION ALL ".join([
    _nulls("stg_suppliers", "supplier_id supplier_name country risk_level reliability_score is_active"),
    _nulls("stg_inventory", "inventory_id sku warehouse quantity_on_hand unit_cost_usd"),
    _nulls("stg_shipments", "shipment_id supplier_id status delay_category delay_days"),
    _nulls("mart_supplier_risk", "supplier_id risk_level disruption_rate_pct reliability_score"),
    _nulls("mart_inventory_health", "inventory_id stock_status stock_value_usd")])
_REJECTED = " UNION ALL ".join([
    _rejected("stg_suppliers", "risk_level", _LEVELS),
    _rejected("stg_inventory", "warehouse", "Nairobi-KE Mombasa-KE Lagos-NG Accra-GH Cairo-EG Johannesburg-ZA "
                                            "London-UK Dubai-UAE"),
    _rejected("stg_shipments", "status", "ON_TIME DELAYED IN_TRANSIT DELIVERED CANCELLED"),
    _rejected("stg_shipments", "delay_category", "NO_DELAY MINOR MODERATE SEVERE"),
    _rejected("mart_supplier_risk", "risk_level", _LEVELS),
    _rejected("mart_inventory_health", "stock_status", "HEALTHY LOW CRITICAL STOCKOUT")])

_REJECTED_COLUMNS = (
    "stg_suppliers risk_level", "stg_inventory warehouse", "stg_shipments status", "stg_shipments delay_category",
    "mart_supplier_risk risk_level", "mart_inventory_health stock_status")
_UNIQUE_COLUMNS = (
    "stg_suppliers supplier_id", "stg_inventory inventory_id", "stg_shipments shipment_id",
    "mart_supplier_risk supplier_id", "mart_inventory_health inventory_id")


def _summary() -> str:
    """All 36 checks: the found violations counted per check, zero where none were found."""
    parts = [f"SELECT model, column_name, 'not_null' AS check_name, null_count AS violations FROM ({_NULLS})"]
    for check, columns, found, size in (("unique", _UNIQUE_COLUMNS, _DUPLICATES, "count(*)"),
                                        ("accepted_values", _REJECTED_COLUMNS, _REJECTED, "sum(occurrences)")):
        for model, column in (c.split() for c in columns):
            parts.append(
                f"SELECT '{model}', '{column}', '{check}', CAST(coalesce((SELECT {size} FROM ({found}) f "
                f"WHERE f.model = '{model}' AND f.column_name = '{column}'), 0) AS BIGINT)")
    parts.append("SELECT 'stg_shipments', 'supplier_id', 'relationships', count(*) FROM stg_shipments "
                 "WHERE supplier_id NOT IN (SELECT supplier_id FROM stg_suppliers)")
    parts.append("SELECT 'stg_shipments', 'delay_days', 'no_negative_delays', count(*) FILTER (delay_days < 0) "
                 "FROM stg_shipments")
    return (f"SELECT *, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status "
            f"FROM ({' UNION ALL '.join(parts)})")


_OVERVIEW = """SELECT (SELECT count(*) FROM stg_suppliers) AS total_suppliers,
(SELECT count(*) FILTER (is_active) FROM stg_suppliers) AS active_suppliers,
(SELECT round_even(count(*) FILTER (is_disrupted) / count(*)::DOUBLE * 100 * 10, 0) / 10 FROM stg_shipments)
  AS disruption_pct,
(SELECT count(*) FROM mart_inventory_health WHERE stock_status = 'STOCKOUT') AS stockouts,
(SELECT count(*) FROM mart_inventory_health WHERE stock_status IN ('STOCKOUT', 'CRITICAL')) AS stock_alerts"""

_MATRIX = """SELECT f.supplier_id, reliability_score, lead_time_days,
        CAST(is_active AS INTEGER) AS is_active_int, annual_spend_usd, total_shipments, disrupted_shipments,
        avg_delay_days, max_delay_days, disruption_rate_pct, country_enc, category_enc, risk_enc,
        CAST(disruption_rate_pct > 20 OR risk_level IN ('HIGH', 'CRITICAL') AS INTEGER) AS target
        FROM supplier_features f JOIN supplier_codes c ON f.supplier_id = c.supplier_id"""

_RULE = f"""SELECT *, CASE WHEN score > 0.4 THEN 'HIGH' WHEN score > 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS tier
    FROM (SELECT f.*, m.target, round(1 - f.reliability_score, 2) AS score
          FROM supplier_features f JOIN ({_MATRIX}) m USING (supplier_id))"""

_LABELS = """['Reliability Score', 'Lead Time (Days)', 'Is Active', 'Annual Spend (USD)', 'Total Shipments',
        'Disrupted Shipments', 'Avg Delay (Days)', 'Max Delay (Days)', 'Disruption Rate %', 'Country',
        'Product Category', 'Risk Level']"""
_PAGE = "supplier_id, supplier_name, risk_tier, risk_probability, top_risk_driver, explanation"

_BODIES: dict[str, str] = {
    # loading
    "ingest_metadata": "SELECT *, '2024-01-31T00:00:00' AS _ingested_at, 'orders.parquet' AS _source_file FROM orders",
    "load_summary": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {view}) AS row_count, "
        f"CAST({columns} AS INTEGER) AS column_count"
        for name, view, columns in [
            ("raw_suppliers", "raw_suppliers", 13), ("raw_inventory", "raw_inventory", 13),
            ("raw_shipments", "raw_shipments", 15), ("demand_history", "demand_history", 4),
            ("weather_daily", "weather_scored", 16), ("country_lpi", "lpi", 6),
            ("currency_rates_historical", "fx_history", 3)]),
    "preview": "SELECT * FROM raw_suppliers ORDER BY supplier_id LIMIT 3",
    "preview_inventory": "SELECT * FROM raw_inventory ORDER BY inventory_id LIMIT 3",
    "preview_shipments": "SELECT * FROM raw_shipments ORDER BY shipment_id LIMIT 3",
    "indicator_json_flatten": "SELECT * FROM lpi",
    "indicator_json_flatten_gdp": "SELECT * FROM gdp",
    "fx_json_flatten": "SELECT date, currency_code, round(rate_vs_usd, 6) AS rate_vs_usd FROM fx_history",
    "fx_current_lookup": "SELECT country, currency_code, round(rate_vs_usd, 6) AS rate_vs_usd, date FROM fx_current",
    "weather_json_flatten": f"SELECT {_SCORED_WEATHER} FROM weather",
    "weather_concat": """SELECT date, country, city, precipitation_mm, round(windspeed_kmh, 6) AS windspeed_kmh,
        temp_max_c, temp_min_c, if(right(city, 1)::INTEGER % 3 = 0, 0, snowfall_cm) AS snowfall_cm,
        if(right(city, 1)::INTEGER % 3 = 1, 0, weather_code)::INTEGER AS weather_code FROM weather""",
    # staging and marts
    "stg_suppliers": "SELECT * FROM stg_suppliers",
    "stg_inventory": "SELECT * FROM stg_inventory",
    "stg_shipments": "SELECT * FROM stg_shipments",
    "mart_supplier_risk": """SELECT * REPLACE (round(total_freight_cost, 3) AS total_freight_cost)
        FROM mart_supplier_risk""",
    "mart_inventory_health": "SELECT * FROM mart_inventory_health",
    "shipment_stats": "SELECT * REPLACE (round(total_freight_cost, 3) AS total_freight_cost) FROM shipment_stats",
    "supplier_rate_stats": "SELECT * FROM supplier_rate_stats",
    "supplier_features": "SELECT * FROM supplier_features",
    "shipment_supplier_enrich": "SELECT * FROM enriched_shipments",
    "shipment_derive": """SELECT shipment_id, scheduled_date, delay_days,
        scheduled_date + delay_days AS actual_arrival_date,
        CASE WHEN delay_days > 5 THEN 'DELAYED' WHEN delay_days = 0 THEN 'ON_TIME'
             WHEN scheduled_date > DATE '1998-06-30' THEN 'IN_TRANSIT' ELSE 'DELIVERED' END AS status,
        delay_days > 14 AS disruption_flag FROM raw_shipments""",
    "inventory_derive": """SELECT inventory_id, quantity_on_hand, reorder_point,
        quantity_on_hand < reorder_point AS below_reorder FROM raw_inventory""",
    # external signals
    "minmax_normalise": "SELECT * FROM lpi_normalised",
    "filter_supplier_countries": "SELECT * FROM lpi WHERE country_name IN (SELECT country_name FROM country_names)",
    "country_risk_profile": "SELECT * FROM country_profile",
    "sorted_profiles": """SELECT our_country_name, lpi_score, logistics_risk_score, logistics_risk_tier
        FROM country_profile ORDER BY logistics_risk_score DESC, 1""",
    "external_lpi_view": "SELECT * RENAME (our_country_name AS country) FROM country_profile ORDER BY lpi_score",
    "external_lpi_view_by_risk":
        "SELECT * RENAME (our_country_name AS country) FROM country_profile ORDER BY logistics_risk_score DESC",
    "weather_disruption_score": f"""SELECT {_SCORED_WEATHER}, {_FLAGS} FROM weather_scored""",
    "weather_country_summary": "SELECT * FROM weather_summary",
    "sorted_weather": """SELECT country, city, avg_disruption_score, severe_days, warning_days, country_weather_risk
        FROM weather_summary ORDER BY 3 DESC, 1""",
    "external_weather_view": """SELECT country, city, avg_disruption_score, max_disruption_score, severe_days,
        warning_days, avg_precipitation_mm, avg_windspeed_kmh, country_weather_risk FROM weather_summary
        ORDER BY 3 DESC, 1""",
    "fx_daily_returns": """SELECT date, currency_code, round(rate_vs_usd, 6) AS rate_vs_usd,
        round(daily_return, 8) AS daily_return FROM fx_returns""",
    "fx_first_last": """SELECT currency_code, round(first_rate, 6) AS first_rate, round(last_rate, 6) AS last_rate,
        points, pct_change_30d FROM fx_ends""",
    "fx_volatility": _FX_ALL,
    "filter_high_fx": _FX_ALL + " WHERE currency_risk_tier IN ('HIGH', 'CRITICAL')",
    "sorted_fx": """SELECT country, currency_code, pct_change_30d, daily_volatility_pct, currency_risk_score,
        currency_risk_tier, fetched_at FROM fx_volatility ORDER BY currency_risk_score DESC, country""",
    "external_fx_view": _FX_VIEW + " ORDER BY currency_risk_score DESC, country",
    # demand and stock
    "demand_daily": """SELECT CAST(date AS DATE) AS date, sku, warehouse, CAST(sum(demand) AS BIGINT) AS demand
        FROM demand_history GROUP BY 1, 2, 3 ORDER BY 2, 3, 1""",
    "demand_refused": """SELECT * FROM (SELECT sku, warehouse, CAST(min(date) AS DATE) AS first_date,
        CAST(max(date) AS DATE) AS last_date,
        CAST(datediff('day', CAST(min(date) AS DATE), CAST(max(date) AS DATE)) + 1 AS INTEGER) AS days
        FROM demand_history GROUP BY 1, 2) WHERE days > 36525""",
    "demand_coverage": """SELECT count(*) AS records, count(DISTINCT sku) AS skus,
        count(DISTINCT warehouse) AS warehouses FROM demand_history""",
    "inventory_by_sku_wh": "SELECT * FROM inventory_by_sku_wh",
    "forecast_trend_weekday": "SELECT * FROM trend_forecast",
    "forecast_summary": """SELECT sku, warehouse, round(sum(yhat), 4) AS forecasted_demand_90d,
        max(yhat) AS peak_daily_demand, round(avg(yhat), 6) AS avg_daily_demand FROM trend_forecast GROUP BY 1, 2""",
    "stockout_risk": f"SELECT {_STOCKOUT} FROM stockout",
    "stockout_summary": """SELECT stockout_risk, count(*) AS combinations,
        round(avg(days_until_stockout), 1) AS avg_days_to_stockout,
        count(*) FILTER (will_stockout_90d) AS will_stockout FROM stockout GROUP BY 1 ORDER BY 3, 1""",
    "top5_stockout": """SELECT sku, warehouse, current_stock, round(avg_daily_demand, 1) AS avg_daily_demand,
        days_until_stockout, stockout_risk FROM stockout ORDER BY days_until_stockout, sku, warehouse LIMIT 5""",
    "closest_stockout_10": """SELECT sku, warehouse, current_stock, round(avg_daily_demand, 6) AS avg_daily_demand,
        days_until_stockout, round(forecasted_demand_90d, 4) AS forecasted_demand_90d, stockout_risk
        FROM stockout ORDER BY days_until_stockout, sku, warehouse LIMIT 10""",
    "stockout_tier_counts": _counts("stockout", "stockout_risk"),
    # features
    "label_encode": """SELECT s.supplier_id, country, product_category, risk_level, country_enc,
        category_enc, risk_enc FROM stg_suppliers s JOIN supplier_codes c ON s.supplier_id = c.supplier_id""",
    "label_encode_shipments": """SELECT shipment_id, origin_country, destination_warehouse, carrier, sku,
        supplier_risk_level, CAST(dense_rank() OVER (ORDER BY origin_country) - 1 AS INTEGER) AS country_enc,
        CAST(dense_rank() OVER (ORDER BY destination_warehouse) - 1 AS INTEGER) AS warehouse_enc,
        CAST(dense_rank() OVER (ORDER BY carrier) - 1 AS INTEGER) AS carrier_enc,
        CAST(dense_rank() OVER (ORDER BY sku) - 1 AS INTEGER) AS sku_enc,
        CAST(dense_rank() OVER (ORDER BY supplier_risk_level) - 1 AS INTEGER) AS risk_enc FROM enriched_shipments""",
    "risk_target": """SELECT supplier_id, risk_level, disruption_rate_pct,
        CAST(disruption_rate_pct > 20 OR risk_level IN ('HIGH', 'CRITICAL') AS INTEGER) AS target
        FROM supplier_features""",
    "target_distribution": """SELECT CAST(disruption_rate_pct > 20 OR risk_level IN ('HIGH', 'CRITICAL') AS INTEGER)
        AS target, count(*) AS suppliers FROM supplier_features GROUP BY 1""",
    "supplier_feature_matrix": _MATRIX,
    "rule_confusion_matrix": f"""SELECT label, prediction, count(guess) AS suppliers
        FROM (SELECT unnest([0, 0, 1, 1]) AS label, unnest([0, 1, 0, 1]) AS prediction) cells
        LEFT JOIN (SELECT target, (score > 0.25)::INTEGER AS guess FROM ({_RULE})) scored
            ON target = label AND guess = prediction
        GROUP BY ALL""",
    "rule_classification_metrics": f"""SELECT * FROM (
        WITH scored AS (SELECT target, (score > 0.25)::INTEGER AS guess FROM ({_RULE})),
        classes AS (
            SELECT c, count(*) FILTER (target = c AND guess = c)::DOUBLE AS hit,
                   count(*) FILTER (target = c)::DOUBLE AS actual, count(*) FILTER (guess = c)::DOUBLE AS guessed
            FROM scored, (VALUES (0), (1)) t(c) GROUP BY c),
        rates AS (
            SELECT c, hit, actual, if(guessed > 0, hit / guessed, 0) AS p, if(actual > 0, hit / actual, 0) AS r,
                   if(hit > 0, 2 * hit / (guessed + actual), 0) AS f
            FROM classes),
        rows AS (
            SELECT if(c = 1, 'High Risk', 'Low Risk') AS label, p, r, f, actual AS n FROM rates
            UNION ALL SELECT 'accuracy', sum(hit) / sum(actual), sum(hit) / sum(actual), sum(hit) / sum(actual),
                   sum(actual) FROM rates
            UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(actual) FROM rates
            UNION ALL SELECT 'weighted avg', sum(p * actual) / sum(actual), sum(r * actual) / sum(actual),
                   sum(f * actual) / sum(actual), sum(actual) FROM rates)
        SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1_score, n::BIGINT AS support
        FROM rows)""",
    # The share of pairs of both classes in the right order, ties counting half.
    "rule_roc_auc": f"""SELECT * FROM (
        WITH levels AS (
            SELECT score, count(*) FILTER (target = 1) AS high, count(*) FILTER (target = 0) AS low
            FROM ({_RULE}) GROUP BY score)
        SELECT round((SELECT sum(a.high * b.low * if(a.score > b.score, 1.0::DOUBLE, if(a.score = b.score, 0.5, 0)))
                      FROM levels a, levels b) / (sum(high) * sum(low)), 9) AS roc_auc
        FROM levels)""",
    "rule_risk_tier_summary": f"""SELECT tier AS risk_tier, count(*) AS supplier_count,
        round(avg(score), 3) AS avg_risk_prob, round(avg(disruption_rate_pct), 1) AS avg_disruption_rate
        FROM ({_RULE}) GROUP BY 1""",
    "rule_top5_risky_suppliers": f"""SELECT supplier_id, supplier_name, country, tier AS risk_tier,
        score AS risk_probability, disruption_rate_pct FROM ({_RULE}) ORDER BY score DESC, supplier_id LIMIT 5""",
    "rule_risk_tier_counts": _counts(f"({_RULE})", "tier").replace("tier", "tier AS risk_tier", 1),
    # The linear score: its table, its Shapley values, the reports on both.
    "linear_risk_scores": "SELECT * FROM linear_scores",
    "linear_shap_explanations": "SELECT * FROM linear_explained",
    "linear_top_driver": "SELECT supplier_id, top_risk_driver, top_driver_impact FROM linear_explained",
    "linear_top3_explanation": "SELECT supplier_id, explanation FROM linear_explained",
    "linear_driver_distribution": "SELECT top_risk_driver, count(*) AS suppliers FROM linear_explained GROUP BY 1",
    "linear_global_shap_importance": f"""SELECT feature, round(avg(abs(value)), 6) AS mean_abs_shap
        FROM (SELECT unnest({_LABELS}) AS feature, unnest(shap) AS value FROM linear_scored) GROUP BY feature""",
    "linear_top5_critical_explanations": f"""SELECT {_PAGE} FROM linear_explained WHERE risk_tier = 'CRITICAL'
        ORDER BY risk_probability DESC, supplier_id LIMIT 5""",
    "linear_filter_tier_driver": """SELECT * FROM linear_explained WHERE risk_tier IN ('HIGH', 'CRITICAL')
        AND top_risk_driver IN ('Risk Level', 'Disruption Rate %')""",
    "linear_explanation_page": f"""SELECT {_PAGE} FROM linear_explained WHERE risk_tier IN ('HIGH', 'CRITICAL')
        ORDER BY supplier_id LIMIT 10""",
    "linear_supplier_shap_long": f"""SELECT supplier_id, unnest({_LABELS}) AS feature,
        round(unnest(shap), 6) AS shap_value FROM linear_scored""",
    "linear_driver_options": "SELECT DISTINCT top_risk_driver FROM linear_explained",
    "linear_risk_scatter": """SELECT disruption_rate_pct, risk_probability, risk_tier, total_shipments, supplier_name,
        country, product_category, avg_delay_days FROM linear_scores WHERE risk_tier IN ('HIGH', 'CRITICAL')""",
    "linear_risk_table": """SELECT supplier_id, supplier_name, country, product_category, risk_tier, risk_probability,
        disruption_rate_pct, avg_delay_days, total_shipments FROM linear_scores
        WHERE risk_tier IN ('HIGH', 'CRITICAL')""",
    "linear_kpi_overview": _OVERVIEW + """,
        (SELECT count(*) FROM linear_scores WHERE risk_tier = 'CRITICAL') AS critical_suppliers""",
    # An exact quarter of the suppliers, shared out to the classes by largest remainder, by least hash.
    "stratified_split": f"""SELECT * FROM (
        WITH labelled AS (
            SELECT supplier_id, target, ('0x' || substr(md5(supplier_id || '|42'), 1, 13))::BIGINT AS number
            FROM ({_MATRIX})),
        sizes AS (
            SELECT target, count(*) AS n, sum(count(*)) OVER () AS total, ceil(0.25 * sum(count(*)) OVER ()) AS wanted
            FROM labelled GROUP BY target),
        shares AS (
            SELECT *, floor(n * wanted / total) AS whole, n * wanted / total - floor(n * wanted / total) AS part
            FROM sizes),
        quotas AS (
            SELECT target, whole + if(row_number() OVER (ORDER BY part DESC, target)
                                      <= wanted - sum(whole) OVER (), 1, 0) AS quota
            FROM shares)
        SELECT supplier_id, target, row_number() OVER (PARTITION BY target ORDER BY number) <= quota AS is_test
        FROM labelled JOIN quotas USING (target))""",
    "anomaly_features": """SELECT shipment_id, delay_days, freight_cost_usd, quantity_shipped, reliability_score,
        supplier_lead_time, cost_per_unit, delay_ratio, CAST(is_disrupted AS INTEGER) AS is_disrupted_int,
        CAST(dense_rank() OVER (ORDER BY origin_country) - 1 AS INTEGER) AS country_enc,
        CAST(dense_rank() OVER (ORDER BY destination_warehouse) - 1 AS INTEGER) AS warehouse_enc,
        CAST(dense_rank() OVER (ORDER BY carrier) - 1 AS INTEGER) AS carrier_enc,
        CAST(dense_rank() OVER (ORDER BY sku) - 1 AS INTEGER) AS sku_enc,
        CAST(dense_rank() OVER (ORDER BY supplier_risk_level) - 1 AS INTEGER) AS risk_enc FROM shipment_ratios""",
    "quantile_thresholds": """SELECT round(cost_limit, 6) AS cost_per_unit_q95,
        round(quantity_limit, 6) AS quantity_shipped_q97 FROM reason_limits""",
    "reason_flags": """SELECT shipment_id, CASE WHEN met = '' THEN 'MULTIVARIATE_PATTERN' ELSE met END AS reasons
        FROM (SELECT shipment_id, concat_ws(' | ',
            CASE WHEN delay_days > 20 THEN 'SEVERE_DELAY' END,
            CASE WHEN cost_per_unit > cost_limit THEN 'HIGH_FREIGHT_COST' END,
            CASE WHEN quantity_shipped > quantity_limit THEN 'UNUSUALLY_LARGE_SHIPMENT' END,
            CASE WHEN delay_ratio > 2 THEN 'DELAY_EXCEEDS_LEAD_TIME_2X' END,
            CASE WHEN reliability_score < 0.6 AND is_disrupted THEN 'LOW_RELIABILITY_DISRUPTION' END) AS met
          FROM shipment_ratios CROSS JOIN reason_limits)""",
    # distances from the medians, and the reports on them
    "robust_anomaly_severity": """SELECT shipment_id, is_anomaly, anomaly_score, anomaly_severity, severity_tier
        FROM robust_anomalies""",
    "robust_anomaly_reasons": "SELECT * FROM robust_anomalies",
    "robust_anomaly_rate": """SELECT count(*) FILTER (is_anomaly) AS anomalies,
        round_even(count(*) FILTER (is_anomaly) * 100.0::DOUBLE / count(*) * 10, 0) / 10 AS anomaly_pct
        FROM robust_anomalies""",
    "robust_severity_summary": """SELECT severity_tier, count(*) AS shipment_count,
        round(avg(delay_days), 1) AS avg_delay_days, round(avg(freight_cost_usd), 0) AS avg_freight_cost
        FROM robust_anomalies GROUP BY 1""",
    "robust_severity_counts": _counts("robust_anomalies", "severity_tier"),
    "robust_anomaly_reason_breakdown": """SELECT anomaly_reasons, count(*) AS count FROM robust_anomalies
        WHERE is_anomaly GROUP BY 1""",
    "robust_top10_anomalies": """SELECT shipment_id, supplier_id, origin_country, carrier, delay_days, severity_tier,
        anomaly_reasons FROM robust_anomalies WHERE is_anomaly ORDER BY anomaly_severity DESC, shipment_id LIMIT 10""",
    "robust_top15_anomalies": """SELECT shipment_id, supplier_id, origin_country, carrier, delay_days, severity_tier,
        anomaly_severity, anomaly_reasons FROM robust_anomalies WHERE is_anomaly
        ORDER BY anomaly_severity DESC, shipment_id LIMIT 15""",
    "robust_kpi_anomalies": """SELECT count(*) FILTER (is_anomaly) AS anomalies,
        count(*) FILTER (severity_tier = 'CRITICAL') AS critical_anomalies,
        round_even(avg(anomaly_severity) FILTER (is_anomaly) * 1000, 0) / 1000 AS avg_severity FROM robust_anomalies""",
    "robust_kpi_shipments": """SELECT count(*) AS total_shipments, count(*) FILTER (is_disrupted) AS disrupted,
        round_even(avg(delay_days) * 10, 0) / 10 AS avg_delay_days,
        (SELECT count(*) FILTER (is_anomaly) FROM robust_anomalies) AS anomalies FROM stg_shipments""",
    # data quality
    "dq_summary": _summary(),
    "dq_unique": _DUPLICATES,
    "dq_not_null": _NULLS,
    "dq_accepted_values": _REJECTED,
    "dq_relationships": """SELECT supplier_id, count(*) AS occurrences FROM stg_shipments s
        WHERE supplier_id NOT IN (SELECT supplier_id FROM stg_suppliers) GROUP BY 1""",
    "fk_violations": """SELECT supplier_id, count(*) AS occurrences FROM stg_shipments s
        WHERE supplier_id NOT IN (SELECT supplier_id FROM stg_suppliers WHERE is_active) GROUP BY 1""",
    "dq_no_negative_delays": "SELECT * FROM stg_shipments WHERE delay_days < 0",
    "dq_range": """SELECT 'disruption_rate_pct' AS check_name,
          count(*) FILTER (disruption_rate_pct NOT BETWEEN 0 AND 100) AS violations FROM mart_supplier_risk
        UNION ALL SELECT 'reliability_score', count(*) FILTER (reliability_score NOT BETWEEN 0 AND 1)
          FROM stg_suppliers
        UNION ALL SELECT 'lead_time_days', count(*) FILTER (lead_time_days <= 0) FROM stg_suppliers
        UNION ALL SELECT 'supplier_id_unique', count(*) FILTER (n > 1)
          FROM (SELECT count(*) AS n FROM stg_suppliers GROUP BY supplier_id)""",
    "health_check": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        f"CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"
        for name, source in [*[(f"raw.{t}", t) for t in _RAW],
                             ("predictions.supplier_risk_scores", "stg_suppliers")]),
    # reports
    "filter_tier_country": _MART_KEPT + " AND country IN ('NATION_1', 'NATION_6', 'NATION_12')",
    "filter_tier_only": _MART_KEPT,
    "kpi_overview_without_scores": _OVERVIEW,
    "shipment_status_counts": _counts("stg_shipments", "status"),
    "supplier_country_counts": _counts("stg_suppliers", "country"),
    "kpi_shipments_without_anomalies": """SELECT count(*) AS total_shipments,
        count(*) FILTER (is_disrupted) AS disrupted, round_even(avg(delay_days) * 10, 0) / 10 AS avg_delay_days
        FROM stg_shipments""",
    "delay_category_counts": _counts("stg_shipments", "delay_category"),
    "carrier_performance":
        "SELECT carrier, avg(delay_days) AS avg_delay_days FROM stg_shipments GROUP BY 1 ORDER BY 2, 1",
    "kpi_inventory": """SELECT count(DISTINCT sku) AS skus, count(DISTINCT warehouse) AS warehouses,
        count(*) FILTER (stock_status = 'STOCKOUT') AS stockouts,
        count(*) FILTER (stock_status = 'CRITICAL') AS below_reorder FROM mart_inventory_health""",
    "stock_status_counts": _counts("mart_inventory_health", "stock_status"),
    "warehouse_stock_value": """SELECT warehouse, round(sum(stock_value_usd), 2) AS stock_value_usd
        FROM stg_inventory GROUP BY 1 ORDER BY 2, 1""",
    "filter_options": "SELECT DISTINCT country FROM stg_suppliers ORDER BY 1",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(body) for name, body in _BODIES.items()}
