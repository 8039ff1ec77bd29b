"""Named subqueries shared by the check SQL."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

# -- raw tables ---------------------------------------------------------------

VIEWS["raw_suppliers"] = """
SELECT 'SUP-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS supplier_id,
       ' ' || s_name || '  ' AS supplier_name,
       n_name || ' ' AS country,
       ' ' || s_name || '@Example.COM ' AS contact_email,
       'CAT-' || CAST(s_suppkey % 5 AS VARCHAR) AS product_category,
       CAST(7 + s_suppkey % 84 AS INTEGER) AS lead_time_days,
       0.5::DOUBLE + CAST((s_suppkey * 37) % 51 AS DOUBLE) / 100.0::DOUBLE AS reliability_score,
       CASE WHEN (s_suppkey * 7919) % 10 < 4 THEN 'LOW' WHEN (s_suppkey * 7919) % 10 < 7 THEN 'MEDIUM'
            WHEN (s_suppkey * 7919) % 10 < 9 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level,
       s_suppkey % 7 <> 3 AS active,
       DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS onboarded_date,
       abs(s_acctbal) * 100.0::DOUBLE AS annual_spend_usd,
       '2024-01-31T00:00:00' AS _ingested_at, 'supplier.parquet' AS _source_file
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""

VIEWS["raw_inventory"] = """
SELECT 'INV-' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS inventory_id,
       ' ' || p_brand AS sku, p_type || ' ' AS product_category,
       'WH-' || CAST(p_partkey % 8 AS VARCHAR) AS warehouse,
       'SUP-' || lpad(CAST(i_suppkey AS VARCHAR), 6, '0') AS supplier_id,
       CAST(greatest(0, (p_partkey * 7919) % 5001 - 100) AS INTEGER) AS quantity_on_hand,
       CAST(50 + p_size * 9 AS INTEGER) AS reorder_point,
       greatest(0, (p_partkey * 7919) % 5001 - 100) < 50 + p_size * 9 AS below_reorder,
       p_retailprice / 10.0::DOUBLE AS unit_cost_usd,
       DATE '2024-01-01' - CAST(p_partkey % 180 AS INTEGER) AS last_restocked_date,
       DATE '2024-07-01' + CAST(p_partkey % 900 AS INTEGER) AS expiry_date,
       '2024-01-31T00:00:00' AS _ingested_at, 'part.parquet' AS _source_file
FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS i_suppkey FROM lineitem GROUP BY l_partkey) m
  ON p_partkey = m.l_partkey
"""

VIEWS["shipment_base"] = """
SELECT l.*, CAST(o_orderdate AS DATE) AS scheduled, p_brand, c_nationkey, n_name,
       CAST(greatest(0, datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)))
            // (40 * (1 + l_suppkey % 5)) AS INTEGER) AS delay
FROM lineitem l
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey
"""

VIEWS["raw_shipments"] = """
SELECT 'SHP-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS shipment_id,
       'SUP-' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS supplier_id,
       ' ' || p_brand AS sku, n_name || ' ' AS origin_country,
       'WH-' || CAST(c_nationkey % 8 AS VARCHAR) AS destination_warehouse,
       CAST(l_quantity AS INTEGER) AS quantity_shipped, scheduled AS scheduled_date,
       scheduled + delay AS actual_arrival_date, delay AS delay_days,
       CASE WHEN delay > 5 THEN 'DELAYED' WHEN delay = 0 THEN 'ON_TIME'
            WHEN scheduled > DATE '2024-01-31' THEN 'IN_TRANSIT' ELSE 'DELIVERED' END AS status,
       l_extendedprice * 0.1::DOUBLE AS freight_cost_usd,
       'CARRIER-' || CAST(l_orderkey % 8 AS VARCHAR) AS carrier, delay > 14 AS disruption_flag,
       '2024-01-31T00:00:00' AS _ingested_at, 'lineitem.parquet' AS _source_file
FROM shipment_base
"""

VIEWS["demand_history"] = """
SELECT strftime(scheduled_date, '%Y-%m-%d') AS date, trim(sku) AS sku, destination_warehouse AS warehouse,
       CAST(sum(quantity_shipped) AS BIGINT) AS demand
FROM raw_shipments GROUP BY 1, 2, 3
"""

# -- staging ---------------------------------------------------------------------

# Staging renames the flags, fixes the types, trims text and keeps rows that have a key. Types first, then text.

def _staged(raw: str, key: str, typed: dict[str, str], renamed: dict[str, str], trimmed: tuple[str, ...],
            extra: str = "") -> str:
    casts = ", ".join(f"{column}::{kind} AS {column}" for column, kind in typed.items())
    names = ", ".join(f"{old}::BOOLEAN AS {new}" for old, new in renamed.items())
    blanks = ", ".join(f"regexp_replace({column}, '^ +| +$', '', 'g') AS {column}" for column in trimmed)
    return f"""
FROM {raw}
SELECT {key}, {casts}, {names}, {blanks}{extra}, _ingested_at::TIMESTAMP AS ingested_at
WHERE {key} IS NOT NULL
"""


VIEWS["stg_suppliers"] = _staged(
    "raw_suppliers", "supplier_id",
    {"lead_time_days": "INTEGER", "reliability_score": "DOUBLE", "onboarded_date": "DATE", "annual_spend_usd": "DOUBLE"},
    {"active": "is_active"}, ("supplier_name", "country", "product_category", "risk_level"),
    ", lower(regexp_replace(contact_email, '^ +| +$', '', 'g')) AS contact_email")

VIEWS["stg_inventory"] = _staged(
    "raw_inventory", "inventory_id",
    {"supplier_id": "VARCHAR", "quantity_on_hand": "INTEGER", "reorder_point": "INTEGER", "unit_cost_usd": "DOUBLE",
     "last_restocked_date": "DATE", "expiry_date": "DATE"},
    {"below_reorder": "is_below_reorder"}, ("sku", "product_category", "warehouse"),
    ", round(unit_cost_usd * quantity_on_hand, 2) AS stock_value_usd")

# Bands of days late as a table; what is in none of them (also early or unknown) is severe.
VIEWS["stg_shipments"] = _staged(
    "raw_shipments", "shipment_id",
    {"supplier_id": "VARCHAR", "quantity_shipped": "INTEGER", "scheduled_date": "DATE", "actual_arrival_date": "DATE",
     "delay_days": "INTEGER", "freight_cost_usd": "DOUBLE"},
    {"disruption_flag": "is_disrupted"}, ("sku", "origin_country", "destination_warehouse", "status", "carrier"),
    """, coalesce((SELECT band FROM (VALUES (0, 0, 'NO_DELAY'), (1, 5, 'MINOR'), (6, 14, 'MODERATE')) t(least, most, band)
                   WHERE least <= delay_days AND delay_days <= most), 'SEVERE') AS delay_category""")

# -- aggregates and marts ------------------------------------------------------------

VIEWS["_supplier_totals"] = """
FROM stg_shipments
SELECT supplier_id, count(*) AS total_shipments, count(*) FILTER (is_disrupted) AS disrupted_shipments,
       sum(delay_days)::DOUBLE / count(delay_days) AS avg_delay_days, max(delay_days) AS max_delay_days,
       sum(freight_cost_usd) AS total_freight_cost
GROUP BY ALL
"""

VIEWS["shipment_stats"] = "FROM _supplier_totals"

VIEWS["supplier_rate_stats"] = """
FROM _supplier_totals
SELECT * EXCLUDE (total_freight_cost), round(100.0 * disrupted_shipments / total_shipments, 2) AS disruption_rate_pct
"""

# A supplier without shipments has zero counts and delays, but no rate.
VIEWS["mart_supplier_risk"] = """
SELECT supplier_id, supplier_name, country, product_category, risk_level, reliability_score, lead_time_days, is_active,
       annual_spend_usd, ifnull(total_shipments, 0) AS total_shipments,
       ifnull(disrupted_shipments, 0) AS disrupted_shipments, ifnull(avg_delay_days, 0) AS avg_delay_days,
       ifnull(max_delay_days, 0) AS max_delay_days, ifnull(total_freight_cost, 0) AS total_freight_cost,
       CASE WHEN total_shipments > 0 THEN round(100.0 * disrupted_shipments / total_shipments, 2) END
           AS disruption_rate_pct,
       greatest(ifnull(list_position(['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'], risk_level), 1), 1)::INTEGER AS risk_score
FROM stg_suppliers LEFT JOIN shipment_stats USING (supplier_id)
"""

VIEWS["mart_inventory_health"] = """
WITH owners AS (
    SELECT supplier_id, supplier_name, country AS supplier_country, risk_level AS supplier_risk FROM stg_suppliers)
SELECT inventory_id, sku, product_category, warehouse, supplier_id, supplier_name, supplier_country, supplier_risk,
       quantity_on_hand, reorder_point, is_below_reorder, unit_cost_usd, stock_value_usd, last_restocked_date,
       expiry_date, date_diff('day', last_restocked_date, DATE '2024-01-31')::INTEGER AS days_since_restock,
       date_diff('day', DATE '2024-01-31', expiry_date)::INTEGER AS days_to_expiry,
       coalesce(if(quantity_on_hand = 0, 'STOCKOUT', NULL), if(is_below_reorder, 'CRITICAL', NULL),
                if(2 * quantity_on_hand < 3 * reorder_point, 'LOW', NULL), 'HEALTHY') AS stock_status
FROM stg_inventory LEFT JOIN owners USING (supplier_id)
"""

# The features have a rate of zero where the mart has none.
VIEWS["supplier_features"] = """
FROM mart_supplier_risk
SELECT * EXCLUDE (total_freight_cost, risk_score) REPLACE (ifnull(disruption_rate_pct, 0) AS disruption_rate_pct)
"""

VIEWS["enriched_shipments"] = """
WITH attributes AS (
    SELECT supplier_id, reliability_score, lead_time_days AS supplier_lead_time, risk_level AS supplier_risk_level,
           annual_spend_usd
    FROM stg_suppliers)
SELECT * EXCLUDE (scheduled_date, actual_arrival_date, delay_category, ingested_at)
FROM stg_shipments LEFT JOIN attributes USING (supplier_id)
"""

VIEWS["shipment_ratios"] = """
SELECT *,
  round_even(freight_cost_usd / CASE WHEN quantity_shipped = 0 THEN 1 ELSE quantity_shipped END * 10000, 0) / 10000
    AS cost_per_unit,
  round_even(CAST(delay_days AS DOUBLE)
    / CASE WHEN supplier_lead_time = 0 THEN 1 ELSE supplier_lead_time END * 10000, 0) / 10000 AS delay_ratio
FROM enriched_shipments
"""

VIEWS["supplier_codes"] = """
SELECT supplier_id,
       CAST(dense_rank() OVER (ORDER BY country) - 1 AS INTEGER) AS country_enc,
       CAST(dense_rank() OVER (ORDER BY product_category) - 1 AS INTEGER) AS category_enc,
       CAST(dense_rank() OVER (ORDER BY risk_level) - 1 AS INTEGER) AS risk_enc
FROM stg_suppliers
"""

VIEWS["reason_limits"] = """
SELECT quantile_cont(cost_per_unit, 0.95) AS cost_limit,
       quantile_cont(CAST(quantity_shipped AS DOUBLE), 0.97) AS quantity_limit
FROM shipment_ratios
"""

# -- distances of shipments from the medians ------------------------------------------

VIEWS["shipment_scales"] = """
SELECT *, 1.4826::DOUBLE * (SELECT median(abs(delay_days::DOUBLE - delay_mid)) FROM shipment_ratios) AS delay_scale,
       1.4826::DOUBLE * (SELECT median(abs(freight_cost_usd - freight_mid)) FROM shipment_ratios) AS freight_scale,
       1.4826::DOUBLE * (SELECT median(abs(quantity_shipped::DOUBLE - quantity_mid)) FROM shipment_ratios)
           AS quantity_scale,
       1.4826::DOUBLE * (SELECT median(abs(cost_per_unit - unit_mid)) FROM shipment_ratios) AS unit_scale,
       1.4826::DOUBLE * (SELECT median(abs(delay_ratio - ratio_mid)) FROM shipment_ratios) AS ratio_scale
FROM (SELECT median(delay_days::DOUBLE) AS delay_mid, median(freight_cost_usd) AS freight_mid,
             median(quantity_shipped::DOUBLE) AS quantity_mid, median(cost_per_unit) AS unit_mid,
             median(delay_ratio) AS ratio_mid FROM shipment_ratios)
"""

VIEWS["shipment_distances"] = """
SELECT s.*, round_even(list_sum(list_transform(parts, lambda p: coalesce(p, 0)))
                       / greatest(1, list_sum(list_transform(scales, lambda x: (x > 0)::INTEGER))) * 1e6, 0) / 1e6
       AS distance
FROM (SELECT r.*, [delay_scale, freight_scale, quantity_scale, unit_scale, ratio_scale] AS scales,
             [if(delay_scale > 0, abs(delay_days - delay_mid) / delay_scale, 0),
              if(freight_scale > 0, abs(freight_cost_usd - freight_mid) / freight_scale, 0),
              if(quantity_scale > 0, abs(quantity_shipped - quantity_mid) / quantity_scale, 0),
              if(unit_scale > 0, abs(cost_per_unit - unit_mid) / unit_scale, 0),
              if(ratio_scale > 0, abs(delay_ratio - ratio_mid) / ratio_scale, 0)] AS parts
      FROM shipment_ratios r, shipment_scales) s
"""

VIEWS["robust_anomalies"] = """
WITH cut AS (SELECT quantile_cont(distance, 0.95) AS cut FROM shipment_distances),
flagged AS (
    SELECT *, distance > cut AS is_anomaly, round_even((cut - distance) * 1e6, 0) / 1e6 AS anomaly_score
    FROM shipment_distances, cut),
severe AS (
    SELECT *, round_even(coalesce(1 - (anomaly_score - low) / nullif(high - low, 0), 0) * 10000, 0) / 10000
        AS anomaly_severity
    FROM flagged, (SELECT min(anomaly_score) AS low, max(anomaly_score) AS high FROM flagged)),
reasons AS (
    SELECT *, concat_ws(' | ',
            CASE WHEN delay_days > 20 THEN 'SEVERE_DELAY' END,
            CASE WHEN cost_per_unit > cost_limit THEN 'HIGH_FREIGHT_COST' END,
            CASE WHEN quantity_shipped > quantity_limit THEN 'UNUSUALLY_LARGE_SHIPMENT' END,
            CASE WHEN delay_ratio > 2 THEN 'DELAY_EXCEEDS_LEAD_TIME_2X' END,
            CASE WHEN reliability_score < 0.6 AND is_disrupted THEN 'LOW_RELIABILITY_DISRUPTION' END) AS met
    FROM severe, reason_limits)
SELECT shipment_id, supplier_id, sku, origin_country, destination_warehouse, carrier, delay_days, freight_cost_usd,
       cost_per_unit, delay_ratio, status, is_disrupted, is_anomaly, anomaly_score, anomaly_severity,
       CASE WHEN anomaly_severity <= 0.4 THEN 'NORMAL' WHEN anomaly_severity <= 0.6 THEN 'WATCH'
            WHEN anomaly_severity <= 0.8 THEN 'WARNING' ELSE 'CRITICAL' END AS severity_tier,
       CASE WHEN NOT is_anomaly THEN 'NORMAL' WHEN met = '' THEN 'MULTIVARIATE_PATTERN' ELSE met END AS anomaly_reasons
FROM reasons
"""

# -- the linear supplier score -------------------------------------------------------

VIEWS["supplier_inputs"] = """
SELECT f.*, CAST(is_active AS INTEGER) AS is_active_int, country_enc, category_enc, risk_enc,
       CAST(disruption_rate_pct > 20 OR risk_level IN ('HIGH', 'CRITICAL') AS INTEGER) AS target
FROM supplier_features f JOIN supplier_codes c ON f.supplier_id = c.supplier_id
"""

# One row per supplier and input, numbered in the order of the model's inputs.
VIEWS["input_values"] = """
SELECT supplier_id, target, unnest(range(1, 13)) AS position,
       unnest([reliability_score, lead_time_days, is_active_int, annual_spend_usd, total_shipments,
               disrupted_shipments, avg_delay_days, max_delay_days, disruption_rate_pct, country_enc, category_enc,
               risk_enc]) AS x
FROM supplier_inputs
"""

VIEWS["input_weights"] = """
SELECT position, middle, centre, if(within > 0, (high - low) / within, 0) AS weight
FROM (SELECT position, avg(x) AS centre, avg(x) FILTER (target = 1) AS high, avg(x) FILTER (target = 0) AS low,
             (high + low) / 2 AS middle,
             (sum((x - m) * (x - m))) / count(x) AS within
      FROM (SELECT *, avg(x) OVER (PARTITION BY position, target) AS m FROM input_values) GROUP BY position)
"""

VIEWS["linear_scored"] = """
SELECT supplier_id, list(effect ORDER BY position) AS shap,
       1 / (1 + exp(-(any_value(prior) + sum(weight * (x - middle))))) AS chance
FROM (SELECT *, weight * (x - centre) AS effect FROM input_values JOIN input_weights USING (position)),
     (SELECT ln(count(*) FILTER (target = 1) / count(*) FILTER (target = 0)) AS prior FROM supplier_inputs)
GROUP BY supplier_id
"""

VIEWS["linear_scores"] = """
SELECT supplier_id, supplier_name, country, product_category, risk_level, reliability_score, lead_time_days,
       total_shipments, disrupted_shipments, avg_delay_days, disruption_rate_pct, risk_probability, predicted_risk,
       ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'][greatest(1, ceil(risk_probability * 4)::INTEGER)] AS risk_tier,
       TIMESTAMP '2024-01-31 00:00:00' AS predicted_at
FROM (SELECT *, round_even(chance * 10000, 0) / 10000 AS risk_probability, (chance > 0.5)::INTEGER AS predicted_risk
      FROM supplier_inputs JOIN linear_scored USING (supplier_id))
"""

VIEWS["linear_phrases"] = """
SELECT supplier_id, string_agg(printf('%s %s risk by %.3f', name, if(effect > 0, 'increases', 'reduces'), abs(effect)),
                               ' | ' ORDER BY abs(effect) DESC, position) AS explanation,
       arg_min(name, place) AS top_risk_driver, arg_min(effect, place) AS top_effect
FROM (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY abs(effect) DESC, position) AS place
      FROM (SELECT supplier_id, unnest(range(1, 13)) AS position, unnest(shap) AS effect,
                   unnest(['Reliability Score', 'Lead Time (Days)', 'Is Active', 'Annual Spend (USD)',
                           'Total Shipments', 'Disrupted Shipments', 'Avg Delay (Days)', 'Max Delay (Days)',
                           'Disruption Rate %', 'Country', 'Product Category', 'Risk Level']) AS name
            FROM linear_scored))
WHERE place <= 3 GROUP BY supplier_id
"""

VIEWS["linear_explained"] = """
SELECT supplier_id, supplier_name,
       ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'][greatest(1, ceil(chance * 4)::INTEGER)] AS risk_tier,
       round_even(chance * 10000, 0) / 10000 AS risk_probability,
       round(shap[1], 6) AS "Reliability Score", round(shap[2], 6) AS "Lead Time (Days)",
       round(shap[3], 6) AS "Is Active", round(shap[4], 6) AS "Annual Spend (USD)",
       round(shap[5], 6) AS "Total Shipments", round(shap[6], 6) AS "Disrupted Shipments",
       round(shap[7], 6) AS "Avg Delay (Days)", round(shap[8], 6) AS "Max Delay (Days)",
       round(shap[9], 6) AS "Disruption Rate %", round(shap[10], 6) AS "Country",
       round(shap[11], 6) AS "Product Category", round(shap[12], 6) AS "Risk Level",
       top_risk_driver, round_even(top_effect * 10000, 0) / 10000 AS top_driver_impact, explanation
FROM linear_scored JOIN linear_phrases USING (supplier_id) JOIN stg_suppliers USING (supplier_id)
"""

# -- external signals ------------------------------------------------------------------

VIEWS["lpi"] = """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code, n_name AS country_name,
       round_even(value * 1000, 0) / 1000 AS lpi_score, '2023' AS year
FROM nation JOIN (
  SELECT s_nationkey, 5 - 4 * sum(abs(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))))::DOUBLE
                              / count(*) / 1250.0::DOUBLE AS value
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY s_nationkey) v ON n_nationkey = s_nationkey
WHERE n_nationkey % 12 <> 11
"""

VIEWS["gdp"] = """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code, n_name AS country_name,
       round_even(value * 100, 0) / 100 AS gdp_per_capita_usd, '2023' AS year
FROM nation JOIN (
  SELECT c_nationkey, sum(o_totalprice) / count(*) / 10.0::DOUBLE AS value
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey) v ON n_nationkey = c_nationkey
WHERE n_nationkey % 6 <> 5
"""

VIEWS["country_names"] = """
SELECT 'LOCAL_' || CAST(n_nationkey AS VARCHAR) AS our_country_name, n_name AS country_name
FROM nation WHERE n_nationkey % 5 < 2
"""

VIEWS["lpi_normalised"] = """
SELECT *, round_even((1 - lpi_normalized) * 1000, 0) / 1000 AS logistics_risk_score
FROM (SELECT *, coalesce(round_even((lpi_score - min(lpi_score) OVER ())
               / nullif(max(lpi_score) OVER () - min(lpi_score) OVER (), 0) * 1000, 0) / 1000, 0) AS lpi_normalized
      FROM lpi)
"""

VIEWS["country_profile"] = """
SELECT l.country_code, l.country_name, lpi_score, l.year, lpi_normalized, logistics_risk_score, our_country_name,
       gdp_per_capita_usd,
       CASE WHEN logistics_risk_score < 0 OR logistics_risk_score > 1 THEN NULL
            WHEN logistics_risk_score <= 0.25 THEN 'LOW' WHEN logistics_risk_score <= 0.5 THEN 'MEDIUM'
            WHEN logistics_risk_score <= 0.75 THEN 'HIGH' ELSE 'CRITICAL' END AS logistics_risk_tier
FROM lpi_normalised l JOIN country_names n ON l.country_name = n.country_name
LEFT JOIN gdp g ON l.country_name = g.country_name
"""

VIEWS["weather"] = """
SELECT CAST(ts AS DATE) AS date, 'COUNTRY_' || CAST(user_id % 10 AS VARCHAR) AS country,
       'CITY_' || CAST(user_id % 10 AS VARCHAR) AS city, max(value) / 5 AS precipitation_mm,
       avg(value) AS windspeed_kmh, max(value) / 6 AS temp_max_c, min(value) - 8 AS temp_min_c,
       CASE WHEN day(CAST(ts AS DATE)) % 10 = 0 THEN 0 ELSE min(value) / 2 END AS snowfall_cm,
       CAST(count(*) % 100 AS INTEGER) AS weather_code
FROM events GROUP BY 1, 2, 3
"""

VIEWS["weather_scored"] = """
SELECT *, CASE WHEN weather_disruption_score < 0 THEN NULL WHEN weather_disruption_score <= 10 THEN 'CLEAR'
               WHEN weather_disruption_score <= 30 THEN 'WATCH' WHEN weather_disruption_score <= 60 THEN 'WARNING'
               WHEN weather_disruption_score <= 100 THEN 'SEVERE' END AS weather_risk_tier
FROM (
  SELECT *, round_even(least(heavy_rain * 30 + strong_wind * 25 + extreme_heat * 20 + extreme_cold * 20
      + heavy_snow * 25 + least(precipitation_mm / 5, 20) + least(windspeed_kmh / 10, 15), 100) * 100, 0) / 100
      AS weather_disruption_score
  FROM (SELECT *, CAST(precipitation_mm >= 20 AS INTEGER) AS heavy_rain,
               CAST(windspeed_kmh >= 50 AS INTEGER) AS strong_wind, CAST(temp_max_c >= 38 AS INTEGER) AS extreme_heat,
               CAST(temp_min_c <= -5 AS INTEGER) AS extreme_cold, CAST(snowfall_cm >= 5 AS INTEGER) AS heavy_snow
        FROM weather))
"""

# The means go by way of decimal sums: many lie halfway between two rounded values, where a sum of doubles
# depends on the order of the rows.
VIEWS["weather_summary"] = """
SELECT *, CASE WHEN avg_disruption_score <= 10 THEN 'LOW' WHEN avg_disruption_score <= 25 THEN 'MEDIUM'
               WHEN avg_disruption_score <= 50 THEN 'HIGH' WHEN avg_disruption_score <= 100 THEN 'CRITICAL' END
               AS country_weather_risk, '2024-01-31T00:00:00' AS fetched_at
FROM (
  SELECT country, min_by(city, date) AS city,
         round_even(sum(CAST(weather_disruption_score AS DECIMAL(28, 10)))::DOUBLE
           / count(weather_disruption_score) * 100, 0) / 100 AS avg_disruption_score,
         round_even(max(weather_disruption_score) * 100, 0) / 100 AS max_disruption_score,
         count(*) FILTER (weather_risk_tier = 'SEVERE') AS severe_days,
         count(*) FILTER (weather_risk_tier = 'WARNING') AS warning_days,
         round_even(sum(CAST(precipitation_mm AS DECIMAL(28, 10)))::DOUBLE
           / count(precipitation_mm) * 100, 0) / 100 AS avg_precipitation_mm,
         round_even(sum(CAST(windspeed_kmh AS DECIMAL(28, 10)))::DOUBLE
           / count(windspeed_kmh) * 100, 0) / 100 AS avg_windspeed_kmh, count(date) AS days_measured
  FROM weather_scored GROUP BY country)
"""

VIEWS["fx_history"] = """
SELECT CAST(ts AS DATE) AS date, upper(event_type) AS currency_code, avg(value) AS rate_vs_usd
FROM events GROUP BY 1, 2
"""

VIEWS["fx_current"] = """
SELECT n_name AS country, c.currency_code,
       CASE WHEN c.currency_code = 'USD' THEN 1.0::DOUBLE ELSE rate_vs_usd END AS rate_vs_usd,
       CAST((SELECT max(date) FROM fx_history) AS VARCHAR) AS date
FROM (SELECT n_name, (['CLICK', 'ERROR', 'PURCHASE', 'SIGNUP', 'VIEW', 'USD', 'NONE'])[n_nationkey % 7 + 1]
      AS currency_code FROM nation) c
LEFT JOIN (SELECT currency_code, max_by(rate_vs_usd, date) AS rate_vs_usd FROM fx_history GROUP BY 1) h
  ON c.currency_code = h.currency_code
WHERE c.currency_code = 'USD' OR rate_vs_usd IS NOT NULL
"""

VIEWS["fx_returns"] = """
SELECT * FROM (
  SELECT date, currency_code, rate_vs_usd,
         rate_vs_usd / lag(rate_vs_usd) OVER (PARTITION BY currency_code ORDER BY date) - 1 AS daily_return
  FROM fx_history) WHERE daily_return IS NOT NULL
"""

VIEWS["fx_ends"] = """
SELECT *, round_even((last_rate - first_rate) / first_rate * 100 * 10000, 0) / 10000 AS pct_change_30d
FROM (SELECT currency_code, min_by(rate_vs_usd, date) AS first_rate, max_by(rate_vs_usd, date) AS last_rate,
             count(*) AS points FROM fx_history GROUP BY 1)
"""

VIEWS["fx_volatility"] = """
SELECT *, CASE WHEN currency_risk_score <= 5 THEN 'LOW' WHEN currency_risk_score <= 15 THEN 'MEDIUM'
               WHEN currency_risk_score <= 30 THEN 'HIGH' WHEN currency_risk_score <= 100 THEN 'CRITICAL' END
               AS currency_risk_tier, '2024-01-31T00:00:00' AS fetched_at
FROM (SELECT *, round_even(least(100, abs(pct_change_30d) * 2 + daily_volatility_pct * 10) * 100, 0) / 100
               AS currency_risk_score
      FROM (SELECT c.country, c.currency_code, c.rate_vs_usd AS current_rate_vs_usd,
                   coalesce(e.first_rate, c.rate_vs_usd) AS rate_30d_ago,
                   coalesce(e.pct_change_30d, 0) AS pct_change_30d, coalesce(r.vol, 0) AS daily_volatility_pct
            FROM fx_current c
            LEFT JOIN fx_ends e ON c.currency_code = e.currency_code
            LEFT JOIN (SELECT currency_code, round_even(stddev_samp(daily_return) * 100 * 10000, 0) / 10000 AS vol
                       FROM fx_returns GROUP BY 1) r ON c.currency_code = r.currency_code))
"""

# -- demand -----------------------------------------------------------------------------

VIEWS["inventory_by_sku_wh"] = """
SELECT sku, warehouse, CAST(sum(quantity_on_hand) AS BIGINT) AS current_stock, avg(reorder_point) AS reorder_point
FROM stg_inventory GROUP BY 1, 2
"""

# The gaps are filled in here, unlike in the query under check.
VIEWS["dense_demand"] = """
SELECT d.sku, d.warehouse, d.day, datediff('day', d.first, d.day) AS t, coalesce(h.demand, 0) AS y
FROM (SELECT sku, warehouse, first, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT sku, warehouse, min(CAST(date AS DATE)) AS first, max(CAST(date AS DATE)) AS last
            FROM demand_history GROUP BY 1, 2)) d
LEFT JOIN demand_history h ON h.sku = d.sku AND h.warehouse = d.warehouse AND CAST(h.date AS DATE) = d.day
"""

VIEWS["trend_forecast"] = """
SELECT CAST(f.last + step AS DATE) AS ds,
       round_even(greatest(0, intercept + slope * (f.n - 1 + step))
                  * CASE WHEN mean = 0 THEN 1 ELSE coalesce(w.weekday_mean / mean, 1) END * 10, 0) / 10 AS yhat,
       f.sku, f.warehouse
FROM (SELECT *, unnest(generate_series(1, 90))::INTEGER AS step
      FROM (SELECT sku, warehouse, max(day) AS last, count(*) AS n, avg(y) AS mean,
                   coalesce(regr_slope(y, t), 0) AS slope, coalesce(regr_intercept(y, t), avg(y)) AS intercept
            FROM dense_demand GROUP BY 1, 2)) f
LEFT JOIN (SELECT sku, warehouse, dayofweek(day) AS weekday, avg(y) AS weekday_mean FROM dense_demand
           GROUP BY 1, 2, 3) w
  ON w.sku = f.sku AND w.warehouse = f.warehouse AND w.weekday = dayofweek(CAST(f.last + step AS DATE))
"""

VIEWS["stockout"] = """
SELECT *, CASE WHEN days_until_stockout < 0 THEN NULL WHEN days_until_stockout <= 7 THEN 'CRITICAL'
               WHEN days_until_stockout <= 14 THEN 'HIGH' WHEN days_until_stockout <= 30 THEN 'MEDIUM'
               ELSE 'LOW' END AS stockout_risk, days_until_stockout < 90 AS will_stockout_90d
FROM (
  SELECT f.sku, f.warehouse, forecasted_demand_90d, peak_daily_demand, avg_daily_demand,
         coalesce(current_stock, 0) AS current_stock, coalesce(reorder_point, 100) AS reorder_point,
         round_even(coalesce(current_stock, 0) / CASE WHEN avg_daily_demand = 0 THEN 1 ELSE avg_daily_demand END
                    * 10, 0) / 10 AS days_until_stockout
  FROM (SELECT sku, warehouse, sum(yhat) AS forecasted_demand_90d, max(yhat) AS peak_daily_demand,
               avg(yhat) AS avg_daily_demand FROM trend_forecast GROUP BY 1, 2) f
  LEFT JOIN inventory_by_sku_wh i ON f.sku = i.sku AND f.warehouse = i.warehouse)
"""


def with_views(body: str) -> str:
    """Prefix the named subqueries that the statement uses, directly or through others, in order."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        found = {name for name in VIEWS if name in words} - needed
        needed |= found
        pending += [VIEWS[name] for name in found]
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
