import json

import pytest

from quayside.plans import daily
from quayside.sources import landing, tables

RUN = "2024-01-31T00:00:00"


def test_missing_csv_is_skipped(spark, tmp_path):
    assert landing.csv_scan(spark, str(tmp_path / "no.csv"), "a int") is None
    assert landing.load_landed(spark, str(tmp_path)) == {}


def test_csv_is_typed_and_stamped(spark, tmp_path):
    (tmp_path / "suppliers.csv").write_text(
        "supplier_id,supplier_name,country,contact_email,product_category,lead_time_days,reliability_score,risk_level,"
        "active,onboarded_date,annual_spend_usd\nS1,Acme,Kenya,a@b.c,Cases,12,0.75,LOW,True,2023-05-01,1000.5\n")
    [row] = landing.load_landed(spark, str(tmp_path), RUN)["raw_suppliers"].collect()
    assert (row.lead_time_days, row.active, str(row.onboarded_date)) == (12, True, "2023-05-01")
    assert (row._ingested_at, row._source_file) == (RUN, "suppliers.csv")


def test_full_refresh_replaces_and_may_read_itself(spark):
    tables.full_refresh(spark.range(5), "refresh_test", "t")
    assert spark.table("refresh_test.t").count() == 5
    tables.full_refresh(spark.table("refresh_test.t").filter("id < 2"), "refresh_test", "t")
    assert sorted(r.id for r in spark.table("refresh_test.t").collect()) == [0, 1]


def test_safe_load(spark):
    tables.full_refresh(spark.range(1), "refresh_test", "present")
    assert tables.safe_load(spark, "refresh_test.present", "id long").count() == 1
    missing = tables.safe_load(spark, "refresh_test.absent", "id long, name string")
    assert missing.columns == ["id", "name"] and missing.count() == 0


def test_health_check(spark):
    checks = tables.health_check({"a": spark.range(2), "b": spark.range(0), "c": None})
    assert {r.table_name: (r.row_count, r.status) for r in checks.collect()} == {
        "a": (2, "PASS"), "b": (0, "FAIL"), "c": (None, "FAIL")}
    with pytest.raises(RuntimeError, match="b, c"):
        tables.require_healthy(checks)
    tables.require_healthy(tables.health_check({"a": spark.range(2)}))


def _land(df, folder, name):
    df.drop("_ingested_at", "_source_file").toPandas().to_csv(folder / name, index=False)


@pytest.fixture(scope="module")
def landed(warehouse, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    raw = warehouse.raw
    _land(raw.raw_suppliers(), folder, "suppliers.csv")
    _land(raw.raw_inventory(), folder, "inventory.csv")
    _land(raw.raw_shipments(), folder, "shipments.csv")
    _land(raw.demand_history().filter("sku IN ('Brand#1', 'Brand#2')"), folder, "demand_history.csv")
    (folder / "weather").mkdir()
    for i, row in enumerate(warehouse.weather_documents().collect()):
        (folder / "weather" / f"{i}.json").write_text(row.payload)
    (folder / "fx_latest.json").write_text(json.dumps({"rates": {"EUR": 0.9, "JPY": 150}, "date": "2024-01-30"}))
    (folder / "fx_history.json").write_text(json.dumps(
        {"rates": {"2024-01-01": {"EUR": 0.8, "JPY": 140}, "2024-01-30": {"EUR": 0.9, "JPY": 150}}}))
    return folder


def test_daily_batch(spark, warehouse, landed):
    result = daily.run(spark, str(landed), RUN, as_of=warehouse.raw.as_of, trees=3)
    assert {r.status for r in result.collect()} == {"PASS"}
    counts = {r.table_name: r.row_count for r in daily.written_counts(spark).collect()}
    assert counts["transformed_marts.mart_supplier_risk"] == 10
    assert counts["predictions.shipment_anomalies"] == 6000
    assert counts["predictions.demand_forecasts"] == 16 * 90
    assert counts["predictions.stockout_risk"] == 16
    assert counts["predictions.supplier_shap_explanations"] == counts["predictions.supplier_risk_scores"] == 10
    # Landed and derived tables lead to the same mart.
    stored = spark.table("transformed_marts.mart_inventory_health").drop("supplier_name")
    assert stored.exceptAll(warehouse.inventory_health().drop("supplier_name")).count() == 0
    # No index was landed, so the profile comes from the fixed values; two currencies were quoted.
    assert spark.table("raw.country_risk_profiles").count() == 10
    assert {r.currency_code for r in spark.table("raw.currency_volatility").collect()} == {"EUR", "JPY", "USD"}
    assert spark.table("raw.weather_country_summary").count() == 10


def test_check_fails_without_tables(spark, landed):
    spark.sql("DROP TABLE IF EXISTS predictions.supplier_risk_scores")
    with pytest.raises(RuntimeError, match="supplier_risk_scores"):
        daily.check(spark)
