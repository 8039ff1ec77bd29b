import datetime as dt

import pytest

from quayside.operators import staging
from quayside.plans import marts
from quayside.sources.landing import INVENTORY_SCHEMA, SHIPMENTS_SCHEMA, SUPPLIERS_SCHEMA

STAMP = ", _ingested_at string, _source_file string"
DAY = dt.date(2024, 1, 1)


def supplier(key, name="A", risk="LOW", email="x@y.z"):
    return (key, name, "Kenya", email, "Cases", 10, 0.8, risk, True, DAY, 5.0, "2024-01-01T00:00:00", "s.csv")


def shipment(key, owner, delay):
    return (key, owner, "SKU", "Kenya", "WH", 10, DAY, DAY, delay, "ON_TIME", 100.0, "DHL",
            delay is not None and delay > 14, "2024-01-01T00:00:00", "h.csv")


def stock(key, owner, on_hand, reorder, cost=1.0):
    return (key, "SKU", "Cases", "WH", owner, on_hand, reorder, on_hand < reorder, cost, DAY, DAY,
            "2024-01-01T00:00:00", "i.csv")


@pytest.fixture
def frames(spark):
    def build(rows, schema):
        return spark.createDataFrame(rows, schema + STAMP)
    return build


def test_suppliers_are_trimmed_and_keyed(frames):
    raw = frames([supplier("S1", " Acme ", email="  Me@X.Org "), supplier(None)], SUPPLIERS_SCHEMA)
    [row] = staging.stg_suppliers(raw).collect()
    assert (row.supplier_name, row.contact_email, row.is_active) == ("Acme", "me@x.org", True)
    assert row.ingested_at == dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("delay,category", [
    (0, "NO_DELAY"), (1, "MINOR"), (5, "MINOR"), (6, "MODERATE"), (14, "MODERATE"), (15, "SEVERE"), (-1, "SEVERE"),
    (None, "SEVERE")])
def test_delay_category(frames, delay, category):
    raw = frames([shipment("H1", "S1", delay)], SHIPMENTS_SCHEMA)
    assert staging.stg_shipments(raw).first().delay_category == category


def test_stock_value_is_rounded_half_away(frames):
    raw = frames([stock("I1", "S1", 1, 1, 0.125), stock("I2", "S1", 3, 1, 1.115)], INVENTORY_SCHEMA)
    values = {r.inventory_id: r.stock_value_usd for r in staging.stg_inventory(raw).collect()}
    assert values == {"I1": 0.13, "I2": 3.35}


def test_only_the_wanted_columns_are_needed(frames):
    raw = frames([shipment("H1", "S1", 3)], SHIPMENTS_SCHEMA).select("shipment_id", "delay_days")
    assert staging.stg_shipments(raw, ["delay_category"]).first().asDict() == {"delay_category": "MINOR"}
    with pytest.raises(ValueError):
        staging.stg_shipments(raw, ["nonsense"])


def test_supplier_without_shipments_has_no_rate(frames):
    suppliers = staging.stg_suppliers(frames([supplier("S1", risk="CRITICAL"), supplier("S2")], SUPPLIERS_SCHEMA))
    shipped = staging.stg_shipments(frames(
        [shipment("H1", "S1", 20), shipment("H2", "S1", 0), shipment("H3", "S1", 1)], SHIPMENTS_SCHEMA))
    rows = {r.supplier_id: r for r in marts.mart_supplier_risk(suppliers, shipped).collect()}
    assert (rows["S1"].disruption_rate_pct, rows["S1"].max_delay_days, rows["S1"].risk_score) == (33.33, 20, 4)
    assert (rows["S2"].total_shipments, rows["S2"].avg_delay_days, rows["S2"].disruption_rate_pct) == (0, 0.0, None)


def test_stock_status_order_and_missing_supplier(frames):
    suppliers = staging.stg_suppliers(frames([supplier("S1")], SUPPLIERS_SCHEMA))
    lines = staging.stg_inventory(frames([
        stock("I1", "S9", 0, 10), stock("I2", "S1", 9, 10), stock("I3", "S1", 14, 10), stock("I4", "S1", 15, 10)],
        INVENTORY_SCHEMA))
    rows = {r.inventory_id: r for r in marts.mart_inventory_health(lines, suppliers, dt.date(2024, 1, 31)).collect()}
    assert [rows[f"I{i}"].stock_status for i in range(1, 5)] == ["STOCKOUT", "CRITICAL", "LOW", "HEALTHY"]
    assert rows["I1"].supplier_name is None
    assert (rows["I2"].days_since_restock, rows["I2"].days_to_expiry) == (30, -30)
