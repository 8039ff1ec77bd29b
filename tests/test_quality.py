from quayside.operators import quality


def test_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(r) for r in quality.unique_violations(df, "m", "k").collect()] == [("m", "k", "a", 2)]


def test_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert sorted(tuple(r) for r in quality.null_counts(df, "m", ["x", "y"]).collect()) == [("m", "x", 1), ("m", "y", 2)]


def test_rejected_values(spark):
    df = spark.createDataFrame([("LOW", "q"), ("odd", "q"), ("odd", None)], "x string, y string")
    got = quality.rejected_values(df, "m", {"x": ("LOW",), "y": ("z",)}).collect()
    assert sorted(tuple(r) for r in got) == [("m", "x", "odd", 2), ("m", "y", "q", 2)]


def test_foreign_keys(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [tuple(r) for r in quality.fk_violations(child, parent, "k").collect()] == [("x", 2)]


def test_negative_delays(spark):
    df = spark.createDataFrame([(-1,), (0,), (None,)], "delay_days int")
    assert quality.negative_delays(df).count() == 1


def test_ranges(spark):
    suppliers = spark.createDataFrame([("a", 1.2, 0), ("a", 0.5, 4)],
                                      "supplier_id string, reliability_score double, lead_time_days int")
    risk = spark.createDataFrame([(101.0,), (None,), (3.0,)], "disruption_rate_pct double")
    got = {r.check_name: r.violations for r in quality.range_violations(suppliers, risk).collect()}
    assert got == {"disruption_rate_pct": 1, "reliability_score": 1, "lead_time_days": 1, "supplier_id_unique": 1}


def test_the_36_checks_are_all_there():
    unique = len(quality.UNIQUE)
    not_null = sum(len(c) for c in quality.NOT_NULL.values())
    accepted = sum(len(c) for c in quality.ACCEPTED.values())
    # plus one relationship and one rule on delays
    assert (unique, not_null, accepted, unique + not_null + accepted + 2) == (5, 23, 6, 36)


def test_summary_reads_each_model_once(spark):
    """Violations of every kind in one pass per model, a hot key and repeated rows included."""
    suppliers = spark.createDataFrame(
        [("a", "n", "K", "LOW", 0.5, True)] * 2 + [("b", None, "K", "odd", 0.5, True), (None, "n", "K", None, 0.5, True)],
        "supplier_id string, supplier_name string, country string, risk_level string, reliability_score double, "
        "is_active boolean")
    shipments = spark.createDataFrame(
        [(f"s{i}", "hot", "ON_TIME", "MINOR", 1) for i in range(500)] + [("s1", "a", "LOST", "MINOR", -1)],
        "shipment_id string, supplier_id string, status string, delay_category string, delay_days int")
    inventory = spark.createDataFrame([], "inventory_id string, sku string, warehouse string, quantity_on_hand int, "
                                          "unit_cost_usd double")
    risk = spark.createDataFrame([("a", "LOW", None, 0.5)], "supplier_id string, risk_level string, "
                                 "disruption_rate_pct double, reliability_score double")
    health = spark.createDataFrame([("i", "LOW", 1.0)] * 3, "inventory_id string, stock_status string, "
                                   "stock_value_usd double")
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            reads.add(1)
            yield row

    watched = spark.createDataFrame(shipments.rdd.mapPartitions(counted), shipments.schema)
    models = {"stg_suppliers": suppliers, "stg_inventory": inventory, "stg_shipments": watched,
              "mart_supplier_risk": risk, "mart_inventory_health": health}
    rows = quality.check_summary(models).collect()
    assert reads.value == 501 and len(rows) == 36
    found = {(r.model, r.column_name, r.check_name): r.violations for r in rows if r.violations}
    assert found == {
        ("stg_suppliers", "supplier_id", "unique"): 1, ("stg_suppliers", "supplier_id", "not_null"): 1,
        ("stg_suppliers", "supplier_name", "not_null"): 1, ("stg_suppliers", "risk_level", "not_null"): 1,
        ("stg_suppliers", "risk_level", "accepted_values"): 1, ("stg_shipments", "shipment_id", "unique"): 1,
        ("stg_shipments", "status", "accepted_values"): 1, ("stg_shipments", "delay_days", "no_negative_delays"): 1,
        ("stg_shipments", "supplier_id", "relationships"): 500,
        ("mart_supplier_risk", "disruption_rate_pct", "not_null"): 1,
        ("mart_inventory_health", "inventory_id", "unique"): 1}
    assert {r.status for r in rows if r.violations == 0} == {"PASS"}
