"""Quarantine of bad lines, refresh by versions, counts of the write, bucketed joins, weather files that differ."""

import json

import pytest
from pyspark.sql import functions as F

from quayside.operators import shipments, staging
from quayside.plans import daily, marts
from quayside.sources import feeds, landing, tables

RUN = "2024-01-31T00:00:00"
HEADER = ("shipment_id,supplier_id,sku,origin_country,destination_warehouse,quantity_shipped,scheduled_date,"
          "actual_arrival_date,delay_days,status,freight_cost_usd,carrier,disruption_flag")


def line(number, supplier="S1", delay="3"):
    return f"H{number},{supplier},K,Kenya,W,5,2024-01-01,2024-01-04,{delay},ON_TIME,10.5,C,False"


@pytest.fixture
def landed(tmp_path):
    lines = [line(i, f"S{i % 40}") for i in range(200)]
    lines[7] = line(7, delay="soon")
    lines[30] = "H30,S30,too,short"
    (tmp_path / "shipments.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    heads = ("supplier_id,supplier_name,country,contact_email,product_category,lead_time_days,reliability_score,"
             "risk_level,active,onboarded_date,annual_spend_usd")
    suppliers = [f"S{i},Name {i},Kenya,a@b.c,Cases,12,0.75,LOW,True,2023-05-01,1000.5" for i in range(40)]
    (tmp_path / "suppliers.csv").write_text("\n".join([heads, *suppliers]) + "\n")
    return tmp_path


def test_bad_lines_are_quarantined_and_stop_nothing(spark, landed):
    assert daily.load(spark, str(landed), RUN) == ["raw_shipments", "raw_suppliers"]
    good = spark.table("raw.raw_shipments")
    assert good.count() == 198 and good.filter("shipment_id IN ('H7', 'H30')").count() == 0
    assert "_bad_line" not in good.columns and {r._source_file for r in good.collect()} == {"shipments.csv"}
    bad = spark.table("raw.quarantine").orderBy("line").collect()
    assert [(r.table_name, r.source_file, r.line, r.ingested_at) for r in bad] == [
        ("raw_shipments", "shipments.csv", "H30,S30,too,short", RUN),
        ("raw_shipments", "shipments.csv", line(7, delay="soon"), RUN)]
    # Which lines are bad does not depend on the columns that are read.
    scanned = landing.csv_scan(spark, str(landed / "shipments.csv"), landing.SHIPMENTS_SCHEMA)
    assert landing.good_rows(scanned).select("carrier").count() == 198
    assert landing.good_rows(scanned).count() == 198


def test_clean_files_leave_an_empty_quarantine(spark, landed):
    (landed / "shipments.csv").write_text(HEADER + "\n" + line(1) + "\n")
    daily.load(spark, str(landed), RUN)
    assert spark.table("raw.quarantine").count() == 0 and spark.table("raw.raw_shipments").count() == 1


def test_files_keep_their_names(spark, tmp_path):
    for name in ("one.csv", "two.csv"):
        (tmp_path / name).write_text(f"a,b\n1,{name}\n")
    rows = landing.ingest_metadata(spark.read.csv(str(tmp_path), header=True), RUN).collect()
    assert sorted((r.b, r._source_file, r._ingested_at) for r in rows) == [
        ("one.csv", "one.csv", RUN), ("two.csv", "two.csv", RUN)]


def version_folders(spark, layer, table):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(f"{spark.catalog.getDatabase(layer).locationUri}/{table}__versions")
    return {r.path.rsplit("/", 2)[1] for r in files.select("path").collect()}


def test_a_reader_sees_one_whole_version(spark):
    tables.full_refresh(spark.range(100), "versions_test", "t")
    before = spark.table("versions_test.t")  # planned on the old version, read after the refresh
    tables.full_refresh(spark.range(1_000, 1_300), "versions_test", "t")
    assert before.agg(F.sum("id")).first()[0] == 4950
    assert spark.table("versions_test.t").agg(F.min("id"), F.count("*")).first()[:] == (1_000, 300)
    assert len(version_folders(spark, "versions_test", "t")) == 2
    tables.full_refresh(spark.range(7), "versions_test", "t")
    assert len(version_folders(spark, "versions_test", "t")) == 2 and spark.table("versions_test.t").count() == 7


def test_a_failed_refresh_leaves_the_old_rows(spark):
    tables.full_refresh(spark.range(50), "versions_test", "kept")
    broken = spark.range(50).select((F.lit(1) / F.when(F.col("id") < 49, 1)).alias("x"),
                                    F.when(F.col("id") == 49, F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.full_refresh(broken, "versions_test", "kept")
    assert spark.table("versions_test.kept").count() == 50
    # What a killed refresh leaves behind is removed by the next one.
    spark.range(3).write.option("path", f"{tables._versions(spark, 'versions_test', 'kept')}/lost").saveAsTable(
        "versions_test.kept__next_lost")
    tables.full_refresh(spark.range(51), "versions_test", "kept")
    assert "lost" not in version_folders(spark, "versions_test", "kept")
    assert not spark.catalog.tableExists("versions_test.kept__next_lost")
    assert spark.table("versions_test.kept").count() == 51


def test_changed_columns_and_reading_itself(spark):
    tables.full_refresh(spark.range(5), "versions_test", "changed")
    own = spark.table("versions_test.changed")
    tables.full_refresh(own.select("id", (F.col("id") * 2).alias("twice")).filter("id > 1"), "versions_test", "changed")
    assert spark.table("versions_test.changed").columns == ["id", "twice"]
    assert spark.table("versions_test.changed").count() == 3


def test_writes_count_their_rows(spark):
    tables.full_refresh(spark.range(12), "counts_test", "a")
    tables.full_refresh(spark.range(0), "counts_test", "none")
    tables.full_refresh(spark.range(30).groupBy((F.col("id") % 7).alias("k")).count(), "counts_test", "grouped")
    rows = {r.table_name: r.row_count for r in tables.written_rows(spark, ["counts_test"]).collect()}
    assert rows == {"counts_test.a": 12, "counts_test.none": 0, "counts_test.grouped": 7}
    plan = tables.written_rows(spark, ["counts_test"])._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark, landed):
    daily.load(spark, str(landed), RUN)
    suppliers = staging.stg_suppliers(spark.table("raw.raw_suppliers"))
    facts = staging.stg_shipments(spark.table("raw.raw_shipments"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (shipments.shipment_supplier_enrich(facts, suppliers), shipments.supplier_features(suppliers, facts),
                   marts.mart_supplier_risk(suppliers, facts)):
            plan = plan_of(df)
            assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
        assert shipments.shipment_supplier_enrich(facts, suppliers).filter("reliability_score IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_hot_supplier_is_not_bucketed(spark, landed):
    lines = [line(i, "S0" if i % 3 else f"S{i % 40}") for i in range(300)]
    (landed / "shipments.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        daily.load(spark, str(landed), RUN)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    assert spark.table("raw.raw_shipments").count() == 300
    assert tables._detail(spark, "raw.raw_shipments", "Num Buckets") is None
    assert not tables.spreads(spark.table("raw.raw_shipments"), "supplier_id", 8)
    assert tables.spreads(spark.table("raw.raw_shipments").limit(0), "supplier_id", 8)


def test_weather_files_that_differ(spark, tmp_path):
    def write(city, payload):
        (tmp_path / f"city={city}").mkdir()
        (tmp_path / f"city={city}" / "a.json").write_text(payload)

    time = ["2024-01-01", "2024-01-02"]
    write("Nairobi", json.dumps({"country": "Kenya", "daily": {"time": time, "precipitation_sum": [1.5, None]}}))
    write("Lagos", json.dumps({"country": "Nigeria", "city": "Ikeja", "daily": {
        "time": time, "snowfall_sum": [0.0], "temperature_2m_max": [31, 32], "extra": [1, 2]}}))
    write("Empty", "")
    write("Blank", " \n\t\n")
    write("Broken", "{not json")
    write("Timeless", json.dumps({"country": "X", "daily": {"snowfall_sum": [1.0]}}))
    rows = feeds.concat_weather(spark, str(tmp_path)).orderBy("city", "date").collect()
    assert [(r.city, str(r.date), r.precipitation_mm, r.temp_max_c, r.snowfall_cm, r.weather_code) for r in rows] == [
        ("Ikeja", "2024-01-01", 0, 31, 0, 0), ("Ikeja", "2024-01-02", 0, 32, 0, 0),
        ("Nairobi", "2024-01-01", 1.5, 0, 0, 0), ("Nairobi", "2024-01-02", 0, 0, 0, 0)]
    plan = plan_of(feeds.concat_weather(spark, str(tmp_path)))
    assert plan.count("FileScan") == 1 and "Union" not in plan
