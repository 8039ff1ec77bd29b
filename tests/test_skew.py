"""One supplier holds a third of all shipments, and no table is small enough to broadcast."""

import pytest
from pyspark.sql import functions as F

from quayside.operators import order_statistics, quality, shipments


@pytest.fixture(scope="module")
def skewed(spark):
    """200,000 shipments of 1,000 suppliers; supplier 0 has every third one."""
    ids = spark.range(200_000)
    owner = F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)))
    return ids.select(
        F.concat(F.lit("H"), "id").alias("shipment_id"), owner.cast("string").alias("supplier_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("sku"), F.lit("X").alias("origin_country"),
        F.lit("W").alias("destination_warehouse"), F.lit(5).alias("quantity_shipped"),
        (F.col("id") % 20).cast("int").alias("delay_days"), (F.col("id") % 500).cast("double").alias("freight_cost_usd"),
        F.lit("C").alias("carrier"), (F.col("id") % 20 > 14).alias("is_disrupted"), F.lit("D").alias("status"))


@pytest.fixture(scope="module")
def suppliers(spark):
    return spark.range(1000).select(
        F.col("id").cast("string").alias("supplier_id"), F.lit(0.7).alias("reliability_score"),
        (F.col("id") + 7).cast("int").alias("lead_time_days"), F.lit("LOW").alias("risk_level"),
        F.lit(1.0).alias("annual_spend_usd"))


@pytest.fixture
def no_broadcast(spark):
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    for key, value in options.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_supplier_is_split(no_broadcast, skewed, suppliers):
    joined = shipments.shipment_supplier_enrich(skewed.repartition(8), suppliers)
    total = joined.agg(F.count("*").alias("n"), F.sum("supplier_lead_time").alias("days"),
                       F.sum(F.length("sku")).alias("width"))
    [row] = total.collect()
    expected = skewed.agg(F.sum(F.col("supplier_id").cast("int") + 7).alias("days")).first().days
    assert (row.n, row.days) == (200_000, expected)
    assert "SortMergeJoin(skew=true)" in total._jdf.queryExecution().executedPlan().toString()


def test_grouping_combines_before_the_exchange(skewed):
    """A hot supplier reaches the exchange as one row per task."""
    stats = shipments.shipment_stats(skewed)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    hot = stats.filter("supplier_id = '0'").first()
    assert hot.total_shipments >= 200_000 // 3 and hot.max_delay_days == 19


def test_foreign_keys_are_counted_first(skewed, suppliers):
    known = suppliers.filter("supplier_id <> '0'")
    rows = quality.fk_violations(skewed, known, "supplier_id").collect()
    assert [r.supplier_id for r in rows] == ["0"]
    assert rows[0].occurrences == skewed.filter("supplier_id = '0'").count()


def test_a_hot_value_is_one_bucket(skewed):
    value = F.when(F.col("supplier_id") == "0", 3.0).otherwise(F.col("freight_cost_usd"))
    found = order_statistics.exact_quantiles(skewed, {"q": (value, 0.2)})
    assert found["q"] == 3.0
