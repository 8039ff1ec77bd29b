"""Dictionaries, the single coded pass of the anomaly job, and the joins behind the enriched shipments."""

from pyspark.sql import functions as F

from quayside.operators import anomalies, encoding, features
from quayside.session import cut_lineage


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, rows=4_000):
    return cut_lineage(spark.range(rows).select(
        F.concat(F.lit("long-name-of-an-article-"), F.col("id").cast("string")).alias("many"),
        (F.col("id") % 7).cast("string").alias("few"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 5).cast("string")).alias("gaps"), F.lit(None).cast("string").alias("none")))


COLUMNS = {"many": "many_enc", "few": "few_enc", "gaps": "gaps_enc", "none": "none_enc"}


def test_codes(spark):
    rows = encoding.label_encode(table(spark), COLUMNS).collect()
    for source, target in COLUMNS.items():
        values = sorted({r[source] for r in rows} - {None})
        place = {value: i for i, value in enumerate(values)}
        assert all(r[target] == place.get(r[source], len(values)) for r in rows)


def test_small_dictionaries_cost_no_exchange(spark):
    df = table(spark)
    books = encoding.dictionaries(df, list(COLUMNS))
    assert {name: book.size for name, book in books.items()} == {"many": 4_000, "few": 7, "gaps": 5, "none": 0}
    assert "Exchange hashpartitioning" not in plan_of(encoding.apply_codes(df, COLUMNS, books))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(8_000))
    try:  # the long dictionary is beyond the limit, the others are not
        plan = plan_of(encoding.apply_codes(df, COLUMNS, books))
        assert plan.count("SortMergeJoin") == 1
        assert plan.count("Exchange hashpartitioning") == 2, "the rows once, and their dictionary"
        assert plan.count("BroadcastHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rows_meet_their_supplier_once(warehouse):
    plan = plan_of(warehouse.enriched_shipments())
    assert plan.count("supplier.parquet") == 1 and plan.count("lineitem.parquet") == 1


def test_rows_are_coded_once(warehouse, monkeypatch):
    """Counting and drawing read the numbered rows; what is coded is the sample, and all rows in the scoring pass."""
    numbered = anomalies.number_rows(warehouse.shipment_ratios())
    books = features.shipment_dictionaries(numbered)
    coded = []

    def code(rows):
        coded.append("tree" in rows.columns)
        return features.shipment_codes(rows, books)

    flagged = anomalies.isolation_forest(numbered, code, trees=5)
    assert coded == [True, False]
    assert flagged.count() == numbered.count()
    assert not {"sku_enc", "carrier_enc", "row_number"} & set(flagged.columns)
