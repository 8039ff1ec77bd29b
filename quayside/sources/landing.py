"""Landed CSV files to raw tables."""

from __future__ import annotations

import datetime as dt
import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import cut_lineage

_LOAD = "_ingested_at string, _source_file string"
SUPPLIERS_SCHEMA = (
    "supplier_id string, supplier_name string, country string, contact_email string, product_category string, "
    "lead_time_days int, reliability_score double, risk_level string, active boolean, onboarded_date date, "
    "annual_spend_usd double"
)
INVENTORY_SCHEMA = (
    "inventory_id string, sku string, product_category string, warehouse string, supplier_id string, "
    "quantity_on_hand int, reorder_point int, below_reorder boolean, unit_cost_usd double, "
    "last_restocked_date date, expiry_date date"
)
SHIPMENTS_SCHEMA = (
    "shipment_id string, supplier_id string, sku string, origin_country string, destination_warehouse string, "
    "quantity_shipped int, scheduled_date date, actual_arrival_date date, delay_days int, status string, "
    "freight_cost_usd double, carrier string, disruption_flag boolean"
)
DEMAND_SCHEMA = "date string, sku string, warehouse string, demand int"

# Raw table, landed file and schema.
LANDED = {
    "raw_suppliers": ("suppliers.csv", SUPPLIERS_SCHEMA),
    "raw_inventory": ("inventory.csv", INVENTORY_SCHEMA),
    "raw_shipments": ("shipments.csv", SHIPMENTS_SCHEMA),
}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


_BAD = "_bad_line"


def csv_scan(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A CSV file, or a folder of such, with a header; None when it is not there. The schema is given, so nothing is
    inferred. A line that does not fit it has its text in ``_bad_line`` (else null) and whatever could be read; ``_file``
    names the file of a row.

    The lines are parsed once, with all columns, and stored: whether a line fits would else depend on the columns that a
    plan happens to read.
    """
    if not path_exists(spark, path):
        return None
    typed = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    lines = T.StructType([*typed.fields, T.StructField(_BAD, T.StringType())])
    rows = spark.read.csv(path, header=True, schema=lines, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD)
    return cut_lineage(rows.withColumn("_file", F.col("_metadata.file_name")))


def good_rows(scanned: DataFrame) -> DataFrame:
    """The rows whose line fits the schema; ``_file`` stays."""
    return scanned.filter(F.col(_BAD).isNull()).drop(_BAD)


def quarantined(scanned: DataFrame, table: str, run_ts: str) -> DataFrame:
    """The lines that do not fit: table, file, line and load time."""
    return scanned.filter(F.col(_BAD).isNotNull()).select(
        F.lit(table).alias("table_name"), F.col("_file").alias("source_file"), F.col(_BAD).alias("line"),
        F.lit(run_ts).alias("ingested_at"))


def load_stamp(run_ts: str | None = None) -> str:
    return run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()


def ingest_metadata(df: DataFrame, run_ts: str | None = None, source_file: Column | str = "_metadata.file_name") -> DataFrame:
    """Stamp rows with one load time (ISO text) and the name of the file each came from, as the scan itself knows it."""
    named = F.col(source_file) if isinstance(source_file, str) else source_file
    return df.withColumn("_ingested_at", F.lit(load_stamp(run_ts))).withColumn("_source_file", named)


def scan_landed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every landed file that is there, as scanned; missing files are left out."""
    found = {table: csv_scan(spark, posixpath.join(folder, name), schema) for table, (name, schema) in LANDED.items()}
    return {table: rows for table, rows in found.items() if rows is not None}


def load_landed(spark: SparkSession, folder: str, run_ts: str | None = None) -> dict[str, DataFrame]:
    """The good rows of every landed file, stamped."""
    return {table: stamped(rows, run_ts) for table, rows in scan_landed(spark, folder).items()}


def stamped(scanned: DataFrame, run_ts: str | None = None) -> DataFrame:
    return ingest_metadata(good_rows(scanned), run_ts, "_file").drop("_file")
