"""Layers of stored tables: create, replace, read when present, count, preview."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RAW, STAGING, MARTS, PREDICTIONS = "raw", "transformed_staging", "transformed_marts", "predictions"


def create_layer(spark: SparkSession, layer: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")


WRITTEN_ROWS = "written_rows"  # table property: the rows of the current version
_NEXT = "__next_"


def _versions(spark: SparkSession, layer: str, table: str) -> str:
    return f"{spark.catalog.getDatabase(layer).locationUri}/{table}__versions"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _detail(spark: SparkSession, name: str, field: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == field).collect()
    return rows[-1]["data_type"] if rows else None


def full_refresh(df: DataFrame, layer: str, table: str, bucket_by: str | None = None) -> DataFrame:
    """Replace a stored table with the frame and read it back.

    Every refresh writes a folder of its own, and one catalog operation then points the table to it. A reader sees
    either version whole; one that began on the old version can finish, since the version before the current one is
    kept. A failed or killed refresh leaves the table as it was, and the next one removes what it left. The frame may be
    computed from the table it replaces. One writer per table is assumed.

    Only where the columns or buckets change is the table dropped and made anew, with a moment in between.

    ``bucket_by`` distributes the rows by a key that later joins and groups use, which then need no exchange. It is
    meant for keys none of which holds a large share of the rows, see ``spreads``. The rows are counted as they are
    written, see ``written_rows``.
    """
    spark = df.sparkSession
    create_layer(spark, layer)
    name, version = f"{layer}.{table}", uuid4().hex
    side, path = f"{layer}.{table}{_NEXT}{version}", f"{_versions(spark, layer, table)}/{version}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if bucket_by:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = counted.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    else:
        writer = counted.write
    writer.format("parquet").option("path", path).saveAsTable(side)
    rows = seen.get.get("rows", 0)

    previous = None
    if spark.catalog.tableExists(name):
        previous = _detail(spark, name, "Location")
        alike = spark.table(name).schema == spark.table(side).schema and previous.startswith(
            _versions(spark, layer, table)) and all(
            _detail(spark, name, f) == _detail(spark, side, f) for f in ("Num Buckets", "Bucket Columns"))
        if alike:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            spark.sql(f"DROP TABLE {side}")  # external: its files stay
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {side} RENAME TO {name}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{WRITTEN_ROWS}' = '{rows}')")
    _forget_versions(spark, layer, table, {path, previous})
    return spark.table(name)


def _forget_versions(spark: SparkSession, layer: str, table: str, kept: set[str | None]) -> None:
    """Remove the folders of versions that nobody points to, and the side tables of killed refreshes."""
    for other in spark.catalog.listTables(layer):
        if other.name.startswith(f"{table}{_NEXT}"):
            spark.sql(f"DROP TABLE IF EXISTS {layer}.{other.name}")
    names = {path.rstrip("/").rsplit("/", 1)[-1] for path in kept if path}
    folder = spark._jvm.org.apache.hadoop.fs.Path(_versions(spark, layer, table))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        if status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def spreads(df: DataFrame, key: str, parts: int) -> bool:
    """Whether no value of the key holds more than twice the rows of an even part, so that ``parts`` tasks share them.

    Counted per value before anything is exchanged.
    """
    heaviest = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return not heaviest["all"] or heaviest["most"] * parts <= 2 * heaviest["all"]


def written_rows(spark: SparkSession, layers: Sequence[str]) -> DataFrame:
    """Rows of every stored table of the layers, as counted by the write that made it; no table is read."""
    counts = []
    for layer in layers:
        for table in spark.catalog.listTables(layer):
            if not table.isTemporary and _NEXT not in table.name:
                rows = _properties(spark, f"{layer}.{table.name}").get(WRITTEN_ROWS)
                counts.append((f"{layer}.{table.name}", None if rows is None else int(rows)))
    return spark.createDataFrame(counts, "table_name string, row_count bigint").orderBy("table_name")


def materialize(spark: SparkSession, models: Mapping[str, DataFrame], stored: bool) -> None:
    """Marts are stored tables; staging models stay lazy, as temporary views."""
    for name, df in models.items():
        if stored:
            full_refresh(df, MARTS, name)
        else:
            df.createOrReplaceTempView(name)


def safe_load(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A stored table, or an empty frame when there is none."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def load_summary(tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Row and column count of each table, by name. A table comes as any frame with its rows, such as its key alone,
    and the number of its columns, which the schema tells."""
    return union_all([
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(columns).alias("column_count"))
        for name, (df, columns) in tables.items()
    ]).orderBy("table_name")


def preview(df: DataFrame, key: Sequence[str], rows: int = 3) -> DataFrame:
    """The first rows by key: a top-k, not a sort."""
    return df.orderBy(*key).limit(rows)


def health_check(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """PASS or FAIL per table; a table that is missing (None) or empty fails."""
    present = {name: df for name, df in tables.items() if df is not None}
    spark = next(iter(present.values())).sparkSession if present else SparkSession.active()
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in present.items()
    ]
    missing = [(name, None) for name, df in tables.items() if df is None]
    if missing:
        parts.append(spark.createDataFrame(missing, "table_name string, row_count bigint"))
    return union_all(parts).select(
        "table_name", "row_count", F.when(F.col("row_count") > 0, "PASS").otherwise("FAIL").alias("status"))


def require_healthy(checks: DataFrame) -> None:
    """Raise when any check failed."""
    failed = [row["table_name"] for row in checks.filter("status = 'FAIL'").collect()]  # one row per table
    if failed:
        raise RuntimeError(f"empty or missing tables: {', '.join(sorted(failed))}")
