"""Ordinal codes of string columns: position in the sorted distinct values, from 0."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import checkpoint_dir, cut_lineage


def distinct_values(df: DataFrame, columns: list[str], stored: bool = False) -> DataFrame:
    """(field, value) pairs that occur; duplicates go map-side. All columns come from one pass, unless ``df`` is stored:
    then each is read alone, which costs less than a row per value."""
    if stored:
        fields = [df.select(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns]
        return reduce(DataFrame.unionAll, fields).filter(F.col("value").isNotNull()).distinct()
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    )


def rank_values(values: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(field, value, code) and the number of values per field."""
    # Range partitions are in order, so a code is the rows in the partitions before plus the rank within.
    # The partition numbers are written down, because a second sampling could choose other boundaries.
    ranged = cut_lineage(
        values.repartitionByRange("field", "value").withColumn("slice", F.spark_partition_id()))
    slices = ranged.groupBy("field", "slice").agg(F.count("*").alias("n"))
    sizes = {row["field"]: row["n"] for row in slices.groupBy("field").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("field").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("field", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("field", "slice").orderBy("value")
    ranked = ranged.withColumn("position", F.row_number().over(within) - 1).join(offsets, ["field", "slice"])
    codes = ranked.select("field", "value", (F.col("offset") + F.col("position")).cast("int").alias("code"))
    return codes, sizes


@dataclass(frozen=True)
class Dictionary:
    """The codes of one field: ``value`` and ``code``, and how many there are."""

    codes: DataFrame | None
    size: int


def dictionaries(df: DataFrame, columns: Sequence[str], stored: bool = False) -> dict[str, Dictionary]:
    """The dictionary of every column, from one pass over ``df``, or one over each column of a stored table.

    They are stored, each in a folder of its own. So the optimizer knows the size of each when it picks a join: those
    below its broadcast limit cost the encoded rows no exchange, however large another one is.
    """
    spark = df.sparkSession
    codes, sizes = rank_values(distinct_values(df, list(columns), stored))
    path = f"{checkpoint_dir(spark)}/stored-{uuid4().hex}"
    codes.write.partitionBy("field").parquet(path)
    found = {}
    for column in columns:
        size = sizes.get(column, 0)
        stored = spark.read.schema("value string, code int").parquet(f"{path}/field={column}") if size else None
        found[column] = Dictionary(stored, size)
    return found


def apply_codes(df: DataFrame, columns: Mapping[str, str], books: Mapping[str, Dictionary]) -> DataFrame:
    """Add a code column per ``source -> target``. A null is coded after all values, as is a value without a code.

    The smallest dictionaries come first, so that one too large to broadcast is joined last.
    """
    for source, target in sorted(columns.items(), key=lambda item: books[item[0]].size):
        book = books[source]
        if book.codes is None:
            df = df.withColumn(target, F.lit(book.size))
            continue
        entries = book.codes.select(F.col("value").alias(source), F.col("code").alias(target))
        df = df.join(entries, source, "left").withColumn(target, F.coalesce(target, F.lit(book.size)))
    return df


def label_encode(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add a code column per ``source -> target``. A null is coded after all values."""
    return apply_codes(df, columns, dictionaries(df, list(columns)))
