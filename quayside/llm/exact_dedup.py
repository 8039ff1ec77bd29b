"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups, keep the stable best row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stored


def _md5(content: Column) -> Column:
    return F.md5(content.cast("binary"))


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = _md5) -> DataFrame:
    """One row per document: the row of its group of equal texts that stays.

    Texts are equal when identical after deleting ASCII white space (space, tab to carriage return). Of a group, the
    row with the most code points in the original text stays, then the one with the smallest id; of rows that repeat an
    id with the same length, one. A null text counts as empty. A null id comes after all others. Other columns are
    ignored, an empty table gives an empty result.

    The content hash only proposes groups. The distinct texts of each hash are gathered with a partial aggregate, so a
    group of any size sends one copy per task; where a hash has a single text, its rows are proven equal and meet by
    hash alone. Where it has several (a collision), its rows meet by hash and text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        F.length("text").cast("long").alias("chars"),
        F.regexp_replace("text", r"[ \t-\r]+", "").alias("content"),
    ).select("doc_id", "chars", "content", digest(F.col("content")).alias("hash"),
             F.sha2(F.col("content").cast("binary"), 256).alias("text_sha256"),
             F.monotonically_increasing_id().alias("row")))

    contents = rows.select("hash", "content").distinct()
    collided = stored(contents.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"))
    narrow = rows.drop("content")
    settled = _elect(narrow.join(collided, "hash", "left_anti"), ["hash"])
    # Parquet knows the row count: with no collision at all this branch is not planned.
    if collided.isEmpty():
        return settled
    return settled.unionByName(_elect(rows.join(collided, "hash", "left_semi"), ["hash", "content"]))


def _elect(rows: DataFrame, keys: list[str]) -> DataFrame:
    best = F.max(F.struct(F.col("chars"), (-F.col("doc_id")).alias("id"), (-F.col("row")).alias("row"))).alias("best")
    groups = rows.groupBy(*keys).agg(F.count("*").alias("group_size"), best)
    return rows.join(groups, keys).select(
        "doc_id",
        (-F.col("best.id")).alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("best.row")).alias("kept"),
        "text_sha256",
    )
