"""Labelled texts to learn from: different texts, a bounded number of either label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, learnable: Column,
                   per_class: int) -> tuple[dict[int, int], DataFrame | None]:
    """How many different texts carry label 0 and 1, and a sample of them (``content``, ``label``, ``text``).

    ``learnable`` tells the ids that may be learned from. Copies of a text count once, under whatever ids, and a text or
    id with both labels not at all; repeated rows of either table do no harm. The sample: of either label at most
    ``per_class`` texts, those with the smallest content hashes, each whole. No sample unless both labels occur.
    """
    marks = (
        labels.select("doc_id", F.col(label).alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
        .filter(learnable).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
    )
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("content", F.md5(F.col("text").cast("binary")))
    texts = (
        rows.select("doc_id", "content").join(marks, "doc_id").groupBy("content")
        .agg(F.min("doc_id").alias("doc_id"), F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most").select("content", "doc_id", "label")
    )
    counts = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return counts, None
    drawn = [texts.filter(F.col("label") == c).orderBy("content").limit(per_class) for c in (0, 1)]
    # At most 2 * per_class narrow rows are broadcast; a row of the documents that repeats goes once.
    chosen = rows.join(F.broadcast(drawn[0].unionByName(drawn[1])), ["content", "doc_id"]).dropDuplicates(["content"])
    return counts, chosen.select("content", "label", "text")
