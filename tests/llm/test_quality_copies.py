"""The quality classifier learns from different texts: copies, repeated rows and labels move nothing."""

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import quality
from quayside.llm.common import remainder, table


def test_copies_of_one_labelled_document_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 15)
    folder = "/root/testdata/sf0.01"
    docs, marks = table(spark, folder, "documents"), table(spark, folder, "labels", "doc_id", "quality")
    plain = quality.train(docs, marks, 60)
    first = marks.filter("quality = 0").filter(remainder(F.col("doc_id"), 5) != 0).orderBy("doc_id").first()
    one = docs.filter(F.col("doc_id") == first.doc_id)
    copies = one.crossJoin(spark.range(2_000)).drop("id")
    renamed = one.drop("doc_id").crossJoin(spark.range(10**7, 10**7 + 2_000)).withColumnRenamed("id", "doc_id")
    more = renamed.select("doc_id", F.lit(0).alias("quality"))
    both = quality.train(docs.unionByName(copies).unionByName(renamed), marks.unionByName(more).unionByName(marks), 60)
    assert all(np.array_equal(plain.weights[k], both.weights[k]) for k in plain.weights)
    assert abs(plain.prior - both.prior) < 1e-12
    scores = quality.classify(docs, marks, both).agg(F.stddev("score")).first()[0]
    assert scores > 0


def test_contradicting_labels_are_not_learned(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, "bad text"), (3, "good text"), (4, "odd")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0), (4, 1)], "doc_id long, quality int")
    learnable = F.lit(True)
    from quayside.llm.sampling import labelled_texts
    counts, sample = labelled_texts(docs, marks, "quality", learnable, 10)
    assert counts == {0: 1} and sample is None


def test_whole_texts_are_learned_from(spark):
    long = "word " * 4_000
    docs = spark.createDataFrame([(1, long + "end"), (2, "short")], "doc_id long, text string")  # not held out
    marks = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    whole = quality.fit
    try:
        quality.fit = lambda samples, labels, prior: seen.extend(map(len, samples))
        quality.train(docs, marks, 10)
    finally:
        quality.fit = whole
    assert sorted(seen) == [1, len(quality.chunks(long + "end"))]
