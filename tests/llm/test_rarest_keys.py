"""The keys by which the n-gram join finds sets to compare: the rarest shingles, counted over all sets."""

import random

from pyspark.sql import functions as F
from quayside.llm import ngram_join
from quayside.session import cut_lineage


def rows(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return cut_lineage(docs.withColumn("row", F.xxhash64("doc_id", "text")))


def test_a_common_passage_is_no_key_beside_rarer_shingles(spark):
    """Texts that hold half of their words in common are no candidates at a similarity of 0.8."""
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [f"{passage} " + " ".join(f"w{i}_{k}" for k in range(40)) for i in range(40)]
    sets, keys = ngram_join.keyed_sets(rows(spark, texts), 5, 80)
    assert sets.count() == 40 and keys.isEmpty()


def test_five_words_at_four_fifths_equal_brute_force(spark, monkeypatch):
    """Copies with changed words around common passages, repeated texts and short ones, in many chunks and parts."""
    monkeypatch.setattr(ngram_join, "CHUNK", 150)
    monkeypatch.setattr(ngram_join, "PART_BYTES", 1_000)
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(60)]
    texts = ["", None, "one", "ONE", "one two three four five"]
    for b in range(25):
        base = [f"b{b}_{k}" for k in range(rng.randint(4, 80))] + passage[: rng.choice([0, 10, 60])]
        for _ in range(rng.randint(1, 6)):
            texts.append(" ".join(w if rng.random() > 0.02 else f"new{rng.random()}" for w in base))
    texts += texts[10:40:3]
    rng.shuffle(texts)
    sets = [set(ngram_join.shingles(t, 5).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    found = ngram_join.ngram_join(rows(spark, texts).drop("row"), 5, 80).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(group)) and len(set(group)) < len(texts) - 20
