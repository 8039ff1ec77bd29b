"""Periodic runs against brute force, on words, on a table and on edge cases."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from quayside.llm import queries
from quayside.llm.common import words
from quayside.llm.runs import branching_squares, collapse, find_runs, numbered, run_digest, runs_of, suffix_array


def brute(sequence, least=6, copies=4):
    """Every maximal stretch of every period, keeping the smallest period of a stretch."""
    n, found = len(sequence), {}
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and sequence[j] == sequence[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, copies * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def sequences(rng, count, longest=60):
    for _ in range(count):
        n, kinds = rng.randrange(longest), rng.choice([1, 2, 2, 3, 5])
        sequence = [str(rng.randrange(kinds)) for _ in range(n)]
        if n > 8 and rng.random() < 0.5:
            a, p = rng.randrange(n), 1 + rng.randrange(n // 4)
            sequence = sequence[:a] + [sequence[a + (i - a) % p] for i in range(a, n)]
        yield sequence


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (4, 2), (6, 3)])
def test_runs_equal_brute_force(limits):
    for sequence in sequences(random.Random(sum(limits)), 400):
        assert runs_of(numbered([sequence]), *limits) == brute(sequence, *limits), sequence


def test_suffix_array_and_squares():
    rng = random.Random(3)
    for sequence in sequences(rng, 150, 40):
        symbols = numbered([sequence])
        if not len(symbols):
            continue
        order, place, common = suffix_array(symbols)
        values = symbols.tolist()
        assert order.tolist() == sorted(range(len(values)), key=lambda i: [*values[i:], -1])
        assert (place[order] == np.arange(len(values))).all()
        for k in range(1, len(values)):
            a, b = values[order[k - 1]:], values[order[k]:]
            shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == shared
        squares = {(i, q) for q in range(1, len(values) // 2 + 1) for i in range(len(values) - 2 * q + 1)
                   if values[i:i + q] == values[i + q:i + 2 * q]
                   and (i + 2 * q == len(values) or values[i + q] != values[i + 2 * q])}
        assert set(zip(*(x.tolist() for x in branching_squares(symbols)))) == squares


def test_documents_do_not_meet():
    rng = random.Random(5)
    documents = list(sequences(rng, 60))
    found = runs_of(numbered(documents))
    expected, base = [], 0
    for sequence in documents:
        expected += [(base + s, length, q) for s, length, q in brute(sequence)]
        base += len(sequence)
    assert found == expected


def test_long_runs_are_linear_enough():
    for sequence in (["a"] * 60_000, [str(i % 7) for i in range(60_000)], ["x"] + ["a", "b"] * 30_000):
        found = runs_of(numbered([sequence]))
        assert len(found) == 1 and found[0][1] >= 59_999


def digest(doc_id, sequence):
    found = brute(sequence)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(sequence) if i not in drop).encode()).hexdigest())


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    expected = {d.doc_id: digest(d.doc_id, queries.with_period(d.doc_id, words(d.text or ""))) for d in docs}
    rows = queries.op13_periodic_runs(spark, small)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                            "collapsed_sha256"]
    assert [t for _, t in rows.dtypes] == ["bigint"] * 6 + ["string"] * 2
    found = {r.doc_id: tuple(r) for r in rows.collect()}
    assert found == expected
    assert sum(r[1] > 0 for r in found.values()) >= 5


def test_ties_take_the_first(spark):
    text = "a a a a a a x b b b b b b y c d c d c d c d c d c d"
    row = run_digest(find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (3, 0, 6, 1, 6000)
    assert collapse(text.split(), brute(text.split())) == "a x b y c d".split()


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", None), (None, "w " * 9, None), (None, "w " * 9, None),
            (4, "mot " * 30_000, "y"), (5, "日本 \x1c x", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = {(r.doc_id, r.n_words): r for r in find_runs(docs).collect()}
    assert found[(None, 9)].collapsed == "w" and found[(4, 30_000)].collapsed == "mot"
    assert found[(1, 0)].runs == [] and found[(2, 0)].collapsed == "" and found[(3, 0)].n_words == 0
    assert found[(5, 3)].collapsed == "日本 \x1c x"
    assert run_digest(find_runs(docs)).count() == len(rows)
    assert run_digest(find_runs(docs.limit(0))).count() == 0
