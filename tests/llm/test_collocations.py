"""Collocations: the parse, counts against brute force, whole results against SQL and plain Python, edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from compare import connect, difference
from quayside.llm import collocations as C, queries


def text_of(rng, words):
    """Words of a small vocabulary with passages that repeat, some punctuation, long pieces without any."""
    vocabulary = [f"w{i}" for i in range(30)] + ["Ärger", "É", "a b"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    out = []
    while len(out) < words:
        out += passage if rng.random() < 0.1 else [rng.choice(vocabulary)]
        if rng.random() < 0.02:
            out[-1] += rng.choice([".", ",", ";\n", "\r", "!?", "::"])
    return " ".join(out)


def plain_pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [p for p in (re.findall(r"[^ \t]+", x) for x in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered)) if p]


def plain_counts(rows):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in plain_pieces(text):
            for n in range(1, 6):
                counts[lang or "und"].update(" ".join(piece[i:i + n]) for i in range(len(piece) - n + 1))
    return counts


def plain_collocations(rows, least, top):
    result = []
    for lang, counts in plain_counts(rows).items():
        total = sum(f for p, f in counts.items() if " " not in p)
        candidates = {p: a for p, a in counts.items() if " " in p and a >= least}
        scored = []
        for phrase, a in candidates.items():
            words = phrase.split(" ")
            if any(len(o.split(" ")) > len(words) and 100 * f >= 100 * a and f" {phrase} " in f" {o} "
                   for o, f in candidates.items()):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[" ".join(words[:k])], counts[" ".join(words[k:])]
                cuts.append((1000 * a * total // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, phrase.encode(), phrase, left, right))
        result += [(lang, rank, phrase, -a, left, right, total, -score)
                   for rank, (score, a, _, phrase, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(result)


def chunks_of(sequence):
    return [(sequence[begin:end], own) for begin, end, own in C.parse(sequence, C._Codes())]


def test_each_phrase_begins_in_one_chunk():
    rng = random.Random(2)
    for _ in range(80):
        sequence = [f"w{rng.randrange(20)}" for _ in range(rng.randrange(0, 1_500))]
        if rng.random() < 0.3:
            sequence = ["same"] * (2 * len(sequence))
        chunks = chunks_of(sequence)
        assert [w for words, own in chunks for w in words[:own]] == sequence
        for k, (words, own) in enumerate(chunks):
            last = k == len(chunks) - 1
            assert own == len(words) - (0 if last else C.WINDOW)
            assert own <= C.FARTHEST + (C.WINDOW if last else 0) and (last or own >= C.NEAREST)
            if not last:
                assert words[own:] == chunks[k + 1][0][:C.WINDOW]


def test_equal_passages_parse_alike():
    rng = random.Random(4)
    passage = [f"w{rng.randrange(500)}" for _ in range(4_000)]
    a = {" ".join(c) for c, _ in chunks_of([f"x{rng.randrange(500)}" for _ in range(333)] + passage)}
    b = {" ".join(c) for c, _ in chunks_of([f"y{rng.randrange(500)}" for _ in range(77)] + passage)}
    assert len(a & b) > 0.7 * len(chunks_of(passage))


def test_tokens_are_the_words_of_the_pieces():
    for text in ("", None, " . ,", "A b. C", ".a..b , c\x0b\x0cd  e!", "no break\there", "x\x1cy\xa0z É."):
        assert [p.split(" ") for p in " ".join(C.tokens(text)).split(" \n ") if p] == plain_pieces(text)


def batch_of(rows):
    return pa.RecordBatch.from_pydict({
        "lang": ["en"] * len(rows), "chunk": [r[0] for r in rows], "own": pa.array([r[1] for r in rows], pa.int32()),
        "n_words": pa.array([r[1] for r in rows], pa.int32()), "frequency": [r[2] for r in rows]})


def listed(batches):
    return sorted(row for b in batches for row in zip(*b.to_pydict().values()))


def test_counts_with_and_without_a_bitmap():
    rng = random.Random(6)
    rows = [(" ".join(f"w{rng.randrange(9)}" for _ in range(30)), 30, 1) for _ in range(39)]
    rows.append((" ".join(f"w{rng.randrange(9)}" for _ in range(30)), 30, 10**16 + 1))
    whole = listed(C._counts(3, None, [batch_of(rows)]))
    assert whole == listed(C._counts(3, np.full(C.BITS // 8, 255, np.uint8), [batch_of(rows)]))
    assert listed(C._counts(3, np.zeros(C.BITS // 8, np.uint8), [batch_of(rows)])) == []
    assert sum(f for _, _, f in whole) == 28 * (10**16 + 40)


@pytest.mark.parametrize("n", [2, 3, 4])
def test_stretches_keep_every_phrase_that_may_be_frequent(n):
    """Longer phrases counted in the stretches equal those counted in the chunks, where all their parts are marked."""
    rng = random.Random(n)
    rows = []
    for _ in range(60):
        words = [rng.choice(["a", "b", "c", "d", "\n"]) for _ in range(rng.randrange(1, 25))]
        rows.append((" ".join(words), rng.randrange(1, len(words) + 1), rng.randrange(1, 5)))
    laid = next(C._laid_out([batch_of(rows)]))
    marked = {p for _, p, _ in listed(C._counts(n, None, [batch_of(rows)])) if rng.random() < 0.6}
    bits = C._bit(np.concatenate([C._roll(C._word_codes("en", p.split(" ")), n) for p in sorted(marked)]))
    bitmap = np.zeros(C.BITS // 8, np.uint8)
    np.bitwise_or.at(bitmap, bits >> 3, (1 << (bits & 7)).astype(np.uint8))
    stretches = [laid.runs(n, bitmap)]
    for k in range(n + 1, 6):
        expected = [(lang, p, f) for lang, p, f in listed(C._counts(k, None, [batch_of(rows)]))
                    if all(" ".join(p.split(" ")[i:i + n]) in marked for i in range(k - n + 1))]
        assert listed(C._counts(k, None, stretches)) == expected


@pytest.mark.parametrize("least", [2, 9])
def test_equals_plain_python(spark, least):
    rng = random.Random(least)
    rows = [(text_of(rng, rng.randrange(400)), rng.choice(["en", "de", None])) for _ in range(60)]
    rows += [rows[0]] * 50  # a group of copies
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = C.collocations(docs, least, 300)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in found.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(tuple(r) for r in found.collect()) == plain_collocations(rows, least, 300)


def test_products_beyond_64_bits(spark):
    dictionary = spark.createDataFrame([("en", "alpha beta gamma", 3, 3, 4 * 10**15), ("en", "alpha", 1, 1, 10**15)],
                                       "lang string, chunk string, own int, n_words int, frequency long")
    phrases, totals = C.frequent_phrases(dictionary)
    assert {(r.phrase, r.f) for r in phrases.collect()} == {
        ("alpha", 5 * 10**15), ("beta", 4 * 10**15), ("gamma", 4 * 10**15), ("alpha beta", 4 * 10**15),
        ("beta gamma", 4 * 10**15), ("alpha beta gamma", 4 * 10**15)}
    assert totals.first().n == 13 * 10**15
    row = C.rank_collocations(phrases, totals).first()
    # 1000 a n / (l r) by either cut: alpha | beta gamma and alpha beta | gamma.
    assert (row.phrase, row.l, row.r, row.score) == ("alpha beta gamma", 5 * 10**15, 4 * 10**15, 2600)


def test_query_equals_sql(spark, small):
    con = connect(small)
    assert difference(queries.op11_collocations(spark, small), con, queries.ORACLE_SQL["op11_collocations"]) is None


def test_odd_rows(spark):
    rows = [(1, None, "en", 1), (2, "", None, 1), (3, " \t. ,", "en", None), (None, "A b. A b", None, 3),
            (None, "A b. A b", None, 3), (4, "mot " * 30_000, "fr", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase long")
    found = sorted(tuple(r) for r in C.collocations(docs, 2).collect())
    assert ("und", 1, "a b", 4, 4, 4, 8, 2000) in found
    assert [(r[0], r[2], r[3]) for r in found if r[0] == "fr"] == [
        ("fr", "mot mot", 29_999), ("fr", "mot mot mot", 29_998), ("fr", "mot mot mot mot", 29_997),
        ("fr", "mot mot mot mot mot", 29_996)]
    assert C.collocations(docs.limit(0), 2).count() == 0
    assert C.collocations(docs, 10**6).count() == 0


def test_chunks_count_the_words_that_begin_phrases(spark):
    """Breaks in the closing window belong to the next chunk, those before it are no words."""
    rng = np.random.default_rng(11)
    texts = [" ".join(str(w) if w else "x." for w in rng.integers(0, 40, 700)) for _ in range(6)]
    found = C.parse_documents(spark.createDataFrame([("en", t) for t in texts], "lang string, text string")).collect()
    for r in found:
        assert r.n_words == r.own - r.chunk.split(" ")[:r.own].count(C.BREAK)
    assert sum(r.n_words * r.frequency for r in found) == 6 * 700
    assert any(C.BREAK in r.chunk.split(" ")[r.own:] for r in found)


def test_word_codes_tell_words_and_languages_apart():
    words = [f"w{i}" for i in range(20_000)]
    codes = np.concatenate([C._word_codes(lang, words) for lang in ("en", "de")])
    assert len(set(codes.tolist())) >= 39_990 and np.array_equal(codes[:20_000], C._word_codes("en", words))
    assert len(set(C._bit(codes).tolist())) > 39_900
