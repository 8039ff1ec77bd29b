"""Lines of hot buckets: whole results, and work that grows with the lines instead of their pairs."""

import random

from pyspark.sql import functions as F

from quayside.llm import line_dedup, ngram_join
from quayside.session import cut_lineage


def edited(count, edits, seed=1):
    """One line of 150 characters, each copy with so many random letters."""
    rng = random.Random(seed)
    base = [rng.choice("abcdefghijklmnop ") for _ in range(150)]
    rows = []
    for i in range(count):
        line = list(base)
        for _ in range(edits):
            line[rng.randrange(1, 149)] = rng.choice("qrstuvwxyz")
        rows.append((i, "".join(line)))
    return rows


def shingles(line):
    return {line[i:i + line_dedup.SHINGLE] for i in range(max(1, len(line) - line_dedup.SHINGLE + 1))}


def true_groups(lines):
    sets = [shingles(x.strip().lower()) for x in lines]
    parent = list(range(len(lines)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if 100 * same >= 80 * (len(a) + len(sets[j]) - same):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(lines))]


def test_groups_of_hot_buckets(spark):
    """Lines that share a bucket are all judged. Only pairs without a common band may be missed, and here lines have many
    partners, so the groups are whole but for single lines."""
    rows = [*edited(60, 3, 1), *[(i + 60, t) for i, t in edited(60, 6, 2)]]
    cut = cut_lineage(line_dedup.lines(spark.createDataFrame(rows, "doc_id long, text string")))
    found = {r.node: r.component for r in line_dedup.line_components(cut).collect()}
    label = {r.doc_id: found.get(r.node, r.node) for r in cut.select("doc_id", "node").collect()}
    truth = true_groups([text for _, text in rows])
    for group in set(label.values()):  # nothing is joined that is not linked
        members = [i for i in label if label[i] == group]
        assert len({truth[i] for i in members}) == 1
    parts = {}
    for i, group in enumerate(truth):
        parts.setdefault(group, set()).add(label[i])
    assert sum(len(labels) - 1 for labels in parts.values()) <= 2


def test_pairs_grow_with_the_lines(spark, monkeypatch):
    """A bucket gives at most two pairs per line; the filter behind it no more than that."""
    counted = []
    whole = line_dedup._similar

    def similar(pairs, texts):
        counted.append(pairs.count())
        return whole(pairs, texts)

    monkeypatch.setattr(line_dedup, "_similar", similar)
    rows = edited(600, 9)
    line_dedup.line_components(cut_lineage(line_dedup.lines(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert counted[0] <= 2 * line_dedup.BANDS * len(rows)
    assert len(counted) == 1 or counted[1] <= 2 * len(rows)


def test_rarest_shingles_find_every_similar_pair(spark):
    """The exact filter against all pairs of different components."""
    rows = [*edited(40, 3, 1), *[(i + 40, t) for i, t in edited(40, 6, 2)], *[(i + 80, t) for i, t in edited(20, 1, 3)]]
    cut = cut_lineage(line_dedup.lines(spark.createDataFrame(rows, "doc_id long, text string")))
    nodes = cut.select("node").distinct().withColumn("component", F.pmod("node", F.lit(3)))
    texts = line_dedup._texts(cut, nodes.select("node"))
    found = {(r.a, r.b) for r in line_dedup._rare_partners(nodes, texts).collect()}
    content = {r.node: shingles(r.content) for r in cut.select("node", "content").distinct().collect()}
    for a in content:
        for b in content:
            same = len(content[a] & content[b])
            if a < b and a % 3 != b % 3 and 100 * same >= 80 * (len(content[a]) + len(content[b]) - same):
                assert (a, b) in found


def test_own_columns_survive(spark):
    rows = [(1, "one line here\nanother line", "u", 5, "d"), (2, "one line here\nnew words", "v", 6, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string, dropped long, `number` string")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(cut_lineage(docs)).collect()}
    assert (out[1].row, out[1].dropped, out[1].number) == ("u", 5, "d")
    assert out[2].text == "new words" and out[2].row == "v"
    kept = ngram_join.keep_first(cut_lineage(docs))
    assert kept.columns == docs.columns and {r.number for r in kept.collect()} <= {"d", "e"}


def test_first_round_compares_a_line_once(spark, monkeypatch):
    """Lines that share many buckets meet one partner each, and lose no link by it."""
    counted = []
    whole = line_dedup._similar

    def similar(pairs, texts):
        counted.append(pairs.count())
        return whole(pairs, texts)

    monkeypatch.setattr(line_dedup, "_similar", similar)
    rows = edited(200, 1)
    found = line_dedup.line_components(cut_lineage(line_dedup.lines(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert counted[0] < len({text for _, text in rows})
    assert found.select("component").distinct().count() == 1


def test_small_buckets_need_no_shingle_index(spark, monkeypatch):
    """A bucket of a few lines in several components is settled by its own pairs, with the same result."""
    rows = [*edited(6, 2, 1), *[(i + 6, t) for i, t in edited(6, 4, 2)]]
    cut = cut_lineage(line_dedup.lines(spark.createDataFrame(rows, "doc_id long, text string")))

    def groups():
        parts = {}
        for r in line_dedup.line_components(cut).collect():
            parts.setdefault(r.component, set()).add(r.node)
        return sorted(map(sorted, parts.values()))

    with monkeypatch.context() as patched:
        patched.setattr(line_dedup, "SMALL", 1)
        indexed = groups()
    monkeypatch.setattr(line_dedup, "_rare_partners", lambda *_: 1 / 0)
    assert groups() == indexed


def test_lines_that_share_too_little_are_no_partners(spark):
    """Lines of other words around a common part share rare shingles, but too few of them to be compared."""
    rng = random.Random(4)
    common = "".join(rng.choice("abcdefghij") for _ in range(100))
    rows = [(i, common + "".join(rng.choice("klmnopqrst") for _ in range(60))) for i in range(30)]
    cut = cut_lineage(line_dedup.lines(spark.createDataFrame(rows, "doc_id long, text string")))
    nodes = cut.select("node").distinct().withColumn("component", F.col("node"))
    texts = line_dedup._texts(cut, nodes.select("node"))
    assert line_dedup._rare_partners(nodes, texts).isEmpty()
