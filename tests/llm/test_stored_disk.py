"""What the line and n-gram joins leave on disk."""

import os

from pyspark.sql import functions as F

from quayside.llm import line_dedup, ngram_join
from quayside.session import checkpoint_dir, cut_lineage, discard


def left(spark):
    root = checkpoint_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(root) if d.startswith("stored-")}


def columns(spark, folders):
    root = checkpoint_dir(spark)
    return [set(spark.read.parquet(f"{root}/{d}").columns) for d in folders]


def test_discard_deletes_a_stored_frame_alone(spark):
    before = left(spark)
    one, two = cut_lineage(spark.range(5)), cut_lineage(spark.range(6))
    discard(one)
    assert len(left(spark) - before) == 1 and two.count() == 6


def test_no_table_of_keys_or_shingles_stays(spark):
    texts = [" ".join(f"w{i % 40 + k}" for k in range(60)) for i in range(80)]
    docs = cut_lineage(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    before = left(spark)
    kept = ngram_join.keep_first(docs).count()
    line_dedup.dedup_lines(docs).count()
    stayed = columns(spark, left(spark) - before)
    assert 0 < kept <= 40 and not [c for c in stayed if c & {"keys", "tokens"} or c == {"node", "token", "lines"}]


def test_sets_that_share_a_key_are_a_block(spark):
    sets = cut_lineage(spark.createDataFrame(
        [(1, [10, 11]), (2, [11, 12]), (3, [13]), (4, [12])], "fp long, keys array<long>"))
    found = {r.fp: r.block for r in ngram_join.candidate_blocks(sets).collect()}
    assert found == {1: 1, 2: 1, 4: 1}


def test_a_set_goes_only_to_tiles_that_can_hold_a_link(spark):
    """Of ten tiles a set meets those where a set of another component has one of its keys."""
    placed = spark.createDataFrame([(i, i % 10, 100 + i // 20) for i in range(40)], "fp long, tile int, component long")
    shared = [(1, 1), (1, 2), (1, 13),           # one component
              (2, 3), (2, 24), (2, 33), (2, 20),  # 3 meets tile 4; 33 is in its own tile and 20 in tile 0
              (3, 5), (3, 25)]
    keys = spark.createDataFrame([(k, fp, 0) for k, fp in shared], "key long, fp long, first long")
    found = {r.fp: sorted(r.others) for r in ngram_join._meetings(placed, keys).collect()}
    assert found == {3: [4], 24: [3]}


def test_links_across_tiles_are_found_in_the_second_phase(spark, monkeypatch):
    """Texts around a common passage, in pairs that differ in a word, with a tile for about every set."""
    monkeypatch.setattr(ngram_join, "TILE", 60)
    sent = []
    whole = ngram_join._tile_edges

    def tile_edges(members, pairs, n, percent):
        sent.append((members.count(), members.select(F.explode(pairs)).count()))
        return whole(members, pairs, n, percent)

    monkeypatch.setattr(ngram_join, "_tile_edges", tile_edges)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [f"{passage} " + " ".join(f"{'x' if k == 30 and j else 'w'}{i}_{k}" for k in range(31))
             for i in range(12) for j in range(2)]
    docs = cut_lineage(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in ngram_join.keep_first(docs).collect()) == list(range(0, 24, 2))
    # Without the keys every set would go to all of some 25 tiles.
    assert len(sent) == 2 and sent[1][1] < 24 * 25 / 2
