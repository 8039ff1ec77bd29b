"""Fuzzy line deduplication with DataFrame functions alone.

A line's set holds its shingles of ``SHINGLE`` characters. Minima of permuted shingle hashes form a signature, bands of
the signature are bucket keys, and lines that share a bucket are candidates; the exact Jaccard similarity of their sets
decides. Components come from distributed union-find, and of each the first line, by document id and position, stays.

A large bucket never meets itself. First every line is compared with one other, the smallest line of the bucket that it
shares most often. What is then in buckets of several components goes on: in buckets of at most ``SMALL`` lines those of
different components are all compared; in larger ones those outside of the largest component with a line of it. For the
lines of larger buckets that stay in several components the rest is settled by an exact filter: two sets with the
similarity share one of their rarest shingles, so only lines of different components that do are compared.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import free_name, stored
from quayside.llm.components import components
from quayside.session import discard

SHINGLE = 8
PERCENT = 80
BANDS, ROWS = 8, 4      # a pair at the threshold shares a bucket with probability 0.985, at 0.9 with 0.9998
RUN = 16                # shingles that are hashed in one row
SMALL = 12              # lines of a bucket that are compared pairwise
BROADCAST_ROWS = 500_000    # at most so many keys or nodes (longs) are broadcast to the lines


def _content(line: Column) -> Column:
    return F.lower(F.trim(line))


def lines(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``line_no`` (from 0), ``content`` (lower case, trimmed of blanks) and ``node``, a 64-bit hash
    of it, of all lines. ``node`` is null for a blank line, which takes no part."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                           "text")
    cut = numbered.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    content = _content(F.col("line"))
    return cut.select("row", "doc_id", "line_no", content.alias("content")).withColumn(
        "node", F.when(F.length("content") > 0, F.xxhash64("content")))


def _units(content: Column) -> Column:
    """Two bytes per character, so that a shingle is cut out in constant time."""
    return F.encode(content, "UTF-16BE")


def _starts(units: Column) -> Column:
    """Where shingles start, as bytes before them; a line shorter than a shingle is one."""
    return F.sequence(F.lit(0), F.greatest(F.octet_length(units) - 2 * SHINGLE, F.lit(0)), F.lit(2))


def signatures(cut: DataFrame) -> DataFrame:
    """``node`` and the minima of its shingles under each permutation, as ``m0`` and so on."""
    units = cut.filter("node IS NOT NULL").select("node", _units(F.col("content")).alias("u"))
    sized = units.withColumn("last", F.greatest(F.octet_length("u") - 2 * SHINGLE, F.lit(0)))
    # A row per run of shingles, whose minimum is taken within the row: far fewer updates of the aggregate.
    runs = sized.select("node", "u", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(2 * RUN))).alias("at"))

    # Behind the last shingle of a line, the last one again: a branch here would double the code of the loop.
    shingles = runs.select("node", *(
        F.hash(F.substring("u", F.least(F.col("at") + 2 * k, F.col("last")) + 1, F.lit(2 * SHINGLE))).alias(f"h{k}")
        for k in range(RUN)))
    rng = random.Random(5)
    masks = [rng.randrange(-(1 << 31), 1 << 31) for _ in range(BANDS * ROWS)]
    # With a random hash, flipping fixed bits of it is another random order of the shingles.
    return shingles.groupBy("node").agg(*(
        F.min(F.least(*(F.col(f"h{k}").bitwiseXOR(F.lit(mask)) for k in range(RUN)))).alias(f"m{j}")
        for j, mask in enumerate(masks)))


def band_keys(signed: DataFrame) -> DataFrame:
    """``node`` and ``keys``, one per band."""
    keys = [F.xxhash64(F.lit(b), *(f"m{b * ROWS + r}" for r in range(ROWS))) for b in range(BANDS)]
    return signed.select("node", F.array(*keys).alias("keys"))


def _few(keys: DataFrame) -> DataFrame:
    """A stored table of one long column, broadcast to what it is joined to if it is small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _tokens(units: str) -> Column:
    # Bound as a variable, the line is read once; as a column it would be copied for every shingle.
    return F.transform(F.array(F.col(units)), lambda line: F.transform(
        _starts(line), lambda at: F.xxhash64(F.substring(line, at + 1, F.lit(2 * SHINGLE)))))[0]


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose shingle sets have the similarity. Sets whose sizes alone rule it out are not built."""
    def side(end: str, units: str, size: str) -> DataFrame:
        return texts.select(F.col("node").alias(end), F.col("units").alias(units), F.col("size").alias(size))

    both = pairs.join(side("a", "x", "nx"), "a").join(side("b", "y", "ny"), "b").filter(
        F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * PERCENT)
    same = both.select("a", "b", F.size(F.array_intersect(_tokens("x"), _tokens("y"))).alias("s"),
                       (F.col("nx") + F.col("ny")).alias("n"))
    return same.filter(F.col("s") * 100 >= PERCENT * (F.col("n") - F.col("s"))).select("a", "b")


def _texts(cut: DataFrame, nodes: DataFrame) -> DataFrame:
    """The characters of one line per node, two bytes each, and the size of its shingle set."""
    found = cut.filter("node IS NOT NULL").select("node", "content").join(_few(stored(nodes)), "node")
    return stored(found.groupBy("node").agg(F.first("content").alias("content")).select(
        "node", _units(F.col("content")).alias("units")).withColumn("size", F.size(F.array_distinct(_tokens("units")))))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(members: DataFrame, known: DataFrame) -> DataFrame:
    """The members of the buckets that are in several components, with their components."""
    labelled = members.join(_few(known), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
        "low <> high").select("key")
    return labelled.join(mixed, "key")


def _anchors(members: DataFrame) -> DataFrame:
    """``a`` and ``b``: of each line the smallest line of a bucket, the one it shares most buckets with."""
    shared = members.filter("node <> least").groupBy("node", "least").agg(F.count("*").alias("n"))
    return shared.groupBy(F.col("node").alias("a")).agg(
        F.max_by("least", F.struct("n", F.bitwise_not("least"))).alias("b"))


def _unsettled(mixed: DataFrame, decided: DataFrame) -> DataFrame:
    """Pairs of lines of different components that a bucket holds and that are not among the ``decided`` ones: all of a
    small bucket; of a larger one those of one line of its largest component."""
    known = mixed.filter(F.col("lines") <= SMALL).join(
        decided.withColumnsRenamed({"a": "node", "b": "anchor"}), "node", "left")
    small = known.groupBy("key").agg(F.collect_list(F.struct("node", "component", "anchor")).alias("all"))
    met = small.select("all", F.explode("all").alias("x")).select("x", F.explode(F.filter(
        "all", lambda y: y["component"] != F.col("x.component"))).alias("y")).filter(
        # Of the two orders of a pair one has the larger line first, and only that can have the other for its anchor.
        "x.node > y.node AND NOT x.anchor <=> y.node").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    large = mixed.filter(F.col("lines") > SMALL)
    groups = large.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.min_by("node", F.xxhash64("node", "key")).alias("pivot"))
    top = groups.groupBy("key").agg(
        F.max_by(F.struct("component", "pivot"), F.struct("n", "component")).alias("top"))
    rest = large.join(top, "key").filter("component <> top.component").select(
        F.col("node").alias("a"), F.col("top.pivot").alias("b"))
    return _ordered(met.unionByName(rest))


def _rare_partners(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of lines of different components (``nodes``: node, component) that share one of their rarest shingles.

    Shingles are ordered, those of one component alone first, the others by the number of the lines that have them. A
    set that is similar enough to another shares a shingle among its first ones, all but the required overlap and one
    more. Shingles of one component alone are never shared, so their number bounds the overlap of a pair. Where most lines with a shingle are of one component, those of the others are joined to all, and never those
    of one component to each other.
    """
    known = nodes.join(texts, "node")
    tokens = known.select("node", "component", F.explode(F.array_distinct(_tokens("units"))).alias("token"))
    same = Window.partitionBy("token")
    mixed = stored(tokens.withColumns({
        "lines": F.count("*").over(same), "low": F.min("component").over(same), "high": F.max("component").over(same)})
        .filter("low <> high").select("node", "token", "lines"))
    # Shingles of one component alone take the first places, and only their number counts.
    own = Window.partitionBy("node")
    placed = mixed.select("node", "token", F.count("*").over(own).alias("held"), (
        F.row_number().over(own.orderBy("lines", "token")) - F.count("*").over(own)).alias("behind"))
    first = stored(placed.join(known.select("node", "component", "size"), "node").filter(
        F.col("behind") <= 1 - F.ceil(F.col("size") * PERCENT / 100)).withColumn(
        # The smaller set of a pair has more of its shingles in common, so fewer first ones do.
        "early", F.col("behind") <= 1 - F.ceil(F.col("size") * 2 * PERCENT / (100 + PERCENT))).drop("behind"))
    discard(mixed)
    top = first.groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token").agg(
        F.count("*").alias("groups"), F.max_by("component", F.struct("n", "component")).alias("top")).filter("groups > 1")
    other = first.select("token", F.col("node").alias("b"), F.col("component").alias("other"), F.col("size").alias("nb"),
                         F.col("held").alias("hb"), F.col("early").alias("eb"))
    # Two lines of different components have no more in common than the shingles that either has not for its own alone.
    most = F.least("held", "hb")
    met = first.join(top, "token").filter("component <> top").withColumnRenamed("node", "a").join(other, "token").filter(
        "component <> other AND CASE WHEN size < nb THEN early ELSE eb END").filter(
        most * 100 >= (F.col("size") + F.col("nb") - most) * PERCENT)
    return _ordered(met.select("a", "b"))


def bucket_members(keyed: DataFrame) -> DataFrame:
    """``key``, ``node``, ``lines`` and ``least``, the smallest node: the lines of each bucket that has several, of all
    lines' keys. One exchange; the rows of a key are read in order, not gathered."""
    same = Window.partitionBy("key")
    return keyed.withColumns({"lines": F.count("*").over(same), "least": F.min("node").over(same)}).filter("lines > 1")


def line_components(cut: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the distinct lines that are similar to a different one."""
    members = stored(bucket_members(band_keys(signatures(cut)).select("node", F.explode("keys").alias("key"))))
    texts = _texts(cut, members.select("node").distinct())
    anchors = stored(_anchors(members))
    known = stored(components(stored(_similar(anchors, texts))))
    mixed = stored(_labelled(members, known))
    pairs = stored(_unsettled(mixed, anchors))
    discard(mixed, anchors)
    known = _joined(known, _similar(pairs, texts))
    apart = stored(_labelled(members.filter(F.col("lines") > SMALL), known).select("node", "component").distinct())
    discard(members, pairs)
    if not apart.isEmpty():
        known = _joined(known, _similar(stored(_rare_partners(apart, texts)), texts))
    discard(texts)
    return known


def _joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """The components, stored, that further links make of the known ones."""
    more = stored(links)
    if more.isEmpty():
        return known
    return stored(components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """``row`` and ``dropped``, the numbers of its dropped lines, of the rows that have some: a list no longer than the
    document. Of each group the first line stays."""
    cut = lines(docs)
    grouped = line_components(cut)
    spots = stored(cut.filter("node IS NOT NULL").select("row", "doc_id", "line_no", "node"))
    labelled = spots.join(_few(grouped), "node", "left").select(
        F.coalesce("component", "node").alias("group"), "doc_id", "row", "line_no")
    # Null ids come last.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "line_no")
    first = stored(labelled.groupBy("group").agg(F.min(place).alias("first"), F.count("*").alias("lines")).filter(
        "lines > 1").select("group", F.col("first.row").alias("first_row"), F.col("first.line_no").alias("first_line")))
    gone = labelled.join(_few(first), "group").filter("row <> first_row OR line_no <> first_line")
    return gone.groupBy("row").agg(F.array_sort(F.collect_list("line_no")).alias("dropped"))


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_kept`` and ``dropped_lines`` (line numbers from 0, comma-joined) of every document.

    Lines end at ``\\n``; they are compared in lower case, without leading and trailing blanks. Blank lines are kept.
    Of similar lines, wherever they are, the first one by document id and position stays. A null text has no line; of
    repeated rows one keeps its lines; a null id comes after all others. Other columns are ignored. ``docs`` is read
    more than once and numbers its rows, so it should be a stored table.
    """
    cut = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    ids = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      cut.alias("n_lines"))
    return ids.join(dropped_lines(docs), "row", "left").select(
        "doc_id", "n_lines",
        (F.col("n_lines") - F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped"))).alias("n_kept"),
        F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped_lines"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents, all columns kept, without the dropped lines. A document that had lines with content and loses all
    of them goes; others stay, also null and blank ones. ``n_chars``, where present, follows the text."""
    row, gone = free_name(docs, "row"), free_name(docs, "dropped")
    marks = dropped_lines(docs).select(F.col("row").alias(row), F.col("dropped").alias(gone))
    numbered = docs.withColumn(row, F.monotonically_increasing_id()).join(marks, row, "left")
    kept = F.array_join(F.filter(
        F.split("text", "\n"), lambda line, k: ~F.array_contains(F.col(gone), k)), "\n")
    out = numbered.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept))
    out = out.filter(F.col(gone).isNull() | (F.length(F.trim(F.translate("text", "\n", " "))) > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
