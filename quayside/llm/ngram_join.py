"""Documents with nearly the same n-gram sets: exact Jaccard links by signature trees, and the groups they form.

Trees compare sets inside blocks, and blocks must be small. With the shingles of all sets in one order, rarest first,
linked sets share a shingle among the first n - ceil(n * percent / 100) + 1 of their n. Those of them that occur in
several sets are a set's keys: a passage that many documents hold is no key where enough else is rarer. Sets that
share a key form a block's candidates; connected candidates are a block. A block whose sets are too many for a task is
cut into tiles, and a task joins a pair of tiles: every tile with the first one, then of the others the sets that share
a key across components.

To order the shingles they are counted: each set's are dealt by hash into parts, a part tells which of its own occur
several times, and only those go back to their sets. Until then they travel as arrays of 32 bits, without ids; two
shingles that are one there make a key too many at worst.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import free_name, partitions_of, stored, words
from quayside.llm.components import components
from quayside.llm.signature_trees import linking_edges
from quayside.session import by_key, discard

WORDS, PERCENT = 3, 90
CHUNK = 1_000_000       # shingles that are dealt at a time
PART_BYTES = 16_000_000     # bytes of text whose shingles make a part, some two million shingles
TILE, TILE_SETS = 1_000_000, 2_000  # shingles and sets that a tile holds, about
BROADCAST_ROWS = 500_000    # at most so many block members (of 32 bytes) are broadcast to the texts

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def _lower(text: str) -> str:
    """Lower-case A-Z alone."""
    return text.lower() if text.isascii() else text.translate(_CASE)


_CASE = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct n-word shingles; of fewer words, the hash of all; without words, none."""
    split = words(_lower(text)) if text else []
    if not split:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    n_used = min(n, len(split))
    code = np.full(len(split) - n_used + 1, n_used, np.uint64)
    for k in range(n_used):
        code = _mix(code + hashed[k:len(split) - n_used + 1 + k])
    return np.unique(code)


_PROFILE = "doc_id long, n_shingles long, fp long"
_DEALT = "chunk long, part long, hashes binary, places binary"


def _deal(chunk: int, sets: dict[int, np.ndarray], parts: int) -> list[tuple]:
    """Rows of ``_DEALT`` for a chunk of sets by fingerprint: the fingerprints and sizes as part -1, then per part the
    lower halves of its shingles and the places of their sets in the chunk."""
    sizes = np.fromiter(map(len, sets.values()), np.uint32, len(sets))
    tokens = np.concatenate(list(sets.values()))
    part = (tokens >> np.uint64(32)) % np.uint64(parts)
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    low = tokens.astype(np.uint32)[order]
    places = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)[order]
    filled, first = np.unique(part[order], return_index=True)
    ends = [*first[1:].tolist(), len(low)]
    return [(chunk, -1, np.fromiter(sets, np.int64, len(sets)).tobytes(), sizes.tobytes())] + [
        (chunk, p, low[i:j].tobytes(), places[i:j].tobytes()) for p, i, j in zip(filled.tolist(), first.tolist(), ends)]


def profiles(docs: DataFrame, n: int, parts: int, *carried: str) -> DataFrame:
    """Per row the size of the shingle set and its fingerprint (null for the empty set), with ``row`` and other long
    columns carried along; between them, with ``part`` not null and nothing else, the rows of the dealt shingles."""
    extra = ["row", *carried]
    schema = ", ".join([*(f"{c} long" for c in extra), _PROFILE, _DEALT])
    own = [*extra, "doc_id", "n_shingles", "fp"]
    types = {c: pa.int64() for c in [*own, "chunk", "part"]} | {"hashes": pa.binary(), "places": pa.binary()}

    def rows(columns: dict) -> pa.RecordBatch:
        length = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([
            columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns.get(c, [None] * length), t)
            for c, t in types.items()], names=list(types))

    def dealt(chunk: int, sets: dict) -> pa.RecordBatch:
        return rows(dict(zip(["chunk", "part", "hashes", "places"], zip(*_deal(chunk, sets, parts)))))

    def run(batches):
        chunk, sets, held = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            size, prints = [], []
            for value in batch.column("text"):
                tokens = shingles(value.as_py(), n)
                size.append(len(tokens))
                prints.append(xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63) if len(tokens) else None)
                if len(tokens) and prints[-1] not in sets:
                    sets[prints[-1]] = tokens
                    held += len(tokens)
                    if held >= CHUNK or len(sets) == 1 << 16:
                        yield dealt(chunk, sets)
                        chunk, sets, held = chunk + 1, {}, 0
            yield rows({c: batch.column(c) for c in [*extra, "doc_id"]} | {"n_shingles": size, "fp": prints})
        if sets:
            yield dealt(chunk, sets)
    return docs.select(*extra, "doc_id", "text").mapInArrow(run, schema)


def _repeated(frame: pd.DataFrame) -> pd.DataFrame:
    """Of a part the shingles that occur several times, with the number of times (at most 65,535), per chunk."""
    low = [np.frombuffer(b, np.uint32) for b in frame["hashes"]]
    ends = np.cumsum([len(x) for x in low])
    low = np.concatenate(low)
    both = np.sort((low.astype(np.uint64) << np.uint64(32)) | np.arange(len(low), dtype=np.uint64))
    value = both >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    length = np.diff(np.append(first, len(low)))
    times = np.empty(len(low), np.uint16)
    times[(both & np.uint64(0xFFFFFFFF)).astype(np.int64)] = np.repeat(np.minimum(length, 65_535), length)
    again = np.flatnonzero(times > 1)
    places = np.concatenate([np.frombuffer(b, np.uint16) for b in frame["places"]])
    cuts = np.searchsorted(again, ends[:-1])
    return pd.DataFrame({"chunk": frame["chunk"], "part": frame["part"]} | {
        name: [x.tobytes() for x in np.split(column[again], cuts)]
        for name, column in (("hashes", low), ("places", places), ("times", times))})


def _first_keys(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """``fp`` and ``keys`` of the sets of a chunk that have keys."""
    head = frame["part"] == -1
    prints = np.frombuffer(frame["hashes"][head].iloc[0], np.int64)
    sizes = np.frombuffer(frame["places"][head].iloc[0], np.uint32).astype(np.int64)
    rest = frame[~head]

    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(rest[name]), kind)
    low, places, times = joined("hashes", np.uint32), joined("places", np.uint16), joined("times", np.uint16)
    part = np.repeat(rest["part"].to_numpy(np.int64), rest["hashes"].map(len).to_numpy(np.int64) // 4)
    key = (part << 32) | low
    # Shingles that occur once are the first of the order and need no key.
    shared = np.bincount(places, minlength=len(sizes))
    left = shared + 1 + -percent * sizes // 100
    order = np.lexsort((key, times, places))
    place = places[order]
    taken = np.arange(len(order)) - (np.cumsum(shared) - shared)[place] < left[place]
    place, key = place[taken], key[order][taken]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return pd.DataFrame({"fp": prints[place[first]], "keys": pd.Series(np.split(key, first)[1:], dtype=object)})


def set_keys(dealt: DataFrame, percent: int) -> DataFrame:
    """``fp`` and ``keys`` of the sets whose rarest shingles some other set may have, from the dealt shingles."""
    counted = by_key(dealt.filter("part >= 0"), "part").groupBy("part").applyInPandas(_repeated, f"{_DEALT}, times binary")
    whole = dealt.filter("part = -1").withColumn("times", F.lit(None).cast("binary")).unionByName(
        counted.filter("octet_length(hashes) > 0"))
    return by_key(whole, "chunk").groupBy("chunk").applyInPandas(
        lambda frame: _first_keys(frame, percent), "fp long, keys array<long>")


def shared_keys(sets: DataFrame) -> DataFrame:
    """``key``, ``fp`` and ``first`` (the smallest ``fp`` of the key) of the keys that several sets share."""
    # One exchange of the keys, by far the largest table here; the rows of a key are read in order, not gathered.
    same = Window.partitionBy("key")
    keyed = sets.select(F.explode("keys").alias("key"), "fp").withColumns(
        {"first": F.min("fp").over(same), "last": F.max("fp").over(same)})
    return keyed.filter("first <> last").select("key", "fp", "first").distinct()


def _blocks(keys: DataFrame) -> DataFrame:
    return components(keys.filter("fp <> first").select(F.col("fp").alias("a"), F.col("first").alias("b"))).select(
        F.col("node").alias("fp"), F.col("component").alias("block"))


def candidate_blocks(sets: DataFrame) -> DataFrame:
    """``fp`` and ``block`` of every set that shares a key with a different one."""
    return _blocks(shared_keys(sets))


def _meetings(placed: DataFrame, keys: DataFrame) -> DataFrame:
    """``fp`` and ``others``, the further tiles beyond tile 0 that hold a set of a different component with one of its
    keys, of the sets (``placed``: fp, tile, component) that have any."""
    at = keys.select("key", "fp").join(placed.filter("tile > 0"), "fp")
    spans = at.groupBy("key", F.col("tile").alias("other")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"))
    # Per key and tile one row, however many sets are there.
    met = at.join(spans, "key").filter("tile <> other AND (low <> component OR high <> component)")
    return met.groupBy("fp").agg(F.collect_set("other").alias("others"))


def _tile_edges(members: DataFrame, pairs, n: int, percent: int) -> DataFrame:
    """``a`` - ``b`` links between sets of the same block, for the tile pairs that the column ``pairs`` lists for each
    member as structs of ``i`` and ``j``."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("fp")
        sets = [np.frombuffer(t, np.uint64) for t in frame["tokens"]]
        # Similar sets next to each other: by size, then by the least hashes.
        order = sorted(range(len(sets)), key=lambda k: (len(sets[k]), sets[k][:4].tolist()))
        prints, known = frame["fp"].to_numpy()[order], frame["component"].to_numpy()[order]
        edges = linking_edges([sets[k] for k in order], percent, known)
        a, b = zip(*edges) if edges else ((), ())
        return pd.DataFrame({"a": prints[list(a)], "b": prints[list(b)]}, dtype="int64")

    dealt = members.select("block", "fp", "tokens", "component", F.explode(pairs).alias("p"))
    return dealt.select("block", "p.i", "p.j", "fp", "tokens", "component").groupBy("block", "i", "j").applyInPandas(
        run, "a long, b long")


def keyed_sets(docs: DataFrame, n: int, percent: int, *carried: str) -> tuple[DataFrame, DataFrame]:
    """The stored profiles, and the stored keys that several sets share."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(partitions_of(docs.sparkSession), -(-size // PART_BYTES))
    both = stored(profiles(docs, n, parts, *carried))
    shared = stored(shared_keys(set_keys(both.filter("part IS NOT NULL").select("chunk", "part", "hashes", "places"),
                                         percent)))
    sets = stored(both.filter("part IS NULL").drop("chunk", "part", "hashes", "places"))
    discard(both)
    return sets, shared


def link_sets(docs: DataFrame, sets: DataFrame, keys: DataFrame, n: int, percent: int) -> DataFrame:
    """``node`` (fingerprint) and ``component`` of the sets that are linked with a different set."""
    chosen = sets.filter("fp IS NOT NULL").groupBy("fp").agg(
        F.min("row").alias("row"), F.first("n_shingles").alias("n_shingles")).join(stored(_blocks(keys)), "fp")
    sizes = chosen.groupBy("block").agg(F.ceil(F.sum("n_shingles") / TILE).cast("int").alias("tiles"))
    placed = stored(chosen.join(sizes, "block").select(
        "row", "fp", "block", "tiles", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("tile")))

    @F.pandas_udf("binary")
    def tokens(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingles(t, n).tobytes())

    few = placed.count() <= BROADCAST_ROWS
    texts = docs.join(F.broadcast(placed) if few else placed, "row")
    members = stored(texts.withColumn("tokens", tokens("text")).drop("text", "doc_id"))

    # First every tile with the block's tile 0, which connects most of a block of close copies. A task joins all sets it
    # is given, so also those of one tile.
    fresh = members.withColumn("component", F.col("fp"))
    first = F.array_distinct(F.transform(
        F.when(F.col("tile") == 0, F.sequence(F.least(F.lit(1), F.col("tiles") - 1), F.col("tiles") - 1))
        .otherwise(F.array(F.lit(0))),
        lambda o: F.struct(F.least(F.col("tile"), o).alias("i"), F.greatest(F.col("tile"), o).alias("j"))))
    edges = stored(_tile_edges(fresh, first, n, percent))
    if placed.filter("tiles > 2").isEmpty():
        discard(members)
        return components(edges)
    # Then, in blocks that are not one component yet, the remaining tile pairs. Linked sets share a key, so a set goes
    # only where one of a different component has one of its keys.
    known = components(edges)
    labelled = placed.filter("tiles > 2").join(known.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    meeting = stored(labelled.join(_meetings(labelled.select("fp", "tile", "component"), keys), "fp").select(
        "fp", "component", "others"))
    rest = F.transform("others", lambda o: F.struct(F.least("tile", o).alias("i"), F.greatest("tile", o).alias("j")))
    more = stored(_tile_edges(members.join(meeting, "fp"), rest, n, percent))
    discard(members)
    return components(edges.unionByName(more))


def ngram_join(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document.

    A document's set holds the distinct shingles of ``n`` words (A-Z lower-cased); with fewer words, all words as one;
    without words or text it is empty and linked with nothing. Two documents link when 100 * intersection >= percent *
    union; ``component_id`` is the smallest id reachable by links, the own id included.

    Repeated rows and equal sets belong together. Null ids take part in links, but name a component only if it has no
    other id (then null). Other columns are ignored; an empty table gives an empty result. Sets are compared by 64-bit
    hashes of their shingles.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "row", F.xxhash64("doc_id", "text"))
    sets, keys = keyed_sets(rows, n, percent)
    linked = stored(link_sets(rows, sets, keys, n, percent))
    firsts = sets.filter("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    members = linked.join(firsts, F.col("node") == F.col("fp"))
    names = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = linked.join(names, "component").select(F.col("node").alias("fp"), "component_id")
    return sets.select("doc_id", "n_shingles", "fp").join(firsts.join(named, "fp", "left"), "fp", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.coalesce("component_id", "first_id"))
        .alias("component_id"))


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns kept, of which each group of linked ones keeps the one with the smallest id.

    A group is linked by sets of ``n``-word shingles with the similarity of ``percent``. Documents without words stay.
    Of repeated rows, equal in id and text, one stays. ``docs`` is read more than once and numbers its rows, so it
    should be a stored table.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("number"), F.col("doc_id").cast("long").alias("doc_id"),
                       "text").withColumn("row", F.xxhash64("doc_id", "text"))
    sets, keys = keyed_sets(rows, n, percent, "number")
    linked = stored(link_sets(rows.drop("number"), sets, keys, n, percent))
    grouped = sets.filter("fp IS NOT NULL").join(linked, F.col("node") == F.col("fp"), "left").select(
        F.coalesce("component", "fp").alias("group"), "doc_id", "number")
    # Null ids come last.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "number")
    best = grouped.groupBy("group").agg(F.min(place).alias("best"))
    name = free_name(docs, "number")
    kept = best.select(F.col("best.number").alias(name)).unionByName(
        sets.filter("fp IS NULL").select(F.col("number").alias(name)))
    return docs.withColumn(name, F.monotonically_increasing_id()).join(kept, name, "left_semi").select(*docs.columns)
