"""Packing token sequences: sum-of-squares best fit.

A piece goes where the squared counts of open sequences per remaining gap then sum to the least: into an open sequence
with some gap, or into a new one. Every group of pieces is packed by one task, longest pieces first; groups have a
fixed size, so their number grows with the input. Sequences that a group leaves with a large gap are packed again as
whole pieces, in ever fewer groups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import bpe
from quayside.llm.common import stored

CAPACITY = 4096
END_ID = 1
GROUP = 8_000           # pieces of a group
ROUNDS = 3
OPEN_GAP = CAPACITY // 64   # a sequence with a larger gap takes part in the next round

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The documents' token ids, an end id behind each, cut only where longer than ``capacity``: all pieces but the last
    are full. With ids hashed as little-endian 32-bit numbers."""
    end = np.array([END_ID], "<u4")

    def run(batches):
        tokenizer = bpe.load(path)
        names = [c.split()[0] for c in _PIECES.split(", ")]
        for batch in batches:
            rows, crc = [], []
            doc_ids = batch.column("doc_id")
            owner: list[int] = []
            for k, value in enumerate(batch.column("text")):
                ids = np.concatenate([tokenizer.encode(value.as_py() or ""), end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    owner.append(k)
                    rows.append((piece, start, len(part)))
                    crc.append(zlib.crc32(part.tobytes()))
            piece, start, length = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces in the given order, the sequence (from 0) and the offset of each."""
    count = np.zeros(capacity + 1, np.int64)     # open sequences by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    gap_of: list[int] = []
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, size in enumerate(lengths.tolist()):
        # Moving a sequence from gap g to g - size changes the sum by 2 (count[g - size] - count[g]) + 2; a full one
        # leaves the sum, and a new one only enters it.
        after = count[:capacity - size + 1].copy()
        change = 2 * (after - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change[count[size:] == 0] = np.iinfo(np.int64).max
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        best = int(change.argmin())                # the first: of equal ones, the tightest fit
        if change[best] <= fresh:
            number = waiting[best + size].pop()
            count[best + size] -= 1
        else:
            number, best = len(gap_of), capacity - size
            gap_of.append(capacity)
        sequence[k], offset[k] = number, capacity - (best + size)
        gap_of[number] = best
        if best:
            count[best] += 1
            waiting[best].append(number)
    return sequence, offset


def _pack_groups(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """``item``, ``sequence`` and ``offset``: each group packed by itself. ``items`` has ``item`` and ``length``."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "item"], ascending=[False, True], kind="stable")
        sequence, offset = sum_of_squares(frame["length"].to_numpy(), capacity)
        # A sequence is named after its first item, so names are unique and the same in a repeated task.
        first = frame["item"].to_numpy()[np.unique(sequence, return_index=True)[1]]
        return pd.DataFrame({"item": frame["item"], "sequence": first[sequence], "offset": offset})

    group = F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int").alias("g")
    return items.select("item", "length", group).groupBy("g").applyInPandas(
        run, "item long, sequence long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, group: int = GROUP) -> DataFrame:
    """Every piece of every document with its place: ``sequence_id`` and the gapless ``offset`` in it.

    A null or empty text is the end id alone. Repeated rows and null ids are packed as rows of their own; other columns
    are ignored; an empty table gives an empty result. Only pieces of documents longer than ``capacity`` are cut.
    """
    cut = stored(pieces(docs, capacity, path).withColumn("item", F.monotonically_increasing_id()))
    loose = cut.filter(F.col("length") < capacity).select("item", "length")
    placed = cut.filter(F.col("length") == capacity).select(
        "item", F.col("item").alias("sequence"), F.lit(0).cast("long").alias("offset"))
    for round_ in range(ROUNDS):
        groups = max(1, -(-loose.count() // group))
        packed = stored(_pack_groups(loose, groups, capacity))
        if round_ == 0:
            placed = placed.unionByName(packed)
        else:  # a sequence that was packed again moved as a whole
            moved = packed.select(F.col("item").alias("sequence"), F.col("sequence").alias("to"),
                                  F.col("offset").alias("by"))
            placed = placed.join(moved, "sequence", "left").select(
                "item", F.coalesce("to", "sequence").alias("sequence"),
                (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"))
        if groups == 1:
            break
        fill = packed.join(loose, "item").groupBy("sequence").agg(F.sum("length").alias("length"))
        loose = stored(fill.filter(F.col("length") < capacity - OPEN_GAP).select(
            F.col("sequence").alias("item"), "length"))
    return cut.join(placed, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), "offset")
