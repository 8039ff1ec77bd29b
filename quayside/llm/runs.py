"""Periodic runs of words, found on a suffix array enhanced by common prefixes.

A word sequence is periodic over a stretch when words ``period`` apart are identical. Every such stretch ends in a
branching square: two equal copies side by side whose next words differ. The copies are suffixes whose common prefix is
exactly the period, so some interval of the suffix array has them on two sides. For each interval the suffixes of the
smaller side look up the place of the suffix one prefix length before and after them; a hit on the other side is a
branching square. Rotating it to the left as long as it stays a square gives the run. Intervals are ranges of the
arrays; no suffix tree is built.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import words

LEAST, COPIES = 6, 4        # a run has at least so many words and repeats its period so often
AT_ONCE = 100_000           # short documents are sorted together up to so many words
_LOOKUPS = 1 << 20          # suffixes looked up in one go

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def numbered(documents: list[list[str]]) -> np.ndarray:
    """One number per word, equal only for equal words of one document, so that no match crosses documents."""
    numbers: list[int] = []
    base = 0
    for sequence in documents:
        known = dict(zip(dict.fromkeys(sequence), count(base)))
        numbers.extend(map(known.__getitem__, sequence))
        base += len(known)
    return np.array(numbers, np.int32)


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, the place of each suffix, and the common prefix of each with the one before it.

    Prefixes of doubling length are ranked; only suffixes that still share a rank are sorted again. The ranks of all
    lengths are kept: where two neighbours part, they tell the length of the common prefix bit by bit.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    common = np.zeros(n, np.int64)
    levels: list[np.ndarray] = []
    slots, keys = np.arange(n), symbols[order].astype(np.int64)
    rank = np.full(n + 1, -1, np.int64)  # the last entry stands for the end of the text
    while len(slots):
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        starts = np.flatnonzero(first)
        group = np.repeat(slots[starts], np.diff([*starts, len(slots)]))
        if levels:
            # Neighbours that shared a rank up to now and part here.
            apart = slots[first & (slots != rank[order[slots]])]
            a, b = order[apart - 1], order[apart]
            shared = np.full(len(apart), 1 << (len(levels) - 1))
            for level in range(len(levels) - 2, -1, -1):
                shared += (levels[level][a + shared] == levels[level][b + shared]) << level
            common[apart] = shared
        rank = rank.copy()
        rank[order[slots]] = group
        levels.append(rank)
        several = np.repeat(np.diff([*starts, len(slots)]) > 1, np.diff([*starts, len(slots)]))
        slots = slots[several]
        here = order[slots]
        ahead = np.minimum(here + (1 << (len(levels) - 1)), n)
        keys = rank[here] * (n + 1) + rank[ahead] + 1
        again = np.argsort(keys, kind="stable")
        order[slots], keys = here[again], keys[again]
    return order, rank[:n], common


def sides(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per slot with a common prefix: the slot, the first slot of its left side and the last of its right side.

    The left side reaches back over prefixes at least as long, the right side to before the next that is not longer,
    so two suffixes lie on the two sides of exactly one slot, whose prefix is their common prefix.
    """
    n = len(common)
    values = common.tolist()
    left, right = [0] * n, [n - 1] * n
    open_slots: list[int] = []
    for slot, value in enumerate(values):
        while open_slots and values[open_slots[-1]] >= value:
            right[open_slots.pop()] = slot - 1
        if value:
            left[slot] = open_slots[-1] if open_slots else last_zero
            open_slots.append(slot)
        else:
            last_zero = slot
    at = np.flatnonzero(common)
    return at, np.array(left)[at], np.array(right)[at]


def branching_squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square that its next word does not continue."""
    order, place, common = suffix_array(symbols)
    at, left, right = sides(common)
    smaller_left = at - left <= right - at + 1
    begin, size = np.where(smaller_left, left, at), np.where(smaller_left, at - left, right - at + 1)
    low, high = np.where(smaller_left, at, left), np.where(smaller_left, right, at - 1)
    period = common[at]
    starts, periods = [], []
    ends = np.cumsum(size)
    cut = 0
    while cut < len(at):
        until = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + _LOOKUPS, "right")))
        part = slice(cut, until)
        owner = np.repeat(np.arange(cut, until), size[part])
        within = np.arange(len(owner)) - np.repeat(ends[part] - size[part] - (ends[cut - 1] if cut else 0), size[part])
        suffix, step = order[begin[owner] + within], period[owner]
        for other, start in ((suffix + step, suffix), (suffix - step, suffix - step)):
            inside = (other >= 0) & (other < len(symbols))
            spot = place[np.where(inside, other, 0)]
            hit = inside & (spot >= low[owner]) & (spot <= high[owner])
            starts.append(start[hit])
            periods.append(step[hit])
        cut = until
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.zeros(0, int), np.zeros(0, int))


def _rotate(symbols: np.ndarray, start: int, period: int) -> int:
    """The first start of a square of this period that rotations to the left reach, by growing blocks."""
    block = 8
    while start > 0:
        low = max(0, start - block)
        different = np.flatnonzero(symbols[low:start] != symbols[low + period:start + period])
        if len(different):
            return low + int(different[-1]) + 1
        start, block = low, 2 * block
    return 0


def runs_of(symbols: np.ndarray, least: int = LEAST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period.

    A run has at least ``least`` words and ``copies`` times its smallest period, and no neighbour extends it.
    """
    start, period = branching_squares(symbols)
    end = start + 2 * period
    # A longer run rotates at least once; most chance squares stop here.
    wanted = np.maximum(least, copies * period)
    back = np.minimum(wanted - 2 * period, 2)
    for k in (1, 2):
        lower = start - k
        fits = (lower >= 0) & (symbols[np.maximum(lower, 0)] == symbols[np.maximum(lower, 0) + period]) | (back < k)
        start, period, end, wanted, back = (x[fits] for x in (start, period, end, wanted, back))
    found: list[tuple[int, int, int]] = []
    known_end = known_start = -1
    for k in np.lexsort((period, end)).tolist():
        e, q = int(end[k]), int(period[k])
        # A square inside a run of a smaller period that ends here too has a multiple of that period.
        if e == known_end and known_start <= e - 2 * q:
            continue
        s = _rotate(symbols, int(start[k]), q)
        if e - s >= wanted[k]:
            found.append((s, e - s, q))
            known_end, known_start = e, s
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(sequence: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that lie in no run after its first period."""
    if not runs:
        return sequence
    depth = np.zeros(len(sequence) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [word for word, covered in zip(sequence, np.cumsum(depth[:-1])) if not covered]


def find_runs(docs: DataFrame, least: int = LEAST, copies: int = COPIES,
              change: Callable[[int, list[str]], list[str]] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``, the kept words.

    Words are the runs of characters that are not ASCII white space, numbered from 0. A null, empty or blank text has
    no words, no runs and the empty text. One row per row of the input, repeated rows and null ids included; other
    columns are ignored. An empty table gives an empty result. ``change`` may replace the words of a document before
    they are searched; it sees documents with an id only.

    No shuffle: a document is searched as a whole in the task that reads it, in memory of about 200 bytes a word.
    """
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out: list[tuple] = []
            group: list[list[str]] = []

            def flush() -> None:
                symbols = numbered(group)
                ends = np.cumsum([len(g) for g in group])
                found: list[list] = [[] for _ in group]
                if len(symbols):
                    for s, length, q in runs_of(symbols, least, copies):
                        which = int(np.searchsorted(ends, s, "right"))
                        found[which].append((s - int(ends[which]) + len(group[which]), length, q))
                out.extend((len(g), f, " ".join(collapse(g, f))) for g, f in zip(group, found))
                group.clear()

            total = 0
            for doc_id, value in zip(ids, batch.column("text")):
                sequence = words(value.as_py() or "")
                if change is not None and doc_id is not None:
                    sequence = change(doc_id, sequence)
                if group and total + len(sequence) > AT_ONCE:
                    flush()
                    total = 0
                group.append(sequence)
                total += len(sequence)
            if group:
                flush()
            sizes, found, texts = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], pa.list_(_RUN)),
                 pa.array(texts, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def run_digest(found: DataFrame) -> DataFrame:
    """The result of ``find_runs`` as numbers and hashes: ``n_runs``, the run of the greatest exact exponent (then the
    smallest start, then period; null without runs) and SHA-256 of all runs and of the kept words."""
    def stronger(a: Column, b: Column) -> Column:
        # length / period compared by cross products, which are exact.
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).otherwise(F.when(a["period"] > b["period"], 1).otherwise(0)))

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
