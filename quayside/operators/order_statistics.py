"""Exact quantiles of columns too large to sort in one place.

The built-in ``percentile`` keeps every distinct value of a group in one task.
Here each pass counts the values of a bracket in equal-width buckets, keeps the
bucket that holds the wanted rank and narrows the bracket to the values seen in
it. A pass returns at most ``BUCKETS`` rows per rank, whatever the row count,
and a bracket shrinks by about that factor, so a few passes settle any column.
Equal values never need splitting: a bucket with one distinct value is final.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from math import floor, isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 2048


@dataclass
class _Rank:
    """Search state: the wanted 0-based rank lies among the values in [low, high], ``below`` values precede them."""

    series: str
    rank: int
    low: float
    high: float
    below: int = 0

    @property
    def done(self) -> bool:
        return self.low == self.high


def column_ranges(df: DataFrame, series: Mapping[str, Column]) -> dict[str, tuple[int, float, float]]:
    """Count of non-null values, minimum and maximum of each series, in one pass."""
    row = df.agg(*[
        agg.alias(f"{name}__{part}")
        for name, value in series.items()
        for part, agg in (("n", F.count(value)), ("low", F.min(value)), ("high", F.max(value)))
    ]).first()
    return {name: (row[f"{name}__n"], row[f"{name}__low"], row[f"{name}__high"]) for name in series}


def values_at_ranks(df: DataFrame, series: Mapping[str, Column], ranks: Mapping[str, set[int]],
                    ranges: Mapping[str, tuple[int, float, float]]) -> dict[tuple[str, int], float]:
    """The value at each 0-based rank of each series. Values are compared as doubles."""
    for name in ranks:
        if not isfinite(float(ranges[name][2]) - float(ranges[name][1])):
            raise ValueError(f"{name} is not finite")
    searches = [_Rank(name, rank, float(ranges[name][1]), float(ranges[name][2]))
                for name, wanted in ranks.items() for rank in sorted(wanted)]
    while any(not s.done for s in searches):
        # Ranks that still share a bracket are counted once.
        open_brackets = sorted({(s.series, s.low, s.high) for s in searches if not s.done})
        number = {bracket: i for i, bracket in enumerate(open_brackets)}
        # A read of one column per bracket costs far less than a row with an array of all brackets.
        in_bracket = []
        for (name, low, high), i in number.items():
            bucket = F.least(F.floor((F.col("x") - low) / (high - low) * BUCKETS), F.lit(BUCKETS - 1))
            in_bracket.append(df.select(series[name].cast("double").alias("x")).filter(F.col("x").between(low, high)).select(
                F.lit(i).alias("bracket"), bucket.alias("bucket"), "x"))
        counted = (
            reduce(DataFrame.unionAll, in_bracket).groupBy("bracket", "bucket")
            .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .collect()  # bounded: one row per bracket and bucket
        )
        histogram: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r["bracket"], r["bucket"])):
            histogram.setdefault(row["bracket"], []).append(row)
        for s in searches:
            if s.done:
                continue
            for row in histogram[number[(s.series, s.low, s.high)]]:
                if s.rank < s.below + row["n"]:
                    s.low, s.high = row["low"], row["high"]
                    break
                s.below += row["n"]
    return {(s.series, s.rank): s.low for s in searches}


def exact_quantiles(df: DataFrame, targets: Mapping[str, tuple[Column, float]]) -> dict[str, float | None]:
    """Linear-interpolated quantile of each target ``name -> (column, q)``; null without values.

    Several passes read ``df``, each once per target; cut its lineage or persist it first where it is costly.
    """
    series = {name: column for name, (column, _) in targets.items()}
    ranges = column_ranges(df, series)
    positions = {name: q * (ranges[name][0] - 1) for name, (_, q) in targets.items() if ranges[name][0]}
    ranks = {name: {floor(p), min(floor(p) + 1, ranges[name][0] - 1)} for name, p in positions.items()}
    found = values_at_ranks(df, series, ranks, ranges)
    result: dict[str, float | None] = {name: None for name in targets}
    for name, position in positions.items():
        k = floor(position)
        lower = found[(name, k)]
        upper = found[(name, min(k + 1, ranges[name][0] - 1))]
        result[name] = lower + (upper - lower) * (position - k)
    return result
