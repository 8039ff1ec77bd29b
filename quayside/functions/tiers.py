"""Tier labels: right-closed bins with the lowest edge included."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tiers:
    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def of(self, value: Column | str) -> Column:
        return tier_bins(value, self.edges, self.labels)


def tier_bins(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin that holds the value; null when null or outside the outer edges."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    x = F.col(value) if isinstance(value, str) else value
    label = F.when(x < F.lit(float(edges[0])), None)
    for upper, name in zip(edges[1:], labels):
        label = label.when(x <= F.lit(float(upper)), name)
    return label


# Edges and labels of each tier column.
PROBABILITY = Tiers((0, 0.25, 0.5, 0.75, 1), ("LOW", "MEDIUM", "HIGH", "CRITICAL"))
LOGISTICS = PROBABILITY
CURRENCY = Tiers((0, 5, 15, 30, 100), ("LOW", "MEDIUM", "HIGH", "CRITICAL"))
WEATHER_DAY = Tiers((0, 10, 30, 60, 100), ("CLEAR", "WATCH", "WARNING", "SEVERE"))
WEATHER_COUNTRY = Tiers((0, 10, 25, 50, 100), ("LOW", "MEDIUM", "HIGH", "CRITICAL"))
STOCKOUT = Tiers((0, 7, 14, 30, float("inf")), ("CRITICAL", "HIGH", "MEDIUM", "LOW"))
SEVERITY = Tiers((0, 0.4, 0.6, 0.8, 1), ("NORMAL", "WATCH", "WARNING", "CRITICAL"))
