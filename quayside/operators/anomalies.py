"""Shipment anomalies by isolation forest (Liu et al. 2008)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from math import ceil, comb, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import tiers
from quayside.functions.rounding import half_away, half_even
from quayside.operators.features import (
    SHIPMENT_FEATURES, reason_flags, reason_thresholds, shipment_codes, shipment_dictionaries, shipment_ratios,
)
from quayside.operators.order_statistics import exact_quantiles
from quayside.session import by_key, cut_lineage

# Forest settings.
TREES, SAMPLE, CONTAMINATION, SEED = 200, 256, 0.05, 42

ANOMALY_COLUMNS = (
    "shipment_id", "supplier_id", "sku", "origin_country", "destination_warehouse", "carrier", "delay_days",
    "freight_cost_usd", "cost_per_unit", "delay_ratio", "status", "is_disrupted", "is_anomaly", "anomaly_score",
    "anomaly_severity", "severity_tier", "anomaly_reasons",
)
# What the scores, the reasons and the anomaly table read.
SCORED_COLUMNS = (
    "shipment_id", "supplier_id", "sku", "origin_country", "destination_warehouse", "quantity_shipped", "delay_days",
    "freight_cost_usd", "carrier", "is_disrupted", "status", "reliability_score", "supplier_lead_time",
    "supplier_risk_level", "cost_per_unit", "delay_ratio",
)
_NODE_SCHEMA = "tree int, node int, feature int, threshold double, child int, length double"
_CHUNK = 5_000
# Parts of a node's word.
_FIELD_BITS = 20
_FIELD = (1 << _FIELD_BITS) - 1
# Rows up to which they are dealt out anew. More come in enough partitions, and dealing them would cost an exchange and
# a sort of the whole table.
DEALT_ROWS = 2_000_000


def expected_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 12) / float(2**52)


def draw_samples(numbered: DataFrame, rows: int, trees: int, sample: int, seed: int) -> DataFrame:
    """About ``trees * sample`` rows, each with the tree it belongs to, at most ``sample`` per tree.

    Draws hash the row's own number, not its key, so repeated keys are drawn independently. The number of trees that
    draw a row is binomial; one hash against the distribution tells it, and most rows of a large input are drawn by
    none. A drawn row joins so many distinct trees, those with the smallest hashes. A little more than wanted is
    drawn, then cut to size inside the (small) tree groups.
    """
    share = min(1.0, 1.4 * sample / max(rows, 1))
    chances = np.array([comb(trees, k) * share**k * (1 - share) ** (trees - k) for k in range(trees)])
    below = [min(1.0, float(c)) for c in np.cumsum(chances)]  # below[k]: at most k trees draw the row
    unit = _unit(F.col("row_number"), F.lit(seed))
    drawn = numbered.withColumn("_unit", unit).filter(F.col("_unit") >= below[0]) if share < 1 else \
        numbered.withColumn("_unit", F.lit(1.0))
    many = F.size(F.filter(F.array(*map(F.lit, below)), lambda c: c <= F.col("_unit")))
    ordered = F.sort_array(F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(F.xxhash64(F.col("row_number"), t, F.lit(seed + 1)).alias("h"), t.alias("tree"))))
    drawn = drawn.withColumn("tree", F.explode(F.slice(ordered, 1, many)["tree"])).drop("_unit")
    order = Window.partitionBy("tree").orderBy(F.xxhash64("row_number", "tree", F.lit(seed + 2)), "row_number")
    picked = by_key(drawn, "tree").withColumn("_pick", F.row_number().over(order))
    return picked.filter(F.col("_pick") <= sample).drop("_pick")


def _grow_tree(points: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, threshold, left child, length); the right child follows the left. A leaf has
    feature -1 and is its own child."""
    nodes: list[tuple] = []
    todo = [(0, points, 0)]
    spare = 1
    while todo:
        number, here, depth = todo.pop()
        low, high = here.min(axis=0), here.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(here) <= 1 or len(varying) == 0:
            nodes.append((number, -1, 0.0, number, depth + expected_path(len(here))))
            continue
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = here[:, feature] <= cut
        nodes.append((number, feature, cut, spare, 0.0))
        todo += [(spare, here[goes_left], depth + 1), (spare + 1, here[~goes_left], depth + 1)]
        spare += 2
    return nodes


def grow_forest(samples: DataFrame, sample: int, seed: int) -> DataFrame:
    """Node table of one tree per sample group, trees in parallel."""
    limit = ceil(log2(max(sample, 2)))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        # Row order after a shuffle is arbitrary; sorting makes a tree depend on its sample only.
        points = rows.sort_values("row_number")[list(SHIPMENT_FEATURES)].to_numpy(dtype=float)
        nodes = _grow_tree(points, limit, np.random.default_rng([seed, tree]))
        frame = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "child", "length"])
        return frame.assign(tree=tree)[["tree", "node", "feature", "threshold", "child", "length"]]

    return samples.select("tree", "row_number", *SHIPMENT_FEATURES).groupBy("tree").applyInPandas(
        grow, _NODE_SCHEMA)


def pack_forest(nodes: Iterable) -> dict[str, np.ndarray]:
    """Node rows as arrays indexed by (tree, node). The children of a node are neighbours, so one index serves
    both; a leaf sends every row to itself."""
    nodes = list(nodes)
    position = {tree: i for i, tree in enumerate(sorted({n["tree"] for n in nodes}))}
    shape = (len(position), max(n["node"] for n in nodes) + 1)
    packed = {"feature": np.zeros(shape, dtype=np.int64), "threshold": np.full(shape, np.inf),
              "child": np.zeros(shape, dtype=np.int64), "length": np.zeros(shape)}
    for n in nodes:
        at = position[n["tree"]], n["node"]
        packed["child"][at] = n["child"]
        if n["feature"] >= 0:
            packed["feature"][at], packed["threshold"][at] = n["feature"], n["threshold"]
        else:
            packed["length"][at] = n["length"]
    return packed


def _node_words(forest: dict[str, np.ndarray], features: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The thresholds of each feature in order, and one word per node: its child, then the complement of its threshold's
    place among them. A value exceeds the threshold if more thresholds than its place tells lie below the value, so
    adding that number carries into the child just then, which gives the right one of the two."""
    inner = np.isfinite(forest["threshold"])
    known = [np.unique(forest["threshold"][inner & (forest["feature"] == f)]) for f in range(features)]
    if max(map(len, known)) > _FIELD:
        raise ValueError("too many thresholds of a feature")
    place = np.full(inner.shape, _FIELD, dtype=np.int64)  # a leaf sends no row to the right
    for f, values in enumerate(known):
        here = inner & (forest["feature"] == f)
        place[here] = np.searchsorted(values, forest["threshold"][here])
    return known, (forest["child"] << 2 * _FIELD_BITS) | (_FIELD - place) << _FIELD_BITS


def isolation_scores(x: np.ndarray, forest: dict[str, np.ndarray], sample: int) -> np.ndarray:
    """Negated anomaly score per row, in [-1, 0): the shorter the paths, the lower."""
    trees = len(forest["feature"])
    levels = ceil(log2(max(sample, 2)))
    known, words = _node_words(forest, x.shape[1])
    scores = np.empty(len(x))
    for begin in range(0, len(x), _CHUNK):
        rows = x[begin:begin + _CHUNK]
        n = len(rows)
        below = np.empty((len(known), n), dtype=np.int64)
        for f, values in enumerate(known):
            below[f] = np.where(np.isnan(rows[:, f]), 0, np.searchsorted(values, rows[:, f]))
        below = (below << _FIELD_BITS).ravel()
        # The lowest part of a word tells where the values of the node's feature begin. The steps share their arrays, and
        # clipping spares the check of indexes that are never out of bounds.
        nodes, row, depth, length = words | forest["feature"] * n, np.arange(n), np.zeros(n), np.empty(n)
        at, node, place, value = (np.empty(n, dtype=np.int64) for _ in range(4))
        for t in range(trees):
            at[:] = 0
            for _ in range(levels):
                np.take(nodes[t], at, out=node, mode="clip")
                np.bitwise_and(node, _FIELD, out=place)
                np.add(place, row, out=place)
                np.take(below, place, out=value, mode="clip")
                np.add(node, value, out=node)
                np.right_shift(node, 2 * _FIELD_BITS, out=at)
            np.take(forest["length"][t], at, out=length, mode="clip")
            depth += length
        scores[begin:begin + _CHUNK] = -np.power(2.0, -(depth / trees) / max(expected_path(sample), 1e-12))
    return scores


def number_rows(df: DataFrame, deal: bool = True) -> DataFrame:
    """Write the rows once, each with a number. Sampling, scoring and encoding read them in separate passes,
    and a number stays with its row only while nothing recomputes it. A small table is dealt out first, since it may
    come in a single partition."""
    if deal:
        df = df.repartition(df.sparkSession.sparkContext.defaultParallelism * 2)
    return cut_lineage(df.withColumn("row_number", F.monotonically_increasing_id()))


def isolation_forest(numbered: DataFrame, code: Callable[[DataFrame], DataFrame] = lambda rows: rows,
                     trees: int = TREES, sample: int = SAMPLE, contamination: float = CONTAMINATION,
                     seed: int = SEED) -> DataFrame:
    """Rows of ``number_rows`` with ``anomaly_label``, ``anomaly_score`` and ``is_anomaly``.

    ``code`` adds the features that ``numbered`` lacks. Rows are counted and drawn without them; the drawn sample is
    coded, and all rows once, in the pass that scores them. The scores are written, since the exact cut-off takes
    several passes. What reaches the driver is the node table, whose size depends on the settings only.
    """
    columns = [c for c in numbered.columns if c != "row_number"]
    rows = numbered.count()
    if rows == 0:
        return numbered.select(
            *columns, F.lit(1).alias("anomaly_label"), F.lit(0.0).alias("anomaly_score"),
            F.lit(False).alias("is_anomaly"))
    sample = min(sample, rows)
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SHIPMENT_FEATURES]
    drawn = code(draw_samples(numbered, rows, trees, sample, seed)).select(
        "tree", "row_number", *[v.alias(c) for v, c in zip(inputs, SHIPMENT_FEATURES)])
    nodes = grow_forest(by_key(drawn, "tree"), sample, seed).collect()  # trees x 2 x sample
    forest = numbered.sparkSession.sparkContext.broadcast(pack_forest(nodes))

    @F.pandas_udf(T.DoubleType())
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(isolation_scores(x, forest.value, sample))

    scored = cut_lineage(code(numbered).select(*columns, score(*inputs).alias("raw_score")))
    cut = exact_quantiles(scored, {"raw": (F.col("raw_score"), contamination)})["raw"]
    return (
        scored.withColumn("anomaly_label", F.when(F.col("raw_score") - F.lit(cut) < 0, -1).otherwise(1))
        .withColumn("anomaly_score", half_even(F.col("raw_score") - F.lit(cut), 6))
        .withColumn("is_anomaly", F.col("anomaly_label") == -1)
        .drop("raw_score")
    )


def anomaly_severity(flagged: DataFrame) -> DataFrame:
    """Score scaled to 0..1 with 1 the most anomalous, and its tier. Equal scores count as 0."""
    ends = flagged.agg(F.min("anomaly_score").alias("low"), F.max("anomaly_score").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    scaled = F.coalesce(1 - (F.col("anomaly_score") - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))
    return flagged.withColumn("anomaly_severity", half_even(scaled, 4)).withColumn(
        "severity_tier", tiers.SEVERITY.of("anomaly_severity"))


def anomaly_reasons(severe: DataFrame, thresholds: dict[str, float | None]) -> DataFrame:
    """Reasons on the same row, so repeated shipment ids cannot multiply."""
    return severe.withColumn(
        "anomaly_reasons", F.when(F.col("is_anomaly"), reason_flags(thresholds)).otherwise("NORMAL"))


def shipment_anomalies(enriched: DataFrame, rows: int) -> DataFrame:
    """The anomaly table of about so many rows, on stored scores. The joins behind the enriched shipments run once, the
    codes are joined once."""
    ratios = shipment_ratios(enriched)
    deal = rows <= DEALT_ROWS
    numbered = number_rows(ratios if deal else ratios.select(*SCORED_COLUMNS), deal)
    books = shipment_dictionaries(numbered, stored=True)
    flagged = isolation_forest(numbered, lambda rows: shipment_codes(rows, books))
    return anomaly_reasons(anomaly_severity(flagged), reason_thresholds(flagged)).select(*ANOMALY_COLUMNS)


# -- reports on the stored anomalies --------------------------------------------------

def severity_summary(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("severity_tier").agg(
            F.count("*").alias("shipment_count"), half_away(F.avg("delay_days"), 1).alias("avg_delay_days"),
            half_away(F.avg("freight_cost_usd"), 0).alias("avg_freight_cost"),
        ).orderBy(F.desc("avg_delay_days"), "severity_tier")
    )


def reason_breakdown(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter("is_anomaly").groupBy("anomaly_reasons").agg(F.count("*").alias("count")).orderBy(
        F.desc("count"), "anomaly_reasons")


def anomaly_rate(anomalies: DataFrame) -> DataFrame:
    share = F.count_if("is_anomaly") * 100.0 / F.nullif(F.count("*"), F.lit(0))
    return anomalies.agg(
        F.count_if("is_anomaly").alias("anomalies"), half_even(share, 1).alias("anomaly_pct"))


def top_anomalies(anomalies: DataFrame, rows: int) -> DataFrame:
    return anomalies.filter("is_anomaly").orderBy(F.desc("anomaly_severity"), "shipment_id").limit(rows)


def top10_anomalies(anomalies: DataFrame) -> DataFrame:
    return top_anomalies(anomalies, 10).select(
        "shipment_id", "supplier_id", "origin_country", "carrier", "delay_days", "severity_tier",
        "anomaly_reasons")


def top15_anomalies(anomalies: DataFrame) -> DataFrame:
    return top_anomalies(anomalies, 15).select(
        "shipment_id", "supplier_id", "origin_country", "carrier", "delay_days", "severity_tier",
        "anomaly_severity", "anomaly_reasons")


def kpi_anomalies(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(
        F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(F.col("severity_tier") == "CRITICAL").alias("critical_anomalies"),
        half_even(F.avg(F.when(F.col("is_anomaly"), F.col("anomaly_severity"))), 3).alias("avg_severity"),
    )
