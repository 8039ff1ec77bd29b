"""Shipment anomalies by distance from the median, in units of the median absolute deviation.

Unlike means and deviations, medians do not move with the outliers they are to reveal. Both come from the exact bracket
search, so no column is ever sorted in one task: one search for the medians of all measures, one for the medians of the
distances from them, one for the cut-off of the score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.rounding import half_even
from quayside.operators.anomalies import ANOMALY_COLUMNS, CONTAMINATION, SCORED_COLUMNS, anomaly_reasons, anomaly_severity
from quayside.operators.features import reason_thresholds, shipment_ratios
from quayside.operators.order_statistics import exact_quantiles
from quayside.session import cut_lineage

# Measured inputs; codes of names have no distance.
MEASURES = ("delay_days", "freight_cost_usd", "quantity_shipped", "cost_per_unit", "delay_ratio")
# A deviation of a normal distribution is so many median absolute deviations.
NORMAL = 1.4826


def _measure(name: str) -> Column:
    return F.col(name).cast("double")


def centres_and_spreads(shipments: DataFrame) -> dict[str, tuple[float, float]]:
    """Median, and scaled median distance from it, of each measure that has values. Reads ``shipments`` in some passes."""
    centres = exact_quantiles(shipments, {m: (_measure(m), 0.5) for m in MEASURES})
    known = {m: c for m, c in centres.items() if c is not None}
    if not known:
        return {}
    distances = {m: (F.abs(_measure(m) - F.lit(c)), 0.5) for m, c in known.items()}
    return {m: (known[m], NORMAL * spread) for m, spread in exact_quantiles(shipments, distances).items()}


def robust_score(scales: dict[str, tuple[float, float]]) -> Column:
    """Mean distance over the measures. A measure of which most values are equal has no scale and adds nothing; a missing
    reading counts as the median."""
    total = F.lit(0.0)
    used = 0
    for name in MEASURES:
        centre, spread = scales.get(name, (0.0, 0.0))
        if spread > 0:
            used += 1
            total = total + F.coalesce(F.abs(_measure(name) - F.lit(centre)) / F.lit(spread), F.lit(0.0))
    return half_even(total / F.lit(float(max(used, 1))), 6)


def flag(shipments: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Rows with ``anomaly_label``, ``anomaly_score`` and ``is_anomaly``, as the isolation forest gives them.

    The score is the cut-off less the distance: negative for the ``contamination`` share of rows that lie farthest out.
    Rows at the cut-off itself are normal, so equal rows are always judged alike.
    """
    # The distance follows from five columns of the row, so reading them again costs less than writing all rows anew.
    scored = shipments.withColumn("distance", robust_score(centres_and_spreads(shipments)))
    cut = exact_quantiles(scored, {"distance": (F.col("distance"), 1 - contamination)})["distance"]
    cut = F.lit(cut).cast("double")
    return (
        scored.withColumn("anomaly_label", F.when(F.col("distance") > cut, -1).otherwise(1))
        .withColumn("anomaly_score", half_even(cut - F.col("distance"), 6))
        .withColumn("is_anomaly", F.col("anomaly_label") == -1)
        .drop("distance")
    )


def shipment_anomalies(enriched: DataFrame) -> DataFrame:
    """The anomaly table, with severities and reasons, on stored shipments. The joins behind them run once."""
    flagged = flag(cut_lineage(shipment_ratios(enriched).select(*SCORED_COLUMNS)))
    return anomaly_reasons(anomaly_severity(flagged), reason_thresholds(flagged)).select(*ANOMALY_COLUMNS)
