"""A linear supplier score with exact Shapley values.

A diagonal linear discriminant: each input is weighed by the distance of its class means over its variance within the
classes. The log odds are the weighted distances from the midpoints of the means, plus the log odds of the classes. All
it needs are counts, means and variances, which one aggregate gathers.

Where a score is linear, the Shapley value of an input is its weight times its distance from the mean over all
suppliers, in every order the inputs may become known in (Strumbelj and Kononenko 2014). Values add up to the log odds
less those of the mean supplier.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import tiers
from quayside.functions.rounding import half_even
from quayside.operators.features import SUPPLIER_FEATURES
from quayside.operators.risk_model import SCORE_COLUMNS


@dataclass(frozen=True)
class LinearModel:
    """``weights`` and ``means`` over all suppliers, per input in order; ``base``, the log odds of the mean supplier."""

    weights: tuple[float, ...]
    means: tuple[float, ...]
    base: float

    @property
    def log_odds(self) -> Column:
        total = F.lit(self.base)
        for name, weight, mean in zip(SUPPLIER_FEATURES, self.weights, self.means):
            total = total + _effect(name, weight, mean)
        return total


def _effect(name: str, weight: float, mean: float) -> Column:
    """What an input adds to the log odds. A missing reading counts as the mean one."""
    return F.coalesce((F.col(name).cast("double") - F.lit(mean)) * F.lit(weight), F.lit(0.0))


def train(matrix: DataFrame) -> LinearModel:
    """Fit on ``SUPPLIER_FEATURES`` and ``target``, in one aggregate whose result is a single row.

    An input that never varies within the classes has weight zero. With one class only all weights are zero and the log
    odds are infinite.
    """
    sums = [F.count_if(F.col("target") == c).alias(f"n{c}") for c in (0, 1)]
    for i, name in enumerate(SUPPLIER_FEATURES):
        x = F.col(name).cast("double")
        sums.append(F.avg(x).alias(f"mean_{i}"))
        for c in (0, 1):
            of_class = F.when(F.col("target") == c, x)
            sums += [F.avg(of_class).alias(f"mean{c}_{i}"), F.var_pop(of_class).alias(f"var{c}_{i}"),
                     F.count(of_class).alias(f"n{c}_{i}")]
    row = matrix.agg(*sums).first()
    inputs = range(len(SUPPLIER_FEATURES))
    means = tuple(row[f"mean_{i}"] or 0.0 for i in inputs)
    if not row["n0"] or not row["n1"]:
        return LinearModel((0.0,) * len(means), means, float("inf") if row["n1"] else float("-inf"))
    weights, base = [], log(row["n1"] / row["n0"])
    for i in inputs:
        n0, n1 = row[f"n0_{i}"], row[f"n1_{i}"]
        within = (n0 * row[f"var0_{i}"] + n1 * row[f"var1_{i}"]) / (n0 + n1) if n0 and n1 else 0.0
        weight = (row[f"mean1_{i}"] - row[f"mean0_{i}"]) / within if within > 0 else 0.0
        weights.append(weight)
        if weight:
            base += weight * (means[i] - (row[f"mean0_{i}"] + row[f"mean1_{i}"]) / 2)
    return LinearModel(tuple(weights), means, base)


def predict(model: LinearModel, matrix: DataFrame) -> DataFrame:
    """Unrounded ``probability_high`` and the predicted class."""
    chance = 1 / (1 + F.exp(-model.log_odds))
    return matrix.withColumn("probability_high", chance).withColumn(
        "predicted_risk", (F.col("probability_high") > 0.5).cast("int"))


def risk_scores(model: LinearModel, matrix: DataFrame, run_ts: str) -> DataFrame:
    """The score table, as the boosted model's."""
    scored = predict(model, matrix).withColumn("risk_probability", half_even("probability_high", 4))
    return scored.withColumn("risk_tier", tiers.PROBABILITY.of("risk_probability")).select(
        *SCORE_COLUMNS, F.lit(run_ts).cast("timestamp").alias("predicted_at"))


def explain(model: LinearModel, matrix: DataFrame) -> DataFrame:
    """Suppliers with ``shap`` (one value per input, in order, in log odds), probability and tier.

    Expressions on the row: the model travels as literals, nothing is shuffled.
    """
    effects = [_effect(name, weight, mean) for name, weight, mean in
               zip(SUPPLIER_FEATURES, model.weights, model.means)]
    return predict(model, matrix).select(
        "supplier_id", "supplier_name", tiers.PROBABILITY.of("probability_high").alias("risk_tier"),
        half_even("probability_high", 4).alias("risk_probability"), "probability_high",
        F.array(*effects).alias("shap"),
    )
