"""Why a supplier is scored as it is: exact path-dependent Shapley values of the boosted trees.

A leaf of depth d depends on at most d inputs, and its value given a subset of
known inputs is a product over those inputs: 1 or 0 where the input is known
(the row passes or fails the leaf's interval), the share of training rows that
pass where it is not. Shapley values of such a product have a closed form, so a
table of leaves is all a task needs (Lundberg et al. 2018).
"""

from __future__ import annotations

from itertools import combinations
from math import factorial
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import tiers
from quayside.functions.rounding import half_even
from quayside.operators.features import SUPPLIER_FEATURES
from quayside.operators.risk_model import predict
from quayside.session import checkpoint_dir

LABELS = tuple(SUPPLIER_FEATURES.values())
# The classifier's probability is the logistic of twice the margin.
LOG_ODDS_PER_MARGIN = 2.0
_CHUNK = 512


def leaf_table(spark: SparkSession, model: GBTClassificationModel, depth: int) -> dict[str, np.ndarray]:
    """Per leaf: its weighted value, and per input on its path the interval and the share of rows that pass.

    Read from the saved model. Its size is set by the model (trees x leaves), not by the data.
    """
    path = f"{checkpoint_dir(spark)}/risk-model-{uuid4().hex}"
    model.save(path)
    stored = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold")
    nodes = {(r["treeID"], r["id"]): r for r in stored.collect()}  # bounded by the model
    leaves = []
    for tree, weight in enumerate(model.treeWeights):
        open_nodes = [(0, {})]
        while open_nodes:
            number, path_terms = open_nodes.pop()
            node = nodes[(tree, number)]
            if node["leftChild"] < 0:
                leaves.append((node["prediction"] * weight * LOG_ODDS_PER_MARGIN, path_terms))
                continue
            cut, feature = node["leftCategoriesOrThreshold"][0], node["featureIndex"]
            low, high, share = path_terms.get(feature, (-np.inf, np.inf, 1.0))
            for child, bounds in ((node["leftChild"], (low, min(high, cut))),
                                  (node["rightChild"], (max(low, cut), high))):
                passed = nodes[(tree, child)]["rawCount"] / node["rawCount"]
                open_nodes.append((child, {**path_terms, feature: (*bounds, share * passed)}))
    shape = (len(leaves), depth)
    table = {"value": np.array([v for v, _ in leaves]), "feature": np.full(shape, -1),
             "low": np.full(shape, -np.inf), "high": np.full(shape, np.inf), "share": np.ones(shape)}
    for i, (_, terms) in enumerate(leaves):
        for j, (feature, (low, high, share)) in enumerate(terms.items()):
            table["feature"][i, j], table["low"][i, j], table["high"][i, j] = feature, low, high
            table["share"][i, j] = share
    return table


def base_value(leaves: dict[str, np.ndarray]) -> float:
    """Log-odds when no input is known."""
    return float((leaves["value"] * leaves["share"].prod(axis=1)).sum())


def leaf_effects(leaves: dict[str, np.ndarray]) -> np.ndarray:
    """What each input on the path of a leaf adds, by (input, outcome, leaf). An outcome tells by bits which of the
    inputs a row passes, so there are few, and a row needs no sum over subsets of its own."""
    depth = leaves["feature"].shape[1]
    used = leaves["feature"] >= 0
    size = used.sum(axis=1)
    share = leaves["share"]
    coefficients = np.array([[
        factorial(s) * factorial(m - s - 1) / factorial(m) if s < m else 0.0 for s in range(depth)]
        for m in range(depth + 1)])
    outcomes = np.arange(1 << depth)[:, None, None] >> np.arange(depth) & 1
    passes = (outcomes.astype(bool) | ~used).astype(float)
    effects = np.empty((depth, *passes.shape[:2]))
    for j in range(depth):
        others = [k for k in range(depth) if k != j]
        weight = np.zeros(passes.shape[:2])
        for known_size in range(depth):
            # Unused slots are neutral factors, so subsets are taken over the used ones only.
            for known in combinations(others, known_size):
                valid = used[:, j] & used[:, list(known)].all(axis=1)
                coefficient = np.where(valid, coefficients[size, known_size], 0.0)
                unknown = [k for k in others if k not in known]
                term = passes[:, :, list(known)].prod(axis=2) * share[:, unknown].prod(axis=1)
                weight += coefficient * term
        effects[j] = leaves["value"] * (passes[:, :, j] - share[:, j]) * weight
    return effects


def shapley_values(x: np.ndarray, leaves: dict[str, np.ndarray], effects: np.ndarray | None = None) -> np.ndarray:
    """Attribution of each input (columns) for each row of ``x``, in log-odds."""
    count, depth = leaves["feature"].shape
    slot_input = np.where(leaves["feature"] < 0, 0, leaves["feature"])
    used = leaves["feature"] >= 0
    effects = leaf_effects(leaves) if effects is None else effects
    result = np.zeros((len(x), x.shape[1]))
    for begin in range(0, len(x), _CHUNK):
        rows = x[begin:begin + _CHUNK]
        at = np.zeros((len(rows), count), dtype=np.int64)
        for j in range(depth):
            value = rows[:, slot_input[:, j]]
            at += ((value > leaves["low"][:, j]) & (value <= leaves["high"][:, j]) | ~used[:, j]).astype(np.int64) << j
        at = at * count + np.arange(count)
        for j in range(depth):
            effect = effects[j].ravel().take(at)
            for feature in np.unique(slot_input[used[:, j], j]):
                here = used[:, j] & (slot_input[:, j] == feature)
                result[begin:begin + _CHUNK, feature] += effect[:, here].sum(axis=1)
    return result


def explain(model: GBTClassificationModel, matrix: DataFrame, depth: int) -> DataFrame:
    """Suppliers with ``shap`` (one value per input, in order), probability and tier."""
    spark = matrix.sparkSession
    table = leaf_table(spark, model, depth)
    leaves = spark.sparkContext.broadcast((table, leaf_effects(table)))
    # A stored matrix is small on disk and may come in one partition, but a row costs much work.
    matrix = matrix.repartition(spark.sparkContext.defaultParallelism * 2)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def attribute(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(list(shapley_values(x, *leaves.value)))

    inputs = [F.col(c).cast("double") for c in SUPPLIER_FEATURES]
    return predict(model, matrix).select(
        "supplier_id", "supplier_name", tiers.PROBABILITY.of("probability_high").alias("risk_tier"),
        half_even("probability_high", 4).alias("risk_probability"), "probability_high",
        attribute(*inputs).alias("shap"),
    )


def add_drivers(explained: DataFrame) -> DataFrame:
    """The strongest input with its signed value, and the three strongest as text. Ties go to the first input."""
    names = F.array(*[F.lit(label) for label in LABELS])
    size = F.transform("shap", lambda v: F.abs(v))
    first = F.array_position(size, F.array_max(size)).cast("int")
    ranked = F.array_sort(F.transform("shap", lambda v, i: F.struct(
        (-F.abs(v)).alias("order"), i.alias("position"), v.alias("value"))))
    phrases = F.transform(F.slice(ranked, 1, 3), lambda s: F.format_string(
        "%s %s risk by %.3f", F.element_at(names, s["position"] + 1),
        F.when(s["value"] > 0, "increases").otherwise("reduces"), F.abs(s["value"])))
    return (
        explained.withColumn("top_risk_driver", F.element_at(names, first))
        .withColumn("top_driver_impact", half_even(F.element_at("shap", first), 4))
        .withColumn("explanation", F.array_join(phrases, " | "))
    )


def shap_explanations(explained: DataFrame) -> DataFrame:
    """One row per supplier, one column per input under its display name."""
    return add_drivers(explained).select(
        "supplier_id", "supplier_name", "risk_tier", "risk_probability",
        *[F.get("shap", F.lit(i)).alias(label) for i, label in enumerate(LABELS)],
        "top_risk_driver", "top_driver_impact", "explanation",
    )


# -- reports on the stored explanations ------------------------------------------------

def _long(wide: DataFrame, ids: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("shap_value")) for c in LABELS])
    return wide.select(*ids, F.inline(rows))


def global_importance(wide: DataFrame) -> DataFrame:
    """Mean absolute attribution per input. The 12 means are taken in one row, then turned into rows."""
    means = wide.agg(*[F.avg(F.abs(F.col(f"`{c}`"))).alias(c) for c in LABELS])
    return _long(means, []).select("feature", F.col("shap_value").alias("mean_abs_shap")).orderBy(
        F.desc("mean_abs_shap"), "feature")


def driver_distribution(wide: DataFrame) -> DataFrame:
    return wide.groupBy("top_risk_driver").agg(F.count("*").alias("suppliers")).orderBy(
        F.desc("suppliers"), "top_risk_driver")


def top_driver(wide: DataFrame) -> DataFrame:
    return wide.select("supplier_id", "top_risk_driver", "top_driver_impact")


def top3_explanation(wide: DataFrame) -> DataFrame:
    return wide.select("supplier_id", "explanation")


def top5_critical_explanations(wide: DataFrame) -> DataFrame:
    return (
        wide.filter(F.col("risk_tier") == "CRITICAL").orderBy(F.desc("risk_probability"), "supplier_id").limit(5)
        .select("supplier_id", "supplier_name", "risk_tier", "risk_probability", "top_risk_driver", "explanation")
    )


def filter_tier_driver(wide: DataFrame, tiers_kept: list[str], drivers: list[str]) -> DataFrame:
    """Both filters apply; an empty list does not filter."""
    if tiers_kept:
        wide = wide.filter(F.col("risk_tier").isin(*tiers_kept))
    if drivers:
        wide = wide.filter(F.col("top_risk_driver").isin(*drivers))
    return wide


def explanation_page(filtered: DataFrame, rows: int = 10) -> DataFrame:
    return filtered.orderBy("supplier_id").limit(rows).select(
        "supplier_id", "supplier_name", "risk_tier", "risk_probability", "top_risk_driver", "explanation")


def supplier_shap_long(wide: DataFrame) -> DataFrame:
    """(supplier, feature, value), strongest first within a supplier."""
    return _long(wide, ["supplier_id"]).orderBy("supplier_id", F.desc(F.abs("shap_value")), "feature")


def driver_options(wide: DataFrame) -> DataFrame:
    return wide.select("top_risk_driver").distinct().orderBy("top_risk_driver")
