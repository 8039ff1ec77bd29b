"""Gradient-boosted supplier risk: training, scores, evaluation."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions import tiers
from quayside.functions.rounding import half_away, half_even
from quayside.operators.features import SUPPLIER_FEATURES
from quayside.session import checkpoint_dir, cut_lineage

# Boosting settings.
TREES, RATE, DEPTH, SEED = 100, 0.1, 4, 42

SCORE_COLUMNS = (
    "supplier_id", "supplier_name", "country", "product_category", "risk_level", "reliability_score",
    "lead_time_days", "total_shipments", "disrupted_shipments", "avg_delay_days", "disruption_rate_pct",
    "risk_probability", "predicted_risk", "risk_tier",
)


def assemble(matrix: DataFrame) -> DataFrame:
    """Inputs as one vector of plain numbers: the codes carry no category metadata, so splits stay ordinal."""
    return VectorAssembler(inputCols=list(SUPPLIER_FEATURES), outputCol="features").transform(matrix)


def train(matrix: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
          seed: int = SEED) -> GBTClassificationModel:
    checkpoint_dir(matrix.sparkSession)
    booster = GBTClassifier(
        labelCol="target", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed,
        maxBins=64, minInstancesPerNode=1, subsamplingRate=1.0, featureSubsetStrategy="all",
        checkpointInterval=20,
    )
    return booster.fit(assemble(matrix).select("features", "target"))


def predict(model: GBTClassificationModel, matrix: DataFrame) -> DataFrame:
    """Unrounded ``probability_high`` and the predicted class."""
    scored = model.transform(assemble(matrix))
    return (
        scored.withColumn("probability_high", vector_to_array("probability")[1])
        .withColumn("predicted_risk", F.col("prediction").cast("int"))
        .drop("rawPrediction", "probability", "prediction", "features")
    )


def risk_scores(model: GBTClassificationModel, matrix: DataFrame, run_ts: str) -> DataFrame:
    scored = predict(model, matrix).withColumn("risk_probability", half_even("probability_high", 4))
    return scored.withColumn("risk_tier", tiers.PROBABILITY.of("risk_probability")).select(
        *SCORE_COLUMNS, F.lit(run_ts).cast("timestamp").alias("predicted_at"))


# -- evaluation on the test rows (columns target, predicted_risk, probability_high) --------

def confusion_matrix(predicted: DataFrame) -> DataFrame:
    """Counts of all four label and prediction pairs."""
    cells = [(label, guess) for label in (0, 1) for guess in (0, 1)]
    counted = predicted.agg(*[
        F.count_if((F.col("target") == label) & (F.col("predicted_risk") == guess)).alias(f"c{label}{guess}")
        for label, guess in cells
    ])
    rows = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(guess).alias("prediction"),
                 F.col(f"c{label}{guess}").alias("suppliers"))
        for label, guess in cells
    ])
    return counted.select(F.inline(rows))


def classification_metrics(predicted: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    hit, actual, guessed = {}, {}, {}
    for c in (0, 1):
        hit[c] = F.count_if((F.col("target") == c) & (F.col("predicted_risk") == c))
        actual[c] = F.count_if(F.col("target") == c)
        guessed[c] = F.count_if(F.col("predicted_risk") == c)
    counts = predicted.agg(*[
        f[c].cast("double").alias(f"{name}{c}")
        for name, f in (("hit", hit), ("actual", actual), ("guessed", guessed)) for c in (0, 1)
    ])
    zero = F.lit(0.0)

    def ratio(top, bottom):
        return F.coalesce(top / F.nullif(bottom, zero), zero)

    classes = {}
    for c in (0, 1):
        precision = ratio(F.col(f"hit{c}"), F.col(f"guessed{c}"))
        recall = ratio(F.col(f"hit{c}"), F.col(f"actual{c}"))
        classes[c] = (precision, recall, ratio(2 * precision * recall, precision + recall), F.col(f"actual{c}"))
    total = F.col("actual0") + F.col("actual1")
    accuracy = ratio(F.col("hit0") + F.col("hit1"), total)
    macro = [(classes[0][i] + classes[1][i]) / 2 for i in range(3)]
    weighted = [ratio(classes[0][i] * classes[0][3] + classes[1][i] * classes[1][3], total) for i in range(3)]
    lines = [
        ("Low Risk", *classes[0]), ("High Risk", *classes[1]), ("accuracy", accuracy, accuracy, accuracy, total),
        ("macro avg", *macro, total), ("weighted avg", *weighted, total),
    ]
    rows = F.array(*[
        F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f1.alias("f1_score"),
                 support.cast("long").alias("support"))
        for name, p, r, f1, support in lines
    ])
    return counts.select(F.inline(rows))


def roc_auc(predicted: DataFrame) -> DataFrame:
    """Area under the ROC curve, by ranks: the share of pairs of both classes in the right order, ties counting half.

    Rows are counted per score and class first, so a score that many rows share is one row. The scores are dealt to range
    partitions; what precedes a partition is the sum over those before it, what precedes a score within is a window over
    the partition. Counts are whole numbers throughout. No row unless both classes occur; rows without a score or class
    are left out.
    """
    levels = (
        predicted.select(F.col("probability_high").alias("score"), "target")
        .filter("score IS NOT NULL AND target IN (0, 1)")
        .groupBy("score").agg(F.count_if(F.col("target") == 1).alias("high"), F.count_if(F.col("target") == 0).alias("low"))
    )
    # The partition numbers are written down, because a second sampling could choose other boundaries.
    ranged = cut_lineage(levels.repartitionByRange("score").withColumn("slice", F.spark_partition_id()))
    slices = ranged.groupBy("slice").agg(F.sum("low").alias("slice_low"))
    # One row per partition.
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("slice", F.coalesce(F.sum("slice_low").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("slice").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("low").over(within), F.lit(0)) + F.col("offset")
    pairs = ranged.join(offsets, "slice").withColumn("lower", lower).agg(
        # Twice the pairs, to stay whole; the products pass 64 bits on large inputs.
        F.sum(F.col("high").cast("decimal(19,0)") * (2 * F.col("lower") + F.col("low")).cast("decimal(19,0)")).alias("won"),
        F.sum("high").alias("high"), F.sum("low").alias("low"))
    area = F.col("won").cast("double") / (2.0 * F.col("high").cast("double") * F.col("low").cast("double"))
    return pairs.filter("high > 0 AND low > 0").select(area.alias("roc_auc"))


def feature_importance(model: GBTClassificationModel, spark) -> DataFrame:
    """Importance of each model input, largest first."""
    values = model.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(SUPPLIER_FEATURES, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


# -- reports on the stored scores ---------------------------------------------------

def risk_tier_summary(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("risk_tier").agg(
            F.count("*").alias("supplier_count"),
            half_away(F.avg("risk_probability"), 3).alias("avg_risk_prob"),
            half_away(F.avg("disruption_rate_pct"), 1).alias("avg_disruption_rate"),
        ).orderBy(F.desc("avg_risk_prob"), "risk_tier")
    )


def sorted_scores(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("risk_probability"), "supplier_id")


def top5_risky_suppliers(scores: DataFrame) -> DataFrame:
    return sorted_scores(scores).limit(5).select(
        "supplier_id", "supplier_name", "country", "risk_tier", "risk_probability", "disruption_rate_pct")
