import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.functions.rounding import half_away, half_even
from quayside.functions.tiers import STOCKOUT, tier_bins


@pytest.mark.parametrize("value,label", [
    (0.0, "LOW"), (0.25, "LOW"), (0.2500001, "MEDIUM"), (1.0, "CRITICAL"), (-0.0005, None), (1.01, None),
    (None, None)])
def test_bins_are_right_closed(spark, value, label):
    df = spark.createDataFrame([(value,)], "v double")
    got = df.select(tier_bins("v", (0, 0.25, 0.5, 0.75, 1), ("LOW", "MEDIUM", "HIGH", "CRITICAL")).alias("t"))
    assert got.first().t == label


def test_open_ended_bin(spark):
    df = spark.createDataFrame([(1e9,), (float("inf"),), (7.0,)], "v double")
    assert [r.t for r in df.select(STOCKOUT.of("v").alias("t")).collect()] == ["LOW", "LOW", "CRITICAL"]


def test_bins_need_one_label_each():
    with pytest.raises(ValueError):
        tier_bins(F.lit(1.0), (0, 1), ("A", "B"))


def test_half_even_is_numpy_rounding(spark):
    rng = np.random.default_rng(1)
    values = [*(rng.integers(-10**6, 10**6, 500) / 20000).tolist(), *rng.normal(0, 100, 500).tolist(), 0.125, 2.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.r for r in df.select(half_even("v", 4).alias("r")).collect()]
    assert got == np.round(values, 4).tolist()


def test_half_away(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (1.005,)], "v double")
    assert [r.r for r in df.select(half_away("v", 2).alias("r")).collect()] == [0.13, -0.13, 1.0]
