import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import order_statistics as stats


def series(kind):
    rng = np.random.default_rng(7)
    return {
        "uniform": rng.uniform(-50, 900, 3000),
        "heavy_tail": np.exp(rng.normal(0, 6, 3000)),
        "hot_value": np.where(rng.random(3000) < 0.4, 12.5, rng.normal(0, 30, 3000)),
        "integers": rng.integers(0, 50, 3000).astype(float),
        "constant": np.full(100, 3.25),
        "single": np.array([4.0]),
        "pair": np.array([1.0, 2.0]),
    }[kind]


@pytest.mark.parametrize("kind", ["uniform", "heavy_tail", "hot_value", "integers", "constant", "single", "pair"])
def test_equal_to_numpy(spark, kind):
    values = series(kind)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    targets = {f"q{q}": (F.col("v"), q) for q in (0.0, 0.05, 0.5, 0.95, 0.97, 1.0)}
    found = stats.exact_quantiles(df, targets)
    for q in (0.0, 0.05, 0.5, 0.95, 0.97, 1.0):
        assert found[f"q{q}"] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_many_passes_still_exact(spark, monkeypatch):
    monkeypatch.setattr(stats, "BUCKETS", 3)
    values = series("heavy_tail")
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = stats.exact_quantiles(df, {"q": (F.col("v"), 0.95)})
    assert found["q"] == pytest.approx(np.quantile(values, 0.95), rel=1e-12)


def test_nulls_are_left_out_and_empty_is_null(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "v double, w double")
    found = stats.exact_quantiles(df, {"v": (F.col("v"), 0.5), "w": (F.col("w"), 0.5)})
    assert found == {"v": 2.0, "w": None}


def test_passes_return_bounded_rows(spark, monkeypatch):
    """What comes back to the driver does not grow with the rows."""
    from pyspark.sql.classic.dataframe import DataFrame

    sizes, collect = [], DataFrame.collect

    def spy(self):
        rows = collect(self)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(stats, "BUCKETS", 16)
    monkeypatch.setattr(DataFrame, "collect", spy)
    df = spark.range(50_000).select(F.sqrt("id").alias("v"))
    stats.exact_quantiles(df, {"q": (F.col("v"), 0.95)})
    assert max(sizes) <= 2 * 16


def test_infinite_values_are_refused(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "v double")
    with pytest.raises(ValueError):
        stats.exact_quantiles(df, {"v": (F.col("v"), 0.5)})
