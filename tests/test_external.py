import datetime as dt
import json

import numpy as np
import pytest

from quayside.operators import external
from quayside.sources import feeds, seeds

RUN = "2024-01-31T00:00:00"


def documents(spark, *values):
    return spark.createDataFrame([(json.dumps(v),) for v in values], "payload string")


def test_indicator_drops_missing_values(spark):
    doc = [{"page": 1}, [
        {"country": {"id": "KE", "value": "Kenya"}, "value": 2.81249, "date": "2022"},
        {"country": {"id": "GH", "value": "Ghana"}, "value": None, "date": "2022"}]]
    rows = feeds.flatten_indicator(documents(spark, doc), "lpi_score", 3).collect()
    assert [tuple(r) for r in rows] == [("KE", "Kenya", 2.812, "2022")]


def test_fx_history_and_latest(spark):
    doc = {"rates": {"2024-01-02": {"EUR": 0.9, "JPY": 150.0}, "2024-01-03": {"EUR": 0.91}}}
    rows = feeds.flatten_fx_history(documents(spark, doc)).collect()
    assert sorted(tuple(r) for r in rows) == [
        (dt.date(2024, 1, 2), "EUR", 0.9), (dt.date(2024, 1, 2), "JPY", 150.0), (dt.date(2024, 1, 3), "EUR", 0.91)]
    countries = spark.createDataFrame([("Italy", "EUR"), ("USA", "USD"), ("Kenya", "KES")],
                                      "country string, currency_code string")
    latest = documents(spark, {"rates": {"EUR": 0.92}, "date": "2024-01-31"})
    rows = feeds.fx_current_lookup(latest, countries).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("Italy", "EUR", 0.92, "2024-01-31"), ("USA", "USD", 1.0, "2024-01-31")]


def test_weather_arrays_and_gaps(spark):
    doc = {"country": "Kenya", "city": "Mombasa", "daily": {
        "time": ["2024-01-01", "2024-01-02"], "precipitation_sum": [1.5, None], "windspeed_10m_max": [10.0, 20.0],
        "temperature_2m_max": [30.0, 31.0], "temperature_2m_min": [20.0, 21.0], "snowfall_sum": [None, 0.0],
        "weathercode": [3, None]}}
    rows = sorted(feeds.flatten_weather(documents(spark, doc)).collect())
    assert tuple(rows[0]) == (dt.date(2024, 1, 1), "Kenya", "Mombasa", 1.5, 10.0, 30.0, 20.0, 0.0, 3)
    assert (rows[1].precipitation_mm, rows[1].weather_code) == (0.0, 0)


def test_concat_skips_missing_cities(spark):
    one, two = spark.range(2), spark.range(3)
    assert feeds.concat_frames([None, one, two]).count() == 5
    with pytest.raises(ValueError):
        feeds.concat_frames([None])


def test_weather_score_by_hand(spark):
    rows = [("a", 20.0, 50.0, 38.0, -5.0, 5.0), ("b", 5.0, 10.0, 20.0, 10.0, 0.0), ("c", 200.0, 300.0, 0.0, 0.0, 0.0)]
    daily = spark.createDataFrame(
        rows, "id string, precipitation_mm double, windspeed_kmh double, temp_max_c double, temp_min_c double, "
              "snowfall_cm double")
    got = {r.id: (r.weather_disruption_score, r.weather_risk_tier)
           for r in external.weather_disruption_score(daily).collect()}
    # a: all five flags and 4 + 5, capped; c: 30 + 25 + 20 + 15.
    assert got == {"a": (100.0, "SEVERE"), "b": (2.0, "CLEAR"), "c": (90.0, "SEVERE")}


def test_equal_scores_normalise_to_zero(spark):
    lpi = spark.createDataFrame([("A", 3.0), ("B", 3.0)], "country_name string, lpi_score double")
    assert {(r.lpi_normalized, r.logistics_risk_score) for r in external.minmax_normalise(lpi).collect()} == {(0.0, 1.0)}


def test_fallback_profile_covers_all_supplier_countries(spark):
    lpi = external.minmax_normalise(seeds.fallback_logistics(spark))
    profile = external.country_risk_profile(lpi, None, seeds.indicator_names(spark)).collect()
    assert {r.our_country_name for r in profile} == {c for c, _, _ in seeds.FALLBACK_RATES}
    assert all(r.gdp_per_capita_usd is None and r.logistics_risk_tier for r in profile)
    germany = next(r for r in profile if r.country_name == "Germany")
    assert (germany.logistics_risk_score, germany.logistics_risk_tier) == (0.0, "LOW")


def test_fx_volatility_edges(spark):
    current = spark.createDataFrame(
        [("USA", "USD", 1.0), ("One", "AAA", 2.0), ("Two", "BBB", 3.0), ("Many", "CCC", 4.0), ("None", "DDD", 5.0)],
        "country string, currency_code string, rate_vs_usd double")
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    history = [(days[0], "AAA", 2.5), (days[0], "BBB", 2.0), (days[1], "BBB", 3.0), (days[0], "USD", 1.0),
               (days[1], "USD", 2.0), *[(d, "CCC", v) for d, v in zip(days, (4.0, 4.2, 4.0, 4.1))]]
    past = spark.createDataFrame(history, "date date, currency_code string, rate_vs_usd double")
    rows = {r.country: r for r in external.fx_volatility(current, past, RUN).collect()}
    for country in ("USA", "One", "None"):
        r = rows[country]
        assert (r.pct_change_30d, r.daily_volatility_pct, r.currency_risk_score, r.currency_risk_tier) == (0, 0, 0, "LOW")
        assert r.rate_30d_ago == r.current_rate_vs_usd
    # One return has no spread; the trend alone counts.
    assert (rows["Two"].pct_change_30d, rows["Two"].daily_volatility_pct, rows["Two"].currency_risk_score) == (50, 0, 100)
    many = rows["Many"]
    spread = np.std([4.2 / 4.0 - 1, 4.0 / 4.2 - 1, 4.1 / 4.0 - 1], ddof=1) * 100
    assert (many.pct_change_30d, many.daily_volatility_pct) == (2.5, round(spread, 4))
    assert many.currency_risk_score == round(5 + round(spread, 4) * 10, 2)
    high = external.filter_high_fx(external.fx_volatility(current, past, RUN)).collect()
    assert {r.country for r in high} == {"Two", "Many"}


def test_rates_of_the_last_days_only(spark):
    import datetime as dt

    from quayside.operators.external import fx_daily_returns, fx_first_last

    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=k), "EUR", 1.0 + k) for k in range(120)]
    history = spark.createDataFrame(rows, "date date, currency_code string, rate_vs_usd double")
    ends = fx_first_last(history).first()
    assert (ends.points, ends.first_rate, ends.last_rate) == (31, 90.0, 120.0)
    assert fx_first_last(history, days=5).first().points == 6
    assert fx_daily_returns(history).count() == 30
