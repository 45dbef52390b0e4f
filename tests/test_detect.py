"""D1-D8, D5 and P12."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import tick, ticks_df
from tickwatch.operators import detect
from tickwatch.operators.validity import filter_valid
from tickwatch.schemas import ANOMALY_COLUMNS


def _metrics_rows(spark, pairs):
    """Metrics-like rows with a given (volume, volume_ma) per row."""
    rows = [(1000 + i, "bitcoin", 10.0, v, ma, 0.0) for i, (v, ma) in enumerate(pairs)]
    return spark.createDataFrame(
        rows, "collection_timestamp long, crypto_id string, price_usd double, volume_24h_usd double, "
        "volume_ma_24h double, change_24h_pct double"
    )


def test_volume_spike_strict_bounds_and_severity(spark):
    pairs = [(2.5, 1.0), (2.5000001, 1.0), (3.5, 1.0), (3.5000001, 1.0), (5.0, 1.0), (5.0000001, 1.0),
             (10.0, None), (10.0, 0.0)]
    out = detect.detect_volume_spikes(_metrics_rows(spark, pairs)).orderBy("detected_at").collect()
    assert [(r.variation_pct, r.severity) for r in out] == [
        (2.5000001, "low"), (3.5, "low"), (3.5000001, "medium"), (5.0, "medium"), (5.0000001, "high")
    ]
    r = out[0]
    assert r.anomaly_type == "volume_spike" and r.current_price == 2.5000001 and r.reference_value == 1.0
    assert r.description == "Volume is 2.50x the 24h average"
    assert out[-1].description == "Volume is 5.00x the 24h average"


def _change_rows(spark, changes):
    rows = [(1000 + i, "eth", 2000.0, 1.0, 1.0, c) for i, c in enumerate(changes)]
    return spark.createDataFrame(
        rows, "collection_timestamp long, crypto_id string, price_usd double, volume_24h_usd double, "
        "volume_ma_24h double, change_24h_pct double"
    )


def test_price_variation_bounds_sign_and_text(spark):
    changes = [5.0, -5.0, 5.01, -5.01, 10.0, -10.5, 15.0, -15.01, None, 1234.5]
    out = detect.detect_price_variations(_change_rows(spark, changes)).orderBy("detected_at").collect()
    got = [(r.variation_pct, r.severity, r.reference_value) for r in out]
    assert got == [(5.01, "low", 0.0), (-5.01, "low", 0.0), (10.0, "low", 0.0), (-10.5, "medium", 0.0),
                   (15.0, "medium", 0.0), (-15.01, "high", 0.0), (1234.5, "high", 0.0)]
    assert out[1].description == "Price changed -5.01% in 24 hours"
    assert out[-1].description == "Price changed 1,234.50% in 24 hours"
    assert out[0].current_price == 2000.0


def test_golden_observation_is_normal(spark):
    # Documented sample: all five judged normal -> no price variation.
    rows = [(1, "bitcoin", 70956.0, 40.02e9, None, 2.09), (1, "ethereum", 2110.0, 18.69e9, None, 0.23),
            (1, "solana", 87.18, 2.97e9, None, -1.73), (1, "binancecoin", 645.03, 924e6, None, -0.97),
            (1, "cardano", 0.27, 708e6, None, -0.97)]
    df = spark.createDataFrame(rows, "collection_timestamp long, crypto_id string, price_usd double, "
                                     "volume_24h_usd double, volume_ma_24h double, change_24h_pct double")
    assert detect.detect_price_variations(df).count() == 0
    assert detect.detect_volume_spikes(df).count() == 0


def test_detect_all_keeps_duplicates_and_orders_newest_first(spark):
    df = spark.createDataFrame(
        [(1, "a", 10.0, 30.0, 10.0, 6.0), (2, "b", 10.0, 1.0, 1.0, -20.0), (2, "b", 10.0, 1.0, 1.0, -20.0)],
        "collection_timestamp long, crypto_id string, price_usd double, volume_24h_usd double, "
        "volume_ma_24h double, change_24h_pct double",
    )
    out = detect.detect_all(df).collect()
    assert out[0].detected_at == 2 and out[1].detected_at == 2
    assert len(out) == 4
    assert detect.detect_all(df).columns == ANOMALY_COLUMNS


def test_price_spike_lag_five(spark):
    prices = [100.0] * 5 + [111.0, 100.0, 100.0, 100.0, 100.0, 80.0]
    rows = [tick(100 + i, "sol", price=p, seq=i) for i, p in enumerate(prices)]
    out = detect.detect_price_spikes(filter_valid(ticks_df(spark, rows, with_seq=True)), chunk_rows=6).orderBy(
        "detected_at").collect()
    got = [(r.detected_at, round(r.variation_pct, 6), r.reference_value, r.severity) for r in out]
    # row 5: vs row 0 -> +11%; row 10: 80 vs row 5 (111) -> -27.9%; row 6..9 vs 100 -> 0
    assert got == [(105, 11.0, 100.0, "low"), (110, round((80 - 111) / 111 * 100, 6), 111.0, "high")]


def test_pump_dump_window_of_ten(spark):
    prices = [100.0, 100.0, 120.0, 100.0, 100.0, 100.0, 100.0, 100.0, 100.0, 100.0, 100.0, 100.0, 100.0]
    rows = [tick(100 + i, "ada", price=p, seq=i) for i, p in enumerate(prices)]
    out = detect.detect_pump_dump(filter_valid(ticks_df(spark, rows, with_seq=True)), chunk_rows=9).orderBy(
        "detected_at").collect()
    # pump = 20% while 120 is within the last 10 rows; dump = (120-100)/120 = 16.7% on rows 3..11
    assert [r.detected_at for r in out] == list(range(103, 112))
    assert all(r.reference_value == 120.0 for r in out)
    assert out[0].description == "Rose 20.00% then fell 16.67% within 10 readings"
    assert out[0].severity == "high"  # min(20, 16.67) > 16 (2 x 8)


def test_volume_rule_spec(spark):
    vols = [10.0] * 20 + [35.0]
    rows = [tick(100 + i, "bnb", volume=v, seq=i) for i, v in enumerate(vols)]
    out = detect.detect_volume_spikes_spec(ticks_df(spark, rows, with_seq=True)).collect()
    assert len(out) == 1 and out[0].detected_at == 120
    assert out[0].variation_pct == pytest.approx(35 / ((10 * 20 + 35) / 21))


def test_metrics_map(spark):
    df = spark.createDataFrame(
        [("a", "volume_spike", "low", 5, 3.0, 1.0, 3.0, "x")], ", ".join(
            f"{c} {t}" for c, t in zip(ANOMALY_COLUMNS, ["string", "string", "string", "long", "double", "double",
                                                          "double", "string"]))
    )
    m = detect.with_metrics_map(df).first().metrics
    assert m == {"current_price": 3.0, "reference_value": 1.0, "variation_pct": 3.0}


def test_variation_rules_run_on_sf_tables(spark):
    from conftest import SF_SMALL
    from tickwatch.sources import testdata

    valid = filter_valid(testdata.ticks(spark, SF_SMALL))
    a = detect.detect_price_spikes(valid, threshold=500.0).count()
    b = detect.detect_price_spikes(valid, threshold=500.0, chunk_rows=None).count()
    assert a == b
    c = detect.detect_pump_dump(valid, threshold=95.0).count()
    d = detect.detect_pump_dump(valid, threshold=95.0, chunk_rows=None).count()
    assert c == d
    assert valid.where(F.col("price_usd") <= 0).count() == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=0.0, max_value=1e9, allow_nan=False), min_size=1, max_size=40))
def test_volume_multiplier_bounded_by_frame_rows(spark, volumes):
    """With non-negative volumes the multiplier cannot exceed the number of
    rows in the frame, so there is no spike before row 3 at 2.5x."""
    from tickwatch.plans import transform

    rows = [tick(1000 + i * 180, "k", volume=v, seq=i) for i, v in enumerate(volumes)]
    out = transform.with_averages(ticks_df(spark, rows, with_seq=True), chunk_rows=480).collect()
    for r in out:
        if r.volume_ma_24h:
            assert r.volume_24h_usd / r.volume_ma_24h <= min(r.seq + 1, 481) * (1 + 1e-9)
    spikes = detect.detect_volume_spikes(
        transform.metrics(ticks_df(spark, rows, with_seq=True), chunk_rows=480)
    ).collect()
    assert all(s.detected_at >= 1000 + 2 * 180 for s in spikes)


def test_min_history(spark):
    from tickwatch.plans import transform

    vols = [1.0, 100.0, 1.0, 1.0, 1.0, 1.0, 60.0]
    rows = [tick(100 + i * 180, "k", volume=v, seq=i) for i, v in enumerate(vols)]
    m = transform.metrics(ticks_df(spark, rows, with_seq=True), with_counts=True, chunk_rows=480)
    assert "volume_ma_24h_n" in m.columns and "price_ma_15min_n" in m.columns
    # row 2: 100 / 50.5 = 1.98 (bounded by its 2-row frame); row 7: 60 / (165 / 7) = 2.55 with 7 readings
    spikes = lambda h: sorted(r.detected_at for r in detect.detect_volume_spikes(m, min_history=h).collect())
    assert spikes(1) == [100 + 6 * 180]
    assert spikes(7) == [100 + 6 * 180]
    assert spikes(8) == []
