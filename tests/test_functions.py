import hashlib
import math

import pytest
from pyspark.sql import functions as F

from contrail.functions import geo, ladders, numeric, text, time


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()[0]


@pytest.mark.parametrize("value,digits,expected", [
    (0.285, 2, 0.28), (1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.25, 1, 1.3)])
def test_sql_round_takes_halves_away_from_zero(spark, value, digits, expected):
    assert one(spark, numeric.sql_round(F.lit(value), digits)) == expected


@pytest.mark.parametrize("value,digits,expected", [
    (2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (-2.5, 0, -2.0)])
def test_even_round(spark, value, digits, expected):
    assert one(spark, numeric.even_round(F.lit(value), digits)) == expected


def test_text_round_equals_printing(spark):
    values = [2.675, 2.125, 2.345, 1.005, 0.285, -2.675, 0.0, 3.0] + [
        round(2.5 + k / 1000 + 0.005, 4) for k in range(0, 4000, 10)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(numeric.text_round(F.col("v"), 2)).collect()
    assert [f"{r[0]:.2f}" for r in got] == [f"{v:.2f}" for v in values]


def test_ratio_is_null_on_zero(spark):
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numeric.ratio(F.lit(1), F.lit(4))) == 0.25


def test_zscore_without_spread(spark):
    assert one(spark, numeric.zscore(F.lit(5.0), F.lit(3.0), F.lit(0.0))) == 0.0
    assert one(spark, numeric.zscore(F.lit(5.0), F.lit(3.0), F.lit(None).cast("double"))) == 0.0
    assert one(spark, numeric.zscore(F.lit(5.0), F.lit(3.0), F.lit(2.0))) == 1.0


@pytest.mark.parametrize("day,expected", [
    ("2024-01-07", 0), ("2024-01-08", 1), ("2024-01-13", 6)])
def test_weekday_starts_on_sunday(spark, day, expected):
    ts = F.lit(day).cast("timestamp")
    assert one(spark, time.weekday(ts)) == expected
    assert one(spark, time.is_weekend(ts)) == (expected in (0, 6))


def test_duration_of_one_hour(spark):
    minutes = time.minutes_between(time.from_epoch(F.lit(1700000000)),
                                   time.from_epoch(F.lit(1700003600)))
    assert one(spark, minutes) == 60.0


def test_surrogate_key_keeps_null_positions(spark):
    text_key = "ab-1-_dbt_utils_surrogate_key_null_"
    key = text.surrogate_key(F.lit("ab"), F.lit(1), F.lit(None).cast("string"))
    assert one(spark, key) == hashlib.md5(text_key.encode()).hexdigest()


def test_haversine(spark):
    d = geo.haversine(*[F.lit(v) for v in (52.1657, 20.9671, 50.0777, 19.7848)])
    p1, p2 = math.radians(52.1657), math.radians(50.0777)
    h = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(19.7848 - 20.9671) / 2) ** 2)
    assert one(spark, d) == pytest.approx(2 * 6371.0 * math.asin(math.sqrt(h)), rel=1e-12)
    antipodes = geo.haversine(F.lit(7.25), F.lit(-170.5), F.lit(-7.25), F.lit(9.5))
    assert one(spark, antipodes) == pytest.approx(math.pi * 6371.0, rel=1e-9)
    assert one(spark, geo.haversine(F.lit(1.0), F.lit(None).cast("double"), F.lit(1.0),
                                    F.lit(1.0))) is None


def test_prefixes_first_match_and_null(spark):
    for callsign, expected in [("RCH12", "TRANSPORT"), ("LAGR1", "TANKER"), ("HAWK9", "TRAINING"),
                               ("RAGE1", "FIGHTER"), ("FORTE", "SURVEILLANCE"),
                               ("DLH1", "UNKNOWN"), (None, "UNKNOWN")]:
        assert one(spark, ladders.classify_prefix(F.lit(callsign).cast("string"))) == expected


@pytest.mark.parametrize("z,sql_level,binned", [
    (1.49, "NORMAL", "NORMAL"), (1.5, "ELEVATED", "NORMAL"), (2.5, "HIGH", "ELEVATED"),
    (3.5, "CRITICAL", "HIGH"), (3.6, "CRITICAL", "CRITICAL")])
def test_two_ladders_differ_on_their_edges(spark, z, sql_level, binned):
    col = F.lit(z)
    assert one(spark, ladders.ladder(col, ladders.ANOMALY_STEPS, "NORMAL")) == sql_level
    assert one(spark, ladders.right_closed_bins(col, ladders.ANOMALY_EDGES,
                                                ladders.ANOMALY_LEVELS)) == binned


def test_bins_keep_null(spark):
    level = ladders.right_closed_bins(F.lit(None).cast("double"), ladders.ANOMALY_EDGES,
                                      ladders.ANOMALY_LEVELS)
    assert one(spark, level) is None


def test_unknown_country_is_international(spark):
    assert one(spark, ladders.route_type(F.lit("DE"), F.lit("DE"))) == "DOMESTIC"
    assert one(spark, ladders.route_type(F.lit("DE"), F.lit(None).cast("string"))) == \
        "INTERNATIONAL"


def test_distance_bands(spark):
    for km, expected in [(None, "UNKNOWN"), (499.9, "SHORT_RANGE"), (500.0, "MEDIUM_RANGE"),
                         (2000.0, "LONG_RANGE")]:
        assert one(spark, ladders.range_category(F.lit(km).cast("double"))) == expected
