from pyspark.sql import functions as F

from courtside.functions import (
    made_label, pct_rate, percent_text, record_text, signed_text, tier_label, to_double,
    to_int, zone_label, thousands_text,
)


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_coercion_bad_text_and_nan_become_null(spark):
    vals = _one(spark, to_double("v"), [("1.5",), ("n/a",), ("",), ("nan",), (None,), (" 2 ",)],
                "v string")
    assert vals == [1.5, None, None, None, None, 2.0]


def test_int_written_as_float_text(spark):
    assert _one(spark, to_int("v"), [("20.0",), ("20",), ("x",)], "v string") == [20, 20, None]


def test_leading_zero_text_unchanged(spark):
    df = spark.createDataFrame([("0022400001",)], "game_id string")
    assert df.collect()[0][0] == "0022400001"


def test_tier_label_ladder_and_null(spark):
    got = _one(spark, tier_label("p"), [(0.6,), (0.59,), (0.5,), (0.45,), (0.1,), (None,)],
               "p double")
    assert got == ["Elite", "Winning", "Winning", "Bubble", "Rebuilding", None]


def test_zone_label_bounds(spark):
    got = _one(spark, zone_label("d"), [(0,), (7,), (8,), (15,), (16,), (22,), (23,), (None,)],
               "d int")
    assert got == ["Close", "Close", "Mid", "Mid", "Long two", "Long two", "Three", None]


def test_made_label(spark):
    assert _one(spark, made_label("f"), [(1,), (0,), (None,)], "f int") == ["Made", "Missed", None]


def test_half_up_rate(spark):
    # 1 of 16 = 6.25 -> 6.3 (half-up), not 6.2
    assert _one(spark, pct_rate("m", "n"), [(1, 16)], "m long, n long") == [6.3]
    assert _one(spark, pct_rate("m", "n"), [(1, 0), (None, 3)], "m long, n long") == [None, None]


def test_text_helpers(spark):
    df = spark.createDataFrame([(0.5333, 3.25, -1.5, 10, 5, 1234567, "Atlanta", "Hawks"),
                                (None, None, None, 0, 0, 0, None, "Hawks")],
                               "p double, a double, b double, w int, l int, n long, c string, t string")
    rows = df.select(percent_text("p"), signed_text("a"), signed_text("b"), record_text("w", "l"),
                     thousands_text("n")).collect()
    assert tuple(rows[0]) == ("53.3%", "+3.3", "-1.5", "10-5", "1,234,567")
    assert rows[1][0] is None
