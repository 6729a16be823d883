"""Column helpers: whitespace strip, exact rounding, timestamp text."""

import math
import random
from datetime import datetime
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.functions import (
    exact_avg,
    exact_sum,
    iso_text,
    normalize,
    parse_timestamp,
    round_half_even_ratio,
    round_ratio,
    strip_all,
    timestamp_text,
)


def test_strip_removes_every_whitespace_kind(spark):
    df = spark.createDataFrame([("\t Failed \n",), ("　SUCCESS ",), (" a b ",), (None,)], "s string")
    out = [r[0] for r in df.select(normalize("s")).collect()]
    assert out == ["failed", "success", "a b", None]
    # plain trim would keep the tab and newline
    assert df.select(F.trim("s")).first()[0] == "\t Failed \n"
    assert df.select(strip_all("s")).first()[0] == "Failed"


@pytest.mark.parametrize("num,den,expected", [
    (1, 3, 33.33), (2, 3, 66.67), (1, 8, 12.5), (0, 5, 0.0), (5, 5, 100.0),
    (1, 160, 0.63),      # 0.625 exactly -> half up
    (201, 20000, 1.01),  # 1.005 exactly: a double rounding would give 1.0
    (7, 0, None),
])
def test_round_ratio_is_exact_half_up(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    got = df.select(round_ratio(F.col("n"), F.col("d"), factor=100)).first()[0]
    assert got == expected


def test_round_ratio_null_inputs(spark):
    df = spark.createDataFrame([(None, None)], "n long, d long")
    assert df.select(round_ratio(F.col("n"), F.col("d"))).first()[0] is None


@pytest.mark.parametrize("num,den,expected", [
    (17, 18, 94.4), (18, 18, 100.0), (1, 16, 6.2), (3, 16, 18.8), (1, 3, 33.3),
])
def test_round_half_even_ratio(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    got = df.select(round_half_even_ratio(F.col("n"), F.col("d"), factor=100, digits=1)).first()[0]
    assert got == expected
    assert got == round(num * 100 / den, 1)


def test_timestamp_texts(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 3, 30, 19, 48, 38, 221832),), (datetime(2001, 8, 1),), (None,)], "ts timestamp_ntz")
    texts = [r[0] for r in df.select(timestamp_text("ts")).collect()]
    assert texts == ["2026-03-30 19:48:38.221832", "2001-08-01 00:00:00", "NaT"]
    isos = [r[0] for r in df.select(iso_text("ts")).collect()]
    assert isos == ["2026-03-30T19:48:38.221832", "2001-08-01T00:00:00", None]


def test_parse_accepts_mixed_fractions(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05",), ("2024-01-02T03:04:05.123456",)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 123456)]


def test_parse_fails_on_malformed_text(spark):
    df = spark.createDataFrame([("not a time",)], "s string")
    with pytest.raises(PySparkException):
        df.select(parse_timestamp("s")).collect()


def _written(x):
    """The number a double is written as."""
    return Fraction(repr(x))


def test_exact_sum_of_any_doubles_in_any_order(spark):
    rng = random.Random(2)
    values = [round(rng.uniform(-1e6, 1e6), 2) for _ in range(300)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-6, 12) for _ in range(300)]
    values += [0.005, 0.004, -0.0, 1e-20, 9_999_999_999_999.99, 0.1, 0.2]
    rows = [(i % 3, v, i % 5) for i, v in enumerate(values)] + [(7, None, 1)]
    want = {g: sum(_written(v) for k, v, _ in rows if k == g) for g in range(3)}
    heavy = {g: sum(_written(v) * w for k, v, w in rows if k == g) for g in range(3)}
    seen = set()
    for seed in range(3):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, x double, w long").repartition(1 + 3 * seed)
        got = {r.g: r for r in df.groupBy("g").agg(
            exact_sum("x").alias("s"), exact_sum("x", "w").alias("ws"), exact_avg("x").alias("a")).collect()}
        seen.add(tuple((g, got[g].s, got[g].ws) for g in range(3)))
        for g in range(3):
            n = sum(k == g for k, _, _ in rows)
            assert got[g].s == pytest.approx(float(want[g]), rel=1e-15, abs=1e-21)
            assert got[g].ws == pytest.approx(float(heavy[g]), rel=1e-15, abs=1e-21)
            assert got[g].a == pytest.approx(float(want[g] / n), rel=1e-15)
        assert got[7].s is None and got[7].ws is None and got[7].a is None
    assert len(seen) == 1                                     # the order of the rows changes no bit


def test_exact_sum_of_two_decimal_amounts_is_the_nearest_double(spark):
    rng = random.Random(3)
    cents = [rng.randrange(-10**13, 10**13) for _ in range(500)]
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(7)
    assert df.agg(exact_sum("x")).first()[0] == sum(cents) / 100


def test_exact_sum_of_large_and_special_amounts(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum("x")).first()[0]

    assert total(1e15, 2e15, 0.25) == 3e15 + 0.25
    assert total(float("inf"), 1.0) == float("inf")
    assert math.isnan(total(float("nan"), 1.0))
    assert total(1e300, 1e300) == 2e300
    assert spark.createDataFrame([], "x double").agg(exact_sum("x")).first()[0] is None
