"""Column functions: dates, keys, guarded arithmetic (ANSI mode stays on)."""

import datetime as dt
import random
from decimal import Context, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from paygrid.functions.columns import (
    gap_to, guarded_ratio, horizon_start, horizon_start_col, integer_ratio, month_start,
    null_as_empty, null_if_equal, spread,
)
from paygrid.functions.exact import growth, settled


@pytest.mark.parametrize("as_of,expected", [
    (dt.date(2001, 8, 15), dt.date(2000, 2, 1)),
    (dt.date(2001, 6, 30), dt.date(1999, 12, 1)),
    (dt.date(2000, 1, 1), dt.date(1998, 7, 1)),
    (dt.date(2024, 2, 29), dt.date(2022, 8, 1)),
])
def test_horizon_start_driver_and_column_agree(spark, as_of, expected):
    assert horizon_start(as_of) == expected
    assert spark.range(1).select(horizon_start_col(F.lit(as_of))).first()[0] == expected


def test_month_start_on_dates_and_timestamps(spark):
    row = spark.sql("SELECT DATE'2001-03-31' d, TIMESTAMP_NTZ'2001-03-31 23:59:59' t, "
                    "TIMESTAMP'2001-12-01 00:00:00' z").select(
        month_start("d").alias("d"), month_start("t").alias("t"), month_start("z").alias("z")).first()
    assert row == (dt.date(2001, 3, 1), dt.date(2001, 3, 1), dt.date(2001, 12, 1))


def test_keys_and_sentinels(spark):
    df = spark.createDataFrame([(None, 0.0), ("", 5.0), ("x", None)], "k string, v double")
    out = df.select(null_as_empty("k").alias("k"), null_if_equal("v", 0).alias("v")).collect()
    assert [tuple(r) for r in out] == [("", None), ("", 5.0), ("x", None)]


def test_guarded_arithmetic_never_divides_by_zero(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(10, 0, 5.0, 0.0), (15, 10, 4.0, 5.0), (-7, 2, None, 2.0),
                                (7, None, 1.0, None)], "n int, d int, own double, m double")
    rows = df.select(integer_ratio("n", "d").alias("i"), guarded_ratio("n", "d", whole=True).alias("r"),
                     gap_to("own", "m").alias("g"), spread("own", "m").alias("s"))
    rows = rows.select("i", settled("r").alias("r"), settled("g").alias("g"), "s").collect()
    assert [r["i"] for r in rows] == [None, 0, -4, None]          # truncates toward zero
    assert [r["r"] for r in rows] == [None, 0.5, -4.5, None]
    assert [r["g"] for r in rows] == [None, Decimal("-0.2"), None, None]
    assert [r["s"] for r in rows] == [5.0, -1.0, None, None]


def test_as_of_defaults_to_the_current_date():
    from paygrid.operators.horizon import cutoff_month, resolve_as_of
    today = dt.date.today()
    assert resolve_as_of(None) == today
    assert cutoff_month(None) == horizon_start(today)
    assert resolve_as_of("2001-08-15") == dt.date(2001, 8, 15)
    assert resolve_as_of(dt.datetime(2001, 8, 15, 23, 0)) == dt.date(2001, 8, 15)


def nearest(x: Fraction, scale: int) -> Decimal:
    """x at a scale, half away from zero."""
    q, r = divmod(abs(x).numerator * 10 ** scale, abs(x).denominator)
    return Decimal((-1 if x < 0 else 1) * (q + (2 * r >= abs(x).denominator))).scaleb(-scale, Context(prec=80))


@pytest.mark.parametrize("scale", [0, 5, 18])
def test_ratios_are_rounded_once(spark, scale):
    rng = random.Random(scale)
    rows = [(rng.randrange(-10 ** rng.randrange(1, 19), 10 ** rng.randrange(1, 19)), rng.choice([1, -1]) * rng.randrange(1, 10 ** rng.randrange(1, 19)),
             rng.randrange(1, 10 ** 18), rng.randrange(1, 10 ** 18)) for _ in range(200)]
    rows += [(1, 8, 1, 1), (-1, 8, 1, 3), (5, 2, 1, 1), (-5, 2, 1, 1), (10 ** 18 - 1, 1, 10 ** 18 - 1, 10 ** 18 - 1), (630805, 1000000, 1, 1), (0, 7, 1, 1),
             # one part in 10 ** 18 below and above a tie
             (5 * 10 ** 17 - 1, 10 ** 18, 1, 1), (5 * 10 ** 17, 10 ** 18, 1, 1), (-5 * 10 ** 17, 10 ** 18, 1, 1)]
    rows = [r for r in rows if abs(Fraction(r[0], r[1]) / Fraction(r[2], r[3])) < 10 ** 18]
    f, g = (F.struct(F.col(a).alias("num"), F.col(b).alias("den")) for a, b in ("ab", "cd"))
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint, d bigint").select("*", f.alias("f"), g.alias("g"))
    for r in df.select("a", "b", "c", "d", settled("f", scale).alias("one"), growth("f", "g", scale).alias("two")).collect():
        assert r["one"] == nearest(Fraction(r["a"], r["b"]), scale), r
        assert r["two"] == nearest(Fraction(r["a"], r["b"]) / Fraction(r["c"], r["d"]) - 1, scale), r


def test_a_scale_that_would_not_fit_is_refused():
    with pytest.raises(ValueError):
        settled("a", 19)
