"""Exact ratios: numerators and denominators travel as whole numbers, and a result is rounded once.

Money is NUMERIC(18,5), so an amount is a whole number of hundred-thousandths that fits 64 bits, and so is the
difference of two.  A *fraction* is a struct<num bigint, den bigint>, NULL where its guard fails; it can be
lagged and compared like any value.  ``settled`` turns it into a decimal of a given scale, half away from zero.

Scale rule.  A double division, or a decimal one whose result type has fewer digits than the quotient, rounds
first to that type and then to the sink's scale, and the two steps can cross a tie.  Here the quotient is never
formed: with n = w * d + r (whole numbers, 0 <= r < d) the digits after the point are the whole number
nearest to r * 10 ** scale / d.  Either r * 10 ** scale * 2 fits 38 digits, which the denominator's digits prove,
or the digits are taken one at a time, for which r * 10 must fit.  Nothing else is rounded, so a tie goes up
exactly if it is one.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,5)"
MONEY_SCALE = 5
#: Decimals of a ratio whose sink names no scale: all that a NUMERIC(38) with 20 digits before the point has.
RATIO_SCALE = 18
FRACTION = "struct<num:bigint,den:bigint>"
#: Digits of a fraction's parts.
DIGITS = 19
WHOLE = "decimal(38,0)"


def units(amount: Column) -> Column:
    """An amount as a whole number of its smallest parts (a wider type is rounded to NUMERIC(18,5) first)."""
    return (amount.cast(MONEY) * F.lit(10 ** MONEY_SCALE)).cast("bigint")


def fraction(num: Column, den: Column, guard: Column) -> Column:
    """num / den of whole numbers, NULL unless the guard holds (which excludes a zero denominator)."""
    return F.when(guard, F.struct(num.cast("bigint").alias("num"), den.cast("bigint").alias("den")))


def mean(values: Column, over) -> Column:
    """AVG of whole numbers over a frame, as the fraction sum / count; NULL without values."""
    n = F.count(values).over(over)
    return fraction(F.sum(values.cast("bigint")).over(over), n, n > 0)


# The formulas below are SQL texts over named fraction columns: a few expressions per query instead of hundreds of
# column calls.  Spark's ``abs`` and unary minus round a decimal to 34 digits (its other operations do not), so
# signs of wide values are taken by subtraction.

def _wide(x: str) -> str:
    return f"CAST({x} AS {WHOLE})"


def _size(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN {_wide(f'{_wide(0)} - {x}')} ELSE {x} END)"


def _whole_quotient(a: str, b: str) -> str:
    """a / b of non-negative whole numbers without the remainder (``div`` would return 64 bits)."""
    return _wide(f"(({a}) - ({a}) % ({b})) / ({b})")


def _joined(before: str, after: str, negative: str, scale: int) -> str:
    """before + after / 10 ** scale with a sign, in types of few digits: those of a sum of two wide ones lose the last decimal."""
    unit = f"CAST({_power_of_ten(-scale):f} AS DECIMAL({max(scale, 1)},{scale}))"
    small = f"CAST(CAST({after} AS DECIMAL(19,0)) * {unit} AS DECIMAL({scale + 1},{scale}))"
    parts = [(f"CAST({before} AS DECIMAL(19,0))", "DECIMAL(19,0)"), (small, f"DECIMAL({scale + 1},{scale})")]
    signed = [f"CASE WHEN {negative} THEN CAST(CAST(0 AS DECIMAL(1,0)) - {x} AS {kind}) ELSE {x} END" for x, kind in parts]
    return f"CAST({signed[0]} + {signed[1]} AS DECIMAL(38,{scale}))"


def _power_of_ten(exponent: int) -> Decimal:
    return Decimal(1).scaleb(exponent)


def _settled_sql(name: str, scale: int) -> str:
    num, den = f"`{name}`.num", f"`{name}`.den"
    if DIGITS + scale + 1 > 38:
        raise ValueError("the rest times a power of ten must fit 38 digits")
    rest = _wide(f"abs({num}) % abs({den})")
    twice = _wide(f"2 * {_wide(f'abs({den})')}")
    scaled = _wide(f"{_wide(f'{rest} * {_wide(2 * 10 ** scale)}')} + {_wide(f'abs({den})')}")
    return f"CASE WHEN `{name}` IS NOT NULL THEN {_joined(f'abs({num}) div abs({den})', _whole_quotient(scaled, twice), f'({num} < 0) <> ({den} < 0)', scale)} END"


def settled(name: str, scale: int = RATIO_SCALE) -> Column:
    """The fraction column ``name`` as decimal(38, scale), rounded once, half away from zero."""
    return F.expr(_settled_sql(name, scale))


def growth(now: str, then: str, scale: int = RATIO_SCALE) -> Column:
    """now / then - 1 of two fraction columns as decimal(38, scale); NULL without either, or if ``then`` is zero."""
    wide = lambda x, y: _wide(f"{_wide(x)} * {_wide(y)}")
    num = _wide(f"{wide(f'`{now}`.num', f'`{then}`.den')} - {wide(f'`{then}`.num', f'`{now}`.den')}")
    den = wide(f"`{now}`.den", f"`{then}`.num")
    n, d = _size(num), _size(den)
    # one digit at a time: the denominator may have 37
    ten = _wide("s.rest * 10")
    step = (f"named_struct('digits', {_wide(f's.digits * 10 + {_whole_quotient(ten, d)}')}, 'rest', {_wide(f'{ten} % {d}')})")
    last = f"{_wide(f's.digits + CASE WHEN s.rest * 2 >= {d} THEN 1 ELSE 0 END')}"
    steps = f"sequence(1, {scale})" if scale else "CAST(array() AS ARRAY<INT>)"
    start = f"named_struct('digits', {_wide(0)}, 'rest', {_wide(f'{n} % {d}')})"
    after = f"aggregate({steps}, {start}, (s, i) -> {step}, s -> {last})"
    known = f"`{now}` IS NOT NULL AND `{then}` IS NOT NULL AND `{then}`.num <> 0"
    return F.expr(f"CASE WHEN {known} THEN {_joined(_whole_quotient(n, d), after, f'({num} < 0) <> ({den} < 0)', scale)} END")
