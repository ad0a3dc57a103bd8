"""Row-level feature formulas (gaps, ratios, spreads, completeness).

All guards come before the division, so nothing divides by zero under ANSI
mode; results are NULL where a guard fails (CASE without ELSE).  Ratios are
exact fractions until they are settled at the sink's scale (``functions.exact``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.columns import (
    gap_to, guarded_ratio, integer_ratio, missing_flag, null_if_equal, spread,
)
from ..functions.constants import COMPETITOR_UNKNOWN, INSUFFICIENT_ABOVE, STAFFED_VALUE
from ..functions.exact import FRACTION, RATIO_SCALE, fraction, growth, settled

#: Core inputs of the completeness score.
INPUTS = 3
COUNT_RATIO_MODES = ("auto", "integer", "exact")


def add_market_gaps(df: DataFrame) -> DataFrame:
    """(own - market) / market, for p50 and p25, as fractions."""
    return df.withColumns({
        "gap_to_market_p50": gap_to("int_salary_tc5", "market_perc_50"),
        "gap_to_market_p25": gap_to("int_salary_tc5", "market_perc_25"),
    })


def resolve_count_ratio(df: DataFrame, mode: str, column: str = "cnt_vacancy_site") -> str:
    if mode not in COUNT_RATIO_MODES:
        raise ValueError(f"count_ratio must be one of {COUNT_RATIO_MODES}")
    if mode != "auto":
        return mode
    return "integer" if isinstance(df.schema[column].dataType, IntegralType) else "exact"


def salary_yoy() -> Column:
    """p50 against the value 12 rows back, as a fraction."""
    return guarded_ratio("market_perc_50", "lag52_ext_salary_p50")


def vacancy_yoy(mode: str) -> Column:
    """D7 for counts, as a fraction.  ``integer``: truncating division, as int / int in SQL;
    ``exact``: fractional ratio."""
    if mode == "integer":
        whole = integer_ratio("cnt_vacancy_site", "_lag12_post_cnt")
        return fraction(whole, F.lit(1), whole.isNotNull())
    return guarded_ratio("cnt_vacancy_site", "_lag12_post_cnt", whole=True)


def gap_yoy(scale: int = RATIO_SCALE) -> Column:
    """Gap against the gap 12 rows back, both exact (the gap columns are still fractions)."""
    return growth("gap_to_market_p50", "lag52_gap_to_market_p50", scale)


def salary_spread() -> Column:
    """p75 - p25 when both are known."""
    return spread("market_perc_75", "market_perc_25")


def vacancy_count() -> Column:
    """Site count, else own count, else 0 (a site count of 0 wins)."""
    return F.coalesce(F.col("cnt_vacancy_site"), F.col("vacancy_cnt"), F.lit(0))


def staffing_flag() -> Column:
    """100 when staff is present, else NULL."""
    c = F.col("cnt_emp_dist")
    return F.when(c.isNotNull() & (c > 0), F.lit(STAFFED_VALUE)).otherwise(F.lit(None))


def competitor_name() -> Column:
    """The lower-case 'not determined' placeholder becomes NULL."""
    return null_if_equal("company_competitor", COMPETITOR_UNKNOWN)


def missing_inputs() -> Column:
    """Number of missing core inputs: market p50, own pay, vacancy count (0 = missing)."""
    return (
        missing_flag(F.col("market_perc_50").isNull())
        + missing_flag(F.col("int_salary_tc5").isNull())
        + missing_flag(vacancy_count() == 0)
    )


def completeness_ratio() -> Column:
    """Share of the three core inputs that are missing, as a fraction."""
    return fraction(missing_inputs(), F.lit(INPUTS), F.lit(True))


def insufficient() -> Column:
    """The unrounded score above 0.3, i.e. any one input missing; compared in whole numbers."""
    part, whole = Decimal(str(INSUFFICIENT_ABOVE)).as_integer_ratio()
    return missing_inputs() * F.lit(whole) > F.lit(INPUTS * part)


def settle_fractions(df: DataFrame, scales: dict[str, int] | None = None) -> DataFrame:
    """df with every fraction column as a decimal, rounded once to its scale."""
    scales = scales or {}
    known = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[settled(c, scales.get(c, RATIO_SCALE)).alias(c) if t.simpleString() == FRACTION else c for c, t in known.items()])
