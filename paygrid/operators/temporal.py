"""Per-series window operators (lags, rolling means) and their bounded plan.

A series is (position_id, location_rk) ordered by week_dt.  Offsets count
ROWS, not months: a missing month makes ``lag 12`` reach further back, and
duplicate rows of one month each take a row slot.

All operators of one call share a single ``WindowSpec`` ordering, so Spark
plans one Window operator for all of them.

Order inside a month
--------------------
Rows of one month are numbered by :data:`TIE_ORDER` (their *place*).  The
row of place 1 comes first, the others follow from the last place to place 2.
Any order inside a month is a valid outcome of an ORDER BY on the month alone;
this one puts everything a later month can reach, and the row that stands for
its own month, among the lowest places.

Bounded plan (default, ``bounded=True``)
---------------------------------------
A plain series window puts every row of a series in one task.  If one
(position, location, month) holds a huge number of duplicate rows, that task
would get them all.  The job only keeps the *first* row of each month ("run"),
and every frame here ends at the current row and reaches at most ``LOOKBACK``
(51) rows back.  So for the first row of a run the only rows that matter are
itself and the 51 rows before it, and each of those is among the last 51 rows
of its own run: places 2 to 52.  ``row_number() <= 52`` over the run in one
order therefore keeps both ends, and Spark applies that limit before the
shuffle.  The window values at every first row are exactly those of the full series.

*Two levels.*  A run that is present in every input split would still send 52
rows a split to one reducer.  Runs are therefore limited first over (run,
salt), the salt being dealt by input split, and then over the run: with s
salts and m splits a reducer gets 52 * m / s rows of a run, then 52 * s.  The
second limit shares the exchange on the series key with the feature window.

Blocks (``block_months``)
-------------------------
A series of very many months can be windowed in blocks of months.  Each row's
number in its series is its number in its block plus the rows of the blocks
before, which are counts of one row a block.  A row is also sent, as a
*carried* row, to the later blocks that start at most ``LOOKBACK`` rows after
it, so that every block can be windowed alone, by another task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.constants import (
    LAG_PREV, LAG_YEAR, LONG_FRAME, ROLLING_FRAME, TRAILING_FRAME,
)
from ..functions.exact import mean
from ..sources.sinks import stage

SERIES_KEYS = ("position_id", "location_rk")
TIME_COL = "week_dt"
# Order of rows inside a month: our tie-break (any order is a valid outcome of
# an ORDER BY on the month alone).  Listing every non-key column makes the
# order total, so the surviving row and all frame contents are deterministic.
TIE_ORDER = (
    "work_schedule_type", "vacancy_cnt", "cnt_vacancy_site", "location_nm",
    "position_name", "agglomeration_nm", "int_salary_tc5", "target_salary_amt",
    "cnt_emp_dist", "market_perc_25", "market_perc_50", "market_perc_75",
    "company_competitor",
)
LOOKBACK = max(-LONG_FRAME[0], -ROLLING_FRAME[0], -TRAILING_FRAME[0], LAG_YEAR, LAG_PREV)

#: Rows of a run that matter: the first one and the last LOOKBACK.
KEPT = LOOKBACK + 1
PLACE, SALT = "_place", "_salt"
#: Splits that one level of limits is enough for.
ONE_LEVEL = 64


def series_order(df: DataFrame) -> list[str]:
    """Columns that order the rows of a month: TIE_ORDER, then whatever else there is."""
    present = [c for c in TIE_ORDER if c in df.columns]
    return [*present, *(c for c in df.columns if c not in present and c not in SERIES_KEYS and c != TIME_COL)]


def _run_window(order: Iterable[str], *more: str) -> WindowSpec:
    return Window.partitionBy(*SERIES_KEYS, TIME_COL, *more).orderBy(*[F.col(c).asc_nulls_first() for c in order])


def _seat() -> Column:
    """Sorts the rows of a month: place 1, then from the last place down to 2."""
    return F.when(F.col(PLACE) > 1, -F.col(PLACE)).otherwise(F.lit(-(2 ** 31)))


def series_window() -> WindowSpec:
    """The series in the documented order, over rows that have a place."""
    return Window.partitionBy(*SERIES_KEYS).orderBy(F.col(TIME_COL), _seat())


# -- operators: each maps a WindowSpec to named window columns -------------

def lag_prev_columns(w: WindowSpec) -> dict[str, Column]:
    """Value of the previous row."""
    return {
        "lag1_ext_salary_p50": F.lag("market_perc_50", LAG_PREV).over(w),
        "lag1_ext_salary_p25": F.lag("market_perc_25", LAG_PREV).over(w),
        "lag1_post_cnt": F.lag("cnt_vacancy_site", LAG_PREV).over(w),
    }


def lag_year_columns(w: WindowSpec) -> dict[str, Column]:
    """Value 12 rows back (computed once; the yoy ratios reuse it)."""
    return {
        "lag52_ext_salary_p50": F.lag("market_perc_50", LAG_YEAR).over(w),
        "_lag12_post_cnt": F.lag("cnt_vacancy_site", LAG_YEAR).over(w),
    }


def lag_year_gap_columns(w: WindowSpec) -> dict[str, Column]:
    """The guarded gap expression, 12 rows back (gap columns must exist)."""
    return {
        "lag52_gap_to_market_p50": F.lag("gap_to_market_p50", LAG_YEAR).over(w),
        "lag52_gap_to_market_p25": F.lag("gap_to_market_p25", LAG_YEAR).over(w),
    }


def rolling_12_columns(w: WindowSpec) -> dict[str, Column]:
    """Rows in the 12-row frame (NULL measures count) and their mean, a fraction like all means."""
    frame = w.rowsBetween(*ROLLING_FRAME)
    return {
        "n_weeks_12w": F.count(F.lit(1)).over(frame),
        "_avg_12": mean(F.col("cnt_vacancy_site"), frame),
    }


def trailing_3_columns(w: WindowSpec) -> dict[str, Column]:
    """Mean of the 3 preceding rows, current row excluded."""
    return {"rolling_mean_post_4w": mean(F.col("cnt_vacancy_site"), w.rowsBetween(*TRAILING_FRAME))}


def rolling_52_columns(w: WindowSpec) -> dict[str, Column]:
    """Mean over the current row and up to 51 before it."""
    return {"_avg_52": mean(F.col("cnt_vacancy_site"), w.rowsBetween(*LONG_FRAME))}


TEMPORAL_OPERATORS: dict[str, Callable[[WindowSpec], dict[str, Column]]] = {
    "lag_prev": lag_prev_columns,
    "lag_year": lag_year_columns,
    "lag_year_gap": lag_year_gap_columns,
    "rolling_12": rolling_12_columns,
    "trailing_3": trailing_3_columns,
    "rolling_52": rolling_52_columns,
}

# Columns computed once and published under two names (P5).
ALIASES = {
    "_avg_12": ("avg_vacancy_12w", "avg_post_cnt_12w"),
    "_avg_52": ("avg_ext_vacancy_w52", "avg_post_cnt_52w"),
}


def default_salts(df: DataFrame) -> int:
    """1 for a session of few shuffle partitions; beyond, the square root of their number, which halves the levels' load."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 if n <= ONE_LEVEL else math.isqrt(n)


def placed_runs(df: DataFrame, bounded: bool = True, salts: int = 1) -> DataFrame:
    """Rows with their place in their run, dealt by series; ``bounded`` keeps the first ``KEPT`` places only.

    ``salts``: how many ways a run is dealt for the first limit (1: one limit is enough).
    """
    order = series_order(df)
    place = F.row_number().over(_run_window(order))
    if not bounded:
        return df.repartition(*SERIES_KEYS).withColumn(PLACE, place)
    if salts == 1:
        return df.withColumn(PLACE, place).where(F.col(PLACE) <= KEPT).repartition(*SERIES_KEYS)
    salted = df.withColumn(SALT, F.pmod(F.spark_partition_id(), F.lit(salts)))
    first = salted.withColumn(PLACE, F.row_number().over(_run_window(order, SALT))).where(F.col(PLACE) <= KEPT)
    return first.drop(SALT, PLACE).repartition(*SERIES_KEYS).withColumn(PLACE, place).where(F.col(PLACE) <= KEPT)


BLOCK, HOME, NUMBER = "_block", "_home", "_number"


def in_blocks(rows: DataFrame, months: int, lookback: int = LOOKBACK) -> DataFrame:
    """Placed rows with their block, the block they are windowed in, and their number in the series.

    A row comes once for its own block and once for each later block whose rows can reach back to it.
    """
    rows = rows.withColumn(BLOCK, F.floor((F.year(TIME_COL) * 12 + F.month(TIME_COL)) / months).cast("int"))
    own = [*SERIES_KEYS, BLOCK]
    by_block = Window.partitionBy(*SERIES_KEYS).orderBy(BLOCK)
    before = F.coalesce(F.sum("_rows").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_start", before)
    # a block that is not empty takes up a row, so lookback blocks are always enough
    later = F.collect_list(F.struct(BLOCK, "_start")).over(by_block.rowsBetween(1, lookback))
    starts = starts.select(*own, "_start", later.alias("_later"))
    number = F.col("_start") + F.row_number().over(Window.partitionBy(*own).orderBy(F.col(TIME_COL), _seat()))
    keyed = rows.join(starts, own).withColumn(NUMBER, number)
    reach = F.filter("_later", lambda b: b["_start"] < F.col(NUMBER) + lookback)
    homes = F.concat(F.array(BLOCK), F.transform(reach, lambda b: b[BLOCK]))
    return keyed.select(*rows.columns, NUMBER, F.explode(homes).alias(HOME))


def add_series_features(
    df: DataFrame,
    operators: Iterable[str] = tuple(TEMPORAL_OPERATORS),
    bounded: bool = True,
    first_rows_only: bool = True,
    salts: int | None = None,
    block_months: int = 0,
) -> DataFrame:
    """Add the requested window columns in one Window pass.

    ``first_rows_only`` keeps the first row of each (series, month) in window
    order — the row a key-level table keeps.  ``bounded`` requires it, since
    only those rows are exact among the kept places.  ``block_months`` cuts
    every series into blocks of so many months.
    """
    if bounded and not first_rows_only:
        raise ValueError("bounded=True computes exact values for first rows only")
    rows = placed_runs(df, bounded, default_salts(df) if salts is None else salts)
    if block_months:
        rows = in_blocks(stage(rows, "series-rows"), block_months)   # counted and windowed: computed once
        w = Window.partitionBy(*SERIES_KEYS, HOME).orderBy(NUMBER)
    else:
        w = series_window()
    cols: dict[str, Column] = {}
    for name in operators:
        cols.update(TEMPORAL_OPERATORS[name](w))
    out = rows.select("*", *[c.alias(n) for n, c in cols.items()])
    if block_months:
        out = out.where(F.col(HOME) == F.col(BLOCK))   # not the carried rows
    if first_rows_only:
        out = out.where(first_of_run())
    # Final projection: window columns computed once, published under each
    # of their names; helper columns dropped.
    published = []
    for name in cols:
        published += [F.col(name).alias(alias) for alias in ALIASES[name]] if name in ALIASES else [F.col(name)]
    return out.select(*df.columns, *published)


def first_of_run() -> Column:
    """True on the first row of its (series, month) run in window order (O2)."""
    return F.col(PLACE) == 1
