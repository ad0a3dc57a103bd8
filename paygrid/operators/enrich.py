"""Source preparation and enrichment joins.

* :func:`prepare_base`   — in-house pay: horizon, dimension lookup, renames,
  cleaning (location NULL -> '', target 0 -> NULL, title fallback).
* :func:`prepare_market` — market percentiles: horizon, whole-market rows,
  month -> 3-month -> 6-month fallback.
* :func:`count_vacancies` — single vacancies counted per month, position and
  raw agglomeration (NULL and '' stay separate groups).
* :func:`enrich` — left joins of base to both, matching NULL and '' keys to
  each other, then the cross-source fallbacks.

Joins are written as plain equi-joins without hints: both right sides are
aggregates, so AQE sees their real size after the shuffle and turns the join
into a broadcast when they are small, or keeps a sort-merge join when not.
Duplicates on the right side are kept (fan-out is part of the semantics).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.columns import month_start, null_as_empty, null_if_equal
from ..functions.constants import WHOLE_MARKET
from ..functions.exact import MONEY
from .horizon import apply_horizon

# Amounts keep their decimal type from the source to the sink; a source that holds
# them in another type is read as NUMERIC(18,5).


def lookup_position(base: DataFrame, dim: DataFrame) -> DataFrame:
    """Base LEFT JOIN dim on id; ``position_name`` = HR title, else dim name.

    No hint here: Spark's byte estimate and AQE pick the strategy.  Duplicate ids in the dimension fan out (kept, as in the
    original).
    """
    d = dim.select(F.col("id").alias("_dim_id"), F.col("name").alias("dim_name"))
    joined = base.join(d, F.col("position_type_id") == F.col("_dim_id"), "left")
    return joined.select(
        *base.columns, "dim_name",
        F.coalesce(F.col("hrm_job_title_nm"), F.col("dim_name")).alias("position_name"))


def prepare_base(base: DataFrame, dim: DataFrame | None, cutoff: dt.date | None) -> DataFrame:
    b = base if cutoff is None else apply_horizon(base, cutoff)
    if dim is not None:
        b = lookup_position(b, dim)
    else:
        b = b.withColumn("position_name", F.col("hrm_job_title_nm"))
    return b.select(
        month_start("month_dt").alias("week_dt"),
        F.col("position_type_id").alias("position_id"),
        null_as_empty("location_rk").alias("location_rk"),
        "location_nm",
        "position_name",
        F.col("agglomeration_name").alias("agglomeration_nm"),
        "work_schedule_type",
        F.col("fact_salary_fte_amt").alias("int_salary_tc5"),
        null_if_equal("target_salary", 0).alias("target_salary_amt"),
        "cnt_emp_dist",
        "perc_25", "perc_50", "perc_75",
        F.col("cnt_vacancy_site").alias("market_cnt_vacancy_site"),
        "company_competitor",
    )


def prepare_market(ext: DataFrame, cutoff: dt.date | None,
                   market_type: str = WHOLE_MARKET) -> DataFrame:
    e = ext if cutoff is None else apply_horizon(ext, cutoff)
    e = e.where(F.col("type_agg") == F.lit(market_type))
    return e.select(
        month_start("month_dt").alias("month_dt"),
        "position_type_id",
        "agglomeration_name",
        *[
            F.coalesce(f"perc_{p}", f"perc_{p}_3month", f"perc_{p}_6month").alias(f"perc_{p}")
            for p in (25, 50, 75)
        ],
        "cnt_vacancy_site",
    )


def count_vacancies(vac: DataFrame, cutoff: dt.date | None) -> DataFrame:
    """COUNT(*) per (month start, position, raw agglomeration).

    Partial aggregation runs before the shuffle, so a hot group costs one
    counter per map task, not its rows.
    """
    v = vac if cutoff is None else apply_horizon(vac, cutoff)
    return v.groupBy(
        month_start("month_dt").alias("month_dt"), "position_type_id", "agglomeration_name"
    ).agg(F.count(F.lit(1)).alias("vacancy_cnt"))


def _keyed(df: DataFrame, prefix: str, month: str, position: str, agg: str,
           *values: str) -> DataFrame:
    return df.select(
        F.col(month).alias(f"{prefix}_month"),
        F.col(position).alias(f"{prefix}_pos"),
        null_as_empty(agg).alias(f"{prefix}_agg"),
        F.col(agg).alias(f"{prefix}_agg_raw"),
        *[F.col(v).alias(f"{prefix}_{v}") for v in values],
    )


def _on(left_prefix_cols: tuple[str, str, str], prefix: str):
    month, pos, agg = left_prefix_cols
    return (
        (F.col(month) == F.col(f"{prefix}_month"))
        & (F.col(pos) == F.col(f"{prefix}_pos"))
        & (F.col(agg) == F.col(f"{prefix}_agg"))
    )


def join_market(base: DataFrame, market: DataFrame) -> DataFrame:
    """base LEFT JOIN market on month, position and null-as-empty agglomeration."""
    m = _keyed(market, "_m", "month_dt", "position_type_id", "agglomeration_name",
               "perc_25", "perc_50", "perc_75", "cnt_vacancy_site")
    b = base.withColumn("_b_agg", null_as_empty("agglomeration_nm"))
    return b.join(m, _on(("week_dt", "position_id", "_b_agg"), "_m"), "left")


def join_vacancies(base: DataFrame, counts: DataFrame) -> DataFrame:
    """base LEFT JOIN vacancy counts on the same three keys."""
    v = _keyed(counts, "_v", "month_dt", "position_type_id", "agglomeration_name", "vacancy_cnt")
    b = base if "_b_agg" in base.columns else base.withColumn(
        "_b_agg", null_as_empty("agglomeration_nm"))
    return b.join(v, _on(("week_dt", "position_id", "_b_agg"), "_v"), "left")


def market_columns() -> list:
    """D3: market value, else the one on the base row (after :func:`join_market`)."""
    return [
        F.coalesce("_m_perc_25", "perc_25").alias("market_perc_25"),
        F.coalesce("_m_perc_50", "perc_50").alias("market_perc_50"),
        F.coalesce("_m_perc_75", "perc_75").alias("market_perc_75"),
        F.coalesce("_m_cnt_vacancy_site", "market_cnt_vacancy_site").alias("cnt_vacancy_site"),
    ]


def vacancy_column():
    """A missing vacancy count is zero (after :func:`join_vacancies`)."""
    return F.coalesce("_v_vacancy_cnt", F.lit(0)).alias("vacancy_cnt")


BASE_AMOUNTS = ("int_salary_tc5", "target_salary_amt", "perc_25", "perc_50", "perc_75")
MARKET_AMOUNTS = ("perc_25", "perc_50", "perc_75")


def _amounts(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """df with decimal amounts."""
    return df.withColumns({c: F.col(c).cast(MONEY) for c in names if not isinstance(df.schema[c].dataType, DecimalType)})


def join_sides(base: DataFrame, market: DataFrame, counts: DataFrame) -> DataFrame:
    """base LEFT JOIN (market FULL JOIN counts): the rows of two chained left joins.

    Both sides share the three keys, so a base row meets every pair of matching
    sides, or the one that matches, or none.  The large side is joined once and
    nothing above reuses that join's partitioning, so AQE can split a hot key.
    """
    m = _keyed(market, "_m", "month_dt", "position_type_id", "agglomeration_name",
               "perc_25", "perc_50", "perc_75", "cnt_vacancy_site")
    v = _keyed(counts, "_v", "month_dt", "position_type_id", "agglomeration_name", "vacancy_cnt")
    both = m.join(v, (F.col("_m_month") == F.col("_v_month")) & (F.col("_m_pos") == F.col("_v_pos"))
                  & (F.col("_m_agg") == F.col("_v_agg")), "full")
    sides = both.select(
        *[F.coalesce(f"_m_{k}", f"_v_{k}").alias(f"_s_{k}") for k in ("month", "pos", "agg")],
        *[f"_m_{c}" for c in ("perc_25", "perc_50", "perc_75", "cnt_vacancy_site")],
        "_v_vacancy_cnt")
    b = base.withColumn("_b_agg", null_as_empty("agglomeration_nm"))
    return b.join(sides, _on(("week_dt", "position_id", "_b_agg"), "_s"), "left")


def enrich(base: DataFrame, market: DataFrame, counts: DataFrame) -> DataFrame:
    """The ``joined`` relation: base with market and vacancy data, fallbacks applied."""
    sides = join_sides(_amounts(base, BASE_AMOUNTS), _amounts(market, MARKET_AMOUNTS), counts)
    return sides.select(
        "week_dt", "position_id", "location_rk", "location_nm", "position_name",
        "agglomeration_nm", "work_schedule_type", "int_salary_tc5", "target_salary_amt",
        "cnt_emp_dist",
        *market_columns(),
        vacancy_column(),
        "company_competitor",
    )
