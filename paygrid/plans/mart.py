"""The feature mart as one lazy DataFrame plan.

Stages (each a plain DataFrame -> DataFrame step, nothing materialised):
horizon -> prepared sources -> enrichment joins -> one per-series Window pass
-> first row per (month, position, location) -> final formulas.

Physical shape: the source scans (filters pushed down), partial+final
aggregation of vacancies, two left joins (broadcast at runtime when AQE finds
the aggregated sides small), then one hash exchange on the series key for the
windows.  The bounded plan adds one exchange before it, on the (series,
month) run key, fed by a pre-shuffle group limit: at most 52 rows per run
and input split cross it, and at most 52 rows per run reach the windows.
Amounts are decimals throughout, ratios exact fractions that are rounded once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from ..functions.constants import HORIZON_MONTHS
from ..functions.exact import RATIO_SCALE
from ..operators import enrich as E
from ..operators import metrics as M
from ..operators.dedupe import first_per_key
from ..operators.horizon import cutoff_month
from ..operators.temporal import (
    SERIES_KEYS, TEMPORAL_OPERATORS, TIME_COL, add_series_features, series_order,
)
from .contracts import Contract

MONEY_NULL = "decimal(18,5)"

# FIXED VALUES: the 51 deterministic columns of the feature table (table order, without
# inserted_at, which the sink adds).
MART_COLUMNS = (
    "week_dt", "position_id", "location_rk", "location_nm", "position_name",
    "ext_salary_mean", "ext_salary_p25", "ext_salary_p50", "ext_salary_p75",
    "ext_vacancy_cnt", "ext_vacancy_hrm", "ext_vacancy_sal_range",
    "turnover_coeff", "required_positions", "occupied_positions",
    "normalized_positions", "headcount_gap", "average_inhouse_headcount_coeff",
    "average_headcount_coeff", "dismissal_int_reason_group_nm", "dismissal_cnt",
    "int_salary_tc5", "target_salary_amt", "competitor_nm", "competitor_type",
    "competitor_food_cat", "post_cnt", "agglomeration_nm",
    "gap_to_market_p50", "gap_to_market_p25",
    "lag1_ext_salary_p50", "lag1_ext_salary_p25", "lag1_turnover",
    "rolling_mean_turnover_4w", "n_weeks_12w", "avg_vacancy_12w", "lag1_post_cnt",
    "rolling_mean_post_4w", "avg_post_cnt_12w", "lag52_ext_salary_p50",
    "salary_p50_yoy_diff", "avg_ext_vacancy_w52", "avg_post_cnt_52w",
    "vacancy_cnt_yoy_diff", "lag52_turnover_coeff", "turnover_yoy_diff",
    "lag52_gap_to_market_p50", "lag52_gap_to_market_p25", "gap_yoy_diff",
    "nulls_ratio", "data_insufficient",
)

# FIXED VALUES: columns the job declares but never fills (typed NULL placeholders, P3).
PLACEHOLDERS = {
    "ext_vacancy_hrm": MONEY_NULL, "turnover_coeff": MONEY_NULL,
    "required_positions": MONEY_NULL, "occupied_positions": MONEY_NULL,
    "headcount_gap": MONEY_NULL, "average_inhouse_headcount_coeff": MONEY_NULL,
    "average_headcount_coeff": MONEY_NULL, "dismissal_int_reason_group_nm": "string",
    "dismissal_cnt": MONEY_NULL, "competitor_type": "string",
    "competitor_food_cat": "string", "post_cnt": MONEY_NULL,
    "lag1_turnover": MONEY_NULL, "rolling_mean_turnover_4w": MONEY_NULL,
    "lag52_turnover_coeff": MONEY_NULL, "turnover_yoy_diff": MONEY_NULL,
}


@dataclass(frozen=True)
class MartOptions:
    as_of: dt.date | str | None = None
    count_ratio: str = "auto"     # 'auto' | 'integer' | 'exact'  (vacancy yoy)
    bounded: bool = True          # skew-safe run compression before the windows
    # Opt-ins (default off = the original's behaviour):
    warmup_months: int = 0        # read this much extra history; output still starts at the horizon
    dedupe: str = "after"         # 'after': window then keep one row per key; 'before': the reverse
    block_months: int = 0         # cut series into blocks of so many months (0: a series is windowed whole)


def joined_relation(sources, cutoff: dt.date | None) -> DataFrame:
    """Prepared base with market and vacancy data (the ``joined`` stage)."""
    base = E.prepare_base(sources.base(since=cutoff), sources.dim(), cutoff)
    market = E.prepare_market(sources.ext(since=cutoff), cutoff)
    stored = getattr(sources, "counts", None)   # counts kept by month, if the sources have them
    counts = stored(since=cutoff) if stored else E.count_vacancies(sources.vac(since=cutoff), cutoff)
    return E.enrich(base, market, counts)


def series_relation(joined: DataFrame, bounded: bool = True,
                    operators=tuple(TEMPORAL_OPERATORS), dedupe: str = "after",
                    block_months: int = 0) -> DataFrame:
    """Gaps, then every window feature, one row per (month, position, location).

    ``dedupe='before'`` keeps one row per key first (the same survivor), so
    duplicates no longer take row slots in the lags and frames.
    """
    if dedupe not in ("after", "before"):
        raise ValueError("dedupe must be 'after' or 'before'")
    gapped = M.add_market_gaps(joined)
    if dedupe == "before":
        gapped = first_per_key(gapped, [*SERIES_KEYS, TIME_COL], series_order(gapped))
        bounded = False  # one row per run already: nothing left to bound
    return add_series_features(gapped, operators, bounded=bounded, block_months=block_months)


def final_columns(count_ratio: str, scales: dict[str, int]) -> dict[str, Column]:
    """The output formulas over the windowed relation, by output name."""
    cols: dict[str, Column] = {
        "ext_salary_mean": F.col("market_perc_50"),
        "ext_salary_p25": F.col("market_perc_25"),
        "ext_salary_p50": F.col("market_perc_50"),
        "ext_salary_p75": F.col("market_perc_75"),
        "ext_vacancy_cnt": M.vacancy_count(),
        "ext_vacancy_sal_range": M.salary_spread(),
        "normalized_positions": M.staffing_flag(),
        "competitor_nm": M.competitor_name(),
        "salary_p50_yoy_diff": M.salary_yoy(),
        "vacancy_cnt_yoy_diff": M.vacancy_yoy(count_ratio),
        "gap_yoy_diff": M.gap_yoy(scales.get("gap_yoy_diff", RATIO_SCALE)),
        "nulls_ratio": M.completeness_ratio(),
        "data_insufficient": M.insufficient(),
    }
    cols.update({name: F.lit(None).cast(t) for name, t in PLACEHOLDERS.items()})
    return cols


def finish(windowed: DataFrame, count_ratio: str, spec: Contract | None = None) -> DataFrame:
    """The 51 columns; each ratio is rounded once, to the scale of its column in ``spec``."""
    mode = M.resolve_count_ratio(windowed, count_ratio)
    scales = {} if spec is None else ratio_scales(spec)
    cols = final_columns(mode, scales)
    out = windowed.select(*[cols[c].alias(c) if c in cols else c for c in MART_COLUMNS])
    return M.settle_fractions(out, scales)


def ratio_scales(spec: Contract) -> dict[str, int]:
    """Decimals that a contract keeps of a fraction: a column of whole numbers keeps none."""
    return {f.name: f.dataType.scale if isinstance(f.dataType, DecimalType) else 0
            for f in spec.schema.fields if isinstance(f.dataType, (DecimalType, IntegralType))}


def build_mart(sources, options: MartOptions = MartOptions(), spec: Contract | None = None) -> DataFrame:
    """The whole feature computation: 51 columns, one row per key.

    ``spec``: the contract that the rows are meant for; without one ratios have 18 decimals.
    """
    cutoff = cutoff_month(options.as_of)
    read_from = cutoff_month(options.as_of, HORIZON_MONTHS + options.warmup_months)
    joined = joined_relation(sources, read_from)
    windowed = series_relation(joined, options.bounded, dedupe=options.dedupe, block_months=options.block_months)
    if options.warmup_months:
        windowed = windowed.where(F.col(TIME_COL) >= F.lit(cutoff))
    return finish(windowed, options.count_ratio, spec)
