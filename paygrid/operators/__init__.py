"""The job's operators, each usable alone on DataFrames."""

from .dedupe import first_per_key
from .enrich import (  # (the ``enrich`` function stays at ``operators.enrich.enrich``)
    count_vacancies, join_market, join_vacancies, lookup_position, prepare_base,
    prepare_market,
)
from .horizon import apply_horizon, cutoff_month
from .metrics import (
    add_market_gaps, completeness_ratio, competitor_name, gap_yoy, insufficient,
    salary_spread, salary_yoy, staffing_flag, vacancy_count, vacancy_yoy,
)
from .temporal import add_series_features, first_of_run, in_blocks, placed_runs, series_window
from .validate import enforce, violations

__all__ = [
    "first_per_key", "count_vacancies", "join_market", "join_vacancies",
    "lookup_position", "prepare_base", "prepare_market", "apply_horizon", "cutoff_month",
    "add_market_gaps", "completeness_ratio", "competitor_name",
    "gap_yoy", "insufficient", "salary_spread", "salary_yoy", "staffing_flag",
    "vacancy_count", "vacancy_yoy", "add_series_features", "first_of_run", "in_blocks", "placed_runs",
    "series_window", "enforce", "violations",
]
