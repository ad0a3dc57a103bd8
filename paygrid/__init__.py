"""paygrid: a Spark-native monthly labour-market feature mart.

For each (month, position, location) the mart puts in-house pay beside
market salary percentiles and vacancy counts and adds lags, rolling means,
year-over-year ratios, gaps to market and a completeness score.
"""

from .plans.mart import MART_COLUMNS, MartOptions, build_mart
from .plans.job import run
from .plans.contracts import conform, contract
from .sources.testdata import TestDataSources
from .sources.tables import TableSources

__all__ = [
    "MART_COLUMNS", "MartOptions", "build_mart", "run", "conform", "contract",
    "TestDataSources", "TableSources",
]
