"""Typed table contracts and the projection that conforms a batch to them.

Two variants exist for each table: ``compact`` (narrower types: NUMERIC(14,2),
INT counts and rounded INT averages) and ``wide`` (NUMERIC(18,5) throughout,
fractions kept).  ``wide`` is the default.  Unbounded NUMERIC maps to
decimal(38,18), 20 digits before the point and 18 after it.

Parquet tables accept neither primary keys nor CHECK constraints and store
NULL in NOT NULL columns, so the constraints live here as data and are
enforced by :mod:`paygrid.operators.validate` before any write.

Rounding: amounts are decimals, and ratios arrive already rounded to the
contract's scale (``build_mart(..., spec)``), once and half away from zero, so
an exact tie goes up and nothing else does.  Fractions assigned to integral
columns are rounded the same way, not cut.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import FOOD_CATEGORIES

NUMERIC = "decimal(38,18)"

# FIXED VALUES: column names, order and types of the three tables, as
# declared by the job (one line per column: name, type, optional NOT NULL).
_FEATURES_COMPACT = """
week_dt date not null
position_id int not null
location_rk string not null
location_nm string
position_name string
ext_salary_mean decimal(14,2)
ext_salary_p25 decimal(14,2)
ext_salary_p50 decimal(14,2)
ext_salary_p75 decimal(14,2)
ext_vacancy_cnt int
ext_vacancy_hrm int
ext_vacancy_sal_range decimal(14,2)
dismissal_int_reason_group_nm string
dismissal_cnt int
turnover_coeff decimal(18,5)
required_positions int
occupied_positions int
normalized_positions int
headcount_gap int
average_inhouse_headcount_coeff decimal(18,5)
average_headcount_coeff decimal(18,5)
int_salary_tc5 decimal(14,2)
target_salary_amt numeric
competitor_nm string
competitor_type string
competitor_food_cat string
post_cnt int
agglomeration_nm string
gap_to_market_p50 decimal(18,5)
gap_to_market_p25 decimal(18,5)
lag1_ext_salary_p50 numeric
lag1_ext_salary_p25 numeric
lag1_turnover numeric
rolling_mean_turnover_4w numeric
lag1_post_cnt numeric
rolling_mean_post_4w numeric
n_weeks_12w int
avg_vacancy_12w int
avg_post_cnt_12w int
lag52_ext_salary_p50 numeric
salary_p50_yoy_diff numeric
avg_ext_vacancy_w52 int
avg_post_cnt_52w int
vacancy_cnt_yoy_diff numeric
lag52_turnover_coeff numeric
turnover_yoy_diff numeric
lag52_gap_to_market_p50 numeric
lag52_gap_to_market_p25 numeric
gap_yoy_diff numeric
nulls_ratio numeric
data_insufficient boolean
inserted_at timestamp not null
"""

_FEATURES_WIDE = """
week_dt date not null
position_id int not null
location_rk string not null
location_nm string
position_name string
ext_salary_mean decimal(18,5)
ext_salary_p25 decimal(18,5)
ext_salary_p50 decimal(18,5)
ext_salary_p75 decimal(18,5)
ext_vacancy_cnt decimal(18,5)
ext_vacancy_hrm decimal(18,5)
ext_vacancy_sal_range decimal(18,5)
turnover_coeff decimal(18,5)
required_positions decimal(18,5)
occupied_positions decimal(18,5)
normalized_positions decimal(18,5)
headcount_gap decimal(18,5)
average_inhouse_headcount_coeff decimal(18,5)
average_headcount_coeff decimal(18,5)
dismissal_int_reason_group_nm string
dismissal_cnt decimal(18,5)
int_salary_tc5 decimal(18,5)
target_salary_amt decimal(18,5)
competitor_nm string
competitor_type string
competitor_food_cat string
post_cnt decimal(18,5)
agglomeration_nm string
gap_to_market_p50 decimal(18,5)
gap_to_market_p25 decimal(18,5)
lag1_ext_salary_p50 decimal(18,5)
lag1_ext_salary_p25 decimal(18,5)
lag1_turnover decimal(18,5)
rolling_mean_turnover_4w decimal(18,5)
n_weeks_12w int
avg_vacancy_12w decimal(18,5)
lag1_post_cnt decimal(18,5)
rolling_mean_post_4w decimal(18,5)
avg_post_cnt_12w decimal(18,5)
lag52_ext_salary_p50 decimal(18,5)
salary_p50_yoy_diff decimal(18,5)
avg_ext_vacancy_w52 decimal(18,5)
avg_post_cnt_52w decimal(18,5)
vacancy_cnt_yoy_diff decimal(18,5)
lag52_turnover_coeff decimal(18,5)
turnover_yoy_diff decimal(18,5)
lag52_gap_to_market_p50 decimal(18,5)
lag52_gap_to_market_p25 decimal(18,5)
gap_yoy_diff decimal(18,5)
nulls_ratio decimal(10,5)
data_insufficient boolean
inserted_at timestamp not null
"""

_FLAGS_COMPACT = """
week_dt date not null
position_id int not null
location_rk string not null
location_nm string
position_name string
problem_flg boolean
problem_trend boolean
problem_normalized_positions boolean
iso_flag boolean
iso_score double
vacancy_spike_ext_flg boolean
salary_trend_flg boolean
salary_gap_neg_flg boolean
salary_gap_pos_flg boolean
vacancy_gap_int_flg boolean
turnover_trend_flg boolean
different_vacancy_ext_int boolean
competition_intense_flg boolean
int_salary_tc5 numeric
target_salary_amt numeric
ext_salary_p25 numeric
ext_salary_p50 numeric
ext_salary_p75 numeric
salary_delta_p50 numeric
salary_delta_p25 numeric
salary_range numeric
salary_std_4w numeric
ext_salary_p50_ema numeric
competitor_nm string
competitor_type string
competitor_food_cat string
normalized_positions numeric
headcount_gap_share numeric
average_inhouse_headcount_coeff numeric
average_headcount_coeff numeric
required_positions numeric
occupied_positions numeric
vac_ext_int_ratio numeric
salary_p50_yoy_diff numeric
vacancy_cnt_yoy_diff numeric
turnover_yoy_diff numeric
is_december boolean
is_january boolean
is_q1 boolean
is_q4 boolean
gap_neg_robust_flg boolean
gap_pos_robust_flg boolean
headcount_gap_robust_flg boolean
vac_ext_int_robust_flg boolean
turnover_robust_flg boolean
created_at timestamp
"""

_FLAGS_WIDE = """
week_dt date not null
position_id int not null
location_rk string not null
location_nm string
position_name string
salary_trend_flg smallint
salary_gap_neg_flg boolean
salary_gap_pos_flg boolean
vacancy_spike_ext_flg boolean
vacancy_gap_int_flg boolean
turnover_trend_flg smallint
competition_intense_flg boolean
problem_flg boolean
problem_trend smallint
problem_normalized_positions boolean
different_vacancy_ext_int boolean
int_salary_tc5 decimal(18,5)
target_salary_amt decimal(18,5)
ext_salary_p25 decimal(18,5)
ext_salary_p50 decimal(18,5)
ext_salary_p75 decimal(18,5)
salary_delta_p50 decimal(18,5)
salary_delta_p25 decimal(18,5)
iso_score decimal(18,5)
iso_flag boolean
vac_ext_int_ratio decimal(18,5)
headcount_gap_share decimal(18,5)
average_inhouse_headcount_coeff decimal(18,5)
average_headcount_coeff decimal(18,5)
salary_p50_yoy_diff decimal(18,5)
vacancy_cnt_yoy_diff decimal(18,5)
turnover_yoy_diff decimal(18,5)
salary_range decimal(18,5)
salary_std_4w decimal(18,5)
ext_salary_p50_ema decimal(18,5)
is_december boolean
is_january boolean
is_q1 boolean
is_q4 boolean
created_at timestamp not null
competitor_nm string
competitor_type string
competitor_food_cat string
required_positions decimal(18,5)
occupied_positions decimal(18,5)
normalized_positions decimal(18,5)
gap_neg_robust_flg boolean
gap_pos_robust_flg boolean
headcount_gap_robust_flg boolean
vac_ext_int_robust_flg boolean
turnover_robust_flg boolean
"""

_RECOMMENDATIONS_COMPACT = """
week_dt date not null
position_id int not null
position_name string
location_rk string not null
location_nm string
agglomeration_name string
work_schedule_type string
problem_type string not null
severity smallint not null
text_ru string
meta_json variant
fact_salary_fte_amt decimal(14,2)
market_perc_50 decimal(14,2)
gap_to_market_p50 decimal(18,5)
cnt_vacancy_site int
vacancy_cnt int
target_salary decimal(14,2)
created_at timestamp not null
"""

_RECOMMENDATIONS_WIDE = """
week_dt date not null
position_id int not null
position_name string
location_rk string not null
location_nm string
agglomeration_name string
work_schedule_type string
problem_type string not null
severity smallint not null
text_ru string
meta_json variant
fact_salary_fte_amt decimal(18,5)
market_perc_50 decimal(18,5)
gap_to_market_p50 decimal(18,5)
cnt_vacancy_site int
vacancy_cnt int
target_salary decimal(18,5)
created_at timestamp not null
"""

_SIMPLE_TYPES = {
    "date": T.DateType(), "int": T.IntegerType(), "smallint": T.ShortType(),
    "bigint": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "double": T.DoubleType(), "timestamp": T.TimestampType(), "variant": T.VariantType(),
}


def _type(name: str) -> T.DataType:
    if name == "numeric":
        name = NUMERIC
    if name.startswith("decimal("):
        p, s = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    return _SIMPLE_TYPES[name]


def _schema(spec: str) -> T.StructType:
    fields = []
    for line in spec.strip().splitlines():
        name, type_name, *rest = line.split()
        fields.append(T.StructField(name, _type(type_name), nullable=rest != ["not", "null"]))
    return T.StructType(fields)


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    checks: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


_NOW = "now"
_FEATURE_KEYS = ("week_dt", "position_id", "location_rk")

CONTRACTS: dict[tuple[str, str], Contract] = {
    ("features", "compact"): Contract(
        "features", _schema(_FEATURES_COMPACT), _FEATURE_KEYS,
        checks={"competitor_food_cat": FOOD_CATEGORIES}, defaults={"inserted_at": _NOW}),
    ("features", "wide"): Contract(
        "features", _schema(_FEATURES_WIDE), _FEATURE_KEYS,
        defaults={"inserted_at": _NOW, "location_rk": ""}),
    ("flags", "compact"): Contract(
        "flags", _schema(_FLAGS_COMPACT), _FEATURE_KEYS, defaults={"created_at": _NOW}),
    ("flags", "wide"): Contract(
        "flags", _schema(_FLAGS_WIDE), _FEATURE_KEYS,
        defaults={"created_at": _NOW, "location_rk": ""}),
    ("recommendations", "compact"): Contract(
        "recommendations", _schema(_RECOMMENDATIONS_COMPACT), (*_FEATURE_KEYS, "problem_type"),
        defaults={"created_at": _NOW, "severity": 1}),
    ("recommendations", "wide"): Contract(
        "recommendations", _schema(_RECOMMENDATIONS_WIDE), (*_FEATURE_KEYS, "problem_type"),
        defaults={"created_at": _NOW, "severity": 1, "location_rk": ""}),
}


def contract(table: str = "features", variant: str = "wide") -> Contract:
    return CONTRACTS[(table, variant)]


def _default(value, data_type: T.DataType, now: Column) -> Column:
    if value == _NOW:
        return now.cast(data_type)
    return F.lit(value).cast(data_type)


def _cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    # Assigning a fraction to an integral column rounds (half away from zero).
    if isinstance(target, T.IntegralType) and isinstance(source, (T.FractionalType,)):
        return F.round(c).cast(target)
    return c.cast(target)


def conform(df: DataFrame, spec: Contract, now: Column | None = None,
            drop: tuple[str, ...] = ()) -> DataFrame:
    """Insert-by-name projection: contract order and types, defaults for
    missing columns (``now`` for timestamps), nothing else.

    ``drop`` removes contract columns from the output (e.g. ``inserted_at``
    when comparing results across engines).
    """
    now = F.current_timestamp() if now is None else now
    extra = set(df.columns) - set(spec.columns)
    if extra:
        raise ValueError(f"columns not in the {spec.name} contract: {sorted(extra)}")
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = []
    for f in spec.schema.fields:
        if f.name in drop:
            continue
        if f.name in types:
            cols.append(_cast(F.col(f.name), types[f.name], f.dataType).alias(f.name))
        elif f.name in spec.defaults:
            cols.append(_default(spec.defaults[f.name], f.dataType, now).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty_table(spark, spec: Contract) -> DataFrame:
    return spark.createDataFrame([], spec.schema)
