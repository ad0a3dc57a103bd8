"""Properties of the mart: keys, bounds, skew safety, partition independence."""

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL, base_row, months, sources, vac_row
from paygrid import MartOptions, TestDataSources, build_mart
from paygrid.operators.temporal import LOOKBACK

AS_OF = "2001-08-15"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def small_mart(spark):
    return build_mart(TestDataSources(spark, SF_SMALL, with_copies=True), MartOptions(as_of=AS_OF))


def test_key_unique_and_bounded_by_base(spark, small_mart):
    keys = ["week_dt", "position_id", "location_rk"]
    assert small_mart.groupBy(*keys).count().where("count > 1").count() == 0
    base = TestDataSources(spark, SF_SMALL, with_copies=True).base()
    assert small_mart.count() <= base.count()


def test_insufficient_iff_any_missing(small_mart):
    bad = small_mart.where(F.col("data_insufficient") != (F.col("nulls_ratio") > 0))
    assert bad.count() == 0


def test_hot_run_bounded_equals_plain(spark):
    """One (series, month) holds far more rows than any frame looks back."""
    ms = months(16)
    base = []
    for i, m in enumerate(ms):
        copies = 4 * LOOKBACK if i in (5, 13) else 2
        for k in range(copies):
            base.append(base_row(m, work_schedule_type=f"s{k:04d}", cnt_vacancy_site=(i * 7 + k) % 23,
                                 perc_50=1000 + 10 * i + k, perc_25=500 + k, fact_salary_fte_amt=900 + k))
    base += [base_row(m, loc="L2", cnt_vacancy_site=i) for i, m in enumerate(ms)]
    vac = [vac_row(ms[3])] * 3 + [vac_row(ms[5], agg="")] * 2
    src = sources(spark, base, vac=vac)
    bounded = build_mart(src, MartOptions(as_of=AS_OF, bounded=True))
    plain = build_mart(src, MartOptions(as_of=AS_OF, bounded=False))
    assert rows_of(bounded) == rows_of(plain)
    assert bounded.count() == 32


def test_partition_count_does_not_matter(spark):
    src = TestDataSources(spark, SF_SMALL)
    before = rows_of(build_mart(src, MartOptions(as_of=AS_OF)))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = rows_of(build_mart(TestDataSources(spark, SF_SMALL), MartOptions(as_of=AS_OF)))
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        many = rows_of(build_mart(TestDataSources(spark, SF_SMALL), MartOptions(as_of=AS_OF)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert before == one == many


def test_input_order_does_not_matter(spark):
    ms = months(14)
    base = [base_row(m, work_schedule_type=s, cnt_vacancy_site=i + len(s))
            for i, m in enumerate(ms) for s in ("a", "bb")]
    a = build_mart(sources(spark, base), MartOptions(as_of=AS_OF))
    b = build_mart(sources(spark, list(reversed(base))), MartOptions(as_of=AS_OF))
    assert rows_of(a) == rows_of(b)


def test_hot_run_of_identical_rows(spark):
    """A run made of many identical rows (ties in every column) compresses exactly."""
    ms = months(14)
    base = []
    for i, m in enumerate(ms):
        copies = 3 * LOOKBACK if i == 6 else 1
        base += [base_row(m, cnt_vacancy_site=i % 5, perc_50=100 + i)] * copies
    base += [base_row(ms[6], work_schedule_type="zz", cnt_vacancy_site=9)] * 2
    src = sources(spark, base)
    bounded = build_mart(src, MartOptions(as_of=AS_OF, bounded=True))
    plain = build_mart(src, MartOptions(as_of=AS_OF, bounded=False))
    assert rows_of(bounded) == rows_of(plain)
    later = [r for r in bounded.collect() if str(r["week_dt"]) == ms[8]][0]
    assert later["n_weeks_12w"] == 12 and later["lag1_post_cnt"] == 7 % 5


@pytest.mark.parametrize("block_months", [1, 2, 5, 40])
def test_blocks_equal_the_plain_window(spark, block_months):
    """Long series with gaps, hot months, and months without rows between blocks; every block looks back over several others."""
    from paygrid.operators.metrics import settle_fractions
    from paygrid.operators.temporal import add_series_features
    rows = spark.range(0, 3000, 1, 4).selectExpr(
        "add_months(date'1990-01-01', cast(pmod(hash(id), 150) * if(id % 3 = 0, 1, 2) as int)) as week_dt", "cast(id % 3 as int) as position_id",
        "if(id % 2 = 0, 'A', '') as location_rk", "cast(id as string) as work_schedule_type", "cast(if(id % 11 = 0, null, id % 7) as int) as cnt_vacancy_site",
        *[f"cast(id % {k} as decimal(18,5)) as {c}" for k, c in ((13, "market_perc_50"), (17, "market_perc_25"))])
    hot = rows.where("position_id = 1").selectExpr("date'1994-05-01' as week_dt", *[c for c in rows.columns if c != "week_dt"])
    rows = rows.unionByName(hot)
    operators = ("lag_prev", "lag_year", "rolling_12", "trailing_3", "rolling_52")
    plain = rows_of(settle_fractions(add_series_features(rows, operators, bounded=False)))
    blocks = settle_fractions(add_series_features(rows, operators, block_months=block_months))
    assert rows_of(blocks) == plain and len(plain) > 300


def test_a_long_series_is_windowed_by_several_tasks(spark):
    from paygrid.operators.temporal import HOME, LOOKBACK, in_blocks, placed_runs
    rows = spark.range(1200).selectExpr("add_months(date'1900-01-01', cast(id as int)) as week_dt", "1 as position_id", "'A' as location_rk", "id as cnt_vacancy_site")
    cut = in_blocks(placed_runs(rows), months=100)
    sizes = {r[0]: r[1] for r in cut.groupBy(HOME).count().collect()}
    assert len(sizes) >= 12 and max(sizes.values()) <= 100 + LOOKBACK
