"""Hand fixtures FX1-FX17 (FIXTURES.md §2): tiny inputs, results worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from support import base_row, ext_row, months, sources, vac_row
from paygrid import MartOptions, build_mart
from paygrid.operators import enrich as E
from paygrid.operators.horizon import cutoff_month
from paygrid.plans.contracts import conform, contract
from paygrid.operators.validate import violations

AS_OF = "2001-08-15"


def mart(src, **kw):
    return build_mart(src, MartOptions(as_of=AS_OF, **kw))


def by_month(df):
    return {str(r["week_dt"]): r for r in df.collect()}


def test_fx1_market_fallback_chain(spark):
    src = sources(spark, [base_row("2001-01-01", loc="L1", agglomeration_name="A", perc_50=90),
                          base_row("2001-01-01", loc="L2", agglomeration_name="B", perc_50=90)],
                  ext=[ext_row("2001-01-01", agg="A", perc_50=None, perc_50_3month=110, perc_50_6month=120),
                       ext_row("2001-01-01", agg="B"),
                       ext_row("2001-01-01", agg="A", perc_50=999, type_agg="Food")])
    rows = {r["location_rk"]: r for r in mart(src).collect()}
    assert rows["L1"]["ext_salary_p50"] == 110.0
    assert rows["L2"]["ext_salary_p50"] == 90.0
    assert len(rows) == 2


def test_fx2_null_and_empty_keys_fan_out(spark):
    src = sources(spark, [base_row("2001-01-01", agglomeration_name=None, cnt_vacancy_site=None)],
                  vac=[vac_row("2001-01-01", agg=None)] * 2 + [vac_row("2001-01-01", agg="")] * 3)
    c = cutoff_month(AS_OF)
    joined = E.enrich(E.prepare_base(src.base(), None, c), E.prepare_market(src.ext(), c),
                      E.count_vacancies(src.vac(), c))
    assert sorted(r["vacancy_cnt"] for r in joined.collect()) == [2, 3]
    out = mart(src, bounded=False).collect()
    assert len(out) == 1
    # first of the two joined rows in window order (vacancy_cnt 2 sorts first)
    assert out[0]["ext_vacancy_cnt"] == 2 and out[0]["n_weeks_12w"] == 1
    full = mart(src).collect()
    assert [r.asDict() for r in full] == [r.asDict() for r in out]


@pytest.mark.parametrize("bounded", [True, False])
def test_fx3_rows_frames(spark, bounded):
    ms = months(14)
    src = sources(spark, [base_row(m, cnt_vacancy_site=i + 1) for i, m in enumerate(ms)])
    rows = by_month(mart(src, bounded=bounded))
    r1, r4, r12, r13, r14 = (rows[ms[i]] for i in (0, 3, 11, 12, 13))
    assert r1["lag1_post_cnt"] is None and r1["rolling_mean_post_4w"] is None
    assert r1["n_weeks_12w"] == 1 and r1["avg_vacancy_12w"] == 1.0
    assert r4["rolling_mean_post_4w"] == 2.0
    assert r12["n_weeks_12w"] == 12 and r12["avg_vacancy_12w"] == 6.5
    assert r13["n_weeks_12w"] == 12 and r13["avg_vacancy_12w"] == 7.5
    assert r13["avg_ext_vacancy_w52"] == 7.0 and r13["avg_post_cnt_52w"] == 7.0
    assert r13["vacancy_cnt_yoy_diff"] == 12.0 and r14["vacancy_cnt_yoy_diff"] == 6.0


def test_fx4_offsets_count_rows_not_months(spark):
    src = sources(spark, [base_row("2001-01-01", perc_50=10), base_row("2001-03-01", perc_50=30)])
    rows = by_month(mart(src))
    assert rows["2001-03-01"]["lag1_ext_salary_p50"] == 10.0


def test_fx5_guarded_gaps_and_ratios(spark):
    ms = months(13)
    base = [base_row(m, perc_50=100000, fact_salary_fte_amt=90000) for m in ms]
    base[0]["perc_50"] = 0          # lag-12 p50 = 0 at row 13 -> yoy NULL
    src = sources(spark, base)
    rows = by_month(mart(src))
    assert rows[ms[1]]["gap_to_market_p50"] == Decimal("-0.1")
    assert rows[ms[0]]["gap_to_market_p50"] is None            # p50 = 0
    assert rows[ms[12]]["salary_p50_yoy_diff"] is None          # lag-12 p50 = 0
    assert rows[ms[12]]["gap_yoy_diff"] is None                 # lag-12 gap is NULL
    no_pay = by_month(mart(sources(spark, [base_row(ms[0], perc_50=100, fact_salary_fte_amt=None)])))
    assert no_pay[ms[0]]["gap_to_market_p50"] is None
    # lag-12 gap = 0 -> gap_yoy NULL
    base = [base_row(m, perc_50=100, fact_salary_fte_amt=100) for m in ms]
    base[12]["fact_salary_fte_amt"] = 150
    rows = by_month(mart(sources(spark, base)))
    assert rows[ms[12]]["lag52_gap_to_market_p50"] == 0.0
    assert rows[ms[12]]["gap_yoy_diff"] is None


def test_fx6_completeness_score(spark):
    base = [
        base_row("2001-01-01", loc="L0", perc_50=1, fact_salary_fte_amt=1, cnt_vacancy_site=1),
        base_row("2001-01-01", loc="L1", perc_50=None, fact_salary_fte_amt=1, cnt_vacancy_site=1),
        base_row("2001-01-01", loc="L2", perc_50=None, fact_salary_fte_amt=None, cnt_vacancy_site=1),
        base_row("2001-01-01", loc="L3", perc_50=None, fact_salary_fte_amt=None, cnt_vacancy_site=0),
    ]
    rows = {r["location_rk"]: r for r in mart(sources(spark, base)).collect()}
    assert [rows[f"L{i}"]["nulls_ratio"] for i in range(4)] == [0, Decimal("0.333333333333333333"), Decimal("0.666666666666666667"), 1]
    assert [rows[f"L{i}"]["data_insufficient"] for i in range(4)] == [False, True, True, True]


def test_fx7_vacancy_count_fallback(spark):
    base = [base_row("2001-01-01", loc="L0", cnt_vacancy_site=0, agglomeration_name="A", perc_50=1),
            base_row("2001-01-01", loc="L1", cnt_vacancy_site=None, agglomeration_name="A", perc_50=1),
            base_row("2001-01-01", loc="L2", cnt_vacancy_site=None, agglomeration_name="Z", perc_50=1)]
    vac = [vac_row("2001-01-01", agg="A")] * 5
    rows = {r["location_rk"]: r for r in mart(sources(spark, base, vac=vac)).collect()}
    assert rows["L0"]["ext_vacancy_cnt"] == 0 and rows["L0"]["nulls_ratio"] == Decimal("0.333333333333333333")
    assert rows["L1"]["ext_vacancy_cnt"] == 5
    assert rows["L2"]["ext_vacancy_cnt"] == 0 and rows["L2"]["data_insufficient"]


def test_fx8_sentinel_is_case_sensitive(spark):
    base = [base_row("2001-01-01", loc="L0", company_competitor="не определено"),
            base_row("2001-01-01", loc="L1", company_competitor="Не определено")]
    rows = {r["location_rk"]: r for r in mart(sources(spark, base)).collect()}
    assert rows["L0"]["competitor_nm"] is None
    assert rows["L1"]["competitor_nm"] == "Не определено"


def test_fx9_zero_target_is_null(spark):
    base = [base_row("2001-01-01", loc=f"L{i}", target_salary=v) for i, v in enumerate([0, 5, None])]
    rows = {r["location_rk"]: r for r in mart(sources(spark, base)).collect()}
    assert [rows[f"L{i}"]["target_salary_amt"] for i in range(3)] == [None, 5.0, None]


def test_fx10_staffing_placeholder(spark):
    base = [base_row("2001-01-01", loc=f"L{i}", cnt_emp_dist=v) for i, v in enumerate([3, 0, None])]
    rows = {r["location_rk"]: r for r in mart(sources(spark, base)).collect()}
    assert [rows[f"L{i}"]["normalized_positions"] for i in range(3)] == [100, None, None]


def test_fx11_location_and_title_fallbacks(spark):
    base = [base_row("2001-01-01", pos=1, loc=None, hrm_job_title_nm=None),
            base_row("2001-01-01", pos=2, loc="X", hrm_job_title_nm=None)]
    src = sources(spark, base, dim=[{"id": 1, "name": "Cook"}])
    rows = {r["position_id"]: r for r in mart(src).collect()}
    assert rows[1]["location_rk"] == "" and rows[1]["position_name"] == "Cook"
    assert rows[2]["position_name"] is None


def test_fx12_horizon(spark):
    base = [base_row(d, loc=d) for d in ("2000-01-31", "2000-02-01", "2002-01-01")]
    got = sorted(r["location_rk"] for r in mart(sources(spark, base)).collect())
    assert got == ["2000-02-01", "2002-01-01"]
    assert cutoff_month("2001-08-31") == dt.date(2000, 2, 1)
    assert cutoff_month("2001-08-15") == dt.date(2000, 2, 1)


@pytest.mark.parametrize("bounded", [True, False])
def test_fx13_duplicates_window_then_dedupe(spark, bounded):
    base = [base_row("2001-01-01", work_schedule_type="full", cnt_vacancy_site=1),
            base_row("2001-01-01", work_schedule_type="part", cnt_vacancy_site=3),
            base_row("2001-02-01", work_schedule_type="full", cnt_vacancy_site=5)]
    rows = by_month(mart(sources(spark, base), bounded=bounded))
    assert len(rows) == 2
    jan, feb = rows["2001-01-01"], rows["2001-02-01"]
    assert jan["n_weeks_12w"] == 1                  # survivor is first of its run
    assert feb["n_weeks_12w"] == 3                  # the pair counts as 2 rows
    assert feb["lag1_post_cnt"] == 3                # previous row is the 'part' copy
    assert feb["avg_vacancy_12w"] == 3.0


def test_fx16_contract_rounding_and_check(spark):
    base = [base_row(m, cnt_vacancy_site=v) for m, v in zip(months(2), (2, 3))]
    src = sources(spark, base)
    compact, wide = (conform(build_mart(src, MartOptions(as_of=AS_OF), contract("features", v)), contract("features", v))
                     for v in ("compact", "wide"))
    row_c = {str(r["week_dt"]): r for r in compact.collect()}
    row_w = {str(r["week_dt"]): r for r in wide.collect()}
    second = months(2)[1]
    assert row_c[second]["avg_vacancy_12w"] == 3
    assert str(row_w[second]["avg_vacancy_12w"]) == "2.50000"
    bad = compact.withColumn("competitor_food_cat", F.lit("Other"))
    by_rule = {r["rule"]: r["violations"] for r in violations(bad, contract("features", "compact")).collect()}
    assert by_rule["check:competitor_food_cat"] == 2
    assert "check:competitor_food_cat" not in {
        r["rule"] for r in violations(bad, contract("features", "wide")).collect()}
    ok = {r["rule"]: r["violations"] for r in violations(compact, contract("features", "compact")).collect()}
    assert ok["check:competitor_food_cat"] == 0


def test_fx17_count_ratio_modes(spark):
    ms = months(13)
    base = [base_row(m, cnt_vacancy_site=10 if i == 0 else (15 if i == 12 else 1))
            for i, m in enumerate(ms)]
    src = sources(spark, base)
    integer = by_month(mart(src, count_ratio="integer"))[ms[12]]
    exact = by_month(mart(src, count_ratio="exact"))[ms[12]]
    auto = by_month(mart(src))[ms[12]]
    assert integer["vacancy_cnt_yoy_diff"] == 0.0
    assert exact["vacancy_cnt_yoy_diff"] == 0.5
    assert auto["vacancy_cnt_yoy_diff"] == 0.0


def test_warmup_fills_early_lags_without_writing_history(spark):
    ms = months(26, start=(1999, 1))
    src = sources(spark, [base_row(m, perc_50=100 + i) for i, m in enumerate(ms)])
    plain = by_month(mart(src))
    warm = by_month(mart(src, warmup_months=12))
    assert sorted(plain) == sorted(warm) and min(warm) == "2000-02-01"
    assert plain["2000-02-01"]["lag52_ext_salary_p50"] is None
    assert warm["2000-02-01"]["lag52_ext_salary_p50"] == 100.0 + 1     # 1999-02


def test_dedupe_before_windows(spark):
    base = [base_row("2001-01-01", work_schedule_type="full", cnt_vacancy_site=1),
            base_row("2001-01-01", work_schedule_type="part", cnt_vacancy_site=3),
            base_row("2001-02-01", work_schedule_type="full", cnt_vacancy_site=5)]
    rows = by_month(mart(sources(spark, base), dedupe="before"))
    feb = rows["2001-02-01"]
    assert feb["n_weeks_12w"] == 2 and feb["lag1_post_cnt"] == 1   # the 'part' copy is gone
    assert rows["2001-01-01"]["ext_vacancy_cnt"] == 1


def test_fx5_exact_amounts_and_ties(spark):
    """18-digit pay is unchanged, an exact tie goes up, and what is just below a tie does not."""
    pay = "1234567890123.12345"
    base = [base_row("2001-01-01", loc="big", fact_salary_fte_amt=pay, perc_50="9999999999999.99999", perc_25="1234567890123.12344"),
            base_row("2001-01-01", loc="wide", fact_salary_fte_amt=None, perc_25="0.00001", perc_75="9999999999999.99999"),
            base_row("2001-01-01", loc="tie", fact_salary_fte_amt="1.630805", perc_50="1"),
            base_row("2001-01-01", loc="tie below", fact_salary_fte_amt="0.369195", perc_50="1"),
            base_row("2001-01-01", loc="tie4", fact_salary_fte_amt="1.12345", perc_50="4"),
            base_row("2001-01-01", loc="under", fact_salary_fte_amt="1630804.99999", perc_50="1000000")]
    src = sources(spark, base)
    spec = contract("features", "wide")
    rows = {r["location_rk"]: r for r in conform(build_mart(src, MartOptions(as_of=AS_OF), spec), spec).collect()}
    big = rows["big"]
    assert big["int_salary_tc5"] == Decimal(pay) and big["ext_salary_p50"] == Decimal("9999999999999.99999")
    assert big["gap_to_market_p50"] == Decimal("-0.87654") and big["gap_to_market_p25"] == 0
    assert rows["wide"]["ext_vacancy_sal_range"] == Decimal("9999999999999.99998")
    # amounts have five decimals: 1.630805 arrives as 1.63081
    assert rows["tie"]["gap_to_market_p50"] == Decimal("0.63081") and rows["tie below"]["gap_to_market_p50"] == Decimal("-0.63080")
    assert rows["tie4"]["gap_to_market_p50"] == Decimal("-0.71914")          # -0.7191375
    assert rows["under"]["gap_to_market_p50"] == Decimal("0.63080")          # 0.63080499999
    compact = contract("features", "compact")
    row = {r["location_rk"]: r for r in conform(build_mart(src, MartOptions(as_of=AS_OF), compact), compact).where("location_rk = 'tie4'").collect()}["tie4"]
    assert row["int_salary_tc5"] == Decimal("1.12") and row["nulls_ratio"] == Decimal("0.333333333333333333")


def test_exact_means_and_growth_of_gaps(spark):
    ms = months(13)
    base = [base_row(m, perc_50=300, fact_salary_fte_amt=100 if i else 101, cnt_vacancy_site=i % 2 + (i == 12)) for i, m in enumerate(ms)]
    row = by_month(mart(sources(spark, base)))[ms[12]]
    assert row["gap_to_market_p50"] == Decimal("-0.666666666666666667")
    assert row["lag52_gap_to_market_p50"] == Decimal("-0.663333333333333333")
    # -200/300 over -199/300, less one: 1/199, not the ratio of the rounded gaps
    assert row["gap_yoy_diff"] == Decimal("0.005025125628140704")
    assert row["avg_post_cnt_52w"] == Decimal("0.538461538461538462")
