"""Brute-force model of the job in plain Python, compared with Spark on random inputs.

The model follows the job's rules literally on lists of dicts: horizon,
dimension lookup, market fallback chain, vacancy counts, null-as-empty left
joins with fan-out, row-offset windows in the tie order, first row per key,
final formulas.  Hypothesis generates small inputs full of NULLs, zeros,
'' vs NULL keys and duplicates.
"""

import datetime as dt
import decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from support import sources
from paygrid import MartOptions, build_mart
from paygrid.functions.constants import COMPETITOR_UNKNOWN, WHOLE_MARKET
from paygrid.operators.temporal import TIE_ORDER

AS_OF = dt.date(2001, 8, 15)
CUTOFF = dt.date(2000, 2, 1)
MONTHS = [dt.date(2000, 1, 1), dt.date(2000, 2, 1), dt.date(2000, 3, 1), dt.date(2000, 5, 1),
          dt.date(2000, 6, 1), dt.date(2000, 9, 1), dt.date(2001, 2, 1), dt.date(2001, 3, 1)]


def _num(x):
    return None if x is None else decimal.Decimal(str(x))


def _exact(num, den, minus=0):
    """num / den - minus as a fraction."""
    return Fraction(num) / Fraction(den) - minus


def _rounded(x, scale=18):
    """A fraction as a decimal, half away from zero."""
    if x is None:
        return None
    q, r = divmod(abs(x).numerator * 10 ** scale, abs(x).denominator)
    q += 2 * r >= abs(x).denominator
    return decimal.Decimal(-q if x < 0 else q).scaleb(-scale, decimal.Context(prec=60))


def _months_before(day: dt.date, months: int) -> dt.date:
    total = day.year * 12 + day.month - 1 - months
    return dt.date(total // 12, total % 12 + 1, 1)


def model_mart(base, dim, ext, vac, exact=False, dedupe_before=False, warmup=0):
    read_from = _months_before(CUTOFF, warmup)
    names = {}
    for d in dim:
        names.setdefault(d["id"], []).append(d["name"])
    pay = []
    for r in base:
        if r["month_dt"] is None or r["month_dt"] < read_from:
            continue
        for name in names.get(r["position_type_id"], [None]):
            pay.append(dict(
                week_dt=r["month_dt"].replace(day=1), position_id=r["position_type_id"],
                location_rk=r["location_rk"] if r["location_rk"] is not None else "",
                location_nm=r["location_nm"],
                position_name=r["hrm_job_title_nm"] if r["hrm_job_title_nm"] is not None else name,
                agglomeration_nm=r["agglomeration_name"], work_schedule_type=r["work_schedule_type"],
                int_salary_tc5=_num(r["fact_salary_fte_amt"]),
                target_salary_amt=None if r["target_salary"] in (None, 0) else _num(r["target_salary"]),
                cnt_emp_dist=r["cnt_emp_dist"], perc_25=_num(r["perc_25"]), perc_50=_num(r["perc_50"]),
                perc_75=_num(r["perc_75"]), market_cnt=r["cnt_vacancy_site"],
                company_competitor=r["company_competitor"]))
    market = []
    for e in ext:
        if e["month_dt"] < read_from or e["type_agg"] != WHOLE_MARKET:
            continue
        pick = lambda p: next((_num(e[k]) for k in (p, p + "_3month", p + "_6month") if e[k] is not None), None)
        market.append(dict(key=(e["month_dt"].replace(day=1), e["position_type_id"], e["agglomeration_name"] or ""),
                           p25=pick("perc_25"), p50=pick("perc_50"), p75=pick("perc_75"),
                           cnt=e["cnt_vacancy_site"]))
    counts = {}
    for v in vac:
        if v["month_dt"] >= read_from:
            k = (v["month_dt"].replace(day=1), v["position_type_id"], v["agglomeration_name"])
            counts[k] = counts.get(k, 0) + 1
    joined = []
    for p in pay:
        key = (p["week_dt"], p["position_id"], p["agglomeration_nm"] or "")
        ms = [m for m in market if m["key"] == key] or [None]
        vs = [c for (mo, po, ag), c in counts.items() if (mo, po, ag or "") == key] or [None]
        for m in ms:
            for c in vs:
                j = {k: p[k] for k in ("week_dt", "position_id", "location_rk", "location_nm",
                                       "position_name", "agglomeration_nm", "work_schedule_type",
                                       "int_salary_tc5", "target_salary_amt", "cnt_emp_dist",
                                       "company_competitor")}
                j["market_perc_25"] = m["p25"] if m and m["p25"] is not None else p["perc_25"]
                j["market_perc_50"] = m["p50"] if m and m["p50"] is not None else p["perc_50"]
                j["market_perc_75"] = m["p75"] if m and m["p75"] is not None else p["perc_75"]
                j["cnt_vacancy_site"] = m["cnt"] if m and m["cnt"] is not None else p["market_cnt"]
                j["vacancy_cnt"] = c if c is not None else 0
                for g, mk in (("gap_to_market_p50", "market_perc_50"), ("gap_to_market_p25", "market_perc_25")):
                    mv, own = j[mk], j["int_salary_tc5"]
                    j[g] = _exact(own - mv, mv) if mv is not None and mv > 0 and own is not None else None
                joined.append(j)
    order = ["week_dt", *TIE_ORDER, "gap_to_market_p50", "gap_to_market_p25"]
    sort_key = lambda r: tuple((r[c] is not None, r[c]) for c in order)  # NULLs first
    series = {}
    for j in joined:
        series.setdefault((j["position_id"], j["location_rk"]), []).append(j)
    out = {}
    for rows in series.values():
        rows.sort(key=sort_key)
        months = {}
        for r in rows:
            months.setdefault(r["week_dt"], []).append(r)
        # the first row of a month, then its others from the last
        rows[:] = [r for own in months.values() for r in (own[:1] if dedupe_before else [own[0], *own[:0:-1]])]
        for i, r in enumerate(rows):
            if i > 0 and rows[i - 1]["week_dt"] == r["week_dt"]:
                continue
            if r["week_dt"] < CUTOFF:      # read as warm-up history only
                continue
            back = lambda n, c: rows[i - n][c] if i - n >= 0 else None
            def avg(lo, hi):
                vals = [rows[k]["cnt_vacancy_site"] for k in range(max(0, i + lo), i + hi + 1)
                        if k >= 0 and rows[k]["cnt_vacancy_site"] is not None]
                return _rounded(_exact(sum(vals), len(vals))) if vals else None
            p50, l12 = r["market_perc_50"], back(12, "market_perc_50")
            c, c12 = r["cnt_vacancy_site"], back(12, "cnt_vacancy_site")
            g, g12 = r["gap_to_market_p50"], back(12, "gap_to_market_p50")
            vcount = c if c is not None else r["vacancy_cnt"]
            missing = (p50 is None) + (r["int_salary_tc5"] is None) + (vcount == 0)
            out[(r["week_dt"], r["position_id"], r["location_rk"])] = dict(
                position_name=r["position_name"], ext_salary_p50=p50, ext_salary_p25=r["market_perc_25"],
                ext_vacancy_cnt=vcount,
                ext_vacancy_sal_range=(r["market_perc_75"] - r["market_perc_25"]
                                       if r["market_perc_75"] is not None and r["market_perc_25"] is not None else None),
                normalized_positions=100 if r["cnt_emp_dist"] is not None and r["cnt_emp_dist"] > 0 else None,
                target_salary_amt=r["target_salary_amt"],
                competitor_nm=None if r["company_competitor"] == COMPETITOR_UNKNOWN else r["company_competitor"],
                gap_to_market_p50=_rounded(g), gap_to_market_p25=_rounded(r["gap_to_market_p25"]),
                lag1_ext_salary_p50=back(1, "market_perc_50"), lag1_post_cnt=back(1, "cnt_vacancy_site"),
                n_weeks_12w=min(i + 1, 12), avg_vacancy_12w=avg(-11, 0), rolling_mean_post_4w=avg(-3, -1),
                avg_post_cnt_52w=avg(-51, 0), lag52_ext_salary_p50=l12,
                salary_p50_yoy_diff=_rounded(_exact(p50, l12, 1)) if l12 is not None and l12 != 0 and p50 is not None else None,
                vacancy_cnt_yoy_diff=((_rounded(_exact(c, c12, 1)) if exact else c // c12 - 1)
                                      if c12 is not None and c12 != 0 and c is not None else None),
                lag52_gap_to_market_p50=_rounded(g12),
                gap_yoy_diff=_rounded(_exact(g, g12, 1)) if g12 is not None and g12 != 0 and g is not None else None,
                nulls_ratio=_rounded(_exact(missing, 3)), data_insufficient=missing > 0)
    return out


maybe = lambda s: st.one_of(st.none(), s)
money = maybe(st.sampled_from([0, 50, 90, 100, 120, 1000.5, 0.00007, 3333.33333]))
base_rows = st.lists(st.fixed_dictionaries(dict(
    month_dt=st.sampled_from(MONTHS), position_type_id=st.sampled_from([1, 2]),
    location_rk=maybe(st.sampled_from(["A", "B"])), location_nm=st.just("N"),
    hrm_job_title_nm=maybe(st.just("T")), agglomeration_name=maybe(st.sampled_from(["X", ""])),
    work_schedule_type=st.sampled_from(["full", "part"]), fact_salary_fte_amt=money,
    target_salary=money, cnt_emp_dist=maybe(st.sampled_from([0, 1, 3])),
    perc_25=money, perc_50=money, perc_75=money, cnt_vacancy_site=maybe(st.integers(0, 4)),
    company_competitor=maybe(st.sampled_from([COMPETITOR_UNKNOWN, "Не определено", "C"])))),
    min_size=1, max_size=40)
ext_rows = st.lists(st.fixed_dictionaries(dict(
    month_dt=st.sampled_from(MONTHS), position_type_id=st.sampled_from([1, 2]),
    agglomeration_name=maybe(st.sampled_from(["X", ""])),
    perc_25=money, perc_50=money, perc_75=money, perc_25_3month=money, perc_50_3month=money,
    perc_75_3month=money, perc_25_6month=money, perc_50_6month=money, perc_75_6month=money,
    cnt_vacancy_site=maybe(st.integers(0, 4)), type_agg=st.sampled_from([WHOLE_MARKET, "Food"]))),
    max_size=8)
vac_rows = st.lists(st.fixed_dictionaries(dict(
    month_dt=st.sampled_from(MONTHS), position_type_id=st.sampled_from([1, 2]),
    agglomeration_name=maybe(st.sampled_from(["X", ""])))), max_size=12)


MODES = [
    dict(bounded=True), dict(bounded=False),
    dict(bounded=True, count_ratio="exact"), dict(bounded=True, dedupe="before"),
    dict(bounded=True, warmup_months=2), dict(bounded=True, block_months=2),
]


@pytest.mark.parametrize("mode", MODES, ids=lambda m: ",".join(f"{k}={v}" for k, v in m.items()))
@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(base=base_rows, ext=ext_rows, vac=vac_rows)
def test_spark_matches_brute_force_model(spark, mode, base, ext, vac):
    dim = [{"id": 1, "name": "Cook"}]
    src = sources(spark, base, ext=ext, vac=vac, dim=dim)
    got = {(r["week_dt"], r["position_id"], r["location_rk"]): r.asDict()
           for r in build_mart(src, MartOptions(as_of=AS_OF, **mode)).collect()}
    want = model_mart(base, dim, ext, vac, exact=mode.get("count_ratio") == "exact",
                      dedupe_before=mode.get("dedupe") == "before",
                      warmup=mode.get("warmup_months", 0))
    assert set(got) == set(want)
    for key, expected in want.items():
        for col, value in expected.items():
            assert got[key][col] == value, (key, col, got[key][col], value)
