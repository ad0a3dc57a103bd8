"""Rows, sources and paths that several test modules share."""

import datetime as dt
import decimal

from pyspark.sql import types as T

from paygrid.functions.constants import WHOLE_MARKET
from paygrid.sources.frames import FrameSources
from paygrid.sources.tables import SOURCE_SCHEMAS

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def _frame(spark, schema: str, rows: list[dict]):
    st = spark.createDataFrame([], schema).schema
    out = []
    for r in rows:
        vals = []
        for f in st.fields:
            v = r.get(f.name)
            if v is not None and isinstance(f.dataType, T.DecimalType):
                v = decimal.Decimal(str(v))
            if v is not None and isinstance(f.dataType, T.DateType) and isinstance(v, str):
                v = dt.date.fromisoformat(v)
            vals.append(v)
        out.append(tuple(vals))
    return spark.createDataFrame(out, st)


def base_row(month="2001-01-01", pos=1, loc="L1", **kw):
    row = dict(month_dt=month, position_type_id=pos, location_rk=loc, location_nm="N",
               hrm_job_title_nm="T", agglomeration_name="A", work_schedule_type="full",
               fact_salary_fte_amt=100, target_salary=90, cnt_emp_dist=1,
               perc_25=None, perc_50=None, perc_75=None, cnt_vacancy_site=None,
               company_competitor="C")
    row.update(kw)
    return row


def ext_row(month="2001-01-01", pos=1, agg="A", **kw):
    row = dict(month_dt=month, position_type_id=pos, agglomeration_name=agg, type_agg=WHOLE_MARKET)
    row.update(kw)
    return row


def vac_row(month="2001-01-01", pos=1, agg="A"):
    return dict(month_dt=month, position_type_id=pos, agglomeration_name=agg)


def sources(spark, base, ext=(), vac=(), dim=None):
    dim_df = None if dim is None else _frame(spark, SOURCE_SCHEMAS["dim"], list(dim))
    return FrameSources(
        _frame(spark, SOURCE_SCHEMAS["base"], list(base)), dim_df,
        _frame(spark, SOURCE_SCHEMAS["ext"], list(ext)),
        _frame(spark, SOURCE_SCHEMAS["vac"], list(vac)),
    )


def months(n, start=(2000, 3)):
    y, m = start
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1).isoformat())
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out
