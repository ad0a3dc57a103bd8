"""Invariants of the test-data adapters (they plant the cases the queries exercise)."""

from pyspark.sql import functions as F

from support import SF_MID, SF_SMALL
from paygrid.functions.constants import WHOLE_MARKET
from paygrid.sources.tables import SOURCE_SCHEMAS
from paygrid.sources.testdata import TestDataSources


def _types(schema_ddl: str, spark):
    return {f.name: f.dataType for f in spark.createDataFrame([], schema_ddl).schema.fields}


def test_sources_have_the_declared_schemas(spark):
    src = TestDataSources(spark, SF_SMALL)
    for kind, df in (("base", src.base()), ("dim", src.dim()), ("ext", src.ext()), ("vac", src.vac())):
        assert {f.name: f.dataType for f in df.schema.fields} == _types(SOURCE_SCHEMAS[kind], spark), kind


def test_planted_cases_are_present(spark):
    src = TestDataSources(spark, SF_MID)   # the scale the driver's oracle gate uses
    base = src.base()
    assert base.where(F.col("location_rk").isNull()).count() > 0          # '' location key
    assert base.where(F.col("agglomeration_name").isNull()).count() > 0   # NULL agglomeration
    assert base.where(F.col("target_salary") == 0).count() > 0            # zero target
    assert base.where(F.col("perc_50").isNull()).count() > 0
    assert {r[0] for r in base.select("company_competitor").distinct().collect()} >= {
        "не определено", "Не определено"}
    ext = src.ext()
    assert {r[0] for r in ext.select("type_agg").distinct().collect()} == {WHOLE_MARKET, "Food"}
    assert ext.where(F.col("perc_50").isNull() & F.col("perc_50_3month").isNotNull()).count() > 0
    vac = src.vac()
    aggs = {r[0] for r in vac.select("agglomeration_name").distinct().collect()}
    assert None in aggs and "" in aggs


def test_copies_double_the_base(spark):
    one = TestDataSources(spark, SF_SMALL).base()
    two = TestDataSources(spark, SF_SMALL, with_copies=True).base()
    assert two.count() == 2 * one.count()
    assert {r[0] for r in two.select("work_schedule_type").distinct().collect()} == {"full", "part"}


def test_since_only_prunes_earlier_rows(spark):
    import datetime as dt
    src = TestDataSources(spark, SF_SMALL)
    cut = dt.date(2000, 2, 1)
    for full, pruned in ((src.base(), src.base(since=cut)), (src.ext(), src.ext(since=cut)),
                         (src.vac(), src.vac(since=cut))):
        kept = full.where(F.col("month_dt") >= F.lit(cut))
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, pruned.collect()))
