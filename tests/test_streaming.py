"""File-arrival trigger: new vacancy files inside the horizon refresh the mart."""

import datetime as dt

from support import SF_SMALL, vac_row, _frame
from paygrid import MartOptions, TableSources
from paygrid.session import scratch_path
from paygrid.sources.tables import SOURCE_SCHEMAS
from paygrid.sources.testdata import TestDataSources
from paygrid.streaming.refresh import refresh_on_arrival

AS_OF = "2001-08-15"


def test_refresh_runs_once_per_relevant_batch(spark):
    src = TestDataSources(spark, SF_SMALL)
    folders = {name: scratch_path(spark, f"s-{name}") for name in ("base", "dim", "ext", "vac")}
    src.base().write.parquet(folders["base"])
    src.dim().write.parquet(folders["dim"])
    src.ext().write.parquet(folders["ext"])
    src.vac().write.parquet(folders["vac"])
    tables = lambda: TableSources(spark, **folders)
    target, log, ckpt = (scratch_path(spark, n) for n in ("s-target", "s-log", "s-ckpt"))

    def start():
        q = refresh_on_arrival(spark, folders["vac"], SOURCE_SCHEMAS["vac"], tables, target, ckpt,
                               log, MartOptions(as_of=AS_OF))
        q.awaitTermination(300)
        return q

    start()
    first = spark.read.parquet(target).count()
    assert first == 232
    steps = spark.read.parquet(log).count()
    assert steps == 2
    # a file outside the horizon: no run
    _frame(spark, SOURCE_SCHEMAS["vac"], [vac_row("1999-01-05")]).write.mode("append").parquet(folders["vac"])
    start()
    assert spark.read.parquet(log).count() == 2
    # a file inside the horizon: one more run, same keys
    _frame(spark, SOURCE_SCHEMAS["vac"], [vac_row("2001-03-05", pos=1, agg="ASIA")]) \
        .write.mode("append").parquet(folders["vac"])
    start()
    assert spark.read.parquet(log).count() == 4
    assert spark.read.parquet(target).count() == first
    assert dt.date(2000, 2, 1) == min(r[0] for r in spark.read.parquet(target).select("week_dt").collect())
