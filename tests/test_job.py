"""The whole job: upsert semantics (FX14), repeated runs (FX15), run log."""

import datetime as dt

from pyspark.sql import functions as F

from support import base_row, months
from support import sources as make_sources
from paygrid import MartOptions
from paygrid.functions.constants import JOB_NAME, STEP_DONE, STEP_STARTED
from paygrid.plans.job import run
from paygrid.session import scratch_path
from paygrid.sources.sinks import merge_by_key, read_log

KEYS = ["week_dt", "position_id", "location_rk"]


def test_fx14_merge_by_key(spark):
    t = spark.createDataFrame([("A", 1, "old"), ("B", 1, "old")], "k string, v int, tag string")
    b = spark.createDataFrame([("B", 2, "new"), ("C", 2, "new")], "k string, v int, tag string")
    got = sorted(tuple(r) for r in merge_by_key(t, b, ["k"]).collect())
    assert got == [("A", 1, "old"), ("B", 2, "new"), ("C", 2, "new")]


def test_job_upsert_is_idempotent_and_logged(spark):
    src = make_sources(spark, [base_row(m, cnt_vacancy_site=i + 1, perc_50=100 + i)
                               for i, m in enumerate(months(14))])
    target, log = scratch_path(spark, "t-features"), scratch_path(spark, "t-log")
    ts1, ts2 = dt.datetime(2001, 8, 15, 1), dt.datetime(2001, 8, 15, 2)
    run(spark, src, target, log, MartOptions(as_of="2001-08-15"), run_ts=ts1)
    first = spark.read.parquet(target)
    n1 = first.count()
    snapshot = sorted(tuple(r) for r in first.drop("inserted_at").collect())
    run(spark, src, target, log, MartOptions(as_of="2001-08-15"), run_ts=ts2)
    second = spark.read.parquet(target)
    assert second.count() == n1 == 14
    assert sorted(tuple(r) for r in second.drop("inserted_at").collect()) == snapshot
    assert {r[0] for r in second.select("inserted_at").distinct().collect()} == {ts2}
    steps = [r["description_step"] for r in read_log(spark, log).orderBy("logged_at").collect()]
    assert steps == [STEP_STARTED, STEP_DONE, STEP_STARTED, STEP_DONE]
    assert {r[0] for r in read_log(spark, log).select("prc_name").collect()} == {JOB_NAME}


def test_fx15_history_is_overwritten_with_less(spark):
    ms = months(26, start=(1999, 1))
    src = make_sources(spark, [base_row(m, perc_50=100 + i) for i, m in enumerate(ms)])
    target = scratch_path(spark, "t-history")
    probe = dt.date(2000, 1, 1)                     # 13th month: has a year-ago row
    run(spark, src, target, None, MartOptions(as_of="2000-01-15"))
    yoy = lambda: spark.read.parquet(target).where(F.col("week_dt") == F.lit(probe)) \
        .select("salary_p50_yoy_diff", "n_weeks_12w").collect()[0]
    before = yoy()
    assert before["salary_p50_yoy_diff"] is not None and before["n_weeks_12w"] == 12
    run(spark, src, target, None, MartOptions(as_of="2001-01-15"))
    after = yoy()
    assert after["salary_p50_yoy_diff"] is None and after["n_weeks_12w"] == 7  # now row 7
    # months outside the second horizon are kept, untouched
    assert spark.read.parquet(target).where(F.col("week_dt") < F.lit(dt.date(1999, 7, 1))).count() == 6


def test_failed_run_logs_failure(spark):
    bad = make_sources(spark, [base_row(m, loc=None) for m in months(2)])
    # NULL position id violates NOT NULL
    bad._base = bad._base.withColumn("position_type_id", F.lit(None).cast("int"))
    log = scratch_path(spark, "t-faillog")
    try:
        run(spark, bad, scratch_path(spark, "t-fail"), log, MartOptions(as_of="2001-08-15"))
        raise AssertionError("expected a contract violation")
    except ValueError:
        pass
    steps = [r["description_step"] for r in read_log(spark, log).orderBy("logged_at").collect()]
    assert steps[0] == STEP_STARTED and steps[-1].startswith("failed")


def test_failed_run_without_failure_logging_leaves_no_rows(spark):
    bad = make_sources(spark, [base_row(m) for m in months(2)])
    bad._base = bad._base.withColumn("position_type_id", F.lit(None).cast("int"))
    log = scratch_path(spark, "t-nolog")
    try:
        run(spark, bad, scratch_path(spark, "t-fail2"), log, MartOptions(as_of="2001-08-15"),
            log_failures=False)
    except ValueError:
        pass
    from paygrid.sources.sinks import path_exists as _exists
    assert not _exists(spark, log)


def test_upsert_reads_only_the_touched_months(spark):
    from paygrid.sources.sinks import batch_partitions
    src = make_sources(spark, [base_row(m) for m in months(3)])
    target = scratch_path(spark, "t-prune")
    run(spark, src, target, None, MartOptions(as_of="2001-08-15"))
    batch = spark.createDataFrame([(dt.date(2000, 4, 1),)], "week_dt date")
    pruned = spark.read.parquet(target).where(F.col("week_dt").isin(batch_partitions(batch, "week_dt")))
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_dt" in text and "2000-04-01" in text
    assert pruned.count() == 1


def test_command_line_run(spark):
    import json
    import os
    import subprocess
    import sys
    from support import SF_SMALL
    target, log = scratch_path(spark, "t-cli"), scratch_path(spark, "t-cli-log")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)
    out = subprocess.run(
        [sys.executable, "-m", "paygrid", "--testdata", SF_SMALL, "--target", target, "--log", log,
         "--as-of", "2001-08-15", "--master", "local[2]"],
        capture_output=True, text=True, env=env, timeout=600, cwd=repo)
    assert out.returncode == 0, out.stderr[-2000:]
    report = json.loads(out.stdout.strip().splitlines()[-1])
    assert report["status"] == "ok" and report["rows"] == 232
    assert spark.read.parquet(target).count() == 232


def test_existing_parquet_target_keeps_its_types(spark):
    from pyspark.sql import types as T
    src = make_sources(spark, [base_row(m, cnt_vacancy_site=i + 1) for i, m in enumerate(months(3))])
    target = scratch_path(spark, "t-types")
    run(spark, src, target, None, MartOptions(as_of="2001-08-15"), variant="compact")
    run(spark, src, target, None, MartOptions(as_of="2001-08-15"), variant="wide")
    schema = spark.read.parquet(target).schema
    assert schema["ext_salary_p50"].dataType == T.DecimalType(14, 2)
    assert schema["avg_vacancy_12w"].dataType == T.IntegerType()
    assert spark.read.parquet(target).count() == 3


def test_run_with_nothing_in_the_horizon(spark):
    src = make_sources(spark, [base_row("1999-01-01")])      # older than the horizon
    target, log = scratch_path(spark, "t-empty"), scratch_path(spark, "t-empty-log")
    result = run(spark, src, target, log, MartOptions(as_of="2001-08-15"))
    from paygrid.sources.sinks import path_exists
    assert result.rows == 0 and not path_exists(spark, target)
    assert [r["description_step"] for r in read_log(spark, log).orderBy("logged_at").collect()] == [
        STEP_STARTED, STEP_DONE]


def test_times_are_utc_whatever_the_drivers_time_zone(spark, monkeypatch):
    import time
    src = make_sources(spark, [base_row(m) for m in months(3)])
    target, log = scratch_path(spark, "t-utc"), scratch_path(spark, "t-utc-log")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        run(spark, src, target, log, MartOptions(as_of="2000-08-15"), run_ts=dt.datetime(2001, 8, 15, 10, 3))
        late = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M")
        got = spark.read.parquet(target).selectExpr("cast(inserted_at as string) as t").distinct().collect()
        logged = read_log(spark, log).selectExpr("max(date_format(logged_at, 'yyyy-MM-dd HH:mm')) as t").first()["t"]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert [r["t"] for r in got] == ["2001-08-15 10:03:00"]
    assert abs((dt.datetime.fromisoformat(logged) - dt.datetime.fromisoformat(late)).total_seconds()) <= 300


def test_an_empty_target_folder_is_a_first_run(spark, tmp_path):
    target = tmp_path / "features"
    target.mkdir()
    run(spark, make_sources(spark, [base_row(m) for m in months(3)]), str(target), None, MartOptions(as_of="2000-08-15"))
    assert spark.read.parquet(str(target)).count() == 3


def test_a_failed_write_leaves_no_staged_batch(spark, monkeypatch):
    import os

    import pytest

    from paygrid.plans import job
    from paygrid.session import scratch_root

    def fail(*_, **__):
        raise RuntimeError("no space")

    monkeypatch.setattr(job, "upsert_partitioned", fail)
    root = scratch_root(spark).removeprefix("file://")
    before = set(os.listdir(root))
    with pytest.raises(RuntimeError):
        run(spark, make_sources(spark, [base_row(m) for m in months(3)]), scratch_path(spark, "t-failing"), None, MartOptions(as_of="2000-08-15"))
    assert set(os.listdir(root)) == before
