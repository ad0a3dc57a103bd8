"""The whole job: compute -> check -> upsert, with a start and an outcome log row.

The original runs in one transaction: its start and success log rows commit
together with the data, and a failed run leaves no log row at all.  Here the
start row (stamped with the real start time) and the outcome row are written
in one append after the upsert, so the log never shows a start without an
outcome.  One ``inserted_at`` value is shared by every row of a run (``now()``
is constant within a transaction).  Addition: with ``log_failures`` (default)
a failed run writes its start row and a failure row before re-raising.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import STEP_DONE, STEP_STARTED
from ..operators.validate import enforce_observed, observed
from ..session import scratch_path
from ..sources.sinks import append_log_rows, delete_path, has_data, stage_at, upsert_partitioned
from .catalog import contract_for_schema, ensure_tables, table_contract, upsert_table
from .contracts import conform, contract
from .mart import MartOptions, build_mart

STEP_FAILED = "failed"  # addition: the original logs no failure row


@dataclass
class RunResult:
    batch: DataFrame | None   # the staged, conformed batch (kept only on request)
    inserted_at: dt.datetime
    rows: int                 # rows in the batch


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def as_utc(at: dt.datetime) -> dt.datetime:
    """A naive time means UTC; Spark reads only aware times alike under every driver's time zone."""
    return at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)


def run(spark: SparkSession, sources, target_path: str | None = None,
        log_path: str | None = None, options: MartOptions = MartOptions(),
        variant: str = "wide", run_ts: dt.datetime | None = None,
        target_table: str | None = None, log_failures: bool = True,
        keep_batch: bool = False) -> RunResult:
    """Compute the mart and merge it into ``target_path`` (a month-partitioned
    parquet folder) or ``target_table`` (a catalog table, created from the
    ``variant`` contract if missing; an existing table keeps its own types)."""
    if (target_path is None) == (target_table is None):
        raise ValueError("give exactly one of target_path and target_table")
    started = _utc_now()
    run_ts = run_ts or started
    batch_path = scratch_path(spark, "features-batch")
    done = False
    try:
        if target_table:
            ensure_tables(spark, {"features": target_table}, variant)
            spec = table_contract(spark, target_table)
        elif has_data(spark, target_path):   # an existing table keeps its types
            spec = contract_for_schema(spark.read.parquet(target_path).schema)
        else:
            spec = contract("features", variant)
        mart = build_mart(sources, options, spec)
        watched, seen = observed(conform(mart, spec, now=F.lit(as_utc(run_ts)).cast("timestamp")), spec)
        table = stage_at(watched, batch_path)
        rows = enforce_observed(seen, table, spec)
        if target_table:
            batch = upsert_table(table, target_table, spec, batch_is_staged=True)
        else:
            batch = upsert_partitioned(table, target_path, spec.keys, batch_is_staged=True)
        done = True
    except Exception as exc:
        if log_path and log_failures:
            append_log_rows(spark, log_path, [(STEP_STARTED, started),
                                              (f"{STEP_FAILED}: {type(exc).__name__}", None)])
        raise
    finally:
        if not (done and keep_batch):
            delete_path(spark, batch_path)
    if log_path:
        append_log_rows(spark, log_path, [(STEP_STARTED, started), (STEP_DONE, None)])
    if not keep_batch:
        batch = None
    return RunResult(batch=batch, inserted_at=run_ts, rows=rows)
