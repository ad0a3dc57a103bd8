"""Re-run the job when new source files arrive (Structured Streaming trigger).

The job itself is batch: every run recomputes the whole horizon, exactly as
the scheduled original does.  This module only decides *when* to run it.  A
file stream watches one source folder; each micro-batch holds the newly
arrived rows, and if any of them falls inside the horizon the job runs once
for that batch.  The stream's checkpoint records which files were handled,
and the job's upsert is idempotent, so a replayed batch after a failure
gives the same table (exactly-once effect).

``available_now=True`` processes whatever has arrived and stops — the
streaming form of a scheduled run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.horizon import cutoff_month
from ..plans.job import run
from ..plans.mart import MartOptions


def refresh_on_arrival(
    spark: SparkSession,
    watch_path: str,
    watch_schema: str,
    make_sources: Callable[[], object],
    target_path: str | None,
    checkpoint_path: str,
    log_path: str | None = None,
    options: MartOptions | Callable[[], MartOptions] = MartOptions(),
    variant: str = "wide",
    available_now: bool = True,
    month_column: str = "month_dt",
    target_table: str | None = None,
) -> StreamingQuery:
    """Start a file stream on ``watch_path`` that refreshes the mart.

    The mart is merged into ``target_path`` (parquet folder) or, with
    ``target_path=None``, into catalog table ``target_table``.
    ``make_sources`` is called per run so each run sees the current files;
    ``options`` may be a callable to take a fresh as-of date per run.
    """
    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        opts = options() if callable(options) else options
        cutoff = cutoff_month(opts.as_of)
        # One bounded probe (incremental take of one row): does any new row
        # touch the horizon?
        relevant = len(batch.where(F.col(month_column) >= F.lit(cutoff)).select(F.lit(1)).take(1)) > 0
        if relevant:
            run(spark, make_sources(), target_path=target_path, log_path=log_path,
                options=opts, variant=variant, target_table=target_table)

    stream = spark.readStream.schema(watch_schema).parquet(watch_path)
    writer = (stream.writeStream
              .foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint_path)
              .queryName("paygrid_refresh"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
