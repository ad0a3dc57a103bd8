"""Adapters that derive the job's four sources from the driver's test tables.

The job reads in-house pay (``base``), a position dimension (``dim``), market
percentiles (``ext``) and single vacancies (``vac``).  The test data is a
TPC-H-like star schema, so these adapters derive the four relations from
``orders``/``lineitem`` joined to customer geography.  The rules below also
plant NULLs, zeros, sentinels, NULL-vs-'' keys and fan-out so every branch of
the job is exercised by whole-table queries.

Scale notes
-----------
* ``region`` (5 rows) and ``nation`` (25 rows) have a fixed size at every
  scale factor, so they are broadcast; ``customer`` is joined without a hint
  (Spark broadcasts it only while its estimated size is under the threshold,
  otherwise it is a shuffle join).
* ``orders`` is joined to customer geography once per source; ``ext`` and
  ``vac`` each join ``lineitem`` (3 of its 11 columns, shipped-since filter
  pushed into the scan) to that narrow (orderkey, priority, location)
  relation.  They stand for two independent upstream tables, so each pays
  its own join: at scale one ``lineitem`` shuffle per source.
* All grouped measures are partial-aggregated before the shuffle.  The
  percentiles are exact ``percentile_disc`` of the raw prices: equal prices are
  counted first, then ranked in a sort that spills.
* ``since`` (a month start) is applied to the raw date column, so it reaches
  the parquet scan as a pushed filter; it never changes results because the
  job applies the same month-start bound again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import month_start
from ..functions.constants import COMPETITOR_UNKNOWN, WHOLE_MARKET
from ..operators.joins import fixed_size

# FIXED VALUES of the adapters (test scaffolding, not job semantics).
NO_AGGLOMERATION_REGION = "AFRICA"        # agglomeration NULL (vac: '' or NULL by price parity)
NO_LOCATION_REGION = "MIDDLE EAST"        # location_rk NULL -> '' in the job
SECOND_MARKET_TYPE = "Food"               # extra ext copy the job must ignore
COMPETITOR_CAPITALISED = "Не определено"  # must be kept (sentinel is lower case)
FULL_TIME, PART_TIME = "full", "part"
MONEY = "decimal(18,5)"

GRAINS = ("region", "segment")

# Types of the test-table columns the adapters read.  Passing them to the
# reader skips schema inference (a footer-reading job per table) and limits
# the read to these columns.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_shipdate timestamp_ntz",
}


def _price_stats(rows: DataFrame, price: str, **keys: Column) -> DataFrame:
    """Per group: n, pmin, pmax and the prices q25, q50, q75 (percentile_disc).

    Equal prices are counted before the shuffle, so a group's sort holds its
    distinct prices, and spills; no buffer holds a group.
    """
    counts = rows.groupBy(*[c.alias(k) for k, c in keys.items()], F.col(price).alias("v")) \
        .agg(F.count(F.lit(1)).alias("c"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.when(F.col("v").isNotNull(), F.col("c"))
    ranked = counts.select(*keys, "v", "c", F.sum(known).over(upto).alias("upto"),
                           F.sum(known).over(group).alias("known"))
    at = lambda p: F.min(F.when(F.col("upto") >= F.col("known") * p, F.col("v")))
    return ranked.groupBy(*keys).agg(
        F.sum("c").alias("n"), F.min("v").alias("pmin"), F.max("v").alias("pmax"),
        at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))


class TestDataSources:
    """The four job sources derived from ``/root/testdata/sf*/`` tables.

    ``grain="region"``: location = agglomeration = region name (25 series).
    ``grain="segment"``: location = nation/market segment, agglomeration =
    nation (many more series; used by the benchmark).
    ``with_copies``: every base row appears twice (schedule 'full' and 'part',
    target + 1), the duplicate-grain case the job must window then dedupe.
    """

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str, grain: str = "region",
                 with_copies: bool = False):
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.grain = grain
        self.with_copies = with_copies
        self._memo: dict = {}

    def _once(self, key, build):
        # Reuse DataFrames within one source object: each parquet read lists
        # files and reads footers on the driver, so re-reading the same table
        # for every branch of the plan only costs planning time.
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def _read(self, name: str) -> DataFrame:
        return self._once(("table", name), lambda: self.spark.read.schema(TABLE_SCHEMAS[name])
                          .parquet(f"{self.sf_dir}/{name}.parquet"))

    def _table(self, name: str, *cols: str) -> DataFrame:
        df = self._read(name)
        # The read schema already holds just the used columns; skip a no-op select.
        return df if list(cols) == df.columns else df.select(*cols)

    # -- shared geography -------------------------------------------------
    def _customer_location(self) -> DataFrame:
        return self._once("customer_location", self._build_customer_location)

    def _build_customer_location(self) -> DataFrame:
        region = self._table("region", "r_regionkey", "r_name")
        nation = self._table("nation", "n_nationkey", "n_name", "n_regionkey")
        geo = fixed_size(
            nation.join(fixed_size(region), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        cust = self._table("customer", "c_custkey", "c_nationkey", "c_mktsegment")
        cust = cust.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        if self.grain == "region":
            loc, agg = F.col("r_name"), F.col("r_name")
        else:
            loc = F.concat_ws("/", F.col("n_name"), F.col("c_mktsegment"))
            agg = F.col("n_name")
        return cust.select(
            "c_custkey", F.col("r_name").alias("reg"), loc.alias("loc"), agg.alias("agg")
        )

    def _orders(self, since: dt.date | None) -> DataFrame:
        return self._once(("orders", since), lambda: self._build_orders(since))

    def _build_orders(self, since: dt.date | None) -> DataFrame:
        orders = self._table(
            "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
        )
        if since is not None:
            orders = orders.where(F.col("o_orderdate") >= F.lit(since))
        return orders.join(
            self._customer_location(), F.col("o_custkey") == F.col("c_custkey")
        ).select(
            "o_orderkey", "o_orderdate", "o_totalprice",
            F.substring("o_orderpriority", 1, 1).cast("int").alias("prio"),
            "reg", "loc", "agg",
        )

    def _lines(self, since: dt.date | None) -> DataFrame:
        return self._once(("lines", since), lambda: self._build_lines(since))

    def _build_lines(self, since: dt.date | None) -> DataFrame:
        lines = self._table("lineitem", "l_orderkey", "l_extendedprice", "l_shipdate")
        if since is not None:
            lines = lines.where(F.col("l_shipdate") >= F.lit(since))
        attrs = self._orders(None).select("o_orderkey", "prio", "reg", "agg")
        return lines.join(attrs, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")

    # -- the four sources -------------------------------------------------
    def dim(self) -> DataFrame:
        """Position dimension: ids 0-4 vs priorities 1-5, so priority 5 misses.

        Built from ``region``, whose 5 rows are fixed by the data spec, so
        it is broadcast without a counting job.
        """
        region = self._table("region", "r_regionkey", "r_name")
        return fixed_size(
            region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
        )

    def base(self, since: dt.date | None = None) -> DataFrame:
        g = _price_stats(self._orders(since), "o_totalprice", month_dt=month_start("o_orderdate"),
                         **{k: F.col(k) for k in ("prio", "reg", "loc", "agg")})
        n, prio, reg = F.col("n"), F.col("prio"), F.col("reg")
        odd = (n % 2) != 0
        out = g.select(
            "month_dt",
            prio.alias("position_type_id"),
            F.when(reg != NO_LOCATION_REGION, F.col("loc")).alias("location_rk"),
            F.concat(F.lit("R:"), F.col("loc")).alias("location_nm"),
            F.when(prio == 4, F.lit("P4")).alias("hrm_job_title_nm"),
            F.when(reg != NO_AGGLOMERATION_REGION, F.col("agg")).alias("agglomeration_name"),
            F.lit(FULL_TIME).alias("work_schedule_type"),
            F.when((n % 11) != 0, F.col("pmax")).cast(MONEY).alias("fact_salary_fte_amt"),
            F.when((n % 7) == 0, F.lit(0.0)).otherwise(F.col("pmin")).cast(MONEY).alias("target_salary"),
            (n - 1).cast("int").alias("cnt_emp_dist"),
            F.when(odd, F.col("q25")).cast(MONEY).alias("perc_25"),
            F.when(odd, F.col("q50")).cast(MONEY).alias("perc_50"),
            F.when(odd, F.col("q75")).cast(MONEY).alias("perc_75"),
            F.when((n % 3) != 0, n).cast("int").alias("cnt_vacancy_site"),
            F.when(prio == 2, F.lit(COMPETITOR_UNKNOWN))
            .when(prio == 3, F.lit(COMPETITOR_CAPITALISED))
            .otherwise(F.concat(F.lit("C"), prio.cast("string")))
            .alias("company_competitor"),
        )
        if not self.with_copies:
            return out
        schedule = F.explode(F.array(F.lit(FULL_TIME), F.lit(PART_TIME)))
        copies = out.drop("work_schedule_type").select("*", schedule.alias("work_schedule_type"))
        bump = F.when(F.col("work_schedule_type") == PART_TIME, F.lit(1)).otherwise(F.lit(0))
        return copies.withColumn(
            "target_salary", (F.col("target_salary") + bump).cast(MONEY)
        ).select(*out.columns)

    def ext(self, since: dt.date | None = None) -> DataFrame:
        g = _price_stats(self._lines(since), "l_extendedprice", month_dt=month_start("l_shipdate"),
                         **{k: F.col(k) for k in ("prio", "reg", "agg")})
        mon = F.month("month_dt")
        cols = [
            "month_dt",
            F.col("prio").alias("position_type_id"),
            F.when(F.col("reg") != NO_AGGLOMERATION_REGION, F.col("agg")).alias("agglomeration_name"),
        ]
        for q, name in (("q25", "perc_25"), ("q50", "perc_50"), ("q75", "perc_75")):
            cols += [
                F.when(mon % 3 != 0, F.col(q)).cast(MONEY).alias(name),
                F.when(mon % 6 != 0, F.col(q) * 2).cast(MONEY).alias(f"{name}_3month"),
                F.when(mon != 12, F.col(q) * 4).cast(MONEY).alias(f"{name}_6month"),
            ]
        cols += [
            F.when(mon == 5, F.lit(0)).when(mon == 7, F.lit(None)).otherwise(F.col("n"))
            .cast("int").alias("cnt_vacancy_site"),
            F.explode(F.array(F.lit(WHOLE_MARKET), F.lit(SECOND_MARKET_TYPE))).alias("type_agg"),
        ]
        return g.select(*cols)

    def vac(self, since: dt.date | None = None) -> DataFrame:
        """One single vacancy per line item, on its ship date.

        AFRICA rows get '' or NULL as agglomeration by the parity of the whole
        price, so most months hold both groups and the null-as-empty join
        fans out (both match the NULL agglomeration of the in-house rows).
        """
        lines = self._lines(since)
        africa = F.col("reg") == NO_AGGLOMERATION_REGION
        even = (F.floor("l_extendedprice") % 2) == 0
        return lines.select(
            F.to_date("l_shipdate").alias("month_dt"),
            F.col("prio").alias("position_type_id"),
            F.when(africa & even, F.lit("")).when(africa, F.lit(None).cast("string"))
            .otherwise(F.col("agg")).alias("agglomeration_name"),
        )
