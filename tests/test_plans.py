"""Physical-plan checks: pushdown, one window exchange, bounded pre-shuffle limits."""

from support import SF_SMALL
from paygrid import MartOptions, TestDataSources, build_mart
from paygrid.operators.horizon import cutoff_month
from paygrid.plans.mart import joined_relation

AS_OF = "2001-08-15"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_horizon_reaches_the_scans(spark):
    joined = joined_relation(TestDataSources(spark, SF_SMALL), cutoff_month(AS_OF))
    text = plan_text(joined)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate," in text
    assert "GreaterThanOrEqual(l_shipdate," in text


def test_column_pruning_on_fact_scans(spark):
    text = plan_text(build_mart(TestDataSources(spark, SF_SMALL), MartOptions(as_of=AS_OF)))
    for line in text.splitlines():
        if "lineitem.parquet" in line:
            assert "l_partkey" not in line and "l_tax" not in line


def test_plain_plan_has_one_window_exchange(spark):
    m = build_mart(TestDataSources(spark, SF_SMALL), MartOptions(as_of=AS_OF, bounded=False))
    text = plan_text(m)
    windows = [l for l in text.splitlines() if l.strip().startswith(("+- Window ", "Window "))
               or " Window [" in l]
    # the job's own; the adapters rank prices of a group in windows of theirs
    series = [l for l in windows if "windowspecdefinition(position_id" in l]
    prices = [l for l in windows if "AS upto#" in l or "AS known#" in l]
    # places of a month's rows, then the features; both use the one exchange on the series
    assert len(series) == 2 and len(series) + len(prices) == len(windows)
    assert text.count("Exchange hashpartitioning(position_id") == 1
    assert "hashpartitioning(position_id" in text


def test_bounded_plan_limits_runs_before_the_shuffle(spark):
    text = plan_text(build_mart(TestDataSources(spark, SF_SMALL), MartOptions(as_of=AS_OF)))
    partial = [l for l in text.splitlines() if "WindowGroupLimit" in l and "Partial" in l]
    assert len(partial) == 1 and "row_number(), 52" in partial[0]
    # one exchange on the run key (after the partial limit), one on the series key for the feature window
    assert text.count("Exchange hashpartitioning(position_id") == 2
    assert "_side" not in text and "Generate explode(array(0, 1))" not in text


def test_a_run_in_every_split_is_limited_twice(spark):
    """16 splits hold one run: at most 52 rows a salt reach the series exchange, where one level would send 52 a split."""
    from paygrid.operators.temporal import KEPT, add_series_features, default_salts, placed_runs
    rows = spark.range(0, 16_000, 1, 16).selectExpr(
        "date'2001-01-01' as week_dt", "1 as position_id", "'A' as location_rk", "cast(id as string) as work_schedule_type",
        "cast(id % 7 as int) as cnt_vacancy_site", *[f"cast(id as decimal(18,5)) as {c}" for c in ("market_perc_50", "market_perc_25")])
    operators = ("lag_prev", "rolling_12", "rolling_52")
    plan = placed_runs(rows, salts=4)
    text = plan_text(plan)
    limits = [l for l in text.splitlines() if "WindowGroupLimit" in l]
    # the first level's, before and after its exchange; the second is a window over what passed, behind the series exchange
    assert [("_salt" in l, "Partial" in l) for l in limits] == [(True, False), (True, True)]
    assert plan.count() == KEPT
    got = [add_series_features(rows, operators, salts=s).collect() for s in (1, 4, 16)]
    assert got[0] == got[1] == got[2] == add_series_features(rows, operators, bounded=False).collect()
    assert default_salts(rows) == 1
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "400")
        assert default_salts(rows) == 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_series_windows_run_by_block(spark):
    text = plan_text(build_mart(TestDataSources(spark, SF_SMALL), MartOptions(as_of=AS_OF, block_months=3)))
    windows = [l for l in text.splitlines() if "windowspecdefinition(position_id" in l and "lag(" in l]
    assert len(windows) == 1 and "_home" in windows[0] and "_number" in windows[0]


def test_partitioned_sources_are_pruned_by_the_horizon(spark):
    from paygrid.plans.mart import joined_relation as joined
    from paygrid.session import scratch_path
    from paygrid.sources.tables import TableSources

    src = TestDataSources(spark, SF_SMALL)
    paths = {n: scratch_path(spark, f"p-{n}") for n in ("base", "dim", "ext", "vac")}
    src.base().write.partitionBy("month_dt").parquet(paths["base"])
    src.dim().write.parquet(paths["dim"])
    src.ext().write.partitionBy("month_dt").parquet(paths["ext"])
    src.vac().write.parquet(paths["vac"])
    tables = TableSources(spark, **paths)
    text = plan_text(joined(tables, cutoff_month(AS_OF)))
    assert text.count("PartitionFilters: [isnotnull(month_dt") >= 2
    rows = joined(tables, cutoff_month(AS_OF)).count()
    assert rows == joined(TestDataSources(spark, SF_SMALL), cutoff_month(AS_OF)).count()


def test_first_per_key_limits_before_the_shuffle(spark):
    from paygrid.operators.dedupe import first_per_key
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    one = first_per_key(df, ["l_orderkey"], ["l_linenumber"])
    text = plan_text(one)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert one.count() == df.select("l_orderkey").distinct().count()


def test_no_cross_joins_and_no_python_in_any_query(spark):
    from paygrid.plans.queries import QUERIES
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
              "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
    for name, fn in QUERIES.items():
        if name in ("run_log", "written_months", "inserted_once", "upsert_into_table"):
            continue   # they run the whole job, and read what it wrote
        text = plan_text(fn(spark, SF_SMALL))
        found = [b for b in banned if b in text]
        assert not found, (name, found)


def test_a_hot_key_is_split_in_the_enrichment_join(spark):
    from paygrid.operators.enrich import enrich
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        base = spark.range(0, 40_000, 1, 8).selectExpr(
            "date'2001-01-01' as week_dt", "cast(if(id % 4 = 0, id % 50, 7) as int) as position_id", "cast(id as string) as location_rk",
            "'n' as location_nm", "'p' as position_name", "'A' as agglomeration_nm", "'f' as work_schedule_type",
            "cast(1 as decimal(14,2)) as int_salary_tc5", "cast(1 as decimal(14,2)) as target_salary_amt", "1 as cnt_emp_dist",
            *[f"cast(null as decimal(14,2)) as perc_{p}" for p in (25, 50, 75)], "1 as market_cnt_vacancy_site", "'c' as company_competitor")
        side = spark.range(50).selectExpr("date'2001-01-01' as month_dt", "cast(id as int) as position_type_id", "'A' as agglomeration_name")
        market = side.selectExpr("*", *[f"cast(2 as decimal(14,2)) as perc_{p}" for p in (25, 50, 75)], "3 as cnt_vacancy_site")
        joined = enrich(base, market, side.selectExpr("*", "5L as vacancy_cnt"))
        assert len(joined.collect()) == 40_000
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_join_of_both_sides_equals_two_chained_joins(spark):
    from paygrid.operators.enrich import join_market, join_sides, join_vacancies
    base = spark.createDataFrame([(1, 1, "A"), (1, 2, None), (1, 3, "B"), (2, 1, "A"), (None, 1, "A")],
                                 "week_dt int, position_id int, agglomeration_nm string")
    market = spark.createDataFrame([(1, 1, "A", 10), (1, 1, "A", 11), (1, 2, "", 12), (3, 1, "A", 13), (None, 1, "A", 14)],
                                   "month_dt int, position_type_id int, agglomeration_name string, perc_25 int").selectExpr(
        "*", "perc_25 as perc_50", "perc_25 as perc_75", "perc_25 as cnt_vacancy_site")
    counts = spark.createDataFrame([(1, 1, "A", 5), (1, 2, None, 6), (1, 2, "", 7), (1, 3, "B", 8)],
                                   "month_dt int, position_type_id int, agglomeration_name string, vacancy_cnt int")
    columns = ["week_dt", "position_id", "agglomeration_nm", "_m_perc_25", "_v_vacancy_cnt"]
    rows = lambda df: sorted(map(str, df.select(columns).collect()))
    assert rows(join_sides(base, market, counts)) == rows(join_vacancies(join_market(base, market), counts))
