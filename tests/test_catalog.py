"""Catalog tables: create-if-missing DDL, first creator fixes types, upsert."""

import datetime as dt

from pyspark.sql import types as T

from support import base_row, months
from support import sources as make_sources
from paygrid import MartOptions
from paygrid.plans.catalog import create_table_sql, ensure_tables
from paygrid.plans.contracts import contract
from paygrid.plans.job import run
from paygrid.session import scratch_path


def test_ddl_lists_contract_columns():
    sql = create_table_sql(contract("features", "wide"), "f")
    assert sql.count("\n  `") == 52 and "PARTITIONED BY (week_dt)" in sql
    assert "`inserted_at` timestamp NOT NULL" in sql


def test_create_all_three_tables(spark):
    root = scratch_path(spark, "cat")
    names = {"features": "cat_features", "flags": "cat_flags", "recommendations": "cat_recs"}
    ensure_tables(spark, names, "wide", location_root=root)
    ensure_tables(spark, names, "compact", location_root=root)    # no-op: they exist
    assert len(spark.table("cat_features").columns) == 52
    assert len(spark.table("cat_flags").columns) == 51
    assert isinstance(spark.table("cat_recs").schema["meta_json"].dataType, T.VariantType)
    assert spark.table("cat_features").schema["ext_salary_p50"].dataType == T.DecimalType(18, 5)


def test_job_into_catalog_table_keeps_existing_types(spark):
    root = scratch_path(spark, "cat2")
    ensure_tables(spark, {"features": "cat_compact"}, "compact", location_root=root)
    src = make_sources(spark, [base_row(m, cnt_vacancy_site=i + 1, perc_50=100 + i)
                               for i, m in enumerate(months(14))])
    ts = dt.datetime(2001, 8, 15, 3)
    run(spark, src, target_table="cat_compact", variant="wide",
        options=MartOptions(as_of="2001-08-15"), run_ts=ts)
    run(spark, src, target_table="cat_compact", variant="wide",
        options=MartOptions(as_of="2001-08-15"), run_ts=ts)
    t = spark.table("cat_compact")
    assert t.count() == 14
    assert t.schema["ext_salary_p50"].dataType == T.DecimalType(14, 2)   # compact kept
    assert t.schema["avg_vacancy_12w"].dataType == T.IntegerType()
    assert {r[0] for r in t.select("avg_vacancy_12w").collect()} >= {1, 2}


def test_column_defaults_apply_to_sql_inserts(spark):
    root = scratch_path(spark, "cat3")
    ensure_tables(spark, {"recommendations": "cat_recs_defaults"}, "wide", location_root=root)
    spark.sql("INSERT INTO cat_recs_defaults (week_dt, position_id, problem_type) "
              "VALUES (DATE'2001-01-01', 1, 'gap')")
    row = spark.table("cat_recs_defaults").first()
    assert row["severity"] == 1 and row["location_rk"] == "" and row["created_at"] is not None


def test_sources_from_catalog_tables_give_the_same_mart(spark):
    from support import SF_SMALL
    from paygrid import TableSources, build_mart
    from paygrid.sources.testdata import TestDataSources

    src = TestDataSources(spark, SF_SMALL)
    root = scratch_path(spark, "cat4")
    for kind, df in (("base", src.base()), ("dim", src.dim()), ("ext", src.ext()), ("vac", src.vac())):
        writer = df.write.option("path", f"{root}/{kind}")
        if kind != "dim":
            writer = writer.partitionBy("month_dt")
        writer.saveAsTable(f"src_{kind}")
    tables = TableSources(spark, base="src_base", dim="src_dim", ext="src_ext", vac="src_vac")
    opts = MartOptions(as_of="2001-08-15")
    a = sorted((tuple(r) for r in build_mart(tables, opts).collect()), key=repr)
    b = sorted((tuple(r) for r in build_mart(src, opts).collect()), key=repr)
    assert a == b and len(a) == 232


def test_checks_follow_the_variant_that_created_the_table(spark):
    from paygrid.plans.catalog import created_variant, table_contract
    root = scratch_path(spark, "cat5")
    ensure_tables(spark, {"features": "chk_compact"}, "compact", location_root=f"{root}/c")
    ensure_tables(spark, {"features": "chk_wide"}, "wide", location_root=f"{root}/w")
    assert created_variant(spark.table("chk_compact").schema) == "compact"
    assert created_variant(spark.table("chk_wide").schema) == "wide"
    assert "competitor_food_cat" in table_contract(spark, "chk_compact").checks
    assert table_contract(spark, "chk_wide").checks == {}
    assert table_contract(spark, "chk_wide").defaults["location_rk"] == ""


def test_months_are_swapped_by_moving_their_location(spark):
    """A reader from before a swap keeps the old rows, one from after has the new; no file of the table is overwritten."""
    from paygrid.plans.catalog import drop_old_months, month_locations, swap_months
    root = scratch_path(spark, "swap")
    spark.sql(f"CREATE TABLE cat_swap (k int, v string, week_dt date) USING parquet PARTITIONED BY (week_dt) LOCATION '{root}'")
    rows = lambda m, v, n=40: spark.range(n).selectExpr("cast(id as int) as k", f"'{v}' as v", f"date'{m}' as week_dt")
    spark.sql("INSERT INTO cat_swap VALUES (0, 'in place', date'2001-01-01'), (0, 'other month', date'2001-03-01')")
    swap_months(rows("2001-01-01", "first").unionByName(rows("2001-02-01", "first")), "cat_swap")
    state = lambda df: sorted((str(r[0]), r[1], r[2]) for r in df.groupBy("week_dt", "v").count().collect())
    march = ("2001-03-01", "other month", 1)
    assert state(spark.table("cat_swap")) == [("2001-01-01", "first", 40), ("2001-02-01", "first", 40), march]
    reader = spark.table("cat_swap")
    reader._jdf.queryExecution().executedPlan()     # planned before the swap: its files are listed
    old = month_locations(spark, "cat_swap")
    swap_months(rows("2001-01-01", "second", 7), "cat_swap")
    assert state(spark.table("cat_swap")) == [("2001-01-01", "second", 7), ("2001-02-01", "first", 40), march]
    assert reader.where("v = 'first'").count() in (40, 80)   # each month whole, as it was or as it is
    new = month_locations(spark, "cat_swap")
    assert {m for m in new if new[m] != old[m]} == {"2001-01-01"}
    gone = drop_old_months(spark, "cat_swap")
    assert sorted(x.rsplit("/", 1)[1] for x in gone) == ["week_dt=2001-01-01"] * 2
    assert state(spark.table("cat_swap")) == [("2001-01-01", "second", 7), ("2001-02-01", "first", 40), march]
    assert drop_old_months(spark, "cat_swap") == []


def test_a_reader_never_sees_a_part_of_a_month(spark):
    """Counts read in another thread while a month is swapped again and again are always those of one version."""
    import threading
    from paygrid.plans.catalog import swap_months
    root = scratch_path(spark, "swap2")
    spark.sql(f"CREATE TABLE cat_swap2 (v int, week_dt date) USING parquet PARTITIONED BY (week_dt) LOCATION '{root}'")
    version = lambda v: spark.range(0, 1000, 1, 4).selectExpr(f"{v} as v", "date'2001-01-01' as week_dt")
    swap_months(version(0), "cat_swap2")
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(sorted(tuple(r) for r in spark.newSession().table("cat_swap2").groupBy("v").count().collect()))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 5):
            swap_months(version(v), "cat_swap2")
    finally:
        stop.set()
        reader.join()
    assert seen and all(len(x) == 1 and x[0][1] == 1000 for x in seen)


def test_upsert_into_a_table_reads_and_writes_touched_months_only(spark):
    from paygrid.plans.catalog import month_locations, upsert_table
    root = scratch_path(spark, "cat-upsert")
    ensure_tables(spark, {"features": "cat_upsert"}, "wide", location_root=root)
    spec = contract("features", "wide")
    batch = lambda ms, loc: spark.createDataFrame([(dt.date.fromisoformat(m), 1, loc) for m in ms], "week_dt date, position_id int, location_rk string")
    upsert_table(batch(["2001-01-01", "2001-02-01"], "A"), "cat_upsert", spec)
    before = month_locations(spark, "cat_upsert")
    upsert_table(batch(["2001-02-01", "2001-03-01"], "B"), "cat_upsert", spec)
    upsert_table(batch(["2001-02-01"], "B"), "cat_upsert", spec)
    got = sorted((str(r[0]), r[1]) for r in spark.table("cat_upsert").select("week_dt", "location_rk").collect())
    assert got == [("2001-01-01", "A"), ("2001-02-01", "A"), ("2001-02-01", "B"), ("2001-03-01", "B")]
    after = month_locations(spark, "cat_upsert")
    assert after["2001-01-01"] == before["2001-01-01"] and after["2001-02-01"] != before["2001-02-01"]
