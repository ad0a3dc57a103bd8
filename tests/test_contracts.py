"""Table contracts (K3-K5, K9, K10) and validation (K6-K8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import base_row, months, sources
from paygrid import MartOptions, build_mart
from paygrid.operators.validate import ContractViolation, enforce, violations
from paygrid.plans.contracts import conform, contract, empty_table
from paygrid.plans.mart import MART_COLUMNS


def test_column_counts_and_keys():
    assert len(contract("features", "wide").columns) == 52
    assert len(contract("features", "compact").columns) == 52
    assert len(contract("flags", "compact").columns) == 51
    assert len(contract("flags", "wide").columns) == 51
    assert len(contract("recommendations", "wide").columns) == 18
    assert contract("recommendations", "compact").keys[-1] == "problem_type"
    assert set(MART_COLUMNS) | {"inserted_at"} == set(contract("features", "wide").columns)


def test_variant_types_differ_as_declared():
    c, w = contract("features", "compact").schema, contract("features", "wide").schema
    assert c["ext_salary_p50"].dataType == T.DecimalType(14, 2)
    assert w["ext_salary_p50"].dataType == T.DecimalType(18, 5)
    assert c["avg_vacancy_12w"].dataType == T.IntegerType()
    assert w["nulls_ratio"].dataType == T.DecimalType(10, 5)
    assert contract("flags", "wide").schema["problem_trend"].dataType == T.ShortType()
    assert contract("flags", "compact").schema["problem_trend"].dataType == T.BooleanType()


def test_empty_flag_and_recommendation_tables(spark, tmp_path):
    for table in ("flags", "recommendations"):
        for variant in ("compact", "wide"):
            spec = contract(table, variant)
            df = empty_table(spark, spec)
            assert df.count() == 0 and df.columns == spec.columns
    rec = empty_table(spark, contract("recommendations", "wide"))
    assert isinstance(rec.schema["meta_json"].dataType, T.VariantType)


def test_defaults_fill_missing_columns(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, 1), 1, "x", "gap")],
                               "week_dt date, position_id int, location_rk string, problem_type string")
    out = conform(df, contract("recommendations", "wide"), now=F.lit(dt.datetime(2001, 1, 2)))
    row = out.collect()[0]
    assert row["severity"] == 1 and row["created_at"] == dt.datetime(2001, 1, 2)
    miss = spark.createDataFrame([(dt.date(2001, 1, 1), 1)], "week_dt date, position_id int")
    assert conform(miss, contract("features", "wide")).collect()[0]["location_rk"] == ""
    assert conform(miss, contract("features", "compact")).collect()[0]["location_rk"] is None


def test_insert_by_name_and_unknown_columns(spark):
    m = build_mart(sources(spark, [base_row(x) for x in months(3)]), MartOptions(as_of="2001-08-15"))
    shuffled = m.select(*reversed(m.columns))
    out = conform(shuffled, contract("features", "wide"))
    assert out.columns == contract("features", "wide").columns
    with pytest.raises(ValueError):
        conform(m.withColumn("surprise", F.lit(1)), contract("features", "wide"))


def test_key_and_not_null_violations(spark):
    spec = contract("features", "wide")
    m = build_mart(sources(spark, [base_row(x) for x in months(3)]), MartOptions(as_of="2001-08-15"))
    table = conform(m, spec)
    enforce(table, spec)
    dup = table.unionByName(table.limit(1))
    rules = {r["rule"]: r["violations"] for r in violations(dup, spec).collect()}
    assert rules["primary_key:week_dt,position_id,location_rk"] == 1
    nulls = table.withColumn("position_id", F.lit(None).cast("int"))
    rules = {r["rule"]: r["violations"] for r in violations(nulls, spec).collect()}
    assert rules["not_null:position_id"] == 3
    with pytest.raises(ContractViolation):
        enforce(nulls, spec)


def test_cluster_conf_sizes_partitions():
    from paygrid.session import cluster_conf
    conf = cluster_conf(expected_shuffle_bytes=100 * 1024 ** 4, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 819200      # 100 TiB / 128 MiB
    assert cluster_conf(10, cores=8)["spark.sql.shuffle.partitions"] == "24"


def test_rules_are_counted_while_a_batch_is_written(spark):
    from paygrid.operators.validate import enforce_observed, observed, observed_violations
    from paygrid.sources.sinks import stage
    spec = contract("features", "compact")
    rows = [(dt.date(2001, 1, 1), 1, "x", "Food"), (None, 2, "x", "Other"), (dt.date(2001, 1, 1), None, None, None), (dt.date(2001, 1, 1), 3, "y", "Else")]
    bad = conform(spark.createDataFrame(rows, "week_dt date, position_id int, location_rk string, competitor_food_cat string"), spec)
    watched, seen = observed(bad, spec)
    staged = stage(watched, "observed")
    want = {r["rule"]: (r["rows_checked"], r["violations"]) for r in violations(staged, spec, include_keys=False).collect()}
    assert {rule: (n, v) for rule, n, v in observed_violations(seen, staged, spec)} == want
    assert want["check:competitor_food_cat"] == (4, 2) and want["not_null:location_rk"] == (4, 1)
    with pytest.raises(ContractViolation, match="not_null:week_dt=1"):
        enforce_observed(seen, staged, spec)
    good = bad.where("position_id = 1")
    watched, seen = observed(good, spec)
    assert enforce_observed(seen, stage(watched, "observed"), spec) == 1


def test_the_job_checks_with_one_read_of_the_batch(spark):
    """After the staged write only the key rule reads, and it reads the key columns."""
    from paygrid.operators.validate import key_violations, violations as all_rules
    from paygrid.sources.sinks import stage
    spec = contract("features", "wide")
    table = stage(conform(build_mart(sources(spark, [base_row(x) for x in months(2)]), MartOptions(as_of="2001-08-15"), spec), spec), "checked")
    scans = lambda df: [l for l in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in l]
    assert len(scans(all_rules(table, spec))) == 2
    one = scans(key_violations(table, spec.keys))
    assert len(one) == 1 and "ReadSchema: struct<position_id:int,location_rk:string" in one[0].replace("week_dt:date,", "")


def test_payload_is_stored_and_read_by_path(spark):
    from paygrid.functions.payload import payload, payload_field
    from paygrid.sources.sinks import stage
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "k int, name string, x double")
    stored = stage(df.select("k", payload(name="name", inner=F.struct("x", "k")).alias("v")), "payload")
    assert isinstance(stored.schema["v"].dataType, T.VariantType)
    got = stored.select("k", payload_field("v", "$.name", "string").alias("name"), payload_field("v", "$.inner.x", "double").alias("x"),
                        payload_field("v", "$.inner.k", "int").alias("ik"), payload_field("v", "$.name", "int").alias("other"),
                        payload_field("v", "$.nothing", "string").alias("none")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", None, 1, None, None), (2, None, 2.5, 2, None, None)]
