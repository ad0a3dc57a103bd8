"""Vacancy counts kept by month: equal to a full recount after random edits."""

import datetime as dt
import random

import pytest

from support import _frame, base_row, sources, vac_row
from paygrid import MartOptions, build_mart
from paygrid.operators.enrich import count_vacancies
from paygrid.session import scratch_path
from paygrid.sources.counts import CountedSources, CountsBelowZero, read_counts, repair_counts
from paygrid.sources.tables import SOURCE_SCHEMAS

MONTHS = ["2001-01-05", "2001-01-31", "2001-02-01", "2001-05-09", None]


def table(spark, rows):
    return _frame(spark, SOURCE_SCHEMAS["vac"], [dict(zip(("month_dt", "position_type_id", "agglomeration_name"), r)) for r in rows])


def state(df):
    return sorted((tuple(r) for r in df.select("month_dt", "position_type_id", "agglomeration_name", "vacancy_cnt").collect()), key=str)


def test_equal_to_a_recount_after_random_edits(spark):
    rng = random.Random(8)
    path = scratch_path(spark, "counts")
    vacancy = lambda: (rng.choice(MONTHS), rng.choice([1, 2, None]), rng.choice(["A", "", None]))
    held = []
    for _ in range(5):
        gone = rng.sample(held, len(held) // 3)
        new = [vacancy() for _ in range(rng.randrange(25))]
        for g in gone:
            held.remove(g)
        held += new
        months = repair_counts(spark, path, added=table(spark, new), withdrawn=table(spark, gone))
        assert all(isinstance(m, dt.date) and m.day == 1 for m in months)
        assert state(read_counts(spark, path)) == state(count_vacancies(table(spark, held), None).where("month_dt IS NOT NULL"))
    repair_counts(spark, path, withdrawn=table(spark, held))
    assert state(read_counts(spark, path)) == []


def test_only_changed_months_are_rewritten(spark):
    path = scratch_path(spark, "counts")
    repair_counts(spark, path, added=table(spark, [("2001-01-01", 1, "A"), ("2001-02-01", 1, "A")]))
    files = lambda: {r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_path").distinct().collect()}
    before = files()
    late = [("2001-01-15", 1, "A"), ("2001-02-09", 2, "B")]
    assert repair_counts(spark, path, added=table(spark, late), withdrawn=table(spark, late[1:])) == [dt.date(2001, 1, 1)]
    assert len(files() & before) == 1 and state(read_counts(spark, path))[0] == (dt.date(2001, 1, 1), 1, "A", 2)
    assert repair_counts(spark, path, added=table(spark, [])) == []


def test_what_was_never_counted_cannot_be_withdrawn(spark):
    path = scratch_path(spark, "counts")
    repair_counts(spark, path, added=table(spark, [("2001-01-01", 1, "A")]))
    with pytest.raises(CountsBelowZero):
        repair_counts(spark, path, withdrawn=table(spark, [("2001-01-01", 1, "A"), ("2001-01-01", 1, "A")]))
    assert state(read_counts(spark, path)) == [(dt.date(2001, 1, 1), 1, "A", 1)]
    with pytest.raises(ValueError):
        repair_counts(spark, path)


def test_the_mart_from_stored_counts(spark):
    vac = [vac_row("2001-01-01")] * 3 + [vac_row("2001-02-01", agg="")] * 2 + [vac_row("1999-01-01")]
    src = sources(spark, [base_row(m, cnt_vacancy_site=None) for m in ("2001-01-01", "2001-02-01")], vac=vac)
    path = scratch_path(spark, "counts")
    repair_counts(spark, path, added=src.vac())
    options = MartOptions(as_of="2001-08-15")
    assert sorted(map(str, build_mart(CountedSources(src, spark, path), options).collect())) == sorted(map(str, build_mart(src, options).collect()))
