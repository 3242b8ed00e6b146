"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyloom.plans import load_all
from tools.check import canonical, kind

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for path in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", sorted(load_all().ORACLES))
def test_query_equals_sql(spark, con, name):
    frame = queries()[name](spark, SF)
    rows = frame.collect()
    relation = con.sql(oracle_sql()[name])
    want, names = relation.fetchall(), relation.columns
    assert sorted(frame.columns) == sorted(names)
    theirs = dict(zip(names, (str(t) for t in relation.types)))
    assert {c: kind(t) for c, t in frame.dtypes} == {c: kind(t) for c, t in theirs.items()}
    assert canonical(frame.columns, rows) == canonical(names, want)


def test_entry(spark):
    assert entry(spark).count() == 100


@pytest.mark.parametrize("name, keys", [
    ("topk_words", lambda r: (-r["count"], r["word"])),
    ("sort_by_count", lambda r: (-r["count"], r["word"])),
    ("sort_by_count_ascending", lambda r: (r["count"], r["word"])),
    ("sort_by_key", lambda r: r["word"]),
    ("sort_lines", lambda r: r["value"].encode()),
    ("sort_lines_with_source", lambda r: (r["value"].encode(), r["id"])),
    ("costar_count", lambda r: (-r["count"], r["a"], r["b"])),
    ("sort_by_rank", lambda r: (-r["rank"], r["id"])),
])
def test_order(spark, name, keys):
    rows = queries()[name](spark, SF).collect()
    assert rows == sorted(rows, key=keys)


def test_descending_lines(spark):
    rows = [r["value"].encode() for r in queries()["sort_lines_desc"](spark, SF).collect()]
    assert rows == sorted(rows, reverse=True)


def test_no_plan_pairs_everything_with_everything(spark):
    for name in ("costar_count", "best_and_avg", "search_topk", "trending_growth", "pagerank",
                 "run_length_count_global", "attempts_before_success", "zero_preserving_counts"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_scans_read_only_what_is_asked(spark):
    frame = queries()["filter_range"](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice)" in plan
    assert "o_orderdate" not in plan


def test_top_per_window_is_limited_before_the_shuffle(spark):
    plan = queries()["trending_windows"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
