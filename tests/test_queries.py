"""Every query with SQL against DuckDB on the smallest tables, and the shape of key plans."""

import re

import pytest

import __spark_entry__ as entry
from compare import connect, difference

#: Minutes at any size: up to 300 trees one after the other, for twelve fits. tests/test_boosting.py and tests/test_models.py search small grids.
LONG = {"forward_search"}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(set(SQL) - LONG))
def test_query_equals_its_sql(spark, sf, duck, name):
    assert difference(entry.queries()[name](spark, sf), duck, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 24


def plan_of(spark, sf, name):
    return entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["flag_rules", "effect_table", "demand_aggregate", "psi", "sensitivity_sweep", "lookup_predict",
                                  "dedup_exact", "load_check", "distance_hour_baseline"])
def test_plans_hold_no_python_and_no_cross_join(spark, sf, name):
    plan = plan_of(spark, sf, name)
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_row_level_data_is_never_sorted_in_one_task(spark, sf):
    # Discrete quantiles are left out: they order value counts, which have a bounded number of rows.
    for name in ("effect_table", "dedup_exact", "demand_aggregate", "quantile_linear"):
        assert not re.search(r"Window[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan_of(spark, sf, name))


def test_effects_read_the_table_once(spark, sf):
    from tripstrata.operators.effects import effect_table

    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    df = effect_table(lines, "l_extendedprice", "l_discount", ["l_returnflag", "l_suppkey"])
    read = {f.split("/")[-2 if "/stages/" in f else -1].split("-")[0] for f in df.inputFiles()}
    assert read == {"levels"}
