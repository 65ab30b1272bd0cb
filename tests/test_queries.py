"""Every registered query against the same query as SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry_points
from workload import registry
from workload.check import compare, connect

QUERIES = {name: q for name, q in entry_points.queries().items() if name in registry.QUERIES}
SQL = {name: q for name, q in entry_points.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert compare(df.columns, df.collect(), columns, cur.fetchall()) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "total_experienced_ttime_bin" and df.count() > 0


def test_flagship_reads_only_needed_columns(spark, sf_dir):
    plan = QUERIES["r31_gap_calculations"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey" in plan and "o_totalprice" not in plan and plan.count("FileScan") == 1


def test_transit_cells_are_rounded_before_they_are_completed(spark, sf_dir):
    plan = QUERIES["k08_transit_skims_cells"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    cells, given = plan.split("Generate explode(sequence(", 1)
    assert "round(" not in cells and "round(" in given
