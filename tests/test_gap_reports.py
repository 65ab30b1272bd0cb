"""All convergence reports from one scan, beside each report on its own."""

from pyspark.sql import functions as F

from commuta.operators.lineage import written_table
from commuta.plans import gap


def test_one_scan_gives_every_report(spark, tables, rows, monkeypatch):
    columns = ["mode", gap.CODE, "start_s", "end_s", "routed_travel_time", "path", "experienced_gap", "person"]
    trip = tables.trip.select(*columns)
    odd = trip.limit(40).select(*[F.when(F.rand(k) < 0.6, F.col(c)).alias(c) for k, c in enumerate(columns)])  # unknown values of every kind
    trip = written_table(trip.unionByName(odd), "trips")
    plans = []
    monkeypatch.setattr(gap, "written_table", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written_table(df, name))
    made = gap.gap_reports(trip, 3)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and plans[0].count("Exchange hashpartitioning") == 1
    for name, got in made.items():
        alone = getattr(gap, name)(trip, 3) if name == "mode_count_baseline" else getattr(gap, name)(trip)
        assert got.columns == alone.columns, name
        near = [rows(df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])) for df in (got, alone)]
        assert near[0] == near[1], name


def test_no_trips(spark, tables, rows):
    trip = tables.trip.limit(0)
    for name, got in gap.gap_reports(trip).items():
        assert rows(got) == rows(getattr(gap, name)(trip)), name
