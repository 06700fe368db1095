import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# These run whole streaming jobs; the smaller tables show the same.
SLOW = {
    "stream_window_agg", "stream_message_windows", "wallclock_window_agg", "forecast_additive", "stream_late_repair",
    "stream_live_gaps", "stream_live_scores", "stream_one_pass_pairs", "wallclock_closed_windows", "keyed_store_upserts",
}
TEXT = {name for name in QUERIES if name.startswith("op") or name == "pipeline"}


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - TEXT <= set(ORACLES)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 14
    assert "window_start" in frame.columns


@pytest.mark.parametrize("name", sorted(set(ORACLES) - TEXT))
def test_equals_sql(spark, small, medium, name):
    folder = small if name in SLOW else medium
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == ""


def test_text_queries_are_optional(monkeypatch):
    """Without the subpackage the entry point has all other queries."""
    monkeypatch.setattr(entry, "TEXT", False)
    monkeypatch.setattr(entry, "PIPELINE", False)
    assert set(entry.queries()) == set(QUERIES) - TEXT
    assert set(entry.oracle_sql()) == set(ORACLES) - TEXT


@pytest.mark.parametrize("name, most", [("forecast_report", 1), ("prepare_series", 2), ("series_index", 2)])
def test_scans_of_a_plan(spark, small, name, most):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan") <= most


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW - TEXT))
def test_no_cross_joins(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["stream_window_agg", "wallclock_window_agg"])
def test_streams_read_tables_of_many_files(spark, small, tmp_path, name):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    assert differences(QUERIES[name](spark, str(tmp_path)), connect(small), ORACLES[name]) == ""
