"""Joins with the small fixed dimensions leave the events where they are: no task gets all rows of a name."""

import datetime as dt

import pytest

from logwright.operators import model as M
from logwright.operators.append import append_logs
from logwright.plans import registry as R
from logwright.sources.fixtures import fixture_action_type, fixture_tables, fixture_wide


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """One event type for most events, and events without id, type or user."""
    d = tmp_path_factory.mktemp("events")
    ts = dt.datetime(2024, 1, 5, 7)
    rows = [(i, ts, i % 13, "view" if i % 10 else "click", float(i), None) for i in range(400)]
    rows += [(400, ts, 1, None, 1.0, None), (None, ts, 2, "view", 1.0, None), (401, ts, None, "view", None, None)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{d}/events.parquet")
    return str(d)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_are_not_dealt_by_action_name(spark, events):
    p = plan(fixture_wide(spark, events))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "hashpartitioning" not in p
    assert fixture_wide(spark, events).count() == 403


@pytest.mark.parametrize("key", ["m08_upsert", "u02_action_merge", "a08_uuid_conflict"])
def test_names_are_reduced_before_any_exchange(spark, events, key):
    assert "SortMergeJoin" not in plan(R.QUERIES[key](spark, events))


def test_upsert_of_the_names(spark, events):
    got = {r["name"]: r["id"] for r in R.QUERIES["m08_upsert"](spark, events).collect()}
    ids = {r["name"]: r["id"] for r in fixture_action_type(spark).collect()}
    # odd ids view, the row without a type (an even id) DELETE, the one without an id HDFS
    assert got == {"receiving": ids["receiving"]}


def test_appended_rows_are_not_dealt_by_name(spark, events):
    t = fixture_tables(spark, events)
    rows = [("ACCESS", n, "2024-01-05T07:00:00", None, None, None, None) for n in ("GET", "PATCH")]
    req = spark.createDataFrame(rows, "log_type_name string, action_type_name string, log_timestamp string, "
                                      "source_ip string, dest_ip string, block_id string, size_bytes string")
    out = append_logs(t, req)
    assert "SortMergeJoin" not in plan(out.accepted) and "hashpartitioning" not in plan(out.accepted)
    assert [r["action_name"] for r in out.accepted.collect()] == ["GET"]
    assert [r["reason"] for r in out.rejected.collect()] == ["Unknown action_type: PATCH"]


def test_fixed_rows(spark):
    t = M.log_type_table(spark)
    assert [tuple(r) for r in t.collect()] == [(1, "ACCESS"), (2, "HDFS_DATAXCEIVER"), (3, "HDFS_NAMESYSTEM")]
    assert not any(f.nullable for f in t.schema.fields)
    assert len({r["id"] for r in fixture_action_type(spark).collect()}) == 10
