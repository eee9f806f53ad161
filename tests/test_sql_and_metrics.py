"""SQL table functions over a store's views; elapsed time and row count of one execution."""

import pytest
from pyspark.sql import functions as F

from logwright.operators.model import Tables
from logwright.plans import catalog as C
from logwright.plans import registry as R
from logwright.plans import sql_functions as SF
from logwright.sources import store
from logwright.sources.fixtures import fixture_lines, fixture_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sql"))
    lines = fixture_lines(spark, SF_DIR)
    return store.ingest(spark, {k: lines.filter(F.col("kind") == k).select("line")
                                for k in ("access", "dataxceiver", "namesystem")}, root).tables


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_functions_equal_the_catalog_on_a_store(spark, loaded):
    SF.register(spark, loaded)
    texts = {2: "fn_logs_per_day_for_action('GET', '2024-01-02 00:00:00', '2024-01-12 00:00:00')",
             4: "fn_top_blocks_by_actions_per_day('2024-01-02', '2024-01-20')",  # the limit's default
             7: "fn_access_logs_below_size(5)", 9: "fn_blocks_rep_and_serv_same_day_hour()",
             10: "fn_access_logs_by_user_agent_version('5.0')", 3: "fn_most_common_action_per_source_ip('2024-01-05')"}
    for key, text in texts.items():
        want = _rows(C.run(loaded, key, R._CALLS[key]))
        assert _rows(spark.sql(f"SELECT * FROM {text}")) == want, key
    assert sum(bool(C.run(loaded, k, R._CALLS[k]).count()) for k in texts) >= 5
    for key, view in SF.VIEWS.items():
        assert _rows(spark.table(view)) == _rows(C.run(loaded, key))
    assert spark.table("log_entry").columns == list(R.S.ENTRY_FIELDS)
    joined = spark.sql("SELECT l.day, SUM(l.total_logs) AS n FROM fn_logs_per_day_for_action('GET', '2024-01-02', '2024-01-05') l "
                       "WHERE l.day > DATE'2024-01-02' GROUP BY l.day")
    days = C.run(loaded, 2, {"action_name": "GET", "start": "2024-01-02", "end": "2024-01-05"})
    assert _rows(joined) == _rows(days.filter("day > DATE'2024-01-02'"))


def test_arguments_reach_the_scan(spark, loaded):
    SF.register(spark, loaded)
    plan = SF.call(spark, 2, "GET", "2024-01-02 00:00:00", "2024-01-03 00:00:00")._jdf.queryExecution().executedPlan().toString()
    scan = next(p for p in plan.split("\n") if "log_timestamp" in p and "Scan parquet" in p)
    assert "GreaterThanOrEqual(log_timestamp," in scan and "log_date" in scan.split("PartitionFilters:")[1].split("]")[0]
    plan = SF.call(spark, 4, "2024-01-02", "2024-01-20", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=3" in plan


def test_prefixed_functions_live_side_by_side(spark, loaded):
    other = fixture_tables(spark, SF_DIR)
    SF.register(spark, loaded, "a_")
    SF.register(spark, Tables(other.log_type, other.action_type, other.log_entry, other.log_access_detail), "b_")
    for prefix, t in (("a_", loaded), ("b_", other)):
        assert _rows(SF.call(spark, 5, prefix=prefix)) == _rows(C.run(t, 5))
        assert _rows(SF.call(spark, 7, 5, prefix=prefix)) == _rows(C.run(t, 7, {"max_size": 5}))


def test_run_rows_counts_and_times_one_execution(spark, loaded):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    schema = loaded.log_access_detail.schema
    t = Tables(loaded.log_type, loaded.action_type, loaded.log_entry,
               loaded.log_access_detail.coalesce(1).mapInArrow(count, schema))
    rows = C.run_rows(t, 5)
    details = loaded.log_access_detail.count()
    assert rows.elapsed_ms > 0 and rows.row_count == len(rows) == C.run(loaded, 5).count()
    assert rows.columns == ["referrer", "resource_frequency"]
    got = list(rows)
    assert len(got) == rows.row_count and set(got[0]) == set(rows.columns)
    assert seen.value == details  # the details were read once
    ordered = [r["total_logs"] for r in C.run_rows(loaded, 2, R._CALLS[2])]
    assert ordered == sorted(ordered, reverse=True) and ordered


def test_audit_is_written_before_and_not_measured(spark, loaded, tmp_path, monkeypatch):
    import time

    class Slow(C.AuditLog):
        def record(self, *args):
            time.sleep(20)
            super().record(*args)
    audit = Slow(spark, str(tmp_path / "audit"))
    rows = C.run_rows(loaded, 5, user_id=3, audit=audit)
    assert rows.elapsed_ms < 20_000 and audit.listing().first()["query_text"] == "q05_referrers_multiple_resources"
    rows.close()
