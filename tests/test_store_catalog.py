"""Text files -> store -> queries; CSV round trip; append; catalog + audit."""

import tempfile

import pytest
from pyspark.sql import functions as F

from logwright.operators import quality as K
from logwright.operators.append import append_logs
from logwright.plans import catalog as C
from logwright.sources.fixtures import fixture_lines
from logwright.sources import staged_csv
from logwright.sources.store import append_wide, ingest, load_tables, read_store, read_wide

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def store(spark):
    work = tempfile.mkdtemp(prefix="lw-test-")
    lines = fixture_lines(spark, SF)
    for k in ("access", "dataxceiver", "namesystem"):
        lines.filter(F.col("kind") == k).select("line").write.text(f"{work}/raw/{k}")
    res = ingest(spark, {k: f"{work}/raw/{k}" for k in ("access", "dataxceiver", "namesystem")},
                 f"{work}/store")
    return work, res


def test_ingest_counts(spark, store):
    work, res = store
    n_lines = spark.read.parquet(f"{SF}/events.parquet").count()
    rows = res.tables.log_entry.count()
    rejects = res.rejects.count()
    replicate_extra = res.tables.log_entry.filter("dest_ip = '10.1.0.8'").count()
    assert rows + rejects == n_lines + replicate_extra
    assert res.rejects.filter("reason = 'no match'").count() == rejects


def test_integrity_clean(spark, store):
    _, res = store
    assert all(r["violations"] == 0 for r in K.summary(res.tables).collect())


def test_csv_roundtrip(spark, store):
    work, res = store
    staged_csv.write_tables(res.tables, f"{work}/csv")
    staged = staged_csv.read_tables(spark, f"{work}/csv")
    assert staged.rejects.count() == 0
    a = sorted(tuple(r) for r in C.run(res.tables, 7, {"max_size": 1000}).collect())
    b = sorted(tuple(r) for r in C.run(staged.tables, 7, {"max_size": 1000}).collect())
    assert a == b and len(a) > 0
    counts = load_tables(staged.tables, f"{work}/from-csv")
    assert counts["log_entry"] == res.tables.log_entry.count()
    assert counts["log_access_detail"] == res.tables.log_access_detail.count()
    assert counts["action_type"] == res.tables.action_type.count() and counts["log_type"] == 3


def test_csv_forms_and_rejects(spark, tmp_path):
    for name in ("log_type", "action_type", "log_access_detail"):
        (tmp_path / name).mkdir()
    (tmp_path / "log_type" / "a.csv").write_text("id,name\n1,ACCESS\nx,BAD\n")
    (tmp_path / "action_type" / "a.csv").write_text("id,name\na,GET\nb\n")
    (tmp_path / "log_access_detail" / "a.csv").write_text(
        "log_entry_id,remote_name,auth_user,resource,http_status,referrer,user_agent\n"
        '1,-,,/x,200,,"say ""q"", x"\n2,-,,/y,2x0,,  padded agent  \n3,-,,/z\\,200,,  padded agent  \n')
    (tmp_path / "log_entry").mkdir()
    (tmp_path / "log_entry" / "a.csv").write_text(
        "id,log_type_id,action_type_id,log_timestamp,source_ip,dest_ip,block_id,size_bytes\n"
        "1,1,a,2008-11-09T20:35:18,,,,5\n2,1,a,2004-03-07T16:05:49-08:00,,,,\n"
        "3,1,a,2004-03-07T16:05:49.5Z,,,,\n4,1,a,yesterday,,,,\n5,1,a,,,,,\n")
    s = staged_csv.read_tables(spark, str(tmp_path))
    stamps = {r["id"]: r["t"] for r in s.tables.log_entry.select("id", F.date_format(
        "log_timestamp", "yyyy-MM-dd HH:mm:ss.S").alias("t")).collect()}
    assert stamps == {"1": "2008-11-09 20:35:18.0", "2": "2004-03-08 00:05:49.0", "3": "2004-03-07 16:05:49.5"}
    agents = {r["log_entry_id"]: (r["resource"], r["user_agent"]) for r in s.tables.log_access_detail.collect()}
    assert agents == {"1": ("/x", 'say "q", x'), "3": ("/z\\", "  padded agent  ")}
    reasons = sorted((r["table"], r["reason"]) for r in s.rejects.collect())
    assert reasons == [("action_type", "wrong number of columns"), ("log_access_detail", "invalid http_status"),
                       ("log_entry", "invalid log_timestamp"), ("log_entry", "log_timestamp is required"),
                       ("log_type", "invalid id")]


def test_missing_store_and_lost_facts_fail(spark, store, tmp_path):
    import shutil
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_store(spark, str(tmp_path / "none"))
    _, res = store
    copy = str(tmp_path / "copy")
    shutil.copytree(res.root, copy)
    shutil.rmtree(f"{copy}/parsed")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_wide(spark, copy)


def test_uncommitted_load_is_invisible_and_replay_adds_nothing(spark, store, tmp_path, monkeypatch):
    from logwright.sources import store as st
    line = ('9.9.9.9 - - [07/Mar/2004:16:05:49 -0800] "BREW /a HTTP/1.1" 200 1 "-" "x"',)
    one = {"access": spark.createDataFrame([line], "value string")}
    root = str(tmp_path / "s")
    st.ingest(spark, one, root, batch="a")
    with monkeypatch.context() as m:
        def fail(*a):
            raise RuntimeError("lost")
        m.setattr(st.M, "check_action_ids", fail)  # after the rows, before the commit
        with pytest.raises(RuntimeError):
            st.ingest(spark, one, root, mode="append", batch="b")
    assert read_wide(spark, root).count() == 1
    for _ in range(2):
        r = st.ingest(spark, one, root, mode="append", batch="b")
        assert (r.ok_rows, r.rejected_rows) == (1, 0) and read_wide(spark, root).count() == 2
    assert [x["name"] for x in read_store(spark, root).action_type.collect()] == ["BREW"]


def test_append_parses_each_line_once(spark, store, tmp_path):
    from logwright.sources import store as st
    _, res = store
    seen = spark.sparkContext.accumulator(0)
    lines = ['9.9.9.9 - - [07/Mar/2004:16:05:49 -0800] "GET /%d HTTP/1.1" 200 1 "-" "x"' % k for k in range(60)]

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    counted = spark.createDataFrame([(x,) for x in lines], "value string").mapInArrow(count, "value string")
    root = str(tmp_path / "s")
    st.ingest(spark, {"access": counted}, root, mode="append")
    assert seen.value == 60 and read_wide(spark, root).count() == 60


def test_append_then_query(spark, store):
    work, res = store
    req = spark.createDataFrame(
        [("ACCESS", "GET", "2024-01-07 10:00:00", "9.9.9.9", None, None, 5, "-", "-", "/z", 200,
          None, "Mozilla/5.0"),
         ("NOPE", "GET", "2024-01-07 10:00:00", "9.9.9.9", None, None, 5, None, None, None, None,
          None, None)],
        "log_type_name string, action_type_name string, log_timestamp string, source_ip string, "
        "dest_ip string, block_id bigint, size_bytes bigint, remote_name string, auth_user string, "
        "resource string, http_status int, referrer string, user_agent string")
    out = append_logs(res.tables, req)
    assert [r["reason"] for r in out.rejected.collect()] == ["Unknown log_type: NOPE"]
    append_wide(out.accepted, f"{work}/store")
    t = read_store(spark, f"{work}/store")
    ips = [r["source_ip"] for r in C.run(t, 11, {"method": "GET", "start": "2024-01-07 09:00:00",
                                                 "end": "2024-01-07 11:00:00"}).collect()]
    assert "9.9.9.9" in ips


def test_catalog_validation_and_audit(spark, store):
    work, res = store
    audit = C.AuditLog(spark, f"{work}/audit")
    with pytest.raises(ValueError):
        C.run(res.tables, 1, {"start": "2024-01-10", "end": "2024-01-05"}, audit=audit)
    with pytest.raises(ValueError):
        C.run(res.tables, 3, {}, audit=audit)
    rows = list(C.run_rows(res.tables, 2, {"action_name": "GET", "start": "2024-01-01",
                                           "end": "2024-01-31"}, user_id=7, audit=audit))
    assert rows
    C.run(res.tables, 5, {}, user_id=7, audit=audit)  # recorded though nobody reads the result
    listing = C.run(res.tables, 15, {}, user_id=7, audit=audit).collect()
    assert [r["query_text"] for r in listing] == ["q15_audit_listing", "q05_referrers_multiple_resources",
                                                  "q02_logs_per_day_for_action"]
    assert audit.compact(f"{work}/audit2").listing().count() == 3


def test_catalog_insert(spark, store):
    work, res = store
    audit = C.AuditLog(spark, f"{work}/audit3")
    req = spark.createDataFrame(
        [("ACCESS", "GET", "2024-01-08T10:00:00", "8.8.8.8", None, None, "5"),
         ("ACCESS", "GET", "soon", "8.8.8.8", None, None, "5")],
        "log_type_name string, action_type_name string, log_timestamp string, source_ip string, "
        "dest_ip string, block_id string, size_bytes string")
    n, out = C.insert(res.tables, req, f"{work}/store", audit=audit, batch="insert-1")
    assert n == 1 and [r["reason"] for r in out.rejected.collect()] == ["invalid log_timestamp"]
    assert C.insert(res.tables, req, f"{work}/store", audit=audit, batch="insert-1")[0] == 1
    assert read_wide(spark, f"{work}/store").filter("source_ip = '8.8.8.8'").count() == 1


def test_naive_bounds_are_session_time(spark, store, monkeypatch):
    import time
    from datetime import datetime
    _, res = store
    text = {"start": "2024-01-07 09:00:00", "end": "2024-01-09 11:00:00"}
    want = sorted(map(tuple, C.run(res.tables, 1, text).collect()))
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        got = C.run(res.tables, 1, {k: datetime.fromisoformat(v) for k, v in text.items()}).collect()
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    assert sorted(map(tuple, got)) == want and want


def test_result_orders(spark, store):
    _, res = store
    counts = [r["logs"] for r in C.run(res.tables, 1, {"start": "2024-01-01", "end": "2024-02-01"}).collect()]
    assert counts == sorted(counts, reverse=True) and len(counts) > 2
    days = [r["total_logs"] for r in C.run(res.tables, 2, {"action_name": "GET", "start": "2024-01-01",
                                                           "end": "2024-02-01"}).collect()]
    assert days == sorted(days, reverse=True) and days


def test_stream_to_store(spark, store):
    from logwright.streaming.ingest import run_to_store
    work, res = store
    q = run_to_store(spark, {k: f"{work}/raw/{k}" for k in ("access", "dataxceiver", "namesystem")},
                     f"{work}/streamed", f"{work}/stream-ckpt", available_now=True)
    q.awaitTermination()
    t = read_store(spark, f"{work}/streamed")
    assert t.log_entry.count() == res.tables.log_entry.count()
    assert t.log_access_detail.count() == res.tables.log_access_detail.count()
    # line counts of the epochs add up to those of the files
    from logwright.sources.store import read_stats
    whole = {r["kind"]: (r["total_lines"], r["matched_lines"]) for r in read_stats(spark, f"{work}/store").collect()
             if r["total_lines"]}
    epochs = read_stats(spark, f"{work}/streamed")
    assert all(r["batch"].startswith("stream-") for r in epochs.collect())
    summed = epochs.groupBy("kind").agg(F.sum("total_lines").alias("t"), F.sum("matched_lines").alias("m"))
    assert {r["kind"]: (r["t"], r["m"]) for r in summed.collect()} == whole and len(whole) == 3


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_prune_and_avoid_shuffles(spark, store):
    from logwright.plans import queries as Q
    _, res = store
    t = res.tables
    p7 = _plan(Q.q07_access_logs_below_size(t, 1000))
    assert "Exchange" not in p7 and "Join" not in p7          # 1:1 join is a filter
    assert "PartitionFilters: [isnotnull(log_type_id" in p7
    p1 = _plan(Q.q01_total_logs_per_action_type(t, "2024-01-05 00:00:00", "2024-01-10 00:00:00"))
    assert "log_date" in p1.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<action_type_id:string,log_timestamp:timestamp>" in p1
    assert "BroadcastHashJoin" in p1
    p11 = _plan(Q.q11_ips_with_method_in_range(t, "ACCESS", "GET", "2024-01-02 00:00:00",
                                              "2024-01-03 00:00:00"))
    assert "dynamicpruning" in p11


def test_archived_access_format(spark):
    from logwright.operators import parse as P
    line = '1.2.3.4 - - [07/Mar/2004:16:05:49 -0800] "PROPFIND /a HTTP/1.1" 207 - "-" "ua"'
    df = spark.createDataFrame([(line,)], "value string")
    r = P.parse_lines(df, P.ARCHIVED_ACCESS).rows.collect()[0]
    assert (r["action_name"], r["resource"], r["http_status"], r["size_bytes"]) == ("PROPFIND", "/a", 207, None)


def test_match_stats_per_file(spark, store):
    from logwright.operators import parse as P
    from logwright.sources.logs import read_log
    work, _ = store
    stats = P.match_stats(read_log(spark, f"{work}/raw/dataxceiver"), "dataxceiver").collect()
    assert stats and all(r["file"].startswith("file:") for r in stats)
    total = sum(r["total_lines"] for r in stats)
    matched = sum(r["matched_lines"] for r in stats)
    events = spark.read.parquet(f"{SF}/events.parquet")
    shapes = events.select((F.col("event_id") % 7).alias("s"))
    assert total == shapes.filter("s IN (1, 2, 3, 6)").count()
    assert matched == shapes.filter("s IN (1, 2, 3)").count()     # shape 6 is the WARN reject


def test_folder_is_one_scan_and_routed(spark, store, tmp_path):
    from logwright.sources import store as st
    from logwright.sources.logs import LOG_FILES
    lines = fixture_lines(spark, SF)
    for k, name in LOG_FILES.items():
        lines.filter(F.col("kind") == k).select("line").write.text(f"{tmp_path}/raw/day1/{name}")
    lines.select("line").write.text(f"{tmp_path}/raw/access_log_full.bak")  # another name
    typed = st._typed_all(spark, f"{tmp_path}/raw", True)
    plan = typed._jdf.queryExecution().optimizedPlan()
    assert len(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(plan.collectLeaves())) == 1
    cols = [c for c in read_wide(spark, store[1].root).columns if c != "id"]
    first = st.ingest(spark, f"{tmp_path}/raw", f"{tmp_path}/store")
    again = st.ingest(spark, {k: f"{store[0]}/raw/{k}" for k in LOG_FILES}, f"{tmp_path}/store2")
    a, b = (sorted(map(str, r.tables.wide.select(*cols).collect())) for r in (first, again))
    assert a == b and len(a) > 100
    assert sorted(map(str, first.rejects.collect())) == sorted(map(str, again.rejects.collect()))
