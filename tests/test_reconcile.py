"""Loads that break constraints: every row is accepted or rejected with a reason."""

from collections import Counter
from datetime import datetime

import pytest

from logwright import schema as S
from logwright.operators import quality as K
from logwright.operators.model import Tables
from logwright.operators.reconcile import reconcile
from logwright.plans import queries as Q
from logwright.sources import store

D = datetime(2024, 1, 1, 10)


def tables(spark, types, actions, entries, details):
    """Entries: (id, type, action, size); details: (id, resource). Columns may hold NULL anywhere."""
    loose = lambda schema: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return Tables(
        spark.createDataFrame(types, loose(S.LOG_TYPE)), spark.createDataFrame(actions, loose(S.ACTION_TYPE)),
        spark.createDataFrame([(i, t, a, D, None, None, None, z) for i, t, a, z in entries], loose(S.LOG_ENTRY)),
        spark.createDataFrame([(i, "-", "-", r, 200, None, None) for i, r in details], loose(S.LOG_ACCESS_DETAIL)))


@pytest.fixture(scope="module")
def probe(spark):
    """Two details of one entry, an orphan, new types and actions, an entry without detail."""
    return tables(spark, [(1, "ACCESS"), (9, "SYSLOG")], [("a", "GET"), ("b", "PATCH")],
                  [("e1", 1, "a", 5), ("e2", 9, "a", 5), ("e3", 1, "gone", 5), ("e4", 1, None, 5)],
                  [("e1", "/x"), ("e1", "/y"), ("e0", "/z"), ("e2", "/s")])


def test_probe(spark, probe, tmp_path):
    n = store.load_tables(probe, str(tmp_path / "s"))
    assert n == {"log_type": 2, "action_type": 2, "log_entry": 3, "log_access_detail": 1, "rejected": 4}
    t = store.read_store(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, t.log_type.collect())) == [(1, "ACCESS"), (9, "SYSLOG")]
    assert sorted(r["name"] for r in t.action_type.collect()) == ["GET", "PATCH"]
    assert sorted((r["id"], r["log_type_id"]) for r in t.log_entry.collect()) == [("e1", 1), ("e2", 9), ("e4", 1)]
    assert [(r["log_entry_id"], r["resource"]) for r in t.log_access_detail.collect()] == [("e1", "/x")]
    assert [r["id"] for r in Q.q07_access_logs_below_size(t, 10).collect()] == ["e1"]  # e4 has no detail
    got = sorted((r["kind"], r["line"].split(",")[0], r["reason"]) for r in
                 store.read_rejects(spark, str(tmp_path / "s")).collect())
    assert got == [("log_access_detail", "e0", "no such log_entry"),
                   ("log_access_detail", "e1", "duplicate log_entry_id"),
                   ("log_access_detail", "e2", "log_entry is not an ACCESS entry"),
                   ("log_entry", "e3", "no such action_type")]
    assert all(r["violations"] == 0 for r in K.summary(t).collect())


def test_append_reconciles_with_the_store(spark, probe, tmp_path):
    root = str(tmp_path / "s")
    store.load_tables(probe, root, batch="one")
    more = tables(spark, [(1, "ACCESS"), (9, "OTHER"), (4, "NEW")], [("c", "GET"), ("d", "PUT")],
                  [("e1", 1, "a", 7), ("e5", 4, "b", 7), ("e6", 1, "d", 7), ("e7", 1, "c", 7)],
                  [("e1", "/again"), ("e6", "/new")])
    for _ in range(2):  # the second time the batch is known
        n = store.load_tables(more, root, mode="append", batch="two")
        assert n == {"log_type": 1, "action_type": 1, "log_entry": 2, "log_access_detail": 1, "rejected": 5}
    t = store.read_store(spark, root)
    assert sorted(map(tuple, t.log_type.collect())) == [(1, "ACCESS"), (4, "NEW"), (9, "SYSLOG")]
    assert sorted(map(tuple, t.action_type.collect())) == [("a", "GET"), ("b", "PATCH"), ("d", "PUT")]
    assert sorted(r["id"] for r in t.log_entry.collect()) == ["e1", "e2", "e4", "e5", "e6"]
    assert all(r["violations"] == 0 for r in K.summary(t).collect())
    reasons = Counter(r["reason"] for r in store.read_rejects(spark, root).filter("kind <> 'log_access_detail'").collect())
    assert reasons["duplicate id"] == 1 + 0 + 0 + 1  # e1 again; type 9 under another name
    assert reasons["duplicate name"] == 1            # GET under another id
    assert reasons["no such action_type"] == 2       # e3 before, e7 now


def test_rows_in_are_accepted_plus_rejected(spark):
    entries = [(f"e{k % 40}" if k % 9 else None, k % 4, "a" if k % 5 else "x", k % 3) for k in range(400)]
    details = [(f"e{k % 60}" if k % 7 else None, f"/{k % 2}") for k in range(300)]
    t = tables(spark, [(1, "ACCESS"), (2, "B"), (2, "C"), (None, "D"), (3, None), (7, "B")],
               [("a", "GET"), ("a", "GET"), ("q", "GET"), (None, "PUT")], entries, details)
    r = reconcile(t)
    lost = Counter()
    for row in r.rejects.collect():
        lost[row["table"]] += row["copies"]
    wide = r.wide.collect()
    assert len(entries) == len(wide) + lost["log_entry"]
    assert len(details) == sum(bool(w["has_detail"]) for w in wide) + lost["log_access_detail"]
    assert 6 == r.log_type.count() + lost["log_type"] and 4 == r.action_type.count() + lost["action_type"]
    assert len({w["id"] for w in wide}) == len(wide) and {w["log_type_id"] for w in wide} <= {1, 2}
    for w in wide:  # the smallest of the rows that are sound
        same = [z for i, ty, a, z in entries if (i, a) == (w["id"], "a") and ty in (1, 2)]
        types = [ty for i, ty, a, _ in entries if (i, a) == (w["id"], "a") and ty in (1, 2)]
        assert w["log_type_id"] == min(types) and w["size_bytes"] in same


def test_empty_tables(spark, tmp_path):
    n = store.load_tables(tables(spark, [], [], [], []), str(tmp_path / "s"))
    assert n == {"log_type": 0, "action_type": 0, "log_entry": 0, "log_access_detail": 0, "rejected": 0}
    t = store.read_store(spark, str(tmp_path / "s"))
    assert t.log_entry.count() == t.action_type.count() == t.log_type.count() == 0


def _line(k, day, method="GET"):
    return (f'9.9.9.{k} - - [{day:02d}/Mar/2004:16:05:49 -0000] "{method} /{k} HTTP/1.1" 200 1 "-" "x"',)


def test_merge_keeps_rows_and_known_batches(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    loads = {f"b{k}": {"access": spark.createDataFrame([_line(k, 1 + k), ("junk",)], "value string")} for k in range(4)}
    for name in ("b0", "b1", "b2"):
        store.ingest(spark, loads[name], root, mode="append", batch=name)

    def rows():
        return sorted(r["resource"] for r in store.read_wide(spark, root).collect()), store.read_rejects(spark, root).count()
    assert rows() == (["/0", "/1", "/2"], 3) and len(store.committed(spark, root)) == 3
    with monkeypatch.context() as m:  # interrupted after the rows, before the commit
        def fail(*a):
            raise RuntimeError("lost")
        m.setattr(store.M, "check_action_ids", fail)
        with pytest.raises(RuntimeError):
            store.merge_batches(spark, root, batch="merged")
    assert rows() == (["/0", "/1", "/2"], 3) and len(store.committed(spark, root)) == 3
    # a load that is committed while the merge runs stays visible beside it
    commit = store._roll_up

    def slow(spark_, root_, batch):
        commit(spark_, root_, batch)
        if batch == "merged":
            store.ingest(spark, loads["b3"], root, mode="append", batch="b3")
    with monkeypatch.context() as m:
        m.setattr(store, "_roll_up", slow)
        assert store.merge_batches(spark, root, batch="merged") == 6
    assert rows() == (["/0", "/1", "/2", "/3"], 4)
    assert [r["batch"] for r in store.committed(spark, root)] == ["merged", "b3"]
    for name in loads:  # replays of merged loads add nothing
        store.ingest(spark, loads[name], root, mode="append", batch=name)
    assert rows() == (["/0", "/1", "/2", "/3"], 4)
    stats = {r["batch"]: (r["total_lines"], r["matched_lines"], r["rows"]) for r in store.read_stats(spark, root).collect()}
    assert stats == {name: (2, 1, 1) for name in loads}
    t = store.read_store(spark, root)
    assert [tuple(r) for r in Q.q01_total_logs_per_action_type(t, "2004-03-01", "2004-03-31").collect()] == [("GET", 4)]
    store.ingest(spark, loads["b1"], root, batch="fresh")  # a full load replaces everything
    assert rows() == (["/1"], 1)


def test_rollups_read_rows_on_edge_days_only(spark, tmp_path):
    root = str(tmp_path / "s")
    lines = spark.createDataFrame([_line(k, 1 + k % 9, "GET" if k % 3 else "PUT") for k in range(90)], "value string")
    store.ingest(spark, {"access": lines}, root)
    t = store.read_store(spark, root)
    plain = Tables(t.log_type, t.action_type, t.log_entry, t.log_access_detail, t.wide)
    bounds = ["2004-03-01 00:00:00", "2004-03-02 16:05:49", "2004-03-02 16:05:50", "2004-03-05 00:00:00",
              "2004-03-05 23:59:59.999999", "2004-03-09 12:00:00", "2004-04-01 00:00:00"]
    for a, b in [(0, 6), (0, 0), (1, 1), (1, 5), (2, 4), (3, 4), (2, 3), (0, 3)]:
        for a, b in [(bounds[a], bounds[b])]:
            q1 = [sorted(map(tuple, Q.q01_total_logs_per_action_type(x, a, b).collect())) for x in (t, plain)]
            assert q1[0] == q1[1], (a, b)
    for name, n in (("PUT", 2), ("GET", 5)):  # the second day's row lies at the closed bound
        q2 = [sorted(map(tuple, Q.q02_logs_per_day_for_action(x, name, bounds[1], bounds[5]).collect())) for x in (t, plain)]
        assert q2[0] == q2[1] and len(q2[0]) == n
    # days strictly inside the range are read from the rollup alone
    inner = f"{root}/parsed/*/status=ok/log_type_id=1/log_date=2004-03-0[3-8]"
    assert spark.read.parquet(inner).count() == 60
    import glob
    import shutil
    for folder in glob.glob(inner):
        for f in glob.glob(f"{folder}/*.parquet"):
            open(f, "wb").close()  # reading one of these files would fail
    q1 = Q.q01_total_logs_per_action_type(t, bounds[1], bounds[5])
    assert sorted(map(tuple, q1.collect())) == [("GET", 50), ("PUT", 20)]
    shutil.rmtree(f"{root}/parsed")
    assert Q.q04_top_blocks_by_actions_per_day(t, "2004-03-01", "2004-03-05").collect() == []
