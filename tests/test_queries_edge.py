"""Hand tables for what an order-insensitive hash cannot see."""

from datetime import datetime

from logwright import schema as S
from logwright.operators.model import Tables, action_type_table, log_type_table
from logwright.plans import queries as Q

ACTS = ["GET", "POST", "served", "replicate"]


def _tables(spark, entries, details=()):
    at = action_type_table(spark.createDataFrame([(a,) for a in ACTS], "name string"))
    ids = {r["name"]: r["id"] for r in at.collect()}
    le = spark.createDataFrame(
        [(f"e{i}", t, ids.get(a), ts, ip, None, blk, size)
         for i, (t, a, ts, ip, blk, size) in enumerate(entries)], S.LOG_ENTRY)
    lad = spark.createDataFrame(list(details), S.LOG_ACCESS_DETAIL)
    return Tables(log_type_table(spark), at, le, lad)


def _detail(spark, resources):
    ents = [(1, "GET", datetime(2024, 1, 1), "1.1.1.1", None, 10) for _ in resources]
    dets = [(f"e{i}", "-", "-", r, 200, None, "x") for i, r in enumerate(resources)]
    return _tables(spark, ents, dets)


def test_q6_tie_at_top_is_empty(spark):
    t = _detail(spark, ["/a", "/a", "/b", "/b", "/c"])
    assert Q.q06_second_most_common_resource(t).collect() == []


def test_q6_tie_at_second_gives_all(spark):
    t = _detail(spark, ["/a", "/a", "/a", "/b", "/c", None])
    got = sorted((r["resource"] or "", r["frequency"]) for r in Q.q06_second_most_common_resource(t).collect())
    assert got == [("", 1), ("/b", 1), ("/c", 1)]


def test_q12_same_method_twice_is_empty(spark):
    ents = [(1, "GET", datetime(2024, 1, 1, 1), "1.1.1.1", None, 1)]
    t = _tables(spark, ents)
    assert Q.q12_ips_with_two_methods_in_range(t, "ACCESS", "GET", "GET", "2024-01-01", "2024-01-02").collect() == []


def test_q8_nulls_first_and_repeat_per_day(spark):
    d1, d2 = datetime(2024, 1, 1, 3), datetime(2024, 1, 2, 3)
    ents = [(3, "replicate", d1, None, 5, None), (2, "served", d1, None, 5, None),
            (3, "replicate", d2, None, 5, None), (2, "served", d2, None, 5, None),
            (3, "replicate", d1, None, None, None), (2, "served", d1, None, None, None),
            (3, "replicate", d1, None, 9, None)]
    t = _tables(spark, ents)
    assert [r["block_id"] for r in Q.q08_blocks_rep_and_serv_same_day(t).collect()] == [None, 5, 5]


def test_closed_vs_half_open(spark):
    edge = datetime(2024, 1, 2)
    ents = [(1, "GET", edge, "1.1.1.1", None, 1)]
    t = _tables(spark, ents)
    assert Q.q01_total_logs_per_action_type(t, "2024-01-01", "2024-01-02").collect()[0]["logs"] == 1
    assert Q.q11_ips_with_method_in_range(t, "ACCESS", "GET", "2024-01-01", "2024-01-02").collect() == []


def test_q3_ties_kept_and_null_group(spark):
    d = datetime(2024, 1, 5, 1)
    ents = [(1, "GET", d, "1.1.1.1", None, 1), (1, "POST", d, "1.1.1.1", None, 1),
            (1, "GET", d, None, None, 1)]
    t = _tables(spark, ents)
    got = sorted((r["source_ip"] or "", r["action_type_name"])
                 for r in Q.q03_most_common_action_per_source_ip(t, "2024-01-05").collect())
    assert got == [("", "GET"), ("1.1.1.1", "GET"), ("1.1.1.1", "POST")]


def test_q13_exactly_n(spark):
    d = datetime(2024, 1, 3)
    ents = [(1, a, d, "1.1.1.1", None, 1) for a in ("GET", "POST")] + [(1, "GET", d, "2.2.2.2", None, 1)]
    t = _tables(spark, ents)
    rows = Q.q13_ips_with_n_methods_in_range(t, "ACCESS", 2, "2024-01-01", "2024-01-04").collect()
    assert [(r["source_ip"], r["cnt"], r["methods"]) for r in rows] == [("1.1.1.1", 2, "GET|POST")]


def test_append_ignore_case(spark):
    from logwright.operators.append import append_logs
    t = _tables(spark, [(1, "GET", datetime(2024, 1, 1), "1.1.1.1", None, 1)])
    req = spark.createDataFrame(
        [("access", "get", "2024-01-01 00:00:00", "1.1.1.1", None, None, None)],
        "log_type_name string, action_type_name string, log_timestamp string, source_ip string, "
        "dest_ip string, block_id bigint, size_bytes bigint")
    assert append_logs(t, req).accepted.count() == 0
    acc = append_logs(t, req, ignore_case=True).accepted.collect()
    assert len(acc) == 1 and acc[0]["action_name"] == "GET" and acc[0]["log_type_id"] == 1


def test_integrity_checks_find_violations(spark):
    from logwright.operators import quality as K
    d = datetime(2024, 1, 1)
    t = _tables(spark, [(1, "GET", d, "1.1.1.1", None, 1), (2, "served", d, None, 5, None)],
                [("e1", "-", "-", "/a", 200, None, "x"),       # detail on an HDFS entry
                 ("e9", "-", "-", "/b", 200, None, "x")])      # detail without entry
    le = t.log_entry.unionByName(t.log_entry.limit(1))         # duplicate id e0
    bad_fk = spark.createDataFrame([("e7", 1, "no-such-id", d, None, None, None, None)], S.LOG_ENTRY)
    assert K.duplicate_keys(le, "id").collect()[0]["id"] == "e0"
    assert K.orphans(t.log_entry.unionByName(bad_fk), "action_type_id", t.action_type,
                     "id").collect()[0]["id"] == "e7"
    assert sorted(r["log_entry_id"] for r in K.detail_scope_violations(t).collect()) == ["e1", "e9"]
    nulls = spark.createDataFrame([("e8", 1, None, None, None, None, None, None)],
                                  "id string, log_type_id short, action_type_id string, "
                                  "log_timestamp timestamp, source_ip string, dest_ip string, "
                                  "block_id long, size_bytes long")
    assert K.null_violations(nulls, "id", "log_type_id", "log_timestamp").count() == 1


def test_address_and_stamp_forms(spark):
    from logwright.functions.timestamps import access_timestamp
    from logwright.functions.values import is_ip
    good = ["1.2.3.4", "10.0.0.1/24", "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::ffff:1.2.3.4",
            "fe80::1/64", "1:2:3:4:5:6:1.2.3.4"]
    bad = ["1.2.3.4\n", "1.2.3", "256.1.1.1", "01.2.3.4", "1:2:3:4:5:6:7::1:2:3:4:5:6:7", "1:2:3:4:5:6:7", ":::",
           "1::2::3", "1:2:3:4:5:6:7:8:9", "12345::", "::1/129", "10.0.0.1/33", "::1\n", "1:2:3:4:5:6:7:1.2.3.4"]
    df = spark.createDataFrame([(x,) for x in good + bad], "a string")
    got = {r["a"]: r["ok"] for r in df.select("a", is_ip(df.a).alias("ok")).collect()}
    assert [a for a in good if not got[a]] == [] and [a for a in bad if got[a]] == []
    stamps = ["07/Mar/2004:16:05:49 -0800", "7/Mar/2004:16:05:49 +03:00", "07/Mar/2004:16:05:49 Z",
              "07/Mar/2004:16:05:49 ", "07/Mar/2004:16:05:49"]
    df = spark.createDataFrame([(x,) for x in stamps], "a string")
    got = [r["ok"] for r in df.select(access_timestamp(df.a).isNotNull().alias("ok")).collect()]
    assert got == [True, True, True, False, False]


def _exchanges(df) -> list:
    """Exchanges of the initial plan, the result sort's among them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "Exchange " in x and "BroadcastExchange" not in x]


def test_constraints_read_each_table_once(spark, tmp_path):
    from logwright.operators import quality as K
    d = datetime(2024, 1, 1)
    t = _tables(spark, [(1, "GET", d, "1.1.1.1", None, 1), (9, "served", d, None, 5, None)],
                [("e0", "-", "-", "/a", 200, None, "x"), ("e1", "-", "-", "/a", 200, None, "x"),
                 ("e7", "-", "-", "/b", 200, None, "x")])
    frames = []
    for name in ("log_type", "action_type", "log_entry", "log_access_detail"):
        getattr(t, name).write.parquet(f"{tmp_path}/{name}")
        frames.append(spark.read.parquet(f"{tmp_path}/{name}"))
    out = K.summary(Tables(*frames))
    got = {r["check"]: r["violations"] for r in out.collect() if r["violations"]}
    assert got == {"foreign key log_entry(log_type_id)": 1, "foreign key log_access_detail(log_entry_id)": 1,
                   "detail scope": 2}
    plan = K.summary(Tables(*frames))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4 and "Join" not in plan
    empty = K.summary(Tables(*[f.limit(0) for f in frames])).collect()
    assert len(empty) == len(K.UNIQUE) + 9 + len(K.FOREIGN) and not any(r["violations"] for r in empty)


def test_q13_bitmaps_and_sets_agree(spark, monkeypatch):
    from pyspark.sql import functions as F
    names = [f"M{k:03d}" for k in range(150)]  # three words of bits
    at = action_type_table(spark.createDataFrame([(n,) for n in names], "name string"))
    at = at.union(at.select(F.concat(F.lit("second-"), "id"), "name"))  # every name under two ids
    used = {f"10.0.0.{k}": sorted({names[(k * 37 + j * (k + 1)) % 150] for j in range(k % 6)}) for k in range(60)}
    used[None] = [names[0], names[62], names[149]]
    rows = [(ip, n, j) for ip, ns in used.items() for n in ns for j in range(2)]
    base = spark.createDataFrame(rows, "source_ip string, n string, j int").join(at, F.col("n") == F.col("name"))
    le = base.select(F.lit("x").alias("id"), F.lit(1).cast("short").alias("log_type_id"), F.col("id").alias("action_type_id"),
                     F.lit("2024-01-02 00:00:00").cast("timestamp").alias("log_timestamp"), "source_ip",
                     F.lit(None).cast("string").alias("dest_ip"), F.lit(None).cast("long").alias("block_id"),
                     F.lit(None).cast("long").alias("size_bytes"))
    t = Tables(log_type_table(spark), at, le, spark.createDataFrame([], S.LOG_ACCESS_DETAIL))
    for n in (1, 3, 5):
        want = sorted(((ip, len(ns), "|".join(ns)) for ip, ns in used.items() if len(ns) == n), key=str)
        call = (t, "ACCESS", n, "2024-01-01", "2024-01-03")
        assert sorted(map(tuple, Q.q13_ips_with_n_methods_in_range(*call).collect()), key=str) == want and want
        with monkeypatch.context() as m:
            m.setattr(Q, "MAX_BITS", 10)
            assert sorted(map(tuple, Q.q13_ips_with_n_methods_in_range(*call).collect()), key=str) == want


def test_exchanges_of_the_grouping_queries(spark, tmp_path):
    from logwright.sources.fixtures import fixture_tables
    t = fixture_tables(spark, "/root/testdata/sf0.001")
    for name, df in (("log_type", t.log_type), ("action_type", t.action_type), ("wide", t.wide)):
        df.write.parquet(f"{tmp_path}/{name}")
    t = Tables.from_wide(*(spark.read.parquet(f"{tmp_path}/{name}") for name in ("log_type", "action_type", "wide")))
    q13 = _exchanges(Q.q13_ips_with_n_methods_in_range(t, "ACCESS", 4, "2024-01-02", "2024-01-05"))
    assert len(q13) == 2 and "rangepartitioning" in q13[0]      # the aggregation, the result sort
    q3 = _exchanges(Q.q03_most_common_action_per_source_ip(t, "2024-01-05"))
    assert len(q3) == 3 and "rangepartitioning" in q3[0]        # counts, ranks, the result sort


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    from logwright.sources import bucketed
    d = datetime(2024, 1, 1)
    t = _tables(spark, [(1, "GET", d, "1.1.1.1", None, k) for k in range(300)],
                [(f"e{k}", "-", "-", f"/{k}", 200, None, f"Mozilla/{k % 3}.0") for k in range(0, 300, 2)])
    root = str(tmp_path / "buckets")
    bucketed.write_tables(t, root, buckets=5)
    files = list((tmp_path / "buckets" / "log_entry").glob("*.parquet"))
    assert len(files) == 5  # one a bucket
    try:
        for session in (spark, spark.newSession()):
            session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
            b = bucketed.open_tables(session, root)
            out = Q.q07_access_logs_below_size(b, 100)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert sorted(r["resource"] for r in out.collect()) == sorted(f"/{k}" for k in range(0, 100, 2))
            assert Q.q10_access_logs_by_user_agent_version(b, "2.0").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
