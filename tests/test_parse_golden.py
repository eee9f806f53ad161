"""Golden lines: each covers one parsing rule (spaces in the resource, '-'
fields, empty fields, optional size, level filter, century pivot, explode)."""

from datetime import datetime

import pytest

from logwright.operators import parse as P

ACCESS = [
    '10.1.2.3 - - [07/Mar/2004:16:05:49 -0800] "GET /a b.html?x=1 HTTP/1.1" 200 4523 "-" "Mozilla/5.0 (X11)"',
    'host.example.org - bob [07/Mar/2004:23:30:00 -0800] "get /x HTTP/1.0" 304 - "http://r.example/" "-" trailing',
    '10.1.2.3 - - [07/Mar/2004:16:05:49 -0800] "GET /old" 200 1 "-" "x"',
    '10.1.2.3 - - [07/Mar/2004:16:05:49 -0800] "GET /e HTTP/1.1" 200 7 "" ""',
]
DATAX = [
    "081109 203518 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_-16 src: /10.2.1.1:54106 dest: /10.2.1.2:50010",
    "081109 203520 143 INFO dfs.DataNode$DataXceiver: Received block blk_-16 src: /10.2.1.1:54106 dest: /10.2.1.2:50010 of size 911",
    "081109 203520 143 INFO dfs.DataNode$DataXceiver: Received block blk_77 src: /10.2.1.1:54106 dest: /10.2.1.2:50010",
    "081109 203525 143 INFO dfs.DataNode$DataXceiver: 10.2.1.2:50010 Served block blk_-16 to /10.2.1.9",
    "081109 203525 143 WARN dfs.DataNode$DataXceiver: 10.2.1.2:50010 Served block blk_-16 to /10.2.1.9",
    "081109 203520 143 INFO dfs.DataNode$DataXceiver: Received block blk_1-2 src: /10.2.1.1:54106 dest: /10.2.1.2:50010",
]
NAMES = [
    "081109 203526 26 INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blockMap updated: 10.2.1.2:50010 is added to blk_-16 size 911",
    "081109 213526 26 INFO dfs.FSNamesystem: BLOCK* ask 10.2.1.2:50010 to replicate blk_-16 to datanode(s) 10.2.1.7:50010 10.2.1.8:50010",
    "690101 000000 26 INFO dfs.FSNamesystem: BLOCK* ask 10.2.1.2:50010 to replicate blk_5 to datanode(s) 10.2.1.7:50010 ",
]


def _parse(spark, lines, kind, **kw):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "n int, value string")
    p = P.parse_lines(df, kind, keep=["n"], **kw)
    return ({r["n"]: r for r in p.rows.collect()} if kind != "namesystem"
            else sorted(p.rows.collect(), key=lambda r: (r["n"], r["dest_ip"] or ""))), \
        {r["n"]: r["reason"] for r in p.rejects.collect()}


def test_access_lines(spark):
    rows, rej = _parse(spark, ACCESS, "access")
    r = rows[0]
    assert r["action_name"] == "GET"
    assert r["log_timestamp"] == datetime(2004, 3, 8, 0, 5, 49)       # UTC session
    assert r["source_ip"] == "10.1.2.3" and r["size_bytes"] == 4523
    assert r["resource"] == "/a b.html?x=1" and r["http_status"] == 200
    assert r["referrer"] is None and r["user_agent"] == "Mozilla/5.0 (X11)"
    assert r["remote_name"] == "-" and r["auth_user"] == "-"
    assert r["dest_ip"] is None and r["block_id"] is None
    assert rej[1] == "bad source ip"          # a host name is not an INET value
    assert rej[2] == "no match"               # protocol missing
    r = rows[3]
    assert r["size_bytes"] == 7 and r["referrer"] is None and r["user_agent"] is None


def test_access_without_ip_check(spark):
    rows, _ = _parse(spark, ACCESS, "access", validate_ips=False)
    r = rows[1]
    assert r["action_name"] == "get"                                   # case kept
    assert r["log_timestamp"] == datetime(2004, 3, 8, 7, 30, 0)
    assert r["size_bytes"] is None and r["auth_user"] == "bob" and r["user_agent"] == "-"
    assert r["referrer"] == "http://r.example/"


def test_dataxceiver_lines(spark):
    rows, rej = _parse(spark, DATAX, "dataxceiver")
    assert rows[0]["action_name"] == "receiving"
    assert rows[0]["log_timestamp"] == datetime(2008, 11, 9, 20, 35, 18)
    assert (rows[0]["source_ip"], rows[0]["dest_ip"], rows[0]["block_id"]) == ("10.2.1.1", "10.2.1.2", -16)
    assert rows[0]["size_bytes"] is None
    assert rows[1]["action_name"] == "received" and rows[1]["size_bytes"] == 911
    assert rows[2]["block_id"] == 77 and rows[2]["size_bytes"] is None
    assert rows[3]["action_name"] == "served"
    assert (rows[3]["source_ip"], rows[3]["dest_ip"]) == ("10.2.1.2", "10.2.1.9")
    assert rej[4] == "no match"               # WARN level
    assert rej[5] == "bad block id"           # blk_1-2


def test_namesystem_lines(spark):
    rows, rej = _parse(spark, NAMES, "namesystem")
    assert not rej
    upd = [r for r in rows if r["n"] == 0][0]
    assert upd["action_name"] == "update" and upd["source_ip"] == "10.2.1.2"
    assert upd["dest_ip"] is None and upd["block_id"] == -16 and upd["size_bytes"] == 911
    rep = [r for r in rows if r["n"] == 1]
    assert [r["dest_ip"] for r in rep] == ["10.2.1.7", "10.2.1.8"]
    assert all(r["log_timestamp"] == datetime(2008, 11, 9, 21, 35, 26) for r in rep)
    old = [r for r in rows if r["n"] == 2]
    assert len(old) == 1 and old[0]["log_timestamp"] == datetime(1969, 1, 1, 0, 0, 0)


def test_separator_in_line_takes_exact_path(spark):
    line = '10.1.2.3 - - [07/Mar/2004:16:05:49 -0800] "GET /a\u0001b HTTP/1.1" 200 1 "-" "x"'
    rows, rej = _parse(spark, [line], "access")
    assert not rej and rows[0]["resource"] == "/a\u0001b"


def test_match_stats(spark):
    df = spark.createDataFrame([("f", s) for s in DATAX], "file string, value string")
    r = P.match_stats(df, "dataxceiver").collect()[0]
    assert (r["total_lines"], r["matched_lines"]) == (6, 5)
