"""Grok fast path (one regexp_replace + split) equals a plain regex search, edge rows included."""

import re
import time

from pyspark.sql import functions as F

from thawline.functions import patterns as P
from thawline.operators.parse import SEP, route_and_parse, with_access_grok, with_grok

ACCESS = [
    '1.2.3.4 - frank [10/Oct/2000:13:55:36 -0700] "GET /a.gif HTTP/1.0" 200 2326 "http://x/" "Mozilla/4.08"',
    '1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.0" 200 - "-" "x"',
    '1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET /a" 200 1 "-" "x"',
    '1.2.3.4 - - [10/Oct/2000:13:55:36 +0200] "get /a HTTP/1.1" 404 0 "" "agent"',
    '   host.example - - [01/Jan/2024:00:00:00 +0000] "DELETE /x?y=1 HTTP/2.0" 500 12 "ref" "ua"',
    '1.2.3.4 - - [32/Foo/2024:00:00:00 +0000] "GET /a HTTP/1.0" 200 1 "-" "x"',
    '1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET /a\u0001b HTTP/1.0" 200 1 "-" "x"',
    "", "\t\t", "not an access line at all",
]
SYSLOG = [
    "<34>Oct 11 22:14:15 mymachine su[230]: 'su root' failed for lonvick on /dev/pts/8",
    "<13>Feb  5 17:32:18 10.0.0.99 Use the BFG!",
    "<13>Feb  5 17:32:18 host prog: no pid",
    "<86>Dec 31 23:59:59 host sshd[1]: Failed password for invalid user x from 10.0.0.1 port 22 ssh2",
    "<86>Feb 29 12:00:00 host sudo: bob : TTY=pts/0 ; PWD=/ ; USER=root ; COMMAND=/bin/ls",
    "<86>Feb 29 12:00:00 host sudo: bob : TTY=pts/0 ; PWD=/ ; USER=root ; COMMAND=/bin/ls\u0001x",
    "line one\rline two", "",
]
SUB = [
    "Failed password for invalid user x from 10.0.0.1 port 22 ssh2",
    "Failed password for root from 10.0.0.1 port 2222 ssh2",
    "bob : TTY=pts/0 ; PWD=/ ; USER=root ; COMMAND=/bin/ls -la",
    "Accepted password for root from 10.0.0.1 port 22 ssh2",
]


def search(pattern, value, n):
    m = re.search(pattern, value)
    return None if m is None else tuple(g if g is not None else "" for g in m.groups()[:n])


def check(spark, values, pattern, names):
    df = spark.createDataFrame([(v,) for v in values], "m string")
    out = with_grok(df, F.col("m"), pattern, names, "g").collect()
    for r in out:
        got = None if r.g is None else tuple(r.g)
        assert got == search(pattern, r.m, len(names)), repr(r.m)


def test_access_grok(spark):
    check(spark, ACCESS, P.ACCESS_GROK, P.ACCESS_FIELDS)


LINE = '[10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.0" 200 1 "r" "ua"'
HEADS = ["h - - ", "h  - ", "h -  ", "h  ", "h ", "", "#h.x: a b c ", "..h-1 x y z ", "--- h i j ", "x\nh i j ", "h i j\n", "h\t- - ", "é h i j ",
         "h - - [bad] ", "h i\u0001 j ", "a#b c d e ", "a b:c_ d ", "h - -", "h i j  "]


def test_linear_access_grok_equals_search(spark):
    values = ACCESS + [h + LINE for h in HEADS] + [h + LINE + "\n" + h + LINE for h in HEADS] + ["junk " + h + LINE[:-1] for h in HEADS]
    df = spark.createDataFrame([(v,) for v in values], "m string")
    for r in with_access_grok(df, F.col("m"), "g", F.lit(True)).collect():
        got = None if r.g is None else tuple(r.g)
        assert got == search(P.ACCESS_GROK, r.m, len(P.ACCESS_FIELDS)), repr(r.m)


def test_long_lines_take_linear_time(spark):
    long = ["a b " * 25_000, "a" * 100_000, ("x " * 30_000) + LINE, LINE + " y" * 50_000, ("h " * 20_000) + LINE[:-1], '"' * 100_000,
            "[10/Oct/2000:13:55:36 -0700] " * 3_000, "<1>Oct 11 22:14:15 h " + "p" * 100_000, "bob" * 30_000 + " : TTY="]
    df = spark.createDataFrame([(v, "access_log", 0) for v in long] + [(v, "syslog", 0) for v in long], "message string, kind string, event_time_ms long")
    start = time.time()
    rows = route_and_parse(df).select("client_ip", "event_category").collect()
    assert len(rows) == 2 * len(long) and time.time() - start < 60


def test_sshd_addresses(spark):
    lines = [f"Failed password for root from {ip} port 22 ssh2" for ip in ("10.0.0.1", "2001:db8::7", "::1", "fe80::1%eth0", "::ffff:10.0.0.1")]
    df = spark.createDataFrame([(v,) for v in lines], "m string")
    got = [r.g.source_ip for r in with_grok(df, F.col("m"), P.SSHD_FAILED_GROK, P.SSHD_FIELDS, "g").collect()]
    assert got == ["10.0.0.1", "2001:db8::7", "::1", "fe80::1%eth0", "::ffff:10.0.0.1"]


def test_syslog_grok(spark):
    check(spark, SYSLOG, P.SYSLOG_GROK, P.SYSLOG_FIELDS)


def test_sub_groks(spark):
    check(spark, SUB, P.SSHD_FAILED_GROK, P.SSHD_FIELDS)
    check(spark, SUB, P.SUDO_GROK, P.SUDO_FIELDS)


def test_separator_rows_take_the_exact_path():
    assert any(SEP in v for v in ACCESS) and any(SEP in v for v in SYSLOG)
