"""Classification on hand-made edge rows against a brute-force Python classifier of the documented rules."""

import re

from pyspark.sql import functions as F

from thawline.functions import patterns as P
from thawline.operators.classify import classify


def brute(sourcetype, source, message, index):
    def strip(v):
        for p in P.PREFIXES:
            if v.startswith(p):
                return v[len(p):]
        return v
    st, src, msg = strip(sourcetype).lower(), strip(source).lower(), message.strip()
    rules = [
        (st and re.search(P.ACCESS_SOURCETYPE, st), "access_log", f"sourcetype={st!r}"),
        (st and re.search(P.SYSLOG_SOURCETYPE, st), "syslog", f"sourcetype={st!r}"),
        (st and re.search(P.CLOUD_TRAIL_SOURCETYPE, st), "cloud_trail", f"sourcetype={st!r}"),
        (st and re.search(P.VPC_FLOW_SOURCETYPE, st), "vpc_flow", f"sourcetype={st!r}"),
        (src and re.search(P.ACCESS_SOURCE, src), "access_log", f"source={src!r}"),
        (src and re.search(P.SYSLOG_SOURCE, src), "syslog", f"source={src!r}"),
        (re.match(P.ACCESS_MESSAGE, msg, re.IGNORECASE), "access_log", P.REASON_ACCESS_MESSAGE),
        (re.match(P.SYSLOG_MESSAGE, msg), "syslog", P.REASON_SYSLOG_MESSAGE),
    ]
    for hit, kind, reason in rules:
        if hit:
            break
    else:
        kind, reason = "generic", P.REASON_FALLBACK
    return kind, (f"{index}.{kind}" if index else kind), reason


ROWS = [
    ("", "", '1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.0" 200 2326 "-" "x"', "web"),
    ("", "", '  1.2.3.4 - - [10/Oct/2000:13:55:36 -0700] "get /a HTTP/1.0" 200 - "" "x"', "web"),
    ("", "", '1.2.3.4\u2003-\u2003- [10/Oct/2000:13:55:36 -0700]\u2003"POST\u2003/a', ""),
    ("", "", "<34>Oct 11 22:14:15 host prog[12]: text", "sys"),
    ("", "", "<34>Oct  1 22:14:15 host prog: text", "sys"),
    ("", "", "\u00a0<34>Oct 11 22:14:15 host prog: text\u3000", "sys"),
    ("", "", "<34>Oct 11 22:14:15\u2003host prog: text", ""),
    ("", "", "<34>oct 11 22:14:15 host prog: text", ""),
    ("sourcetype::ELB_logs", "", "x", "aws"),
    ("album", "", "x", ""),
    ("host::host::syslog", "", "x", "i"),
    ("", "source::/VAR/LOG/NGINX/error.log", "x", "i"),
    ("", "/var/log/syslog.1", "x", ""),
    ("", "C:\\logs\\access.log", "x", "win"),
    ("it's", "", "x", ""),
    ("", "", "", ""), ("", "", "\t\t", ""), ("", "", "line one\rline two", ""), ("", "", "Grüße", "de"),
    ("aws:cloudtrail", "", "{}", "ct"), ("AWS:CloudWatchLogs:VPCFlow", "", "", "vpc"),
]


def test_classify_matches_brute_force(spark):
    df = spark.createDataFrame(ROWS, "sourcetype string, source string, message string, index_name string")
    got = classify(df).select("sourcetype", "source", "message", "index_name", "kind", "dataset", "reason").collect()
    for r in got:
        assert (r.kind, r.dataset, r.reason) == brute(r.sourcetype, r.source, r.message, r.index_name), r
