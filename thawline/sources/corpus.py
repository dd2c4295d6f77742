"""Derived log corpus: raw archive events computed from the driver's ``events`` table.

Each ``events`` row becomes one raw log event of a frozen bucket.  The shape is
picked by ``event_id % 8`` (0-1 access, 2 syslog, 3 sshd failure, 4 sudo,
5 CloudTrail JSON, 6 VPC flow line, 7 free text) and the classification
evidence by ``event_id % 3`` (0 sourcetype, 1 only source, 2 only message), so
every classification branch is reached.  Broken rows (``-`` bytes, missing
HTTP version, impossible date, December line read in January, 29 February,
broken JSON, short flow lines, empty and tab-only text, CR inside a line, an
IPv6 address, 20 KB in front of an access line) come from ``event_id % 97``.

The same definition is written in DuckDB SQL in ``plans/oracle.py``; the two
must stay in step.  Pure per-row column expressions: one narrow ``select``
over the scan, no shuffle, grows linearly with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline.session import ensure_utc

EPOCH_DAY_2024 = 19723  # 2024-01-01

RAW_COLUMNS = (
    "event_id", "index_name", "bucket_name", "bucket_latest", "bucket_earliest", "bucket_seq",
    "event_time_ms", "index_time", "host", "source", "sourcetype", "message",
)


def s(c: Column) -> Column:
    return c.cast("string")


def lit(v) -> Column:
    return F.lit(v)


def _case(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        v = v if isinstance(v, Column) else lit(v)
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out.otherwise(default if isinstance(default, Column) else lit(default))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` scan, dealt evenly by ``event_id``: row groups do not bound the regex work downstream."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").repartition("event_id")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw archive events derived from ``events``, materialised once as a Parquet table.

    The table lives in the shared checkpoint folder, keyed by the input's files
    (names, sizes, times) and this module's source, and is written under another
    name first.  Later plans scan it with column pruning instead of re-deriving every row.
    """
    import inspect
    import sys
    import uuid

    from thawline import storage
    from thawline.session import checkpoint_dir, compiled_methods

    ensure_utc(spark)
    code = inspect.getsource(sys.modules[__name__]).encode()
    key = storage.fingerprint(spark, f"{sf_dir}/events.parquet", code)
    base = f"{checkpoint_dir(spark).rstrip('/')}/thawline-corpus"
    path = f"{base}/{key}"
    if not storage.exists(spark, f"{path}/_SUCCESS"):
        tmp = f"{base}/{key}.tmp-{uuid.uuid4().hex}"
        with compiled_methods(spark):
            raw_events_from(events(spark, sf_dir)).write.parquet(tmp)
        storage.rename(spark, tmp, path)  # where another writer was first, its table is identical
    return spark.read.parquet(path)


def raw_events_from(ev: DataFrame) -> DataFrame:
    i = F.col("event_id")
    u = F.col("user_id")
    et = F.col("event_type")
    ts = F.col("ts")
    k = i % 8
    e3 = i % 3
    b97 = i % 97
    t_ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    day = F.floor(t_ms / 86400000)

    index_name = _case(k, {0: "apache", 1: "nginx", 2: "syslog", 3: "secure", 4: "secure",
                           5: "cloudtrail", 6: "vpc_flowlogs"}, "app")
    earliest = day * 86400
    # -- metadata strings -------------------------------------------------
    st_base = _case(k, {0: "access_combined", 1: "nginx:plus:kv", 2: "syslog", 3: "linux_secure",
                        4: "Linux:Syslog", 5: "aws:cloudtrail", 6: "aws:cloudwatchlogs:vpcflow"},
                    _case(u % 3, {0: "elb_app", 1: "app_json"}, "json"))
    src_base = _case(k, {0: "/var/log/apache2/access.log", 1: "/var/log/nginx/access.log",
                         2: _case(u % 7, {0: "/VAR/LOG/SYSLOG"}, "/var/log/syslog"),
                         3: "/var/log/auth.log", 4: "/var/log/syslog", 5: "/var/log/cloudtrail/trail.json",
                         6: "/var/log/vpc/flow.log"}, "/opt/app/app.log")
    sourcetype = F.when(e3 == 0, F.when(i % 2 == 0, F.concat(lit("sourcetype::"), st_base)).otherwise(st_base)
                        ).otherwise(lit(""))
    source = F.when(e3 == 1, F.when(i % 2 == 0, F.concat(lit("source::"), src_base)).otherwise(src_base)
                    ).otherwise(lit(""))
    h = F.concat(lit("web-"), s(u % 10))
    host = _case(i % 4, {0: F.concat(lit("host::"), h), 1: h, 2: F.concat(lit("source::"), h)},
                 F.concat(lit("host::host::"), h))

    # -- access line --------------------------------------------------------
    ip = F.concat_ws(".", lit("10"), s(u % 256), s(i % 256), s(F.expr("event_id div 256") % 256))
    auth = F.when(u % 3 == 0, lit("-")).otherwise(F.concat(lit("u"), s(u)))
    shifted = F.when(i % 4 == 3, ts + F.expr("INTERVAL 2 HOURS")).otherwise(ts)
    zone = F.when(i % 4 == 3, lit("+0200")).otherwise(lit("+0000"))
    hdate = F.when(b97 == 2, F.concat(lit("31/Feb/2024:"), F.date_format(ts, "HH:mm:ss"))).otherwise(
        F.date_format(shifted, "dd/MMM/yyyy:HH:mm:ss"))
    method0 = _case(et, {"view": "GET", "click": "POST", "purchase": "PUT", "signup": "PATCH"}, "DELETE")
    method = F.when(i % 13 == 0, F.lower(method0)).otherwise(method0)
    url = F.concat(lit("/"), et, lit("/"), s(u), lit("?k="), F.regexp_extract(F.col("props"), "([0-9]+)", 1))
    ver = _case(i % 3, {0: "1.1", 1: "1.0"}, "2.0")
    proto = F.when(b97 == 1, lit("")).otherwise(F.concat(lit(" HTTP/"), ver))
    status = F.when(et == "error", lit("500")).otherwise(_case(i % 10, {0: "404", 1: "301"}, "200"))
    nbytes = F.when(b97 == 0, lit("-")).otherwise(s(F.floor(F.col("value") * 10)))
    referrer = F.when(i % 5 == 0, lit("")).otherwise(F.concat(lit("https://example.com/"), et))
    agent = F.concat(lit("Mozilla/5.0 (X11; Linux x86_64) Agent/"), s(u % 7))
    access = F.concat(
        F.when(b97 == 12, F.repeat(lit("a b "), 5000)).when(i % 11 == 0, lit("  ")).otherwise(lit("")),
        F.when(b97 == 12, lit("#")).otherwise(lit("")), ip, lit(" - "), auth, lit(" ["), hdate, lit(" "), zone, lit('] "'), method, lit(" "), url, proto,
        lit('" '), status, lit(" "), nbytes, lit(' "'), referrer, lit('" "'), agent, lit('"'))

    # -- syslog family -------------------------------------------------------
    sysdate = F.when(b97 == 3, lit("Dec 31 23:59:59")).when(b97 == 4, lit("Feb 29 12:00:00")).otherwise(
        F.concat(F.date_format(ts, "MMM"), lit(" "), F.lpad(s(F.dayofmonth(ts)), 2, " "), lit(" "),
                 F.date_format(ts, "HH:mm:ss")))
    prog = _case(k, {3: "sshd", 4: "sudo"}, _case(i % 3, {0: "cron", 1: "kernel"}, "systemd"))
    pid = F.concat(lit("["), s(u + 1000), lit("]"))
    pidpart = _case(k, {3: pid, 4: lit("")}, F.when(i % 2 == 0, pid).otherwise(lit("")))
    source_ip = F.when(b97 == 11, F.concat(lit("2001:db8::"), s(u % 256))).otherwise(
        F.concat(lit("10.1."), s(u % 256), lit("."), s(i % 256)))
    sys_text = _case(
        k,
        {3: F.concat(lit("Failed password for "), F.when(i % 2 == 0, lit("invalid user ")).otherwise(lit("")),
                     lit("bob"), s(u), lit(" from "), source_ip, lit(" port "),
                     s(i % 60000 + 1024), lit(" ssh2")),
         4: F.concat(lit("alice"), s(u), lit(" : TTY=pts/"), s(i % 5), lit(" ; PWD=/home/alice"), s(u),
                     lit(" ; USER=root ; COMMAND=/bin/"), et, lit(" --id "), s(i))},
        F.concat(lit("session opened for user u"), s(u), lit(" value "), s(F.floor(F.col("value")))))
    syslog = F.concat(lit("<"), s(u % 191), lit(">"), sysdate, lit(" web-"), s(u % 10), lit(" "), prog, pidpart,
                      lit(": "), sys_text)

    # -- CloudTrail JSON -------------------------------------------------------
    acct = F.concat(lit("1234"), F.lpad(s(u), 8, "0"))
    svc = _case(et, {"view": "s3", "click": "ec2", "purchase": "iam", "signup": "sts"}, "kms")
    name = _case(et, {"view": "GetObject", "click": "RunInstances", "purchase": "CreateUser",
                      "signup": "AssumeRole"}, "Decrypt")
    ct_body = F.concat(lit('"eventSource":"'), svc, lit('.amazonaws.com","eventName":"'), name,
                       lit('","recipientAccountId":"'), acct, lit('","awsRegion":"eu-west-1"}'))
    trail = F.when(b97 == 5, lit('{"eventVersion": "1.08", "eventName": ')).when(
        i % 2 == 0, F.concat(lit('{"eventVersion":"1.08",'), ct_body)).otherwise(F.concat(lit("{"), ct_body))

    # -- VPC flow line -----------------------------------------------------------
    start = F.floor(t_ms / 1000)
    action = F.when(i % 4 == 0, lit("REJECT")).otherwise(lit("ACCEPT"))
    flow = F.when(b97 == 6, F.concat_ws(" ", lit("2"), acct, lit("eni-x"), lit("- - - - - - -"), s(start),
                                         s(start + 60), lit("- NODATA"))).otherwise(
        F.concat_ws(" ", lit("2"), acct, F.concat(lit("eni-"), s(u + 100000)),
                    F.concat(lit("10.0."), s(u % 256), lit("."), s(i % 256)),
                    F.concat(lit("172.16."), s(F.expr("event_id div 256") % 256), lit("."), s(u % 200 + 1)),
                    s(i % 65535), _case(i % 3, {0: "443", 1: "22"}, "80"), lit("6"), s(i % 50 + 1),
                    s(F.floor(F.col("value") * 100)), s(start), s(start + 60), action,
                    F.when(b97 == 8, lit(None)).otherwise(lit("OK"))))

    # -- free text -------------------------------------------------------------------
    free = _case(b97, {7: lit(""), 9: lit("\t\t"), 10: lit("line one\rline two")},
                 F.concat(et, lit(" "), F.col("props"), lit(" Grüße")))

    message = _case(k, {0: access, 1: access, 2: syslog, 3: syslog, 4: syslog, 5: trail, 6: flow}, free)

    return ev.select(
        i.alias("event_id"),
        index_name.alias("index_name"),
        F.concat(lit("db_"), s(earliest + 86399), lit("_"), s(earliest), lit("_"), s(day % 100)).alias("bucket_name"),
        (earliest + 86399).alias("bucket_latest"),
        earliest.alias("bucket_earliest"),
        (day % 100).alias("bucket_seq"),
        t_ms.alias("event_time_ms"),
        (F.floor(t_ms / 1000) + i % 5).alias("index_time"),
        host.alias("host"),
        source.alias("source"),
        sourcetype.alias("sourcetype"),
        message.alias("message"),
    )
