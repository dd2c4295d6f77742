"""Parse processors (grok / date / convert / set / dissect / JSON) and the kind router.

All parsers are column expressions evaluated in one ``select`` after the
classification, so routing by kind costs no shuffle and no extra job.

Grok is a regex *search*.  Extracting n groups with n ``regexp_extract`` calls
runs the match n times; instead one ``regexp_replace`` rewrites the whole
value to the groups joined by a separator and one ``split`` takes them apart.
Values that already contain the separator take the slow but exact path
(``rlike`` + one ``regexp_extract`` per group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thawline.functions import patterns as P
from thawline.functions.text import col

SEP = "\u0001"


def _apply(df: DataFrame, *stages: dict[str, Column]) -> DataFrame:
    """One projection for each stage; columns of a stage may use those of the stages before it."""
    for columns in stages:
        df = df.withColumns(columns)
    return df


def _grok_stages(src: Column, pattern: str, names: tuple[str, ...], out: str, cond: Column | None = None) -> list[dict[str, Column]]:
    """Rewrite and split, then assemble: projections of their own, so that each regex runs once per row."""
    jp = P.java(pattern)
    n = len(names)
    whole = P.java(r"^(?s).*?(?-s)" + pattern + r"(?s).*$")
    repl = SEP.join(f"${i + 1}" for i in range(n))
    on = src.isNotNull() if cond is None else (cond & src.isNotNull())
    has_sep = F.contains(src, F.lit(SEP))
    tmp = f"_{out}_parts"
    parts = F.col(tmp)
    fast = F.struct(*[parts.getItem(i).alias(nm) for i, nm in enumerate(names)])
    slow = F.struct(*[F.regexp_extract(src, jp, i + 1).alias(nm) for i, nm in enumerate(names)])
    return [{tmp: F.when(on & ~has_sep, F.split(F.regexp_replace(src, whole, repl), SEP, -1))},
            {out: F.when(F.size(parts) == n, fast).when(on & has_sep & src.rlike(jp), slow)}]


def with_grok(df: DataFrame, src: Column, pattern: str, names: tuple[str, ...], out: str,
              cond: Column | None = None) -> DataFrame:
    """Add struct column ``out`` holding the pattern's groups (NULL when no match or ``cond`` false).

    Groups that did not take part in the match come out as ``''``.
    """
    return _apply(df, *_grok_stages(src, pattern, names, out, cond)).drop(f"_{out}_parts")


def _access_stages(src: Column, out: str, cond: Column) -> list[dict[str, Column]]:
    """Access lines in time linear in the line; the columns ``_<out>_tail``, ``_line`` and ``_head`` are for dropping.

    Four lazy groups in front of a date make a plain search retry every combination of their ends
    on lines that do not match.  Here the first bracketed date with a whole request behind it is
    found first; host, ident and auth are then taken from the rest of its line before it.
    """
    whole = P.java(r"^((?s).*?)" + P.ACCESS_TAIL + r"(?s).*$")
    head = P.java(r"^(?s).*?(?-s)" + P.ACCESS_HEAD_JAVA)
    n_head, n = 3, len(P.ACCESS_FIELDS)
    on = cond & src.isNotNull()
    has_sep = F.contains(src, F.lit(SEP))

    def groups(c: Column, pattern: str, k: int) -> Column:
        """The pattern's k groups; some other number of parts where it does not match."""
        fast = F.split(F.regexp_replace(c, pattern, SEP.join(f"${i + 1}" for i in range(k))), SEP, -1)
        slow = F.when(c.rlike(pattern), F.array(*(F.regexp_extract(c, pattern, i + 1) for i in range(k))))
        return F.when(has_sep, slow).otherwise(fast)

    tail, line, first = f"_{out}_tail", f"_{out}_line", f"_{out}_head"
    t, h = F.col(tail), F.col(first)
    values = [h.getItem(i) for i in range(n_head)] + [t.getItem(i + 1) for i in range(n - n_head)]
    found = F.struct(*(v.alias(nm) for v, nm in zip(values, P.ACCESS_FIELDS)))
    return [{tail: F.when(on, groups(src, whole, n - n_head + 1))},
            {line: F.when(F.size(t) == n - n_head + 1, F.substring_index(t.getItem(0), "\n", -1))},
            {first: F.when(F.endswith(F.col(line), F.lit(" ")), groups(F.col(line), head, n_head))},
            {out: F.when(F.size(h) == n_head, found)}]


def with_access_grok(df: DataFrame, src: Column, out: str, cond: Column) -> DataFrame:
    """``with_grok`` for access lines (``_access_stages``)."""
    return _apply(df, *_access_stages(src, out, cond)).drop(f"_{out}_tail", f"_{out}_line", f"_{out}_head")


def set_original(message: Column) -> Column:
    """``event.original`` copy of the message, skipped when empty."""
    return F.when(F.length(message) > 0, message)


def access_timestamp_ms(ts_text: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss Z`` -> epoch ms, NULL when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(ts_text, F.lit("dd/MMM/yyyy:HH:mm:ss Z")))


def syslog_timestamp_ms(ts_text: Column, event_time_ms: Column) -> Column:
    """Year-less syslog time -> epoch ms (UTC).

    Year rule: the year of the event's journal time; if that lands more than
    one day after the journal time, the year before.
    """
    squeezed = F.regexp_replace(ts_text, " +", " ")
    year = F.year(F.timestamp_millis(event_time_ms))

    def at(y: Column) -> Column:
        return F.unix_millis(F.try_to_timestamp(F.concat(y.cast("string"), F.lit(" "), squeezed),
                                                F.lit("yyyy MMM d HH:mm:ss")))

    this_year = at(year)
    return F.when(this_year.isNotNull() & (this_year <= event_time_ms + 86400000), this_year).otherwise(at(year - 1))


def cloud_trail_fields(v: Column) -> dict[str, Column]:
    """CloudTrail JSON (a parsed VARIANT) -> event name / source, account id."""
    return {
        "aws_cloudtrail_event_name": F.try_variant_get(v, "$.eventName", "string"),
        "aws_cloudtrail_event_source": F.try_variant_get(v, "$.eventSource", "string"),
        "cloud_account_id": F.try_variant_get(v, "$.recipientAccountId", "string"),
    }


def vpc_flow_fields(toks: Column) -> dict[str, Column]:
    """Dissect of a version-2 flow line into ``aws_vpcflow_*`` (14 tokens, else no fields)."""
    ok = F.size(toks) == len(P.VPC_FIELDS)
    ints = {"srcport", "dstport", "protocol"}
    longs = {"packets", "bytes", "start", "end"}
    out = {}
    for i, nm in enumerate(P.VPC_FIELDS):
        v = F.when(ok, toks.getItem(i))
        if nm in ints:
            v = v.try_cast("int")
        elif nm in longs:
            v = v.try_cast("bigint")
        out["aws_vpcflow_" + nm] = v
    return out


CATEGORY = {P.ACCESS_LOG: P.CATEGORY_ACCESS, P.SYSLOG: P.CATEGORY_SYSLOG, P.CLOUD_TRAIL: P.CATEGORY_CLOUD_TRAIL,
            P.VPC_FLOW: P.CATEGORY_VPC_FLOW, P.GENERIC: P.CATEGORY_GENERIC}

ACCESS_OUT = ("client_ip", "http_ident", "http_auth", "http_request_timestamp", "http_request_method",
              "url_original", "http_version", "http_response_status_code", "http_response_body_bytes",
              "http_request_referrer", "user_agent_original")
SYSLOG_OUT = ("log_syslog_priority", "syslog_timestamp", "syslog_hostname", "syslog_program", "process_pid",
              "syslog_message", "user_name", "source_ip", "source_port", "sudo_tty", "sudo_pwd", "sudo_user",
              "sudo_command")
CLOUD_OUT = ("aws_cloudtrail_event_name", "aws_cloudtrail_event_source", "cloud_account_id")
VPC_OUT = tuple("aws_vpcflow_" + n for n in P.VPC_FIELDS)
PARSED_COLUMNS = ("event_original", "event_category", "ts_ms") + ACCESS_OUT + SYSLOG_OUT + CLOUD_OUT + VPC_OUT


def route_and_parse(df: DataFrame, kinds=P.KINDS, kind="kind", message="message", event_time_ms="event_time_ms",
                    dataset: str | None = None) -> DataFrame:
    """Run exactly the parser of each row's kind, as a few narrow projections.

    ``kinds`` is the router's list: rows of other kinds pass through unparsed
    (no ``event_category``, no fields).  ``ts_ms`` is the parsed ``@timestamp``
    (the journal time unless a date processor parsed one).  ``dataset`` fixes
    ``event.dataset`` (legacy parsers, T15).
    """
    k = col(kind)
    m = col(message)
    t = col(event_time_ms)
    kinds = set(kinds)

    def on(kd: str) -> Column:
        return (k == kd) if kd in kinds else F.lit(False)

    # one regex / JSON parse / split per row, only for its own kind; parsers that wait for nothing of each
    # other share a projection, as every projection copies the row
    acc = _access_stages(m, "_acc", on(P.ACCESS_LOG))
    sys = _grok_stages(m, P.SYSLOG_GROK, P.SYSLOG_FIELDS, "_sys", on(P.SYSLOG))
    # sub-parsers of the syslog message (sshd failure, sudo)
    sm = F.col("_sys.syslog_message")
    sshd = _grok_stages(sm, P.SSHD_FAILED_GROK, P.SSHD_FIELDS, "_sshd")
    # a user name starts where no user-name character precedes it: long words are tried once
    sudo = _grok_stages(sm, r"(?<![a-zA-Z0-9._-])" + P.SUDO_GROK, P.SUDO_FIELDS, "_sudo", F.contains(sm, F.lit(" : TTY=")))
    trail_and_flow = {
        "_ct": F.when(on(P.CLOUD_TRAIL) & F.startswith(F.ltrim(m), F.lit("{")), F.try_parse_json(m)),
        "_vpc": F.when(on(P.VPC_FLOW), F.split(m, " ", -1)),
    }
    df = _apply(df, acc[0] | sys[0] | trail_and_flow, acc[1] | sys[1], acc[2] | sshd[0] | sudo[0], acc[3] | sshd[1] | sudo[1])
    # dates, converts, sets
    a, sy, sh, su = (F.col("_acc"), F.col("_sys"), F.col("_sshd"), F.col("_sudo"))
    acc_ts = access_timestamp_ms(a.getField("http_request_timestamp"))
    sys_ts = syslog_timestamp_ms(sy.getField("syslog_timestamp"), t)
    out: dict[str, Column] = {}
    for nm in P.ACCESS_FIELDS:
        out[nm] = a.getField(nm)
    out["http_version"] = a.getField("http_version").try_cast("float")
    out["http_response_status_code"] = a.getField("http_response_status_code").try_cast("int")
    out["http_response_body_bytes"] = a.getField("http_response_body_bytes").try_cast("bigint")
    for nm in P.SYSLOG_FIELDS:
        out[nm] = sy.getField(nm)
    out["log_syslog_priority"] = sy.getField("log_syslog_priority").try_cast("int")
    out["process_pid"] = F.nullif(sy.getField("process_pid"), F.lit("")).try_cast("int")
    out["source_ip"] = sh.getField("source_ip")
    out["source_port"] = sh.getField("source_port").try_cast("int")
    # sudo runs after sshd: its user.name wins when both match.
    out["user_name"] = F.coalesce(su.getField("sudo_user_name"), sh.getField("sshd_user_name"))
    out["sudo_tty"] = su.getField("sudo_tty")
    out["sudo_pwd"] = su.getField("sudo_pwd")
    out["sudo_user"] = su.getField("sudo_user")
    out["sudo_command"] = su.getField("sudo_command")
    out.update(cloud_trail_fields(F.col("_ct")))
    out.update(vpc_flow_fields(F.col("_vpc")))
    out["ts_ms"] = (F.when(a.isNotNull() & acc_ts.isNotNull(), acc_ts)
                    .when(sy.isNotNull() & sys_ts.isNotNull(), sys_ts).otherwise(t))
    routed = k.isin(list(kinds))
    cat = None
    for kd, c in CATEGORY.items():
        if kd in kinds:
            cat = F.when(k == kd, F.lit(c)) if cat is None else cat.when(k == kd, F.lit(c))
    out["event_original"] = F.when(routed, set_original(m))
    out["event_category"] = cat if cat is not None else F.lit(None).cast("string")
    if dataset is not None:
        out["dataset"] = F.lit(dataset)
    return df.withColumns(out).drop(
        "_acc", "_sys", "_ct", "_vpc", "_sshd", "_sudo", "__acc_tail", "__acc_line", "__acc_head", "__sys_parts", "__sshd_parts", "__sudo_parts")


def legacy_parse(df: DataFrame, index_name: str = "index_name") -> DataFrame:
    """The older fixed per-index parsers: the index picks the parser (apache/nginx access,
    syslog) and ``event.dataset`` is a fixed name; no ``event.kind`` is set."""
    idx = col(index_name)
    lk = F.when(idx == "syslog", F.lit(P.SYSLOG)).otherwise(F.lit(P.ACCESS_LOG))
    ds = F.when(idx == "syslog", F.lit(P.LEGACY_DATASETS["syslog"])).when(
        idx == "nginx", F.lit(P.LEGACY_DATASETS["nginx"])).otherwise(F.lit(P.LEGACY_DATASETS["apache"]))
    out = route_and_parse(df.withColumn("_legacy_kind", lk), kinds=(P.ACCESS_LOG, P.SYSLOG), kind="_legacy_kind")
    return out.withColumn("dataset", ds).drop("_legacy_kind")
