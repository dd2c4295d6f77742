"""DuckDB (ANSI-ish) SQL twins of the plans, used as the correctness oracle.

``corpus`` below must stay in step with ``thawline.sources.corpus``.
"""

from __future__ import annotations

from thawline.functions import patterns as P

CORPUS = r"""
raw AS (
  SELECT *, epoch_us(ts) // 1000 AS t_ms, event_id % 8 AS k, event_id % 3 AS e3, event_id % 97 AS b97,
         CAST(user_id AS VARCHAR) AS su
  FROM events
),
parts AS (
  SELECT *,
    t_ms // 86400000 AS day,
    CASE k WHEN 0 THEN 'apache' WHEN 1 THEN 'nginx' WHEN 2 THEN 'syslog' WHEN 3 THEN 'secure'
           WHEN 4 THEN 'secure' WHEN 5 THEN 'cloudtrail' WHEN 6 THEN 'vpc_flowlogs' ELSE 'app' END AS index_name,
    CASE k WHEN 0 THEN 'access_combined' WHEN 1 THEN 'nginx:plus:kv' WHEN 2 THEN 'syslog'
           WHEN 3 THEN 'linux_secure' WHEN 4 THEN 'Linux:Syslog' WHEN 5 THEN 'aws:cloudtrail'
           WHEN 6 THEN 'aws:cloudwatchlogs:vpcflow'
           ELSE CASE user_id % 3 WHEN 0 THEN 'elb_app' WHEN 1 THEN 'app_json' ELSE 'json' END END AS st_base,
    CASE k WHEN 0 THEN '/var/log/apache2/access.log' WHEN 1 THEN '/var/log/nginx/access.log'
           WHEN 2 THEN CASE WHEN user_id % 7 = 0 THEN '/VAR/LOG/SYSLOG' ELSE '/var/log/syslog' END
           WHEN 3 THEN '/var/log/auth.log' WHEN 4 THEN '/var/log/syslog'
           WHEN 5 THEN '/var/log/cloudtrail/trail.json' WHEN 6 THEN '/var/log/vpc/flow.log'
           ELSE '/opt/app/app.log' END AS src_base,
    'web-' || CAST(user_id % 10 AS VARCHAR) AS h,
    CASE WHEN event_id % 4 = 3 THEN ts + INTERVAL 2 HOUR ELSE ts END AS shifted,
    CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'POST' WHEN 'purchase' THEN 'PUT'
                    WHEN 'signup' THEN 'PATCH' ELSE 'DELETE' END AS method0,
    '1234' || lpad(su, 8, '0') AS acct,
    '[' || CAST(user_id + 1000 AS VARCHAR) || ']' AS pid
  FROM raw
),
msgs AS (
  SELECT *,
    concat(
      CASE WHEN b97 = 12 THEN repeat('a b ', 5000) || '#' WHEN event_id % 11 = 0 THEN '  ' ELSE '' END,
      concat_ws('.', '10', CAST(user_id % 256 AS VARCHAR), CAST(event_id % 256 AS VARCHAR),
                CAST((event_id // 256) % 256 AS VARCHAR)),
      ' - ', CASE WHEN user_id % 3 = 0 THEN '-' ELSE 'u' || su END,
      ' [', CASE WHEN b97 = 2 THEN '31/Feb/2024:' || strftime(ts, '%H:%M:%S')
                 ELSE strftime(shifted, '%d/%b/%Y:%H:%M:%S') END,
      ' ', CASE WHEN event_id % 4 = 3 THEN '+0200' ELSE '+0000' END, '] "',
      CASE WHEN event_id % 13 = 0 THEN lower(method0) ELSE method0 END, ' ',
      '/' || event_type || '/' || su || '?k=' || regexp_extract(props, '([0-9]+)', 1),
      CASE WHEN b97 = 1 THEN '' ELSE ' HTTP/' || CASE event_id % 3 WHEN 0 THEN '1.1' WHEN 1 THEN '1.0' ELSE '2.0' END END,
      '" ',
      CASE WHEN event_type = 'error' THEN '500' ELSE CASE event_id % 10 WHEN 0 THEN '404' WHEN 1 THEN '301' ELSE '200' END END,
      ' ', CASE WHEN b97 = 0 THEN '-' ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) END,
      ' "', CASE WHEN event_id % 5 = 0 THEN '' ELSE 'https://example.com/' || event_type END,
      '" "', 'Mozilla/5.0 (X11; Linux x86_64) Agent/' || CAST(user_id % 7 AS VARCHAR), '"'
    ) AS access,
    concat(
      '<', CAST(user_id % 191 AS VARCHAR), '>',
      CASE WHEN b97 = 3 THEN 'Dec 31 23:59:59' WHEN b97 = 4 THEN 'Feb 29 12:00:00'
           ELSE strftime(ts, '%b') || ' ' || lpad(CAST(day(ts) AS VARCHAR), 2, ' ') || ' ' || strftime(ts, '%H:%M:%S') END,
      ' web-', CAST(user_id % 10 AS VARCHAR), ' ',
      CASE k WHEN 3 THEN 'sshd' WHEN 4 THEN 'sudo'
             ELSE CASE event_id % 3 WHEN 0 THEN 'cron' WHEN 1 THEN 'kernel' ELSE 'systemd' END END,
      CASE k WHEN 3 THEN pid WHEN 4 THEN '' ELSE CASE WHEN event_id % 2 = 0 THEN pid ELSE '' END END,
      ': ',
      CASE k WHEN 3 THEN 'Failed password for ' || CASE WHEN event_id % 2 = 0 THEN 'invalid user ' ELSE '' END
                         || 'bob' || su || ' from ' || CASE WHEN b97 = 11 THEN '2001:db8::' || CAST(user_id % 256 AS VARCHAR)
                           ELSE '10.1.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) END || ' port ' || CAST(event_id % 60000 + 1024 AS VARCHAR)
                         || ' ssh2'
             WHEN 4 THEN 'alice' || su || ' : TTY=pts/' || CAST(event_id % 5 AS VARCHAR) || ' ; PWD=/home/alice'
                         || su || ' ; USER=root ; COMMAND=/bin/' || event_type || ' --id ' || CAST(event_id AS VARCHAR)
             ELSE 'session opened for user u' || su || ' value ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
    ) AS syslog,
    CASE WHEN b97 = 5 THEN '{"eventVersion": "1.08", "eventName": '
         ELSE CASE WHEN event_id % 2 = 0 THEN '{"eventVersion":"1.08",' ELSE '{' END
              || '"eventSource":"' || CASE event_type WHEN 'view' THEN 's3' WHEN 'click' THEN 'ec2'
                                       WHEN 'purchase' THEN 'iam' WHEN 'signup' THEN 'sts' ELSE 'kms' END
              || '.amazonaws.com","eventName":"'
              || CASE event_type WHEN 'view' THEN 'GetObject' WHEN 'click' THEN 'RunInstances'
                                 WHEN 'purchase' THEN 'CreateUser' WHEN 'signup' THEN 'AssumeRole' ELSE 'Decrypt' END
              || '","recipientAccountId":"' || acct || '","awsRegion":"eu-west-1"}' END AS trail,
    CASE WHEN b97 = 6 THEN concat_ws(' ', '2', acct, 'eni-x', '- - - - - - -', CAST(t_ms // 1000 AS VARCHAR),
                                     CAST(t_ms // 1000 + 60 AS VARCHAR), '- NODATA')
         ELSE concat_ws(' ', '2', acct, 'eni-' || CAST(user_id + 100000 AS VARCHAR),
                        '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR),
                        '172.16.' || CAST((event_id // 256) % 256 AS VARCHAR) || '.' || CAST(user_id % 200 + 1 AS VARCHAR),
                        CAST(event_id % 65535 AS VARCHAR),
                        CASE event_id % 3 WHEN 0 THEN '443' WHEN 1 THEN '22' ELSE '80' END, '6',
                        CAST(event_id % 50 + 1 AS VARCHAR), CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR),
                        CAST(t_ms // 1000 AS VARCHAR), CAST(t_ms // 1000 + 60 AS VARCHAR),
                        CASE WHEN event_id % 4 = 0 THEN 'REJECT' ELSE 'ACCEPT' END,
                        CASE WHEN b97 = 8 THEN NULL ELSE 'OK' END) END AS flow,
    CASE b97 WHEN 7 THEN '' WHEN 9 THEN chr(9) || chr(9) WHEN 10 THEN 'line one' || chr(13) || 'line two'
             ELSE event_type || ' ' || props || ' Grüße' END AS free
  FROM parts
),
corpus AS (
  SELECT event_id, index_name,
    'db_' || CAST(day * 86400 + 86399 AS VARCHAR) || '_' || CAST(day * 86400 AS VARCHAR) || '_' || CAST(day % 100 AS VARCHAR) AS bucket_name,
    day * 86400 + 86399 AS bucket_latest, day * 86400 AS bucket_earliest, day % 100 AS bucket_seq,
    t_ms AS event_time_ms, t_ms // 1000 + event_id % 5 AS index_time,
    CASE event_id % 4 WHEN 0 THEN 'host::' || h WHEN 1 THEN h WHEN 2 THEN 'source::' || h ELSE 'host::host::' || h END AS host,
    CASE WHEN e3 = 1 THEN CASE WHEN event_id % 2 = 0 THEN 'source::' || src_base ELSE src_base END ELSE '' END AS source,
    CASE WHEN e3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'sourcetype::' || st_base ELSE st_base END ELSE '' END AS sourcetype,
    CASE k WHEN 0 THEN access WHEN 1 THEN access WHEN 2 THEN syslog WHEN 3 THEN syslog WHEN 4 THEN syslog
           WHEN 5 THEN trail WHEN 6 THEN flow ELSE free END AS message
  FROM msgs
)
"""


def with_corpus(*ctes: str) -> str:
    """``WITH`` prefix holding the corpus plus further CTEs (``name AS (...)``)."""
    return "WITH " + ",\n".join([CORPUS.strip()] + [c.strip() for c in ctes if c]) + "\n"


# ---------------------------------------------------------------------------
# Column snippets over a relation with host/source/sourcetype/message/index_name
# ---------------------------------------------------------------------------
def strip_prefix(c: str) -> str:
    return f"regexp_replace({c}, '^(host|source|sourcetype)::', '')"


def strip_ws(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def py_repr(c: str) -> str:
    esc = f"replace(replace(replace(replace({c}, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    return (f"CASE WHEN contains({c}, '''') AND NOT contains({c}, '\"') THEN '\"' || {esc} || '\"' "
            f"ELSE '''' || replace({esc}, '''', '\\''') || '''' END")


def q(p: str) -> str:
    """SQL string literal of a pattern."""
    return "'" + p.replace("'", "''") + "'"


CLASSIFIED = f"""
cls_in AS (
  SELECT *, lower({strip_prefix('sourcetype')}) AS st_l, lower({strip_prefix('source')}) AS src_l,
         {strip_ws('message')} AS msg_s
  FROM corpus
),
cls_rule AS (
  SELECT *,
    CASE
      WHEN st_l <> '' AND regexp_matches(st_l, {q(P.ACCESS_SOURCETYPE)}) THEN 1
      WHEN st_l <> '' AND regexp_matches(st_l, {q(P.SYSLOG_SOURCETYPE)}) THEN 2
      WHEN st_l <> '' AND regexp_matches(st_l, {q(P.CLOUD_TRAIL_SOURCETYPE)}) THEN 3
      WHEN st_l <> '' AND regexp_matches(st_l, {q(P.VPC_FLOW_SOURCETYPE)}) THEN 4
      WHEN src_l <> '' AND regexp_matches(src_l, {q(P.ACCESS_SOURCE)}) THEN 5
      WHEN src_l <> '' AND regexp_matches(src_l, {q(P.SYSLOG_SOURCE)}) THEN 6
      WHEN regexp_matches(msg_s, {q(P.re2_ci(P.ACCESS_MESSAGE))}) THEN 7
      WHEN regexp_matches(msg_s, {q(P.SYSLOG_MESSAGE)}) THEN 8
      WHEN (CASE WHEN starts_with(msg_s, '{{') AND json_valid(msg_s)
                THEN json_extract_string(msg_s, '$.eventVersion') END) IS NOT NULL THEN 9
      WHEN regexp_matches(msg_s, {q(P.VPC_MESSAGE)}) THEN 10
      ELSE 0 END AS rule
  FROM cls_in
),
classified AS (
  SELECT *,
    CASE WHEN rule IN (1, 5, 7) THEN 'access_log' WHEN rule IN (2, 6, 8) THEN 'syslog'
         WHEN rule IN (3, 9) THEN 'cloud_trail' WHEN rule IN (4, 10) THEN 'vpc_flow' ELSE 'generic' END AS kind,
    CASE WHEN rule BETWEEN 1 AND 4 THEN 'sourcetype=' || {py_repr('st_l')}
         WHEN rule IN (5, 6) THEN 'source=' || {py_repr('src_l')}
         WHEN rule = 7 THEN 'message=access_log_pattern' WHEN rule = 8 THEN 'message=syslog_pattern'
         WHEN rule = 9 THEN 'message=cloud_trail_pattern' WHEN rule = 10 THEN 'message=vpc_flow_pattern'
         ELSE 'fallback=generic' END AS reason
  FROM cls_rule
)
"""


def dataset(kind: str = "kind", index: str = "index_name") -> str:
    return f"CASE WHEN {index} <> '' THEN {index} || '.' || {kind} ELSE {kind} END"


def pipeline(kind: str = "kind") -> str:
    return f"'thaw-parse-' || replace({kind}, '_', '-')"


def _names(names) -> str:
    return "[" + ", ".join("'" + n + "'" for n in names) + "]"


def grok_sql(src: str, pattern: str, names, cond: str = "TRUE") -> str:
    p = q(P.re2(pattern))
    return f"CASE WHEN {cond} AND regexp_matches({src}, {p}) THEN regexp_extract({src}, {p}, {_names(names)}) END"


def routed_sql(kinds=P.KINDS, src: str = "classified") -> str:
    """Parse router over ``classified`` -> ``parsed`` (flat columns, same names as the Spark side)."""
    ks = set(kinds)

    def on(kd):
        return f"kind = '{kd}'" if kd in ks else "FALSE"

    cat = " ".join(f"WHEN kind = '{kd}' THEN '{c}'" for kd, c in
                   [("access_log", "web"), ("syslog", "host"), ("cloud_trail", "cloud"), ("vpc_flow", "network"),
                    ("generic", "unknown")] if kd in ks)
    kin = ", ".join(f"'{k}'" for k in ks)
    vpc_types = {"srcport": "INTEGER", "dstport": "INTEGER", "protocol": "INTEGER", "packets": "BIGINT",
                 "bytes": "BIGINT", "start": "BIGINT", "end": "BIGINT"}
    vpc_cols = []
    for i, nm in enumerate(P.VPC_FIELDS):
        v = f"CASE WHEN len(_vpc) = {len(P.VPC_FIELDS)} THEN _vpc[{i + 1}] END"
        if nm in vpc_types:
            v = f"TRY_CAST({v} AS {vpc_types[nm]})"
        vpc_cols.append(f"{v} AS aws_vpcflow_{nm}")
    acc_cols = [f"_acc.{n} AS {n}" for n in P.ACCESS_FIELDS
                if n not in ("http_version", "http_response_status_code", "http_response_body_bytes")]
    sys_cols = [f"_sys.{n} AS {n}" for n in P.SYSLOG_FIELDS if n not in ("log_syslog_priority", "process_pid")]
    return f"""
p1 AS (
  SELECT *,
    {grok_sql('message', P.ACCESS_GROK, P.ACCESS_FIELDS, on('access_log'))} AS _acc,
    {grok_sql('message', P.SYSLOG_GROK, P.SYSLOG_FIELDS, on('syslog'))} AS _sys,
    CASE WHEN {on('cloud_trail')} AND starts_with(ltrim(message), '{{') AND json_valid(message) THEN message END AS _ct,
    CASE WHEN {on('vpc_flow')} THEN string_split(message, ' ') END AS _vpc
  FROM {src}
),
p2 AS (
  SELECT *,
    {grok_sql('_sys.syslog_message', P.SSHD_FAILED_GROK, P.SSHD_FIELDS, '_sys IS NOT NULL')} AS _sshd,
    {grok_sql('_sys.syslog_message', P.SUDO_GROK, P.SUDO_FIELDS, '_sys IS NOT NULL')} AS _sudo,
    epoch_ms(try_strptime(_acc.http_request_timestamp, '%d/%b/%Y:%H:%M:%S %z')) AS _acc_ts,
    year(epoch_ms(event_time_ms)) AS _yr,
    regexp_replace(_sys.syslog_timestamp, ' +', ' ', 'g') AS _sq
  FROM p1
),
p3 AS (
  SELECT *,
    epoch_ms(try_strptime(CAST(_yr AS VARCHAR) || ' ' || _sq, '%Y %b %d %H:%M:%S')) AS _sys_ts0,
    epoch_ms(try_strptime(CAST(_yr - 1 AS VARCHAR) || ' ' || _sq, '%Y %b %d %H:%M:%S')) AS _sys_ts1
  FROM p2
),
parsed AS (
  SELECT *,
    {', '.join(acc_cols)},
    TRY_CAST(_acc.http_version AS FLOAT) AS http_version,
    TRY_CAST(_acc.http_response_status_code AS INTEGER) AS http_response_status_code,
    TRY_CAST(_acc.http_response_body_bytes AS BIGINT) AS http_response_body_bytes,
    {', '.join(sys_cols)},
    TRY_CAST(_sys.log_syslog_priority AS INTEGER) AS log_syslog_priority,
    TRY_CAST(nullif(_sys.process_pid, '') AS INTEGER) AS process_pid,
    _sshd.source_ip AS source_ip,
    TRY_CAST(_sshd.source_port AS INTEGER) AS source_port,
    coalesce(_sudo.sudo_user_name, _sshd.sshd_user_name) AS user_name,
    _sudo.sudo_tty AS sudo_tty, _sudo.sudo_pwd AS sudo_pwd, _sudo.sudo_user AS sudo_user,
    _sudo.sudo_command AS sudo_command,
    json_extract_string(_ct, '$.eventName') AS aws_cloudtrail_event_name,
    json_extract_string(_ct, '$.eventSource') AS aws_cloudtrail_event_source,
    json_extract_string(_ct, '$.recipientAccountId') AS cloud_account_id,
    {', '.join(vpc_cols)},
    CASE WHEN _acc IS NOT NULL AND _acc_ts IS NOT NULL THEN _acc_ts
         WHEN _sys IS NOT NULL AND _sys_ts0 IS NOT NULL AND _sys_ts0 <= event_time_ms + 86400000 THEN _sys_ts0
         WHEN _sys IS NOT NULL AND _sys_ts1 IS NOT NULL THEN _sys_ts1
         ELSE event_time_ms END AS ts_ms,
    CASE WHEN kind IN ({kin}) AND length(message) > 0 THEN message END AS event_original,
    CASE {cat if cat else 'WHEN FALSE THEN NULL'} END AS event_category
  FROM p3
)
"""


TABLES = """
buckets AS (
  SELECT index_name, bucket_name, max(bucket_latest) AS bucket_latest, max(bucket_earliest) AS bucket_earliest,
         max(bucket_seq) AS bucket_seq
  FROM corpus GROUP BY index_name, bucket_name
),
listing AS (
  SELECT index_name, bucket_name, bucket_latest, bucket_earliest, bucket_seq,
         index_name || '/' || bucket_name AS bucket_key, 'thaw-' || index_name AS target_index FROM buckets
  UNION ALL
  SELECT index_name, 'db_' || CAST(e + 86399 AS VARCHAR) || '_' || CAST(e AS VARCHAR) || '_' || CAST((e // 86400) % 100 AS VARCHAR),
         e + 86399, e, (e // 86400) % 100,
         index_name || '/' || 'db_' || CAST(e + 86399 AS VARCHAR) || '_' || CAST(e AS VARCHAR) || '_' || CAST((e // 86400) % 100 AS VARCHAR),
         'thaw-' || index_name
  FROM (SELECT index_name, max(bucket_earliest) + 86400 AS e FROM buckets GROUP BY index_name)
),
counts AS (
  SELECT index_name || '/' || bucket_name AS bucket_key, count(*) AS n_events,
         count(*) FILTER (WHERE message = '') AS n_empty, CAST(sum(octet_length(encode(message))) AS BIGINT) AS n_bytes
  FROM corpus GROUP BY index_name, bucket_name
),
ckpt_v AS (
  SELECT b.index_name || '/' || b.bucket_name AS bucket_key, b.index_name, b.bucket_name, b.bucket_seq, b.bucket_latest,
         c.n_events, c.n_empty,
         unnest(range(0, b.bucket_seq % 3 + CASE WHEN b.bucket_seq % 10 = 9 THEN 1 ELSE 0 END + 1)) AS version
  FROM buckets b LEFT JOIN counts c ON c.bucket_key = b.index_name || '/' || b.bucket_name
),
ckpt_log AS (
  SELECT bucket_key, index_name, bucket_name, status,
         CASE WHEN status = 'completed' THEN coalesce(n_events - n_empty, 0) ELSE 0 END AS indexed,
         CASE WHEN status = 'completed' THEN coalesce(n_empty, 0) ELSE 0 END AS errors,
         bucket_latest + 60 * version AS updated_at, version
  FROM (SELECT *, CASE WHEN version > bucket_seq % 3 THEN 'cleared'
                       WHEN version < bucket_seq % 3 THEN 'in_progress'
                       WHEN bucket_seq % 4 = 1 THEN 'failed' WHEN bucket_seq % 4 = 3 THEN 'in_progress'
                       ELSE 'completed' END AS status FROM ckpt_v)
),
latest AS (
  SELECT bucket_key, index_name, bucket_name, status, indexed, errors, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY bucket_key ORDER BY updated_at DESC, version DESC) AS rn FROM ckpt_log)
  WHERE rn = 1 AND status <> 'cleared'
),
pending AS (
  SELECT * FROM listing l WHERE NOT EXISTS (SELECT 1 FROM latest t WHERE t.bucket_key = l.bucket_key AND t.status = 'completed')
),
skipped AS (
  SELECT l.bucket_key, l.index_name, l.bucket_name, l.target_index, t.indexed, t.errors, 'skipped' AS status
  FROM listing l JOIN latest t ON t.bucket_key = l.bucket_key AND t.status = 'completed'
),
processed AS (
  SELECT p.bucket_key, p.index_name, p.bucket_name, p.target_index, coalesce(c.n_events - c.n_empty, 0) AS indexed,
         coalesce(c.n_empty, 0) AS errors, 'completed' AS status
  FROM pending p LEFT JOIN counts c ON c.bucket_key = p.bucket_key
),
results AS (SELECT * FROM skipped UNION ALL SELECT * FROM processed)
"""
