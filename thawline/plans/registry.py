"""Registered plans: one Spark builder per operator, each with its DuckDB twin when SQL can say it.

Every builder takes ``(spark, sf_dir)`` and reads the driver tables (or what
Spark derives from them), so its work grows with the data.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline import storage
from thawline.functions import patterns as P
from thawline.functions.text import decode_text, decode_text_fast, iso_utc, strip_prefix
from thawline.operators import classify as C
from thawline.operators.parse import route_and_parse
from thawline.plans import base as B
from thawline.plans import oracle as O

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


W = O.with_corpus
CLS = O.CLASSIFIED


# ---------------------------------------------------------------------------
# Classification
# ---------------------------------------------------------------------------
@register("classify", W(CLS) + f"""
SELECT event_id, index_name, kind, {O.dataset()} AS dataset, {O.pipeline()} AS pipeline, reason FROM classified""")
def q_classify(spark, sf):
    return B.classified(spark, sf).select("event_id", "index_name", "kind", "dataset", "pipeline", "reason")


@register("classify_sourcetype", W(CLS) + f"""
SELECT event_id, st_l AS sourcetype,
  CASE WHEN st_l <> '' AND regexp_matches(st_l, {O.q(P.ACCESS_SOURCETYPE)}) THEN 'access_log'
       WHEN st_l <> '' AND regexp_matches(st_l, {O.q(P.SYSLOG_SOURCETYPE)}) THEN 'syslog'
       WHEN st_l <> '' AND regexp_matches(st_l, {O.q(P.CLOUD_TRAIL_SOURCETYPE)}) THEN 'cloud_trail'
       WHEN st_l <> '' AND regexp_matches(st_l, {O.q(P.VPC_FLOW_SOURCETYPE)}) THEN 'vpc_flow' END AS sourcetype_kind
FROM cls_in""")
def q_classify_sourcetype(spark, sf):
    st = F.lower(strip_prefix(F.col("sourcetype")))
    return B.corpus(spark, sf).select("event_id", st.alias("sourcetype"), C.sourcetype_kind(st).alias("sourcetype_kind"))


@register("classify_source", W(CLS) + f"""
SELECT event_id, src_l AS source,
  CASE WHEN src_l <> '' AND regexp_matches(src_l, {O.q(P.ACCESS_SOURCE)}) THEN 'access_log'
       WHEN src_l <> '' AND regexp_matches(src_l, {O.q(P.SYSLOG_SOURCE)}) THEN 'syslog' END AS source_kind
FROM cls_in""")
def q_classify_source(spark, sf):
    src = F.lower(strip_prefix(F.col("source")))
    return B.corpus(spark, sf).select("event_id", src.alias("source"), C.source_kind(src).alias("source_kind"))


MSG_KIND_SQL = f"""
  CASE WHEN regexp_matches(msg_s, {O.q(P.re2_ci(P.ACCESS_MESSAGE))}) THEN 'access_log'
       WHEN regexp_matches(msg_s, {O.q(P.SYSLOG_MESSAGE)}) THEN 'syslog'
       WHEN (CASE WHEN starts_with(msg_s, '{{') AND json_valid(msg_s) THEN json_extract_string(msg_s, '$.eventVersion') END) IS NOT NULL
            THEN 'cloud_trail'
       WHEN regexp_matches(msg_s, {O.q(P.VPC_MESSAGE)}) THEN 'vpc_flow' END"""


@register("classify_message", W(CLS) + f"SELECT event_id, {MSG_KIND_SQL} AS message_kind FROM cls_in")
def q_classify_message(spark, sf):
    c = C.classify(B.corpus(spark, sf), keep_inputs=True)
    return c.select("event_id", C.message_kind(F.col("_msg_s")).alias("message_kind"))


@register("classify_reason", W(CLS) + "SELECT event_id, kind, reason FROM classified")
def q_classify_reason(spark, sf):
    return B.classified(spark, sf).select("event_id", "kind", "reason")


@register("classify_cloud_trail", W(CLS) + f"""
SELECT event_id,
  (st_l <> '' AND regexp_matches(st_l, {O.q(P.CLOUD_TRAIL_SOURCETYPE)}))
  OR coalesce((CASE WHEN starts_with(msg_s, '{{') AND json_valid(msg_s) THEN json_extract_string(msg_s, '$.eventVersion') END) IS NOT NULL,
              FALSE) AS is_cloud_trail
FROM cls_in""")
def q_classify_cloud_trail(spark, sf):
    c = C.classify(B.corpus(spark, sf), keep_inputs=True)
    st = F.col("_st_l")
    flag = ((st != "") & st.rlike(P.java(P.CLOUD_TRAIL_SOURCETYPE))) | C.is_cloud_trail_json(F.col("_msg_s"))
    return c.select("event_id", flag.alias("is_cloud_trail"))


@register("classify_vpc_flow", W(CLS) + f"""
SELECT event_id,
  (st_l <> '' AND regexp_matches(st_l, {O.q(P.VPC_FLOW_SOURCETYPE)})) OR regexp_matches(msg_s, {O.q(P.VPC_MESSAGE)})
  AS is_vpc_flow
FROM cls_in""")
def q_classify_vpc_flow(spark, sf):
    c = C.classify(B.corpus(spark, sf), keep_inputs=True)
    st = F.col("_st_l")
    flag = ((st != "") & st.rlike(P.java(P.VPC_FLOW_SOURCETYPE))) | F.col("_msg_s").rlike(P.java(P.VPC_MESSAGE))
    return c.select("event_id", flag.alias("is_vpc_flow"))


@register("router_default_kind", W(CLS) + f"""
SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN kind END,
  CASE WHEN regexp_matches({O.strip_prefix('sourcetype')}, {O.q(P.re2_ci(P.ROUTER_ACCESS_SOURCETYPE))}) THEN 'access_log'
       WHEN regexp_matches({O.strip_prefix('sourcetype')}, {O.q(P.re2_ci(P.ROUTER_SYSLOG_SOURCETYPE))}) THEN 'syslog'
       ELSE 'generic' END) AS router_kind
FROM classified""")
def q_router_default_kind(spark, sf):
    """Stored documents where every second one lost its kind; the router refills it."""
    c = B.classified(spark, sf)
    stored = F.when(F.col("event_id") % 2 == 0, F.col("kind"))
    return c.select("event_id", C.router_default_kind(stored, strip_prefix(F.col("sourcetype"))).alias("router_kind"))


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------
@register("strip_prefix", W() + f"""
SELECT event_id, {O.strip_prefix('host')} AS host, {O.strip_prefix('source')} AS source,
       {O.strip_prefix('sourcetype')} AS sourcetype FROM corpus""")
def q_strip_prefix(spark, sf):
    return B.corpus(spark, sf).select("event_id", *[strip_prefix(F.col(c)).alias(c) for c in ("host", "source", "sourcetype")])


ISO_SQL = ("CASE WHEN event_time_ms % 1000 = 0 THEN strftime(epoch_ms(event_time_ms), '%Y-%m-%dT%H:%M:%S+00:00') "
           "ELSE strftime(epoch_ms(event_time_ms), '%Y-%m-%dT%H:%M:%S.%f+00:00') END")


@register("event_time", W() + f"SELECT event_id, event_time_ms, {ISO_SQL} AS ts_iso FROM corpus")
def q_event_time(spark, sf):
    return B.corpus(spark, sf).select("event_id", "event_time_ms", iso_utc(F.col("event_time_ms")).alias("ts_iso"))


DOCS_SQL = f"""
SELECT event_id, {ISO_SQL} AS ts_iso, message,
  {O.strip_prefix('host')} AS host, {O.strip_prefix('source')} AS source, {O.strip_prefix('sourcetype')} AS sourcetype,
  kind AS event_kind, {O.dataset()} AS event_dataset, index_name AS splunk_index, index_time AS splunk_index_time,
  bucket_name AS splunk_bucket_name, bucket_latest AS splunk_bucket_latest, bucket_earliest AS splunk_bucket_earliest,
  {O.pipeline()} AS splunk_pipeline, reason AS splunk_classify_reason
FROM classified"""


@register("to_docs", W(CLS) + DOCS_SQL)
def q_to_docs(spark, sf):
    return B.docs(B.corpus(spark, sf))


@register("parser_router_names", W(CLS) + f"""
SELECT DISTINCT index_name, kind, {O.pipeline()} AS parser_pipeline, 'thaw-pipeline-' || index_name AS router_pipeline
FROM classified""")
def q_parser_router_names(spark, sf):
    c = B.classified(spark, sf).select("index_name", "kind").distinct()
    return c.select("index_name", "kind", C.parser_name(F.col("kind")).alias("parser_pipeline"),
                    C.router_name(F.col("index_name")).alias("router_pipeline"))


BUCKETS_SQL = """
buckets AS (
  SELECT DISTINCT index_name, bucket_name, bucket_latest, bucket_earliest, bucket_seq FROM corpus
)"""


@register("bucket_keys", W(BUCKETS_SQL) + """
SELECT index_name, bucket_name, index_name || '/' || bucket_name AS bucket_key, 'thaw-' || index_name AS target_index
FROM buckets""")
def q_bucket_keys(spark, sf):
    from thawline.operators.runs import buckets_of
    b = buckets_of(B.corpus(spark, sf))
    return b.select("index_name", "bucket_name", "bucket_key", "target_index")


@register("target_name", W(BUCKETS_SQL) + """
SELECT index_name || '/' || bucket_name AS bucket_key, 'thaw-' || index_name AS target_index,
  'thaw-' || index_name || '-' || CAST(bucket_seq AS VARCHAR) || '.0-' || strftime(epoch_ms(bucket_latest * 1000), '%Y%m%d%H%M%S')
  AS versioned_target
FROM buckets""")
def q_target_name(spark, sf):
    """Plain and versioned target of each bucket (iteration = bucket seq, run time = bucket latest)."""
    from thawline.operators.runs import buckets_of, versioned_target
    b = buckets_of(B.corpus(spark, sf))
    return b.select("bucket_key", "target_index",
                    versioned_target(F.col("index_name"), F.concat(F.col("bucket_seq").cast("string"), F.lit(".0")),
                                     F.col("bucket_latest") * 1000).alias("versioned_target"))


@register("text_decode", """
SELECT doc_id, text AS text_out,
  doc_id % 2 = 0 OR NOT regexp_matches(text, '[^\\x00-\\x7F]') AS was_utf8
FROM documents""")
def q_text_decode(spark, sf):
    """Documents stored as UTF-8 (even ids) or Latin-1 (odd ids) bytes decode back to the text."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    raw = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(F.encode("text", "ISO-8859-1"))
    d = d.select("doc_id", raw.alias("b"))
    return d.select("doc_id", decode_text(F.col("b")).alias("text_out"),
                    F.is_valid_utf8(F.col("b").cast("string")).alias("was_utf8"))


@register("text_decode_latin1", """
SELECT doc_id, CASE WHEN lang = 'fr' THEN 'apache' ELSE 'app' END AS index_name,
  CASE WHEN lang = 'fr' THEN array_to_string(list_transform(range(0, octet_length(encode(text))),
    lambda i: chr(CAST('0x' || substr(hex(encode(text)), CAST(2 * i + 1 AS BIGINT), 2) AS INTEGER))), '') ELSE text END AS decoded
FROM documents""")
def q_text_decode_latin1(spark, sf):
    """UTF-8 bytes read through the Latin-1 fast path (index 'apache') keep one char per byte."""
    d = spark.read.parquet(f"{sf}/documents.parquet")
    idx = F.when(F.col("lang") == "fr", F.lit("apache")).otherwise(F.lit("app"))
    d = d.select("doc_id", idx.alias("index_name"), F.encode("text", "UTF-8").alias("b"))
    return d.select("doc_id", "index_name", decode_text_fast(F.col("b"), F.col("index_name")).alias("decoded"))


# ---------------------------------------------------------------------------
# Parse processors
# ---------------------------------------------------------------------------
PARSED = O.routed_sql()


def _parsed(spark, sf, kinds=P.KINDS):
    return route_and_parse(B.classified(spark, sf), kinds=kinds)


def _sel(df: DataFrame, cols, where: str | None = None) -> DataFrame:
    # Rows of other kinds keep NULL fields: a filter on ``kind`` would be pushed
    # below the projections and re-evaluate the whole classification in it.
    return df.select("event_id", *cols)


def _sql_sel(cols, where: str | None = None, parsed=PARSED) -> str:
    return W(CLS, parsed) + f"SELECT event_id, {', '.join(cols)} FROM parsed"


ACC = ("client_ip", "http_ident", "http_auth", "http_request_timestamp", "http_request_method", "url_original",
       "http_version", "http_response_status_code", "http_response_body_bytes", "http_request_referrer",
       "user_agent_original")
SYS = ("log_syslog_priority", "syslog_timestamp", "syslog_hostname", "syslog_program", "process_pid", "syslog_message")
SSHD = ("user_name", "source_ip", "source_port")
SUDO = ("user_name", "sudo_tty", "sudo_pwd", "sudo_user", "sudo_command")
CT = ("aws_cloudtrail_event_name", "aws_cloudtrail_event_source", "cloud_account_id")
VPC = tuple("aws_vpcflow_" + n for n in P.VPC_FIELDS)

_PARSE_VIEWS = {
    "event_original": (("kind", "event_original"), None),
    "parse_access": (ACC, "access_log"),
    "parse_syslog": (SYS, "syslog"),
    "parse_sshd_failed": (("syslog_message",) + SSHD, "syslog"),
    "parse_sudo": (("syslog_message",) + SUDO, "syslog"),
    "access_timestamp": (("http_request_timestamp", "event_time_ms", "ts_ms"), "access_log"),
    "syslog_timestamp": (("syslog_timestamp", "event_time_ms", "ts_ms"), "syslog"),
    "convert_types": (("http_version", "http_response_status_code", "http_response_body_bytes",
                       "log_syslog_priority", "process_pid", "source_port"), None),
    "event_category": (("kind", "event_category"), None),
    "parse_generic": (("event_original", "event_category", "ts_ms"), "generic"),
    "parse_cloud_trail": (CT, "cloud_trail"),
    "parse_vpc_flow": (VPC, "vpc_flow"),
}


def _make_parse_view(cols, where):
    def fn(spark, sf):
        return _sel(_parsed(spark, sf), cols, where)
    return fn


for _name, (_cols, _where) in _PARSE_VIEWS.items():
    register(_name, _sql_sel(_cols, _where))(_make_parse_view(_cols, _where))

ALL_PARSED = ("kind", "event_original", "event_category", "ts_ms") + ACC + SYS + tuple(
    c for c in SSHD + SUDO if c not in ("user_name",)) + ("user_name",) + CT + VPC


@register("route_and_parse", _sql_sel(ALL_PARSED))
def q_route_and_parse(spark, sf):
    return _sel(_parsed(spark, sf), ALL_PARSED)


ROUTER_SUBSET = ("access_log", "generic")


@register("route_partial_router", _sql_sel(("kind", "event_original", "event_category", "ts_ms", "client_ip",
                                            "syslog_hostname"), parsed=O.routed_sql(ROUTER_SUBSET)))
def q_route_partial_router(spark, sf):
    """A router that only knows access and generic: other kinds pass through unparsed."""
    return _sel(_parsed(spark, sf, kinds=ROUTER_SUBSET),
                ("kind", "event_original", "event_category", "ts_ms", "client_ip", "syslog_hostname"))


LEGACY_SQL = """
legacy AS (
  SELECT * REPLACE (CASE WHEN index_name = 'syslog' THEN 'syslog' ELSE 'access_log' END AS kind)
  FROM classified WHERE index_name IN ('apache', 'nginx', 'syslog')
)"""


@register("parse_legacy_dataset", W(CLS, LEGACY_SQL, O.routed_sql(("access_log", "syslog"), src="legacy")) + """
SELECT event_id, CASE WHEN index_name = 'syslog' THEN 'syslog' WHEN index_name = 'nginx' THEN 'nginx.access'
  ELSE 'apache.access' END AS dataset, client_ip, http_response_status_code, syslog_hostname, process_pid,
  event_category, ts_ms
FROM parsed""")
def q_parse_legacy_dataset(spark, sf):
    """Fixed per-index parsers (apache, nginx, syslog) with a fixed ``event.dataset`` and no kind."""
    from thawline.operators.parse import legacy_parse
    c = B.classified(spark, sf).where(F.col("index_name").isin("apache", "nginx", "syslog"))
    return legacy_parse(c).select("event_id", "dataset", "client_ip", "http_response_status_code",
                                  "syslog_hostname", "process_pid", "event_category", "ts_ms")


# ---------------------------------------------------------------------------
# Flagship: decode-equivalent corpus -> classify -> route/parse -> summary
# ---------------------------------------------------------------------------
INGEST_SUMMARY_SQL = W(CLS, PARSED) + """
SELECT index_name, kind, event_category, http_response_status_code AS status,
  CAST(count(*) AS BIGINT) AS n_events, CAST(count(event_original) AS BIGINT) AS n_original,
  CAST(count(client_ip) + count(syslog_hostname) + count(aws_cloudtrail_event_name) + count(aws_vpcflow_action) AS BIGINT)
    AS n_parsed,
  min(ts_ms) AS min_ts_ms, max(ts_ms) AS max_ts_ms
FROM parsed GROUP BY index_name, kind, event_category, http_response_status_code"""


def _summary(p):
    return p.groupBy("index_name", "kind", "event_category", F.col("http_response_status_code").alias("status")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count("event_original").alias("n_original"),
        (F.count("client_ip") + F.count("syslog_hostname") + F.count("aws_cloudtrail_event_name")
         + F.count("aws_vpcflow_action")).alias("n_parsed"),
        F.min("ts_ms").alias("min_ts_ms"), F.max("ts_ms").alias("max_ts_ms"))


@register("ingest_summary", INGEST_SUMMARY_SQL)
def q_ingest_summary(spark, sf):
    """Corpus table -> classify -> route/parse -> per index, kind, category and status counts."""
    return _summary(_parsed(spark, sf))


# ---------------------------------------------------------------------------
# Run bookkeeping: checkpoint log, resume joins, results, totals
# ---------------------------------------------------------------------------
from thawline.operators import profile as PR  # noqa: E402
from thawline.operators import runs as R  # noqa: E402
from thawline.plans import tables as T  # noqa: E402

TB = O.TABLES


@register("checkpoint_latest", W(TB) + "SELECT bucket_key, status, indexed, errors, updated_at FROM latest")
def q_checkpoint_latest(spark, sf):
    return T.latest(spark, sf).select("bucket_key", "status", "indexed", "errors", "updated_at")


@register("checkpoint_state", W(TB) + """
SELECT status, CAST(count(*) AS BIGINT) AS n_buckets, CAST(sum(indexed) AS BIGINT) AS indexed,
       CAST(sum(errors) AS BIGINT) AS errors
FROM latest GROUP BY status""")
def q_checkpoint_state(spark, sf):
    """K4: bucket states after all upserts and clears."""
    return T.latest(spark, sf).groupBy("status").agg(
        F.count(F.lit(1)).alias("n_buckets"), F.sum("indexed").alias("indexed"), F.sum("errors").alias("errors"))


@register("resume_pending", W(TB) + "SELECT bucket_key, index_name, bucket_name FROM pending")
def q_resume_pending(spark, sf):
    return R.resume_pending(T.listing(spark, sf), T.latest(spark, sf)).select("bucket_key", "index_name", "bucket_name")


@register("resume_pending_force", W(TB) + "SELECT bucket_key, index_name, bucket_name FROM listing")
def q_resume_pending_force(spark, sf):
    """J1 with ``force``: checkpoints cleared first, every bucket is pending."""
    return R.resume_pending(T.listing(spark, sf), T.latest(spark, sf), force=True).select(
        "bucket_key", "index_name", "bucket_name")


@register("resume_skipped", W(TB) + "SELECT * FROM skipped")
def q_resume_skipped(spark, sf):
    return R.resume_skipped(T.listing(spark, sf), T.latest(spark, sf))


@register("run_results", W(TB) + "SELECT * FROM results")
def q_run_results(spark, sf):
    return T.results(spark, sf)


@register("run_totals", W(TB) + """
SELECT CAST(coalesce(sum(indexed) FILTER (WHERE status = 'completed'), 0) AS BIGINT) AS total_indexed,
       CAST(coalesce(sum(errors), 0) AS BIGINT) AS total_errors,
       count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'failed') AS failed,
       count(*) AS buckets
FROM results""")
def q_run_totals(spark, sf):
    return R.run_totals(T.results(spark, sf))


# ---------------------------------------------------------------------------
# Profiles and scan
# ---------------------------------------------------------------------------
@register("profile_by_kind", W(CLS) + "SELECT kind, count(*) AS n_events FROM classified GROUP BY kind")
def q_profile_by_kind(spark, sf):
    return PR.profile_by_kind(B.classified(spark, sf))


ST_SQL = f"""
st AS (
  SELECT index_name, {O.strip_prefix('sourcetype')} AS sourcetype, count(*) AS n_events FROM corpus
  WHERE {O.strip_prefix('sourcetype')} <> '' GROUP BY ALL
)"""


@register("profile_by_sourcetype", W(ST_SQL) + """
SELECT sourcetype, CAST(sum(n_events) AS BIGINT) AS n_events FROM st GROUP BY sourcetype""")
def q_profile_by_sourcetype(spark, sf):
    return PR.profile_by_sourcetype(B.corpus(spark, sf))


@register("scan_by_index", W(CLS, TB) + """
SELECT i.index_name, coalesce(a.n_events, 0) AS n_events,
  CASE WHEN a.kinds IS NULL OR len(a.kinds) = 0 THEN 'generic' ELSE array_to_string(a.kinds, ',') END AS required_parsers,
  'thaw-pipeline-' || i.index_name AS router_pipeline
FROM (SELECT DISTINCT index_name FROM listing) i
LEFT JOIN (SELECT index_name, count(*) AS n_events, list_sort(list_distinct(list(kind))) AS kinds
           FROM classified GROUP BY index_name) a ON a.index_name = i.index_name""")
def q_scan_by_index(spark, sf):
    return PR.scan_by_index(B.classified(spark, sf), T.listing(spark, sf))


@register("required_parsers", W(CLS) + """
SELECT index_name, kind, 'thaw-parse-' || replace(kind, '_', '-') AS parser_pipeline
FROM (SELECT DISTINCT index_name, kind FROM classified)""")
def q_required_parsers(spark, sf):
    """T17 in long form: one row per (index, required parser)."""
    s = PR.scan_by_index(B.classified(spark, sf))
    k = s.select("index_name", F.explode(F.split("required_parsers", ",")).alias("kind"))
    return k.select("index_name", "kind", C.parser_name(F.col("kind")).alias("parser_pipeline"))


@register("dry_run_counts", W(TB) + """
SELECT l.index_name, l.bucket_name, CAST(sum(coalesce(c.n_events, 0)) AS BIGINT) AS n_events, count(*) AS n_buckets
FROM listing l LEFT JOIN counts c ON c.bucket_key = l.bucket_key
GROUP BY ROLLUP (l.index_name, l.bucket_name)""")
def q_dry_run_counts(spark, sf):
    return PR.dry_run_counts(T.listing(spark, sf), T.counts(spark, sf))


def _top_sql(k: int) -> str:
    return W(ST_SQL) + f"""
SELECT index_name, sourcetype, n_events, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY index_name ORDER BY n_events DESC, sourcetype ASC) AS rank FROM st)
WHERE rank <= {k}"""


@register("top_sourcetypes", _top_sql(2))
def q_top_sourcetypes(spark, sf):
    """O2: top sourcetypes per index (k=2 here so the cut is visible; API uses 50, CLI 10)."""
    st = PR.profile_by_sourcetype(B.corpus(spark, sf), by=("index_name",))
    return PR.top_sourcetypes(st, 2)


@register("top_sourcetypes_50", _top_sql(50))
def q_top_sourcetypes_50(spark, sf):
    st = PR.profile_by_sourcetype(B.corpus(spark, sf), by=("index_name",))
    return PR.top_sourcetypes(st, 50)


@register("bucket_page", W(TB) + """
SELECT bucket_key, (SELECT count(*) FROM listing) AS total FROM listing
ORDER BY index_name, bucket_name LIMIT 100 OFFSET 20""")
def q_bucket_page(spark, sf):
    """O3: one page of the sorted bucket listing (limit 100, offset 20) with the total."""
    lst = T.listing(spark, sf)
    total = lst.count()
    return lst.orderBy("index_name", "bucket_name").offset(20).limit(100).select(
        "bucket_key", F.lit(total).cast("bigint").alias("total"))


# ---------------------------------------------------------------------------
# Metrics (A10-A13)
# ---------------------------------------------------------------------------
from thawline.operators import metrics as M  # noqa: E402


MAX_ITEM = 200  # bytes of a message that the queries on write outcomes let a table take
_METRIC_RUNS: dict[tuple, str] = {}


def run_metrics(spark, sf):
    """Metric rows of two real ingests ("1.0", then "1.1" resuming) over the partly corrupt tree."""
    from thawline.plans.ingest import ingest
    root = corrupt_copy(spark, journal_root(spark, sf))
    key = (spark.sparkContext.applicationId, root)
    if key not in _METRIC_RUNS:
        base = SK.new_run_path(spark, "thawline-metrics")
        for run in ("1.0", "1.1"):
            ingest(spark, root, f"{base}/docs", run, checkpoint_log_path=f"{base}/log", mode="PERMISSIVE", metrics_path=f"{base}/metrics", max_document_bytes=MAX_ITEM)
        _METRIC_RUNS[key] = f"{base}/metrics"
    return spark.read.parquet(_METRIC_RUNS[key])


RUN_METRICS = f"""
items AS (
  SELECT index_name || '/' || bucket_name AS bucket_key, count(*) FILTER (WHERE octet_length(encode(message)) > {MAX_ITEM}) AS n_bad,
    sum(octet_length(encode(message))) FILTER (WHERE octet_length(encode(message)) <= {MAX_ITEM}) AS b
  FROM corpus GROUP BY 1
),
first_run AS (
  SELECT l.bucket_key, l.index_name, l.bucket_latest, l.bucket_seq % 7 = 0 AND coalesce(c.n_events, 0) > 0 AS bad,
    coalesce(c.n_events, 0) AS n, coalesce(i.n_bad, 0) AS n_bad, coalesce(i.b, 0) AS b
  FROM listing l LEFT JOIN counts c ON c.bucket_key = l.bucket_key LEFT JOIN items i ON i.bucket_key = l.bucket_key
),
run_metrics AS (
  SELECT bucket_key, index_name, bucket_latest, '1.0' AS ingest_iteration, CASE WHEN bad THEN 'failed' ELSE 'completed' END AS status,
    CASE WHEN bad THEN 0 ELSE n END AS event_count, CASE WHEN bad THEN 0 ELSE n_bad END AS docs_error, CASE WHEN bad THEN 0 ELSE b END AS message_bytes FROM first_run
  UNION ALL
  SELECT bucket_key, index_name, bucket_latest, '1.1', CASE WHEN bad THEN 'failed' ELSE 'skipped' END, 0, 0, 0 FROM first_run
)"""


@register("metrics_rollup", W(TB, RUN_METRICS) + """
SELECT index_name, ingest_iteration, count(*) AS journals, CAST(sum(event_count) AS BIGINT) AS events,
  CAST(sum(message_bytes) AS BIGINT) AS bytes, CAST(sum(event_count - docs_error) AS BIGINT) AS docs_success,
  CAST(sum(docs_error) AS BIGINT) AS docs_error,
  count(*) FILTER (WHERE status = 'completed') AS buckets_completed,
  count(*) FILTER (WHERE status = 'failed') AS buckets_failed,
  count(*) FILTER (WHERE status = 'skipped') AS buckets_skipped
FROM run_metrics GROUP BY index_name, ingest_iteration""")
def q_metrics_rollup(spark, sf):
    return M.rollup(run_metrics(spark, sf))


_BOUNDS = ", ".join(str(b) for b in M.BOUNDS)
HIST_CTES = ("""
long AS (SELECT index_name, ingest_iteration, unnest(['event_count', 'message_bytes']) AS metric,
         unnest([event_count, message_bytes]) AS v FROM run_metrics)""", f"""
lb AS (SELECT *, unnest([{_BOUNDS}, NULL]) AS bound FROM long)""")


@register("metrics_histogram", W(TB, RUN_METRICS, *HIST_CTES) + """
SELECT index_name, ingest_iteration, metric, coalesce(CAST(bound AS VARCHAR), '+Inf') AS le,
  count(*) FILTER (WHERE bound IS NULL OR v <= bound) AS count
FROM lb GROUP BY index_name, ingest_iteration, metric, bound""")
def q_metrics_histogram(spark, sf):
    return M.histogram(run_metrics(spark, sf))


@register("metrics_latest", W(TB, RUN_METRICS) + """
SELECT ingest_iteration, CAST(arg_max(event_count, (bucket_latest, bucket_key)) AS BIGINT) AS last_event_count,
  CAST(arg_max(message_bytes, (bucket_latest, bucket_key)) AS BIGINT) AS last_message_bytes
FROM run_metrics WHERE status = 'completed' GROUP BY ingest_iteration""")
def q_metrics_latest(spark, sf):
    return M.latest_gauges(run_metrics(spark, sf))


@register("throughput", W(TB, RUN_METRICS) + """
SELECT ingest_iteration, CAST(sum(event_count - docs_error) AS BIGINT) AS docs, CAST(sum(event_count - docs_error) AS BIGINT) AS docs_from_rate
FROM run_metrics GROUP BY ingest_iteration""")
def q_throughput(spark, sf):
    """Wall times differ from run to run, so the rate is checked against the documents it stands for."""
    t = M.throughput(run_metrics(spark, sf))
    return t.select("ingest_iteration", "docs", F.round(F.col("docs_per_s") * F.col("wall_ms") / 1000).cast("bigint").alias("docs_from_rate"))


# ---------------------------------------------------------------------------
# Ordinals, document ids, write outcome, batching (W3, P8, A7, K3), parser sets (J5, U2), U3, J6
# ---------------------------------------------------------------------------
from thawline.operators.scan import ordinal_within  # noqa: E402


def _with_ordinal(spark, sf, *extra):
    """Event keys and ``extra`` columns with the ordinal; only these are cut and written between slices."""
    key = R.bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key")
    raw = B.corpus(spark, sf).select("event_id", "event_time_ms", key, *extra)
    return ordinal_within(raw, ["bucket_key"], ["event_time_ms", "event_id"], "event_ordinal")


ORD_SQL = """
ord AS (
  SELECT *, index_name || '/' || bucket_name AS bucket_key,
         row_number() OVER (PARTITION BY index_name || '/' || bucket_name ORDER BY event_time_ms, event_id) - 1
           AS event_ordinal
  FROM corpus
)"""


@register("event_ordinal", W(ORD_SQL) + "SELECT event_id, bucket_key, event_ordinal FROM ord")
def q_event_ordinal(spark, sf):
    return _with_ordinal(spark, sf).select("event_id", "bucket_key", "event_ordinal")


DOC_ID_SQL = ("sha256(concat_ws('|', bucket_key, CAST(index_time % 1000 AS VARCHAR), "
              "CAST(event_time_ms // 1000 AS VARCHAR), '0', CAST(event_ordinal AS VARCHAR)))")


def _doc_id_col():
    return R.doc_id(F.col("bucket_key"), F.col("index_time") % 1000, F.floor(F.col("event_time_ms") / 1000),
                    F.lit(0), F.col("event_ordinal"))


@register("doc_id", W(ORD_SQL) + f"SELECT event_id, event_ordinal, {DOC_ID_SQL} AS doc_id FROM ord")
def q_doc_id(spark, sf):
    """Stream id = index_time % 1000, offset = event second, sub-offset 0 (they collide; the ordinal does not)."""
    return _with_ordinal(spark, sf, "index_time").select("event_id", "event_ordinal", _doc_id_col().alias("doc_id"))


BATCH = 500


@register("write_outcome", W(ORD_SQL) + f"""
SELECT bucket_key, event_ordinal // {BATCH} AS batch, count(*) FILTER (WHERE octet_length(encode(message)) <= {MAX_ITEM}) AS success,
  count(*) FILTER (WHERE octet_length(encode(message)) > {MAX_ITEM}) AS errors
FROM ord GROUP BY bucket_key, event_ordinal // {BATCH}""")
def q_write_outcome(spark, sf):
    """Per batch of 500 documents of an ingest: what its table took and what it turned away (messages over 200 bytes)."""
    from thawline.plans import commits
    from thawline.plans.ingest import ingest
    out = SK.new_run_path(spark, "thawline-ingest")
    ingest(spark, journal_root(spark, sf), out, "1.0", max_document_bytes=MAX_ITEM)
    both = commits.read_documents(spark, out).select("bucket_key", "event_ordinal", F.lit(True).alias("taken")).union(
        commits.read_rejects(spark, out).select("bucket_key", "event_ordinal", F.lit(False)))
    return both.groupBy("bucket_key", F.floor(F.col("event_ordinal") / BATCH).alias("batch")).agg(
        F.count_if("taken").alias("success"), F.count_if(~F.col("taken")).alias("errors"))


@register("ingest_rejects", W(TB, ORD_SQL) + f"""
SELECT l.bucket_key, 'completed' AS status, coalesce(o.good, 0) AS indexed, coalesce(o.bad, 0) AS errors, coalesce(o.bad, 0) AS n_rejects, o.reason
FROM listing l LEFT JOIN (
  SELECT bucket_key, count(*) FILTER (WHERE n <= {MAX_ITEM}) AS good, count(*) FILTER (WHERE n > {MAX_ITEM}) AS bad,
    'message of ' || max(n) FILTER (WHERE n > {MAX_ITEM}) || ' bytes' AS reason
  FROM (SELECT bucket_key, octet_length(encode(message)) AS n FROM ord) GROUP BY bucket_key) o ON o.bucket_key = l.bucket_key""")
def q_ingest_rejects(spark, sf):
    """Results and log of an ingest count the documents turned away; each is stored with its reason."""
    from thawline.plans import commits
    from thawline.plans.ingest import ingest
    base = SK.new_run_path(spark, "thawline-ingest")
    ingest(spark, journal_root(spark, sf), f"{base}/docs", "1.0", checkpoint_log_path=f"{base}/log", max_document_bytes=MAX_ITEM)
    log = R.checkpoint_latest(spark.read.parquet(f"{base}/log")).select("bucket_key", "status", "indexed", "errors")
    rejects = commits.read_rejects(spark, f"{base}/docs").groupBy("bucket_key").agg(
        F.count(F.lit(1)).alias("n_rejects"), F.max_by("error_message", F.octet_length("message")).alias("reason"))
    return log.join(rejects, "bucket_key", "left").fillna(0, ["n_rejects"])


@register("batch_by_docs", W(ORD_SQL) + f"""
SELECT bucket_key, event_ordinal // {BATCH} AS batch, count(*) AS n_docs,
  CAST(sum(octet_length(encode(message))) AS BIGINT) AS n_bytes
FROM ord GROUP BY bucket_key, event_ordinal // {BATCH}""")
def q_batch_by_docs(spark, sf):
    """K3: document-count batches (500 per request) per bucket with their body bytes."""
    o = _with_ordinal(spark, sf, F.octet_length("message").alias("body_bytes"))
    return o.groupBy("bucket_key", F.floor(F.col("event_ordinal") / BATCH).alias("batch")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("body_bytes").alias("n_bytes"))


PARSER_SETS_SQL = """
req AS (SELECT DISTINCT 'thaw-parse-' || replace(kind, '_', '-') AS parser_pipeline FROM classified),
reg AS (SELECT DISTINCT 'thaw-parse-' || replace(kind, '_', '-') AS parser_pipeline FROM classified
        WHERE index_name IN ('apache', 'syslog') AND CAST(split_part(bucket_name, '_', 4) AS INTEGER) % 2 = 0)"""


def _parser_sets(spark, sf):
    c = B.classified(spark, sf)
    req = c.select(C.parser_name(F.col("kind")).alias("parser_pipeline")).distinct()
    # parsers an earlier run registered: kinds it saw in the even-numbered buckets of two indices
    even = F.col("index_name").isin("apache", "syslog") & (
        F.substring_index(F.col("bucket_name"), "_", -1).cast("int") % 2 == 0)
    reg = c.where(even).select(C.parser_name(F.col("kind")).alias("parser_pipeline")).distinct()
    return req, reg


@register("parsers_missing", W(CLS, PARSER_SETS_SQL) + """
SELECT parser_pipeline FROM req WHERE parser_pipeline NOT IN (SELECT parser_pipeline FROM reg)""")
def q_parsers_missing(spark, sf):
    req, reg = _parser_sets(spark, sf)
    return R.parsers_missing(req, reg)


@register("parsers_reused", W(CLS, PARSER_SETS_SQL) + """
SELECT parser_pipeline FROM req WHERE parser_pipeline IN (SELECT parser_pipeline FROM reg)""")
def q_parsers_reused(spark, sf):
    req, reg = _parser_sets(spark, sf)
    return R.parsers_reused(req, reg)


@register("parsers_distinct", W(CLS) + """
SELECT 'thaw-parse-' || replace(kind, '_', '-') AS parser_pipeline, min(index_name) AS first_index
FROM classified GROUP BY kind""")
def q_parsers_distinct(spark, sf):
    """Each parser deployed once over all indices; the first index (by name) that needs it wins."""
    c = B.classified(spark, sf).select(C.parser_name(F.col("kind")).alias("parser_pipeline"), "index_name")
    return c.groupBy("parser_pipeline").agg(F.min("index_name").alias("first_index"))


@register("dedupe_docs", W(ORD_SQL) + f"""
SELECT index_name, count(*) AS n_docs, count(DISTINCT {DOC_ID_SQL}) AS n_ids,
  CAST(count(*) + count(*) FILTER (WHERE event_id % 10 = 0) AS BIGINT) AS n_delivered
FROM ord GROUP BY index_name""")
def q_dedupe_docs(spark, sf):
    """Every tenth document delivered twice; dedupe on the id restores one row per event."""
    o = _with_ordinal(spark, sf, "index_name", "index_time").withColumn("doc_id", _doc_id_col()).select("index_name", "event_id", "doc_id")
    delivered = o.unionByName(o.where(F.col("event_id") % 10 == 0))
    d = R.dedupe_docs(delivered)
    n_del = delivered.groupBy("index_name").agg(F.count(F.lit(1)).alias("n_delivered"))
    n = d.groupBy("index_name").agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("doc_id").alias("n_ids"))
    return n.join(n_del, "index_name")


@register("docs_with_bucket", W(TB) + """
SELECT c.event_id, l.bucket_key, l.target_index, l.bucket_latest, l.bucket_earliest
FROM corpus c JOIN listing l ON l.bucket_key = c.index_name || '/' || c.bucket_name""")
def q_docs_with_bucket(spark, sf):
    """Events carry only their bucket key; the bucket context comes from the listing (equi join)."""
    ev = B.corpus(spark, sf).select("event_id", R.bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key"))
    lst = T.listing(spark, sf).select("bucket_key", "target_index", "bucket_latest", "bucket_earliest")
    return ev.join(lst, "bucket_key")


# ---------------------------------------------------------------------------
# Journal source round trips (S1-S9, A8) and op-log replay
# ---------------------------------------------------------------------------
from thawline.functions.text import decode_text_fast as _dtf  # noqa: E402
from thawline.operators import replay as RP  # noqa: E402
from thawline.sources import journal as JS  # noqa: E402
from thawline.sources.buckets import list_buckets  # noqa: E402
from thawline.sources.journal_writer import corrupt_copy, ensure_journals  # noqa: E402


def journal_root(spark, sf):
    return ensure_journals(spark, sf, B.corpus(spark, sf))


def journal_events(spark, sf, **opts):
    return JS.read(spark, journal_root(spark, sf), **opts)


@register("bucket_listing", W(TB) + """
SELECT index_name, bucket_name, bucket_latest AS latest_epoch, bucket_earliest AS earliest_epoch,
       bucket_seq AS sequence, bucket_key, target_index FROM listing""")
def q_bucket_listing(spark, sf):
    return list_buckets(spark, journal_root(spark, sf)).drop("journal_path", "journal_size_bytes")


@register("bucket_filter", W() + """
SELECT index_name || '/' || bucket_name AS bucket_key, count(*) AS n_events FROM corpus
WHERE index_name IN ('apache', 'syslog') GROUP BY ALL""")
def q_bucket_filter(spark, sf):
    """S3: index filter pushed into the source: pruned journals become no partition."""
    ev = journal_events(spark, sf, columns="index_name,bucket_name").where(F.col("index_name").isin("apache", "syslog"))
    return ev.groupBy(R.bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key")).agg(
        F.count(F.lit(1)).alias("n_events"))


@register("bucket_filter_contradiction", W() + """
SELECT route, CAST(0 AS BIGINT) AS n_events FROM (SELECT unnest(['in_and_equal', 'option_and_equal']) AS route)
WHERE (SELECT count(*) FROM corpus) > 0""")
def q_bucket_filter_contradiction(spark, sf):
    """S3: filters that exclude each other keep no journal, pushed down or given as an option."""
    index = F.col("index_name")
    both = journal_events(spark, sf).where(index.isin("apache", "syslog") & (index == "nginx"))
    option = journal_events(spark, sf, indices="apache").where(index == "nginx")
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n_events")).select(F.lit(name).alias("route"), "n_events")
    return one(both, "in_and_equal").unionByName(one(option, "option_and_equal"))


# the writer's stream ids: every 29th does not fit a signed 64-bit integer
STREAM_ID_SQL = "(CAST(index_time % 1000 AS HUGEINT) + CASE WHEN event_id % 29 = 0 THEN 9223372036854775808::HUGEINT ELSE 0::HUGEINT END)"
SCAN_COLS_SQL = """bucket_key, event_ordinal, index_time, event_time_ms, message, host, source, sourcetype,
  CAST(""" + STREAM_ID_SQL + """ AS VARCHAR) AS stream_id, event_time_ms // 1000 AS stream_offset"""


def _scan_cols(df):
    return df.select(R.bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key"), "event_ordinal",
                     "index_time", "event_time_ms", decode_text(F.col("message")).alias("message"), "host", "source",
                     "sourcetype", F.col("stream_id").cast("string").alias("stream_id"), "stream_offset")


@register("journal_scan", W(ORD_SQL) + f"SELECT {SCAN_COLS_SQL} FROM ord")
def q_journal_scan(spark, sf):
    """Decoded events equal the rows the journals were written from (round trip)."""
    return _scan_cols(journal_events(spark, sf))


OPS_SQL = """
strs AS (
  SELECT DISTINCT bucket_key, unnest(CASE WHEN event_id % 10 = 0 THEN ['user', 'u' || CAST(event_id % 7 AS VARCHAR), 'again']
                                           WHEN event_id % 5 = 0 THEN ['user', 'u' || CAST(event_id % 7 AS VARCHAR)]
                                           ELSE [] END) AS s FROM ord
),
opc AS (
  SELECT CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 34 ELSE 38 END AS opcode FROM ord
  UNION ALL SELECT CASE event_id % 50 WHEN 0 THEN 8 WHEN 1 THEN 11 WHEN 2 THEN 9 ELSE 0 END FROM ord WHERE event_id % 50 < 4
  UNION ALL SELECT 10 FROM listing
  UNION ALL SELECT 3 FROM (SELECT DISTINCT bucket_key, host FROM ord WHERE host <> '')
  UNION ALL SELECT 4 FROM (SELECT DISTINCT bucket_key, source FROM ord WHERE source <> '')
  UNION ALL SELECT 5 FROM (SELECT DISTINCT bucket_key, sourcetype FROM ord WHERE sourcetype <> '')
  UNION ALL SELECT 6 FROM strs
)"""


@register("journal_ops_by_opcode", W(TB, ORD_SQL, OPS_SQL) + """
SELECT CAST(opcode AS INTEGER) AS opcode, count(*) AS n_ops FROM opc GROUP BY opcode""")
def q_journal_ops_by_opcode(spark, sf):
    """Opcode dispatch (state-change opcodes 17-31 are left out: their count is writer policy)."""
    ops = journal_events(spark, sf, emit="ops", skipMetadata="false")
    return ops.where(~F.col("opcode").between(17, 31)).groupBy("opcode").agg(F.count(F.lit(1)).alias("n_ops"))


@register("journal_tombstones_skipped", W(ORD_SQL) + """
SELECT bucket_key, count(*) AS n_events, count(*) FILTER (WHERE event_id % 50 IN (0, 1)) AS n_skipped_blocks
FROM ord GROUP BY bucket_key""")
def q_journal_tombstones_skipped(spark, sf):
    """Delete and hash-slice blocks are skipped as length-prefixed blocks between events."""
    root = journal_root(spark, sf)
    ev = JS.read(spark, root, columns="index_name,bucket_name").groupBy(R.bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key")) \
        .agg(F.count(F.lit(1)).alias("n_events"))
    ops = JS.read(spark, root, emit="ops").where(F.col("opcode").isin(8, 11)).groupBy(
        R.bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key")).agg(
        F.count(F.lit(1)).alias("n_skipped_blocks"))
    return ev.join(ops, "bucket_key", "left").fillna(0, ["n_skipped_blocks"])


META_SQL = """
SELECT bucket_key, event_ordinal,
  CASE WHEN event_id % 10 = 0 THEN 'u' || CAST(event_id % 7 AS VARCHAR) || ',again'
       WHEN event_id % 5 = 0 THEN 'u' || CAST(event_id % 7 AS VARCHAR) END AS user_values,
  CASE WHEN event_id % 23 = 0 THEN 1 ELSE 0 END AS n_errors
FROM ord"""


def _meta_cols(df):
    return df.select(R.bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key"), "event_ordinal",
                     F.array_join(F.col("fields")["user"], ",").alias("user_values"),
                     F.coalesce(F.size("extraction_errors"), F.lit(0)).alias("n_errors"))


@register("journal_scan_no_metadata", W(ORD_SQL) + META_SQL)
def q_journal_scan_no_metadata(spark, sf):
    """With ``skipMetadata=false`` metadata maps to fields (repeated key -> list) and errors; the
    default walks the same bytes without mapping (same events, checked by ``journal_scan``)."""
    return _meta_cols(journal_events(spark, sf, skipMetadata="false"))


@register("metadata_error_counts", W() + """
SELECT index_name, count(*) FILTER (WHERE event_id % 23 = 0) AS n_errors,
  count(*) FILTER (WHERE event_id % 23 = 0) AS n_events_with_errors
FROM corpus GROUP BY index_name""")
def q_metadata_error_counts(spark, sf):
    """Decode errors by index: total and events with errors."""
    ev = journal_events(spark, sf, skipMetadata="false")
    return ev.groupBy("index_name").agg(F.coalesce(F.sum(F.size("extraction_errors")), F.lit(0)).alias("n_errors"),
                                        F.count_if(F.col("extraction_errors").isNotNull()).alias("n_events_with_errors"))


@register("corrupt_journals", W() + """
SELECT index_name, count(DISTINCT bucket_name) FILTER (WHERE bucket_seq % 7 = 0) AS bad_journals,
  count(*) FILTER (WHERE bucket_seq % 7 <> 0) AS intact_events
FROM corpus GROUP BY index_name""")
def q_corrupt_journals(spark, sf):
    """PERMISSIVE mode over a copy of the tree where journals with sequence % 7 == 0 are cut inside
    an event: one ``_corrupt_reason`` row per bad journal (events before the fault are kept, and
    counted apart); every other journal decodes in full."""
    root = corrupt_copy(spark, journal_root(spark, sf))
    ev = JS.read(spark, root, mode="PERMISSIVE")
    per = ev.groupBy("index_name", "journal_path").agg(
        F.count_if(F.col("_corrupt_reason").isNotNull()).alias("bad"),
        F.count_if(F.col("_corrupt_reason").isNull()).alias("n"))
    return per.groupBy("index_name").agg(
        F.sum("bad").alias("bad_journals"),
        F.coalesce(F.sum(F.when(F.col("bad") == 0, F.col("n"))), F.lit(0)).alias("intact_events"))


BUCKET_DOCS_SQL = W(ORD_SQL, CLS.replace("FROM corpus", "FROM ord")) + DOCS_SQL.replace(
    "SELECT event_id,", "SELECT bucket_key, event_ordinal,")


@register("bucket_docs", BUCKET_DOCS_SQL)
def q_bucket_docs(spark, sf):
    """S9 + P1/P2 + P3-P5: journals -> decoded text (Latin-1 fast path) -> documents."""
    ev = journal_events(spark, sf)
    ev = ev.withColumns({"message": _dtf(F.col("message"), F.col("index_name")),
                         "bucket_key": R.bucket_key(F.col("index_name"), F.col("bucket_name"))})
    return B.docs(ev, keys=("bucket_key", "event_ordinal"))


def _ops(spark, sf):
    return journal_events(spark, sf, emit="ops", skipMetadata="false")


@register("journal_replay", W(ORD_SQL) + f"SELECT {SCAN_COLS_SQL} FROM ord")
def q_journal_replay(spark, sf):
    """W1 + W2 + J3 + P7: the op log replayed with joins and ordered scans equals the source's own replay."""
    return _scan_cols(RP.replay_events(_ops(spark, sf)).withColumn("stream_id", F.col("stream_id")))


@register("event_time_rebase", W(ORD_SQL) + "SELECT bucket_key, event_ordinal, index_time, event_time_ms FROM ord")
def q_event_time_rebase(spark, sf):
    return RP.event_times(_ops(spark, sf)).select("bucket_key", "event_ordinal", "index_time", "event_time_ms")


DICT_SQL = """
SELECT bucket_key, opcode, row_number() OVER (PARTITION BY bucket_key, opcode ORDER BY first_ord) AS idx, text FROM (
  SELECT bucket_key, 3 AS opcode, host AS text, min(event_ordinal) AS first_ord FROM ord WHERE host <> '' GROUP BY ALL
  UNION ALL
  SELECT bucket_key, 4, source, min(event_ordinal) FROM ord WHERE source <> '' GROUP BY ALL
  UNION ALL
  SELECT bucket_key, 5, sourcetype, min(event_ordinal) FROM ord WHERE sourcetype <> '' GROUP BY ALL)"""


@register("dictionary_index", W(ORD_SQL) + DICT_SQL)
def q_dictionary_index(spark, sf):
    """N-th string per (journal, dictionary) for hosts, sources and sourcetypes."""
    d = RP.dictionary(_ops(spark, sf)).where(F.col("opcode").isin(3, 4, 5))
    return d.select("bucket_key", "opcode", "idx", "text")


@register("state_fill_forward", W(ORD_SQL) + f"""
, dict AS ({DICT_SQL})
SELECT o.bucket_key, o.event_ordinal, coalesce(h.idx, 0) AS host_id, coalesce(s.idx, 0) AS source_id,
       coalesce(t.idx, 0) AS sourcetype_id, o.event_time_ms // 1000 AS base_event_time
FROM ord o
LEFT JOIN dict h ON h.bucket_key = o.bucket_key AND h.opcode = 3 AND h.text = o.host
LEFT JOIN dict s ON s.bucket_key = o.bucket_key AND s.opcode = 4 AND s.text = o.source
LEFT JOIN dict t ON t.bucket_key = o.bucket_key AND t.opcode = 5 AND t.text = o.sourcetype""".replace(
    "\n, dict AS", ",\ndict AS"))
def q_state_fill_forward(spark, sf):
    """Active ids and base time carried forward from the last state opcode of the journal."""
    s = RP.fill_state(_ops(spark, sf)).where(RP.is_event(F.col("opcode")))
    return s.select("bucket_key", "event_ordinal", F.col("state_host").alias("host_id"),
                    F.col("state_source").alias("source_id"), F.col("state_sourcetype").alias("sourcetype_id"),
                    F.col("base_event_time").cast("bigint").alias("base_event_time"))


@register("dictionary_resolve", W(ORD_SQL) + "SELECT bucket_key, event_ordinal, host, source, sourcetype FROM ord")
def q_dictionary_resolve(spark, sf):
    """Active ids joined to the dictionaries (1-based, 0 -> '', defined before use)."""
    return RP.replay_events(_ops(spark, sf)).select("bucket_key", "event_ordinal", "host", "source", "sourcetype")


@register("metadata_fields", W(ORD_SQL) + META_SQL)
def q_metadata_fields(spark, sf):
    """J4 + A9: metadata pairs resolved relationally from the op log, repeated key -> list in order."""
    ops = _ops(spark, sf)
    sc = RP.scanned(ops)
    m = RP.metadata_fields(ops, sc)
    ev = RP.fill_state(ops, sc).where(RP.is_event(F.col("opcode"))).select("bucket_key", "ord", "event_ordinal")
    m = ev.join(m, ["bucket_key", "ord"], "left")
    return m.select("bucket_key", "event_ordinal", F.array_join(F.col("fields")["user"], ",").alias("user_values"),
                    F.coalesce(F.size("extraction_errors"), F.lit(0)).alias("n_errors"))


@register("opcode_flags", W(ORD_SQL) + """
SELECT bucket_key, event_ordinal, opcode, (opcode & 4) <> 0 AS has_extended_storage, (opcode & 1) = 0 AS has_hash,
       (opcode & 34) = 34 AS include_punctuation
FROM (SELECT *, CAST(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 34 ELSE 38 END AS INTEGER) AS opcode FROM ord)""")
def q_opcode_flags(spark, sf):
    """Event flag bits of each event opcode."""
    ops = RP.with_key(_ops(spark, sf)).where(RP.is_event(F.col("opcode"))).select("bucket_key", "ord", "opcode")
    ops = ordinal_within(ops, ["bucket_key"], ["ord"], "event_ordinal")
    fl = RP.opcode_flags(F.col("opcode"))
    return ops.select("bucket_key", "event_ordinal", "opcode", *[fl[c].alias(c) for c in
                                                                  ("has_extended_storage", "has_hash",
                                                                   "include_punctuation")])


# ---------------------------------------------------------------------------
# Sinks (K1, K2, K3, K5), re-parse of stored documents (T16), streaming
# ---------------------------------------------------------------------------
from thawline.sinks import documents as SK  # noqa: E402


def ingest_docs(ev: DataFrame) -> DataFrame:
    """Flagship ingest plan from decoded journal events to documents with ids (S4 -> P1/P2 -> F -> P8)."""
    ev = ev.withColumns({"message": _dtf(F.col("message"), F.col("index_name")),
                         "bucket_key": R.bucket_key(F.col("index_name"), F.col("bucket_name"))})
    ev = ev.withColumn("doc_id", R.doc_id(F.col("bucket_key"), F.col("stream_id"),
                                          F.col("stream_offset"), F.col("stream_sub_offset"), F.col("event_ordinal")))
    return B.docs(ev, keys=("doc_id", "bucket_key", "event_ordinal"))


@register("runs_isolated", W() + """
SELECT ingest_run, count(*) AS n_docs FROM (SELECT '1.0-a' AS ingest_run FROM corpus UNION ALL
  SELECT '1.1-b' FROM corpus) GROUP BY ingest_run""")
def q_runs_isolated(spark, sf):
    """K5: a second run (and a retry of it) never touches the first run's partitions."""
    path = SK.new_run_path(spark)
    docs = ingest_docs(journal_events(spark, sf))
    SK.write_docs(docs, path, "1.0-a")
    SK.write_docs(docs, path, "1.1-b")
    SK.write_docs(docs, path, "1.1-b")  # retried run replaces only its own partitions
    return spark.read.parquet(path).groupBy("ingest_run").agg(F.count(F.lit(1)).alias("n_docs"))


JOURNAL_ID_SQL = DOC_ID_SQL.replace("index_time % 1000", STREAM_ID_SQL)
BULK_SQL = W(ORD_SQL, CLS.replace("FROM corpus", "FROM ord")) + f"""
SELECT {JOURNAL_ID_SQL} AS doc_id,
  '{{"index":{{"_id":"' || {JOURNAL_ID_SQL} || '"}}}}' AS action,
  json_object('@timestamp', {ISO_SQL}, 'message', message, 'host', {O.strip_prefix('host')},
              'source', {O.strip_prefix('source')}, 'sourcetype', {O.strip_prefix('sourcetype')},
              'event', json_object('kind', kind, 'dataset', {O.dataset()}), 'splunk.index', index_name,
              'splunk.index_time', index_time, 'splunk.bucket_name', bucket_name,
              'splunk.pipeline', {O.pipeline()}, 'splunk.classify_reason', reason)::VARCHAR AS body
FROM classified"""


@register("write_docs_readback", W(ORD_SQL, CLS.replace("FROM corpus", "FROM ord")) + f"""
SELECT {JOURNAL_ID_SQL} AS doc_id, index_name AS splunk_index, kind AS event_kind, message, reason AS splunk_classify_reason FROM classified""")
def q_write_docs_readback(spark, sf):
    """K1: documents written as a partitioned Parquet table (schema enforced) and read back row by row."""
    path = SK.new_run_path(spark)
    SK.write_docs(ingest_docs(journal_events(spark, sf)), path, "1.0-run")
    return spark.read.parquet(path).select("doc_id", "splunk_index", "event_kind", "message", "splunk_classify_reason")


@register("parse_errors", W(ORD_SQL) + "SELECT bucket_key, event_ordinal, CAST(NULL AS VARCHAR) AS error_message FROM ord")
def q_parse_errors(spark, sf):
    """Every processor ignores its own failure, so the documents of clean journals carry no ``error_message``."""
    from thawline.plans.ingest import documents
    return documents(journal_events(spark, sf)).select("bucket_key", "event_ordinal", "error_message")


@register("bulk_ndjson", BULK_SQL)
def q_bulk_ndjson(spark, sf):
    """K2: bulk request lines: action with the document id only, body without it."""
    return SK.bulk_lines(ingest_docs(journal_events(spark, sf)))


BATCH_SQL = "WITH RECURSIVE" + BULK_SQL.strip()[len("WITH"):].replace("AS doc_id,", "AS doc_id, bucket_key, event_ordinal,", 1)
i_ = BATCH_SQL.rindex("SELECT ", 0, BATCH_SQL.index("AS doc_id, bucket_key, event_ordinal"))
BATCH_SQL = BATCH_SQL[:i_].rstrip() + """,
sized AS (SELECT bucket_key, event_ordinal, strlen(action) + strlen(body) + 2 AS nb FROM (""" + BATCH_SQL[i_:] + """) x),
walk AS (
  SELECT bucket_key, event_ordinal, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS docs, CAST(nb AS BIGINT) AS bytes
  FROM sized WHERE event_ordinal = 0
  UNION ALL
  SELECT s.bucket_key, s.event_ordinal,
    w.batch + CASE WHEN w.docs >= 500 OR w.bytes >= 65536 THEN 1 ELSE 0 END,
    CASE WHEN w.docs >= 500 OR w.bytes >= 65536 THEN 1 ELSE w.docs + 1 END,
    CASE WHEN w.docs >= 500 OR w.bytes >= 65536 THEN s.nb ELSE w.bytes + s.nb END
  FROM walk w JOIN sized s ON s.bucket_key = w.bucket_key AND s.event_ordinal = w.event_ordinal + 1
)
SELECT bucket_key, batch, max(docs) AS n_docs, max(bytes) AS n_bytes FROM walk GROUP BY bucket_key, batch"""


@register("batch_by_bytes", BATCH_SQL)
def q_batch_by_bytes(spark, sf):
    """K3: per bucket, batches flushed at 500 documents or at 64 KiB (15 MiB by default), in event order."""
    return SK.batch_by_bytes(SK.bulk_lines(ingest_docs(journal_events(spark, sf)), keys=("bucket_key", "event_ordinal")), max_bytes=64 * 1024)


@register("batch_by_bytes_shuffled", BATCH_SQL)
def q_batch_by_bytes_shuffled(spark, sf):
    """K3: the same batches from documents in no order (dealt by their ids): cut in slices, a hot bucket in many tasks."""
    lines = SK.bulk_lines(ingest_docs(journal_events(spark, sf)), keys=("bucket_key", "event_ordinal")).repartition("doc_id")
    return SK.batch_by_bytes(lines, max_bytes=64 * 1024, in_scan_order=False)


REPARSE_SQL = W(CLS, f"""
stored AS (
  SELECT * REPLACE (coalesce(CASE WHEN event_id % 2 = 0 THEN kind END,
    CASE WHEN regexp_matches({O.strip_prefix('sourcetype')}, {O.q(P.re2_ci(P.ROUTER_ACCESS_SOURCETYPE))}) THEN 'access_log'
         WHEN regexp_matches({O.strip_prefix('sourcetype')}, {O.q(P.re2_ci(P.ROUTER_SYSLOG_SOURCETYPE))}) THEN 'syslog'
         ELSE 'generic' END) AS kind)
  FROM classified
)""", O.routed_sql(src="stored")) + """
SELECT kind, event_category, count(*) AS n_docs, count(client_ip) AS n_access_parsed,
  count(syslog_hostname) AS n_syslog_parsed FROM parsed GROUP BY ALL"""


@register("reparse_docs", REPARSE_SQL)
def q_reparse_docs(spark, sf):
    """Stored documents (every second one without a kind) re-parsed through the router into a new
    table; the current-table pointer is swapped only after the write succeeded."""
    from thawline.plans.reparse import current, reparse
    raw = B.corpus(spark, sf)
    stored_path = SK.new_run_path(spark, "thawline-stored")
    c = C.classify(raw).withColumn("kind", F.when(F.col("event_id") % 2 == 0, F.col("kind")))
    c.select("event_id", "message", "sourcetype", "event_time_ms", "kind").write.parquet(stored_path)
    target = SK.new_run_path(spark, "thawline-reparsed")
    reparse(spark, stored_path, target)
    cur = current(spark, target)
    return cur.groupBy("kind", "event_category").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count("client_ip").alias("n_access_parsed"),
        F.count("syslog_hostname").alias("n_syslog_parsed"))


@register("incremental_ingest", W() + "SELECT index_name AS splunk_index, count(*) AS n_docs FROM corpus GROUP BY ALL")
def q_incremental_ingest(spark, sf):
    """Two available-now runs over the same tree: the first ingests every journal, the second none."""
    from thawline.streaming.incremental import run_incremental
    root = journal_root(spark, sf)
    base = SK.new_run_path(spark, "thawline-stream")
    for _ in range(2):
        run_incremental(spark, root, ingest_docs, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    return spark.read.parquet(os.path.join(base, "out")).groupBy("splunk_index").agg(F.count(F.lit(1)).alias("n_docs"))


@register("incremental_idempotent", W() + """
SELECT index_name AS splunk_index, count(*) AS n_docs, count(*) AS n_ids FROM corpus GROUP BY ALL""")
def q_incremental_idempotent(spark, sf):
    """R2: a re-delivered micro-batch overwrites its own output: same rows, stable ids."""
    from thawline.streaming.incremental import ingest_batch
    root = journal_root(spark, sf)
    out = os.path.join(SK.new_run_path(spark, "thawline-stream"), "out")
    batch = list_buckets(spark, root).select(F.col("journal_path").alias("path"), F.col("journal_size_bytes").alias("length"))
    run = ingest_batch(spark, ingest_docs, out)
    run(batch, 0)
    run(batch, 0)  # re-delivery of batch 0
    back = spark.read.parquet(out)
    return back.groupBy("splunk_index").agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("doc_id").alias("n_ids"))


@register("incremental_with_failures", W(TB) + """
SELECT l.bucket_key, CASE WHEN bad THEN 0 ELSE n END AS n_docs, bad AS quarantined, CASE WHEN bad THEN 'failed' ELSE 'completed' END AS logged
FROM (SELECT l.*, coalesce(c.n_events, 0) AS n, l.bucket_seq % 7 = 0 AND coalesce(c.n_events, 0) > 0 AS bad
      FROM listing l LEFT JOIN counts c ON c.bucket_key = l.bucket_key) l""")
def q_incremental_with_failures(spark, sf):
    """Bad journals do not stop the stream: their buckets are quarantined and logged, the others ingested, once."""
    from thawline.plans.ingest import documents
    from thawline.streaming import incremental as INC
    root = corrupt_copy(spark, journal_root(spark, sf))
    base = SK.new_run_path(spark, "thawline-stream")
    out, log = os.path.join(base, "out"), os.path.join(base, "log")
    for _ in range(2):
        INC.run_incremental(spark, root, documents, out, os.path.join(base, "ckpt"), mode="PERMISSIVE", checkpoint_log_path=log)
    docs = spark.read.parquet(out).groupBy("bucket_key").agg(F.count(F.lit(1)).alias("n_docs"))
    held = INC.quarantined(spark, out).select("bucket_key", F.lit(True).alias("quarantined"))
    logged = R.checkpoint_latest(spark.read.parquet(log)).select("bucket_key", F.col("status").alias("logged"))
    return logged.join(docs, "bucket_key", "left").join(held, "bucket_key", "left").fillna(0, ["n_docs"]).fillna(False, ["quarantined"])


@register("incremental_repaired", W() + """
SELECT index_name AS splunk_index, count(*) AS n_docs, count(*) AS n_ids, 0 AS n_quarantined FROM corpus GROUP BY ALL""")
def q_incremental_repaired(spark, sf):
    """Quarantined buckets are delivered again from repaired journals: every document is there once, the quarantine is empty."""
    from thawline.plans.ingest import documents
    from thawline.streaming import incremental as INC
    good = journal_root(spark, sf)
    base = SK.new_run_path(spark, "thawline-stream")
    out = os.path.join(base, "out")
    INC.run_incremental(spark, corrupt_copy(spark, good), documents, out, os.path.join(base, "ckpt"), mode="PERMISSIVE")
    INC.redeliver(spark, documents, out)  # not repaired yet: they stay
    INC.redeliver(spark, documents, out, root=good)
    left = INC.quarantined(spark, out).agg(F.count(F.lit(1)).cast("int").alias("n_quarantined"))
    return spark.read.parquet(out).groupBy("splunk_index").agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("doc_id").alias("n_ids")).crossJoin(left)


# ---------------------------------------------------------------------------
# Flagship ingest with resume (3.1 lifecycle) and profile merge (A2)
# ---------------------------------------------------------------------------
@register("ingest_resume", W(TB) + """
SELECT 1 AS run, l.bucket_key, coalesce(c.n_events, 0) AS indexed, 0 AS errors, 'completed' AS status
FROM listing l LEFT JOIN counts c ON c.bucket_key = l.bucket_key
UNION ALL
SELECT 2, l.bucket_key, coalesce(c.n_events, 0), 0, 'skipped'
FROM listing l LEFT JOIN counts c ON c.bucket_key = l.bucket_key""")
def q_ingest_resume(spark, sf):
    """Two ingests with a checkpoint log: the first writes every bucket, the second skips them all."""
    from thawline.plans.ingest import ingest
    root = journal_root(spark, sf)
    base = SK.new_run_path(spark, "thawline-ingest")
    out, log = os.path.join(base, "docs"), os.path.join(base, "checkpoint_log")
    r1 = ingest(spark, root, out, "1.0", checkpoint_log_path=log).withColumn("run", F.lit(1))
    # cut lineage with a written table so run 1's results are fixed before run 2 changes the checkpoint log
    r1.write.parquet(os.path.join(base, "results_run1"))
    r1 = spark.read.parquet(os.path.join(base, "results_run1"))
    r2 = ingest(spark, root, out, "1.1", checkpoint_log_path=log).withColumn("run", F.lit(2))
    return r1.unionByName(r2).select("run", "bucket_key", "indexed", F.col("errors").cast("int").alias("errors"),
                                     "status")


@register("ingest_resume_same_run", W() + """
SELECT index_name AS splunk_index, count(*) AS n_docs, count(*) AS n_ids FROM corpus GROUP BY index_name""")
def q_ingest_resume_same_run(spark, sf):
    """A run is resumed under its own id after more buckets have come: every document is there once."""
    from thawline.plans.ingest import ingest
    root = journal_root(spark, sf)
    base = SK.new_run_path(spark, "thawline-ingest")
    out, log = os.path.join(base, "docs"), os.path.join(base, "checkpoint_log")
    ingest(spark, root, out, "1.0", checkpoint_log_path=log, indices=["apache", "syslog"])
    ingest(spark, root, out, "1.0", checkpoint_log_path=log)
    return spark.read.parquet(out).groupBy("splunk_index").agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("doc_id").alias("n_ids"))


@register("ingest_resume_uri", W(TB) + """
SELECT l.bucket_key, 'skipped' AS status, coalesce(c.n_events, 0) AS indexed, coalesce(c.n_events, 0) AS n_docs
FROM listing l LEFT JOIN counts c ON c.bucket_key = l.bucket_key""")
def q_ingest_resume_uri(spark, sf):
    """A checkpoint log given as a URI is found: the second call skips every bucket and writes nothing."""
    from thawline.plans.ingest import ingest
    root = journal_root(spark, sf)
    base = SK.new_run_path(spark, "thawline-ingest")
    uri = base if ":" in base else f"file://{base}"
    for _ in range(2):
        last = ingest(spark, root, f"{uri}/docs", "1.0", checkpoint_log_path=f"{uri}/checkpoint_log")
    docs = spark.read.parquet(f"{uri}/docs").groupBy("bucket_key").agg(F.count(F.lit(1)).alias("n_docs"))
    return last.select("bucket_key", "status", "indexed").join(docs, "bucket_key", "left").fillna(0, ["n_docs"])


@register("ingest_with_failures", W(TB) + """
SELECT bucket_key, status, indexed, errors, indexed AS n_docs, logged FROM (
  SELECT l.bucket_key, CASE WHEN bad THEN 'failed' ELSE 'completed' END AS status, CASE WHEN bad THEN 0 ELSE n END AS indexed,
    CAST(0 AS BIGINT) AS errors, CASE WHEN bad THEN 'failed' ELSE 'completed' END AS logged
  FROM (SELECT l.*, coalesce(c.n_events, 0) AS n, l.bucket_seq % 7 = 0 AND coalesce(c.n_events, 0) > 0 AS bad
        FROM listing l LEFT JOIN counts c ON c.bucket_key = l.bucket_key) l)""")
def q_ingest_with_failures(spark, sf):
    """Bad journals fail alone: status, counts, documents in the table and the log's last state."""
    from thawline.plans.ingest import ingest
    root = corrupt_copy(spark, journal_root(spark, sf))
    base = SK.new_run_path(spark, "thawline-ingest")
    res = ingest(spark, root, f"{base}/docs", "1.0", checkpoint_log_path=f"{base}/log", mode="PERMISSIVE")
    docs = spark.read.parquet(f"{base}/docs").groupBy("bucket_key").agg(F.count(F.lit(1)).alias("n_docs"))
    log = R.checkpoint_latest(spark.read.parquet(f"{base}/log")).select("bucket_key", F.col("status").alias("logged"))
    out = res.select("bucket_key", "status", "indexed", "errors").join(docs, "bucket_key", "left").join(log, "bucket_key")
    return out.fillna(0, ["n_docs"])


@register("ingest_crash_resume", W() + """
SELECT step, index_name AS splunk_index, count(*) AS n_docs, count(*) AS n_ids
FROM corpus, (SELECT unnest(['written', 'committed', 'placed']) AS step) GROUP BY ALL""")
def q_ingest_crash_resume(spark, sf):
    """An ingest broken off after the write, the commit or the move: the next call leaves every document once."""
    from thawline.plans import ingest as I
    root = journal_root(spark, sf)
    out = None
    for step in ("written", "committed", "placed"):
        base = SK.new_run_path(spark, "thawline-ingest")

        def stop(name, step=step):
            if name == step:
                raise InterruptedError(step)

        I.ingest(spark, root, f"{base}/docs", "1.0", checkpoint_log_path=f"{base}/log", indices=["apache"])
        keep, I._step = I._step, stop
        try:
            I.ingest(spark, root, f"{base}/docs", "1.0", checkpoint_log_path=f"{base}/log")
        except InterruptedError:
            pass
        finally:
            I._step = keep
        I.ingest(spark, root, f"{base}/docs", "1.0", checkpoint_log_path=f"{base}/log")
        got = spark.read.parquet(f"{base}/docs").groupBy("splunk_index").agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("doc_id").alias("n_ids"))
        got = got.select(F.lit(step).alias("step"), "splunk_index", "n_docs", "n_ids")
        out = got if out is None else out.union(got)
    return out


@register("dedupe_against_target", W() + """
SELECT index_name AS splunk_index, count(*) AS n_docs, count(*) AS n_ids FROM corpus GROUP BY index_name""")
def q_dedupe_against_target(spark, sf):
    """A second delivery holds every document twice, half of which are stored already; only new ones are added."""
    docs = ingest_docs(journal_events(spark, sf))
    path = SK.new_run_path(spark, "thawline-target")
    SK.write_docs(docs.where(F.col("event_ordinal") % 2 == 0), path, "first")
    stored = spark.read.parquet(path)
    SK.write_docs(R.new_docs(docs.unionByName(docs), stored), path, "second")
    return spark.read.parquet(path).groupBy("splunk_index").agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("doc_id").alias("n_ids"))


@register("dedupe_by_bucket", W(ORD_SQL) + f"""
SELECT {JOURNAL_ID_SQL} AS doc_id, index_name AS splunk_index, CASE WHEN event_ordinal % 2 = 0 THEN 'first' ELSE 'second' END AS ingest_run
FROM ord WHERE event_ordinal % 2 = 0 OR index_name IN ('apache', 'syslog')""")
def q_dedupe_by_bucket(spark, sf):
    """Two indices are delivered again, every document twice; only their partitions and buckets of the target are asked."""
    again = ["apache", "syslog"]
    docs = ingest_docs(journal_events(spark, sf))
    path = SK.new_run_path(spark, "thawline-target")
    SK.write_docs(docs.where(F.col("event_ordinal") % 2 == 0), path, "first")
    some = docs.where(F.col("splunk_index").isin(again))
    listing = list_buckets(spark, journal_root(spark, sf), again)
    fresh = R.new_docs(some.unionByName(some), spark.read.parquet(path), buckets=R.bucket_refs(listing), indices=again)
    SK.write_docs(fresh, path, "second")
    return spark.read.parquet(path).select("doc_id", "splunk_index", "ingest_run")


@register("metadata_error_summary", W() + """
SELECT index_name, 'decode_field: IndexError' AS error_key, count(*) AS n_errors, count(*) AS n_events
FROM corpus WHERE event_id % 23 = 0 GROUP BY index_name""")
def q_metadata_error_summary(spark, sf):
    """Metadata decode errors by index and ``context: error type``."""
    return R.error_summary(journal_events(spark, sf, skipMetadata="false"))


@register("profile_merge", W(CLS) + """
SELECT kind, CAST(sum(n) AS BIGINT) AS n_events, count(*) AS n_buckets FROM (
  SELECT index_name, bucket_name, kind, count(*) AS n FROM classified GROUP BY ALL) GROUP BY kind""")
def q_profile_merge(spark, sf):
    """A2: per-bucket profiles merged by counter addition (and the buckets each kind was seen in)."""
    per_bucket = PR.profile_by_kind(B.classified(spark, sf), by=("index_name", "bucket_name", "kind"))
    return per_bucket.groupBy("kind").agg(F.sum("n_events").alias("n_events"), F.count(F.lit(1)).alias("n_buckets"))


@register("parse_errors_corrupt", W() + """
SELECT index_name AS splunk_index, count(DISTINCT bucket_name) FILTER (WHERE bucket_seq % 7 = 0) AS n_error_docs
FROM corpus GROUP BY index_name""")
def q_parse_errors_corrupt(spark, sf):
    """Documents of a PERMISSIVE ingest over the partly corrupt tree: one error document
    (``error_message`` = decode fault) per bad journal."""
    from thawline.plans.ingest import documents
    root = corrupt_copy(spark, journal_root(spark, sf))
    d = documents(JS.read(spark, root, mode="PERMISSIVE"))
    return d.groupBy("splunk_index").agg(F.count("error_message").alias("n_error_docs"))


@register("bucket_listing_sorted", W(TB) + """
SELECT bucket_key, row_number() OVER (ORDER BY index_name, bucket_name) - 1 AS position FROM listing""")
def q_bucket_listing_sorted(spark, sf):
    """O1: buckets sorted by index then bucket name, with their global position (range-partitioned
    ranking; no single-task window)."""
    lst = list_buckets(spark, journal_root(spark, sf)).select("bucket_key", "index_name", "bucket_name")
    return ordinal_within(lst, [], ["index_name", "bucket_name"], "position").select("bucket_key", "position")


@register("ingest_flagship", INGEST_SUMMARY_SQL)
def q_ingest_flagship(spark, sf):
    """Flagship: frozen buckets -> frozen_journal scan -> decode -> classify -> parse -> summary."""
    from thawline.plans.ingest import parsed_events
    return _summary(parsed_events(journal_events(spark, sf)))


@register("kinds_by_count", W(CLS) + """
SELECT index_name, string_agg(kind, ',' ORDER BY n DESC, kind) AS kinds_ranked FROM (
  SELECT index_name, kind, count(*) AS n FROM classified GROUP BY ALL) GROUP BY index_name""")
def q_kinds_by_count(spark, sf):
    """O2: per index, the kinds ordered by event count (ties by name), as the scan report lists them."""
    k = PR.profile_by_kind(B.classified(spark, sf), by=("index_name", "kind"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n_events")).alias("o"), F.col("kind"))))
    return k.groupBy("index_name").agg(F.array_join(F.transform(ranked, lambda x: x["kind"]), ",").alias(
        "kinds_ranked"))
