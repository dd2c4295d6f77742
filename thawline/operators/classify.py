"""Event classification (kind, dataset, parser name, reason) as column expressions.

Rule order (first match wins):
  1-4  sourcetype: access, syslog, CloudTrail, VPC flow
  5-6  source path: access, syslog
  7-10 stripped message: access line, RFC3164 syslog, CloudTrail JSON, VPC flow line
  0    generic fallback
The rule code is computed once per row in its own projection; kind and reason
are cheap lookups on it, so Catalyst keeps the regexes evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thawline.functions import patterns as P
from thawline.functions.text import col, py_repr, strip_prefix, strip_ws

PARSER_PREFIX = "thaw-parse-"
ROUTER_PREFIX = "thaw-pipeline"
TARGET_PREFIX = "thaw-"


def sourcetype_kind(st_l: Column) -> Column:
    """F2 (+F7/F8 sourcetype half): kind from the lower-cased stripped sourcetype, else NULL."""
    ne = st_l != ""
    return (F.when(ne & st_l.rlike(P.java(P.ACCESS_SOURCETYPE)), F.lit(P.ACCESS_LOG))
            .when(ne & st_l.rlike(P.java(P.SYSLOG_SOURCETYPE)), F.lit(P.SYSLOG))
            .when(ne & st_l.rlike(P.java(P.CLOUD_TRAIL_SOURCETYPE)), F.lit(P.CLOUD_TRAIL))
            .when(ne & st_l.rlike(P.java(P.VPC_FLOW_SOURCETYPE)), F.lit(P.VPC_FLOW)))


def source_kind(src_l: Column) -> Column:
    """kind from the lower-cased stripped source path, else NULL."""
    ne = src_l != ""
    return (F.when(ne & src_l.rlike(P.java(P.ACCESS_SOURCE)), F.lit(P.ACCESS_LOG))
            .when(ne & src_l.rlike(P.java(P.SYSLOG_SOURCE)), F.lit(P.SYSLOG)))


def is_cloud_trail_json(msg_s: Column) -> Column:
    """a JSON object with ``eventVersion`` (parse only lines that start with ``{``)."""
    return F.when(
        F.startswith(msg_s, F.lit("{")),
        F.try_variant_get(F.try_parse_json(msg_s), "$.eventVersion", "string").isNotNull(),
    ).otherwise(F.lit(False))


def message_kind(msg_s: Column) -> Column:
    """F4 (+F7/F8 message half): kind from the stripped message, else NULL."""
    return (F.when(msg_s.rlike(P.java_py_ci(P.ACCESS_MESSAGE)), F.lit(P.ACCESS_LOG))
            .when(msg_s.rlike(P.java_py(P.SYSLOG_MESSAGE)), F.lit(P.SYSLOG))
            .when(is_cloud_trail_json(msg_s), F.lit(P.CLOUD_TRAIL))
            .when(msg_s.rlike(P.java(P.VPC_MESSAGE)), F.lit(P.VPC_FLOW)))


def rule_code(st_l: Column, src_l: Column, msg_s: Column) -> Column:
    ne_st, ne_src = st_l != "", src_l != ""
    return (F.when(ne_st & st_l.rlike(P.java(P.ACCESS_SOURCETYPE)), 1)
            .when(ne_st & st_l.rlike(P.java(P.SYSLOG_SOURCETYPE)), 2)
            .when(ne_st & st_l.rlike(P.java(P.CLOUD_TRAIL_SOURCETYPE)), 3)
            .when(ne_st & st_l.rlike(P.java(P.VPC_FLOW_SOURCETYPE)), 4)
            .when(ne_src & src_l.rlike(P.java(P.ACCESS_SOURCE)), 5)
            .when(ne_src & src_l.rlike(P.java(P.SYSLOG_SOURCE)), 6)
            .when(msg_s.rlike(P.java_py_ci(P.ACCESS_MESSAGE)), 7)
            .when(msg_s.rlike(P.java_py(P.SYSLOG_MESSAGE)), 8)
            .when(is_cloud_trail_json(msg_s), 9)
            .when(msg_s.rlike(P.java(P.VPC_MESSAGE)), 10)
            .otherwise(0))


def kind_of_rule(rule: Column) -> Column:
    return (F.when(rule.isin(1, 5, 7), F.lit(P.ACCESS_LOG)).when(rule.isin(2, 6, 8), F.lit(P.SYSLOG))
            .when(rule.isin(3, 9), F.lit(P.CLOUD_TRAIL)).when(rule.isin(4, 10), F.lit(P.VPC_FLOW))
            .otherwise(F.lit(P.GENERIC)))


def reason_of_rule(rule: Column, st_l: Column, src_l: Column) -> Column:
    """why the kind was chosen (Python-repr quoting of the matched value)."""
    return (F.when(rule.between(1, 4), F.concat(F.lit("sourcetype="), py_repr(st_l)))
            .when(rule.isin(5, 6), F.concat(F.lit("source="), py_repr(src_l)))
            .when(rule == 7, F.lit(P.REASON_ACCESS_MESSAGE))
            .when(rule == 8, F.lit(P.REASON_SYSLOG_MESSAGE))
            .when(rule == 9, F.lit(P.REASON_CLOUD_TRAIL_MESSAGE))
            .when(rule == 10, F.lit(P.REASON_VPC_FLOW_MESSAGE))
            .otherwise(F.lit(P.REASON_FALLBACK)))


def dataset_of(kind: Column, index_name: Column) -> Column:
    """``{index}.{kind}``, or the bare kind without an index."""
    return F.when(F.coalesce(index_name, F.lit("")) != "", F.concat(index_name, F.lit("."), kind)).otherwise(kind)


def parser_name(kind: Column) -> Column:
    """P10: parser pipeline name of a kind."""
    return F.concat(F.lit(PARSER_PREFIX), F.replace(kind, F.lit("_"), F.lit("-")))


def router_name(index_name: Column) -> Column:
    """P10: router name of an index, or the bare router name."""
    return F.when(F.coalesce(index_name, F.lit("")) != "",
                  F.concat(F.lit(ROUTER_PREFIX + "-"), index_name)).otherwise(F.lit(ROUTER_PREFIX))


def classify(df: DataFrame, sourcetype="sourcetype", source="source", message="message",
             index_name="index_name", keep_inputs: bool = False) -> DataFrame:
    """add ``kind``, ``dataset``, ``pipeline``, ``reason`` (plus ``st_l/src_l/msg_s`` if asked)."""
    st_l = F.lower(strip_prefix(col(sourcetype)))
    src_l = F.lower(strip_prefix(col(source)))
    msg_s = strip_ws(col(message))
    staged = df.withColumns({"_st_l": st_l, "_src_l": src_l, "_msg_s": msg_s})
    staged = staged.withColumn("_rule", rule_code(F.col("_st_l"), F.col("_src_l"), F.col("_msg_s")))
    kind = kind_of_rule(F.col("_rule"))
    out = staged.withColumns({
        "kind": kind,
        "reason": reason_of_rule(F.col("_rule"), F.col("_st_l"), F.col("_src_l")),
    }).withColumns({
        "dataset": dataset_of(F.col("kind"), col(index_name)),
        "pipeline": parser_name(F.col("kind")),
    })
    drop = ["_rule"] + ([] if keep_inputs else ["_st_l", "_src_l", "_msg_s"])
    return out.drop(*drop)


def router_default_kind(kind: Column, sourcetype: Column) -> Column:
    """kind used by the router on re-parse when the stored kind is NULL (sourcetype only)."""
    st = F.coalesce(sourcetype, F.lit(""))
    return F.coalesce(
        kind,
        F.when(sourcetype.isNotNull() & st.rlike(P.java_ci(P.ROUTER_ACCESS_SOURCETYPE)), F.lit(P.ACCESS_LOG))
        .when(sourcetype.isNotNull() & st.rlike(P.java_ci(P.ROUTER_SYSLOG_SOURCETYPE)), F.lit(P.SYSLOG))
        .otherwise(F.lit(P.GENERIC)))
