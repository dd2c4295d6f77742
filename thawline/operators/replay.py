"""Relational replay of the journal op log.

The source can replay the decoder state machine itself; these operators do
the same from the ``emit=ops`` table with joins and ordered scans, which makes
the stateful decode checkable and lets a stored op log be re-resolved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thawline.operators.scan import scan_within
from thawline.sources import journal_codec as J

STATE = ["state_host", "state_source", "state_sourcetype", "base_event_time", "base_index_time"]


def is_event(op: Column) -> Column:
    return op.isin(J.EVENT, J.EVENT_HASH) | op.between(32, 43)


def opcode_flags(op: Column) -> dict[str, Column]:
    """Event and state flag bits."""
    return {
        "has_extended_storage": op.bitwiseAND(4) != 0,
        "has_hash": op.bitwiseAND(1) == 0,
        "include_punctuation": op.bitwiseAND(0x22) == 34,
        "sets_host": op.between(17, 31) & (op.bitwiseAND(8) != 0),
        "sets_source": op.between(17, 31) & (op.bitwiseAND(4) != 0),
        "sets_sourcetype": op.between(17, 31) & (op.bitwiseAND(2) != 0),
        "sets_base_time": op.between(17, 31) & (op.bitwiseAND(1) != 0),
    }


def with_key(ops: DataFrame) -> DataFrame:
    return ops.withColumn("bucket_key", F.concat_ws("/", "index_name", "bucket_name"))


DICT_OPS = {J.NEW_HOST: "_n_host", J.NEW_SOURCE: "_n_source", J.NEW_SOURCETYPE: "_n_sourcetype",
            J.NEW_STRING: "_n_string"}


def scanned(ops: DataFrame, keep_raw: bool = False) -> DataFrame:
    """W1 + W2 + W3 in one skew-safe ordered pass over each journal: decoder state carried forward
    (start value 0) and running counts of events and of each dictionary's strings.

    ``keep_raw`` adds the ids that a row sets itself, as ``raw_state_host`` and so on."""
    op = F.col("opcode")
    counts = {"_n_event": is_event(op)}
    counts.update({name: op == code for code, name in DICT_OPS.items()})
    keyed = with_key(ops)
    if keep_raw:
        keyed = keyed.withColumns({f"raw_{c}": F.col(c) for c in STATE[:3]})
    s = scan_within(keyed, ["bucket_key"], ["ord"], ffill=STATE, counts=counts)
    return s.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in STATE})


def dictionary(ops: DataFrame, sc: DataFrame | None = None) -> DataFrame:
    """1-based index of each string within its (journal, dictionary opcode)."""
    sc = scanned(ops) if sc is None else sc
    idx = None
    for code, name in DICT_OPS.items():
        idx = F.when(F.col("opcode") == code, F.col(name)) if idx is None else idx.when(F.col("opcode") == code,
                                                                                          F.col(name))
    d = sc.where(F.col("opcode").isin(*DICT_OPS))
    return d.select("bucket_key", "opcode", idx.alias("idx"), F.col("ord").alias("def_ord"), "text")


def fill_state(ops: DataFrame, sc: DataFrame | None = None) -> DataFrame:
    """W1 (+W3): every op with the active ids / base times; events carry ``event_ordinal``."""
    sc = scanned(ops) if sc is None else sc
    return sc.withColumn("event_ordinal", F.when(is_event(F.col("opcode")), F.col("_n_event") - 1))


def rebase_times(base_index: Column, diff: Column, base_event: Column, sub_raw: Column) -> dict[str, Column]:
    """Index time = base + diff (s); event time = base*1000 + (sub >> 1) (ms, low bit dropped)."""
    return {"index_time": base_index.cast("bigint") + diff,
            "event_time_ms": base_event.cast("bigint") * 1000 + F.shiftright(sub_raw, 1)}


ID_OPS = (("state_host", J.NEW_HOST, "host"), ("state_source", J.NEW_SOURCE, "source"),
          ("state_sourcetype", J.NEW_SOURCETYPE, "sourcetype"))


def resolve_ids(refs: DataFrame, d: DataFrame, order: list[str]) -> DataFrame:
    """As-of lookup (bucket_key, opcode, idx, ord) -> ``text`` of the string defined before ``ord``, else NULL.

    References and definitions are sorted together by (bucket, dictionary, id, ord) and the text is
    filled forward, so an id that most references of a bucket name is split over many tasks, which an
    equi-join on (bucket, id) does not do.  ``order`` tells references of one ``ord`` apart.
    """
    rows = refs.withColumn("_def", F.lit(False)).unionByName(
        d.select("bucket_key", "opcode", "idx", F.col("def_ord").alias("ord"), "text", F.lit(True).alias("_def")),
        allowMissingColumns=True)
    rows = rows.withColumn("idx", F.coalesce("idx", F.lit(-1)))  # a missing id names no string
    filled = scan_within(rows, ["bucket_key", "opcode", "idx"], ["ord", *order], ffill=["text"])
    return filled.where(~F.col("_def")).drop("_def")


def string_changes(ops: DataFrame) -> DataFrame:
    """(bucket_key, ord, host, source, sourcetype): each op that changes an active string.

    The string is wrapped in a struct; a null struct keeps the string, a struct of NULL says that the
    active id names nothing yet.  Only state and dictionary ops take part, no event does: a state op
    asks for the string of its id as of its place, and a definition counts at once where its id is active.
    """
    sc = scanned(ops.select("index_name", "bucket_name", "ord", "opcode", "text", *STATE).where(~is_event(F.col("opcode"))), keep_raw=True)
    d = dictionary(ops, sc)
    asked = sc.select("bucket_key", "ord", F.explode(F.array(*[
        F.struct(F.lit(code).alias("opcode"), F.col(f"raw_{c}").cast("bigint").alias("idx")) for c, code, _ in ID_OPS])).alias("a"))
    asked = asked.select("bucket_key", "ord", "a.*").where(F.col("idx").isNotNull())
    told = resolve_ids(asked, d, []).withColumn("text", F.when(F.col("idx") == 0, F.lit("")).otherwise(F.col("text")))
    late = None
    for c, code, _ in ID_OPS:
        hit = (F.col("opcode") == code) & (F.col(c) == F.col(DICT_OPS[code]))
        late = hit if late is None else late | hit
    told = told.select("bucket_key", "ord", "opcode", "text").unionByName(sc.where(late).select("bucket_key", "ord", "opcode", "text"))
    return told.select("bucket_key", "ord", *[F.when(F.col("opcode") == code, F.struct("text")).alias(out) for _, code, out in ID_OPS])


def event_times(ops: DataFrame) -> DataFrame:
    """W1 + W3 + P7: event ordinals and times; no dictionary and no message takes part in the scan."""
    keep = ["index_name", "bucket_name", "ord", "opcode", *STATE, "index_time_diff", "time_sub_raw"]
    s = fill_state(ops.select(*keep)).where(is_event(F.col("opcode")))
    return s.withColumns(rebase_times(F.col("base_index_time"), F.col("index_time_diff"), F.col("base_event_time"),
                                      F.col("time_sub_raw")))


def replay_events(ops: DataFrame) -> DataFrame:
    """W1 + W2 + W3 + J3 + P7: events of the op log with resolved metadata strings and rebased times.

    The strings that become active (``string_changes``) are merged into the op log and carried forward
    by the same ordered scan as ids and times: messages are moved once, and no event is joined to a
    dictionary.
    """
    rows = with_key(ops).unionByName(string_changes(ops), allowMissingColumns=True)
    strings = [out for _, _, out in ID_OPS]
    s = scan_within(rows, ["bucket_key"], ["ord"], ffill=[*STATE, *strings], counts={"_n_event": is_event(F.col("opcode"))})
    s = s.where(is_event(F.col("opcode"))).withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in STATE})
    # before the first state op every id is 0, whose string is empty
    s = s.withColumns({c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.col(c)["text"]) for c in strings})
    s = s.withColumn("event_ordinal", F.col("_n_event") - 1)
    return s.withColumns(rebase_times(F.col("base_index_time"), F.col("index_time_diff"), F.col("base_event_time"),
                                      F.col("time_sub_raw")))


def metadata_fields(ops: DataFrame, sc: DataFrame | None = None) -> DataFrame:
    """J4 + A9: (key id, value id) pairs -> ``MAP<key, ARRAY<value>>`` in journal order, plus errors.

    (bucket_key, ord, fields, extraction_errors), one row per event that has pairs; either column is
    NULL where it would be empty.
    """
    ev = with_key(ops).where(is_event(F.col("opcode")) & (F.size("meta") > 0))
    pairs = ev.select("bucket_key", "ord", F.posexplode("meta").alias("pos", "kv"))
    asked = pairs.select("bucket_key", "ord", "pos", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("kv.key").cast("bigint").alias("idx")),
        F.struct(F.lit(1).alias("side"), F.col("kv.value").cast("bigint").alias("idx")))).alias("a"))
    asked = asked.select("bucket_key", "ord", "pos", "a.*").withColumn("opcode", F.lit(J.NEW_STRING))
    d = dictionary(ops, sc).where(F.col("opcode") == J.NEW_STRING)
    told = resolve_ids(asked, d, ["pos", "side"])
    p = told.groupBy("bucket_key", "ord").agg(F.sort_array(F.collect_list(F.struct("pos", "side", "idx", "text"))).alias("p"))

    def side(n):
        return F.filter("p", lambda x: x["side"] == n)

    p = p.select("bucket_key", "ord", F.zip_with(side(0), side(1), lambda k, v: F.struct(
        k["idx"].alias("k"), v["idx"].alias("v"), k["text"].alias("key"), v["text"].alias("value"))).alias("p"))
    p = p.withColumns({"good": F.filter("p", lambda x: x["key"].isNotNull() & x["value"].isNotNull()),
                       "bad": F.filter("p", lambda x: x["key"].isNull() | x["value"].isNull())})
    keys = F.array_distinct(F.col("good")["key"])
    fields = F.map_from_entries(F.transform(keys, lambda k: F.struct(
        k, F.transform(F.filter("good", lambda x: x["key"] == k), lambda x: x["value"]))))
    errors = F.transform("bad", lambda x: F.format_string("key=%d, value=%d: id out of range", x["k"], x["v"]))
    return p.select("bucket_key", "ord", F.when(F.size("good") > 0, fields).alias("fields"),
                    F.when(F.size("bad") > 0, errors).alias("extraction_errors"))
