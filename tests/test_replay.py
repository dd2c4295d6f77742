"""Op-log replay: strings carried forward by ordered scans equal a row-by-row replay, also where one bucket is hot."""

import random

from pyspark.sql import functions as F

from thawline.operators import replay as RP
from thawline.operators.scan import _sliced
from thawline.plans.registry import QUERIES
from thawline.sources import journal_codec as J

SF = "/root/testdata/sf0.001"
SCHEMA = ("index_name STRING, bucket_name STRING, ord BIGINT, opcode INT, text STRING, state_host BIGINT, state_source BIGINT, "
          "state_sourcetype BIGINT, base_event_time INT, base_index_time INT, index_time_diff BIGINT, time_sub_raw BIGINT, "
          "message BINARY, meta ARRAY<STRUCT<key: BIGINT, value: BIGINT>>")
CODES = (J.NEW_HOST, J.NEW_SOURCE, J.NEW_SOURCETYPE, J.NEW_STRING)


def log(bucket, n, rng):
    """Random ops of one journal: strings come early, late, never; ids repeat; metadata pairs are partly out of range."""
    rows = []
    for o in range(n):
        kind = rng.random()
        row = dict.fromkeys([c.split()[0] for c in SCHEMA.split(", ")[:13]])
        row.update(index_name="i", bucket_name=bucket, ord=o, meta=None)
        if kind < 0.04:
            row.update(opcode=rng.choice(CODES), text=rng.choice(["", f"s{o}", "again"]))
        elif kind < 0.12:
            row.update(opcode=17)
            for c in RP.STATE[:3]:
                row[c] = rng.choice([None, 0, 1, 1, 1, 2, rng.randrange(40)])
            row["base_event_time"] = rng.choice([None, o])
        else:
            row.update(opcode=J.EVENT, index_time_diff=o, time_sub_raw=2 * o, message=bytes([o % 251]),
                       meta=[(rng.choice([1, 1, 2, 60]), rng.choice([0, 1, 2, 3])) for _ in range(rng.choice([0, 0, 1, 5]))])
        rows.append(tuple(row.values()))
    return rows


def replayed(rows):
    out, dicts, state, at, n = {}, {c: [] for c in CODES}, [0, 0, 0], 0, 0
    for r in rows:
        o, op, text, ids, base, meta = r[2], r[3], r[4], r[5:8], r[8], r[13]
        if op in CODES:
            dicts[op].append(text)
        elif op == 17:
            state = [s if i is None else i for s, i in zip(state, ids)]
            at = at if base is None else base
        else:
            def look(code, i):
                return dicts[code][i - 1] if 1 <= i <= len(dicts[code]) else None

            strings = tuple("" if i == 0 else look(c, i) for c, i in zip(CODES, state))
            fields, errors = {}, []
            for k, v in meta:
                key, value = look(J.NEW_STRING, k), look(J.NEW_STRING, v)
                if key is None or value is None:
                    errors.append(f"key={k}, value={v}: id out of range")
                else:
                    fields.setdefault(key, []).append(value)
            out[r[1], o] = (n, *strings, at * 1000 + o, fields or None, errors or None)
            n += 1
    return out


def test_replay_equals_a_row_by_row_replay(spark):
    rng = random.Random(7)
    logs = [log("hot", 3000, rng), log("small", 40, rng), log("tiny", 1, rng)]
    ops = spark.createDataFrame([r for x in logs for r in x], SCHEMA)
    want = {}
    for x in logs:
        want.update(replayed(x))
    ev = RP.replay_events(ops)
    meta = RP.metadata_fields(ops).select("bucket_key", "ord", "fields", "extraction_errors")
    got = ev.join(meta, ["bucket_key", "ord"], "left").collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.event_ordinal, r.host, r.source, r.sourcetype, r.event_time_ms, r.fields, r.extraction_errors) == want[r.bucket_name, r.ord]
    assert any(v[1] is None for v in want.values()) and any(v[6] for v in want.values()) and any(v[5] for v in want.values())


def test_replay_of_nothing(spark):
    ops = spark.createDataFrame([], SCHEMA)
    assert RP.replay_events(ops).count() == 0 and RP.metadata_fields(ops).count() == 0


def test_replay_joins_no_dictionary(spark):
    """The only joins carry the state of earlier slices, on (slice, group): one side has a row per slice and group."""
    plan = QUERIES["journal_replay"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join " in x]
    assert joins and all("_pid" in x for x in joins), joins


def test_a_hot_id_is_dealt_over_tasks(spark):
    """Every event asks for the same two strings of one bucket; no task holds most of the lookups."""
    n = 20_000
    refs = spark.range(n).select(F.lit("i/b").alias("bucket_key"), F.lit(J.NEW_STRING).alias("opcode"), F.lit(1).cast("bigint").alias("idx"),
                                 (F.col("id") + 1).alias("ord"))
    d = spark.createDataFrame([("i/b", J.NEW_STRING, 1, 0, "x")], "bucket_key STRING, opcode INT, idx BIGINT, def_ord BIGINT, text STRING")
    assert RP.resolve_ids(refs, d, []).where("text = 'x'").count() == n
    slices = _sliced(refs, ["bucket_key", "opcode", "idx"], ["ord"], 16)  # how the lookup deals its rows
    sizes = [r["count"] for r in slices.groupBy("_pid").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 4 * sorted(sizes)[len(sizes) // 2], sizes
