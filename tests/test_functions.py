"""Column helpers reproduce the Python semantics of the archive tool."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from thawline.functions.text import decode_text, iso_utc, py_repr, strip_prefix, strip_ws

STRINGS = ["plain", "it's", 'say "hi"', "both ' and \"", "back\\slash", "tab\there", "nl\nx", "  pad  ",
           "\xa0nbsp　", "\x1cfs\x1f", "", "Grüße", "zw\u200bsp", "bell\x07", "ls\u2028x", "emoji\U0001f600", "host::a", "sourcetype::host::b", "HOST::c"]


def test_py_repr_matches_python(spark):
    rows = spark.createDataFrame([(s,) for s in STRINGS], "s string").select("s", py_repr(F.col("s")).alias("r"))
    for r in rows.collect():
        assert r.r == repr(r.s), r.s


def test_strip_ws_matches_str_strip(spark):
    rows = spark.createDataFrame([(s,) for s in STRINGS], "s string").select("s", strip_ws(F.col("s")).alias("r"))
    for r in rows.collect():
        assert r.r == r.s.strip(), repr(r.s)


def test_strip_prefix_once(spark):
    def ref(v):
        for p in ("host::", "source::", "sourcetype::"):
            if v.startswith(p):
                return v[len(p):]
        return v
    rows = spark.createDataFrame([(s,) for s in STRINGS], "s string").select("s", strip_prefix("s").alias("r"))
    for r in rows.collect():
        assert r.r == ref(r.s)


def test_iso_utc_matches_isoformat(spark):
    ms = [0, 1704067207179, 1704067207000, 1709208000001, 951782400000]
    rows = spark.createDataFrame([(m,) for m in ms], "m bigint").select("m", iso_utc("m").alias("r")).collect()
    for r in rows:
        assert r.r == datetime.fromtimestamp(r.m / 1000.0, tz=timezone.utc).isoformat()


def test_decode_text_utf8_then_latin1(spark):
    vals = ["Grüße".encode("utf-8"), "Grüße".encode("latin-1"), b"ascii", b"\xe9t\xe9", b"",
            b"\xed\xa0\x80", b"\xc0\xaf", b"\xe2\x82", b"\xf4\x90\x80\x80", b"\xf0\x9f\x98\x80", b"\x00nul",
            b"\xef\xbb\xbfbom"]
    rows = spark.createDataFrame([(v,) for v in vals], "b binary").select("b", decode_text("b").alias("t")).collect()
    for r in rows:
        b = bytes(r.b)
        try:
            exp = b.decode("utf-8")
        except UnicodeDecodeError:
            exp = b.decode("latin-1")
        assert r.t == exp
