"""Column -> Column text helpers (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thawline.functions import patterns as P



def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_prefix(c: Column | str) -> Column:
    """Drop one leading ``host::`` / ``source::`` / ``sourcetype::`` (case-sensitive), without a regex."""
    c = col(c)
    out = None
    for p in P.PREFIXES:
        cond = F.startswith(c, F.lit(p))
        cut = F.substring(c, len(p) + 1, 1 << 30)
        out = F.when(cond, cut) if out is None else out.when(cond, cut)
    return out.otherwise(c)


# Python's str.isspace() characters (what str.strip() removes); Spark's trim() strips spaces only.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                 "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: whitespace at both ends, no regex."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def decode_text(b: Column | str) -> Column:
    """UTF-8 when the bytes are valid UTF-8 (the bytes are reinterpreted, not re-decoded), else the
    whole value as Latin-1."""
    b = col(b)
    s = b.cast("string")
    return F.when(F.is_valid_utf8(s), s).otherwise(F.decode(b, "ISO-8859-1"))


def decode_text_fast(b: Column | str, index_name: Column | str, latin1_indices=P.LATIN1_INDICES) -> Column:
    """Latin-1 fast path for the plain-text indices, else ``decode_text``."""
    return F.when(col(index_name).isin(list(latin1_indices)), F.decode(col(b), "ISO-8859-1")).otherwise(
        decode_text(b))


# Characters Python's str.isprintable() rejects: Unicode "Other" and "Separator" categories, except space.
_NONPRINT = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def _escape_nonprintable(s: Column) -> Column:
    """``\\xhh`` / ``\\uhhhh`` / ``\\Uhhhhhhhh`` for non-printable characters; strings without
    any (the usual case) skip the per-character path."""
    def one(ch: Column) -> Column:
        code = F.ascii(ch)
        hx = F.lower(F.hex(code))
        esc = (F.when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(hx, 2, "0")))
               .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(hx, 4, "0")))
               .otherwise(F.concat(F.lit("\\U"), F.lpad(hx, 8, "0"))))
        return F.when(ch.rlike(_NONPRINT), esc).otherwise(ch)

    return F.when(s.rlike(_NONPRINT), F.array_join(F.transform(F.split(s, ""), one), "")).otherwise(s)


def py_repr(c: Column | str) -> Column:
    """Python ``repr()`` of a string: single quotes unless it holds ``'`` and no ``"``; backslash,
    ``\\n \\r \\t`` and non-printable characters escaped as Python does."""
    c = col(c)
    esc = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    esc = F.replace(esc, F.lit("\n"), F.lit("\\n"))
    esc = F.replace(esc, F.lit("\r"), F.lit("\\r"))
    esc = F.replace(esc, F.lit("\t"), F.lit("\\t"))
    esc = _escape_nonprintable(esc)
    dq = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    return F.when(dq, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))


def iso_utc(ms: Column | str) -> Column:
    """Epoch milliseconds -> ISO-8601 with ``+00:00``; the fraction is omitted when zero.

    Needs the session zone to be UTC (see ``session.ensure_utc``).
    """
    ms = col(ms)
    ts = F.timestamp_millis(ms)
    return F.when(F.pmod(ms, F.lit(1000)) == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
