"""Compare column types of every registered Spark query with its DuckDB twin."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tests.harness import duck  # noqa: E402

MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
       "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def main():
    import __spark_entry__ as E
    from thawline.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
    spark = local_session()
    con = duck(sf)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for k in sorted(sq):
        sdf = qs[k](spark, sf)
        st = {f.name: MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
        rel = con.sql(sq[k])
        dt = {n: str(t) for n, t in zip(rel.columns, rel.types)}
        diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
        if diff:
            bad += 1
            print("TYPES", k, diff, flush=True)
    print("type mismatches in", bad, "of", len(sq))


if __name__ == "__main__":
    main()
