"""Driver contract: every oracle has a query, and column names and types agree with the DuckDB twin."""

from thawline.plans import registry
from tests.harness import duck
from tests.types_check import MAP

SF = "/root/testdata/sf0.001"


def test_schemas_match_oracles(spark):
    con = duck(SF)
    qs, sq = registry.QUERIES, registry.SQL
    assert set(sq) <= set(qs) and len(sq) == len(qs)
    bad = {}
    for k, sql in sq.items():
        st = {f.name: MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in qs[k](spark, SF).schema.fields}
        rel = con.sql(sql)
        dt = {n: str(t) for n, t in zip(rel.columns, rel.types)}
        if st != dt:
            bad[k] = (st, dt)
    assert not bad, bad
