"""Cross-entropy difference against its DuckDB twin on awkward rows."""

import duckdb

from tests.llm.cases import docs, empty
from thawline.llm import op5_lm as M


def compare(spark, df, labels):
    con = duckdb.connect()
    con.register("d", df.select("doc_id", "text").toPandas())
    con.register("l", labels.toPandas())
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM d")
    con.execute("CREATE VIEW labels AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(quality AS INT) AS quality FROM l")
    cols = ["doc_id", "n_tokens", "h_target", "h_background", "score"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({M.cross_entropy_sql(40)})").fetchall()
    got = M.rounded(M.cross_entropy_difference(df, labels.where("quality = 1"), vocabulary=40)).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_equals_twin(spark):
    df, rows = docs(spark)
    labels = spark.createDataFrame([(d, i % 2) for i, (d, _) in enumerate(rows)] + [(rows[1][0], 1), (None, 1), (77777, 1)], "doc_id bigint, quality int")
    compare(spark, df, labels)


def test_every_word_is_told_apart(spark):
    """Rare words decide: their documents score apart, and as the twin without a bound says."""
    df, rows = docs(spark)
    target = spark.createDataFrame([(d,) for i, (d, _) in enumerate(rows) if i % 2], "doc_id bigint")
    con = duckdb.connect()
    con.register("d", df.select("doc_id", "text").toPandas())
    con.register("l", target.toPandas())
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM d")
    con.execute("CREATE VIEW labels AS SELECT CAST(doc_id AS BIGINT) AS doc_id, 1 AS quality FROM l")
    cols = ["doc_id", "n_tokens", "h_target", "h_background", "score"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({M.cross_entropy_sql()})").fetchall()
    got = M.rounded(M.cross_entropy_difference(df, target, vocabulary=None)).select(*cols).collect()
    key = lambda r: (str(r[0]), r[1], str(r[2]))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:2] == w[:2] and all((x is None) == (y is None) and (x is None or abs(x - y) < 2e-6) for x, y in zip(g[2:], w[2:]))

    # chunks of a few rows and many ranges of keys give the same
    assert got and all(r.score is None for r in M.cross_entropy_difference(docs(spark, [(1, None), (None, "")])[0], target).collect())
    spread = M.rounded(M.cross_entropy_difference(df.repartition(3), target, vocabulary=None, chunk_bytes=300, part_bytes=2000)).select(*cols).collect()
    assert sorted(map(tuple, spread), key=key) == sorted(map(tuple, got), key=key)

    common = " ".join(f"word{i}" for i in range(1600))
    rows = [(i, common) for i in range(4)] + [(10, "zebra okapi"), (11, "zebra okapi"), (12, "lathe chuck"), (13, "lathe chuck")]
    ids = spark.createDataFrame([(0,), (10,)], "doc_id bigint")
    score = {r.doc_id: r.score for r in M.cross_entropy_difference(docs(spark, rows)[0], ids, vocabulary=None).collect()}
    assert score[11] < score[13] - 0.5
    assert M.cross_entropy_difference(empty(spark), ids, vocabulary=None).count() == 0


def test_without_targets_and_empty(spark):
    df, rows = docs(spark, [(1, "a b"), (2, None), (3, "")])
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, quality int")
    compare(spark, df, labels)
    got = {r.doc_id: r for r in M.cross_entropy_difference(df, labels.where("quality = 1"), vocabulary=1500).collect()}
    assert got[2].n_tokens == 0 and got[2].score is None and got[3].score is None and got[1].score is not None
    assert M.cross_entropy_difference(empty(spark), labels, vocabulary=1500).count() == 0


def test_numbers_by_byte_planes():
    for x in ([], [0], [2**64 - 1, 1, 77], list(range(1000))):
        assert M._unsqueezed(M._squeezed(M.np.array(x, M.U64))).tolist() == x
