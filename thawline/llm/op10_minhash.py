"""MinHash near-duplicates: bottom-k sketches of one hash function.

Every document has a set of word shingles; its sketch is the k smallest hashes of that set.

1. Equal sets form a class (128-bit digest); only one set per class goes on, whatever the
   number of copies.
2. Inverted lists over *runs* of three consecutive retained values generate candidates.  Two
   sets with similarity 0.8 share such a run unless the union's retained values hold no three
   common ones in a row: impossible when both sketches are whole sets of more than four
   shingles (at most a fifth of the union differs; smaller sets also use runs of two and one),
   and about 1e-10 for k = 64 otherwise (about 1e-6 where three quarters of the retained values
   stand in long lists, which leave fewer runs to meet in).
3. A list of up to ``list_bound`` classes yields its pairs.  Longer lists are not capped.  A
   class that has enough runs outside them is found there (the same bounds hold for what is
   left), so it leaves them; the others are compared with the list's leader, and what is not
   linked to its leader is compared with the leader's other members block by block, on full
   sets; each block returns a spanning forest of its links.
4. The union sketch (k smallest of both sketches) estimates the similarity; pairs clearly
   below the threshold go.
5. The rest is confirmed on full sets, and the components of all links are taken.

Defined cases: null or empty text, or text without words: empty set, linked with nothing, its
own component.  A null doc_id is returned with a null component and ``kept`` true.  Rows that
repeat a doc_id are separate rows.  Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import U64, WORD_HASHES, digest16, doc_texts, mix, saved
from thawline.llm.components import components

RUN = 3
_C = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5), U64(0x85EBCA77C2B2AE63)]


def shingle_set(text: str, words_per_shingle: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the text's shingles (words: no ASCII white space, A-Z lowered)."""
    h = WORD_HASHES.of(text.encode("utf-8", "surrogatepass").lower().split())
    w = words_per_shingle
    if len(h) == 0:
        return np.zeros(0, np.int64)
    span = min(w, len(h))
    n = len(h) - span + 1
    x = np.full(n, U64(span))
    for i in range(span):
        x = mix(x * _C[0] + h[i : i + n])
    return np.unique((x >> U64(1)).astype(np.int64))


def run_keys(sketch: np.ndarray) -> np.ndarray:
    """Hashes of the runs of RUN consecutive retained values; small sets also give shorter runs."""
    out = []
    s = sketch.astype(np.uint64)
    for r in range(1, RUN + 1):
        if len(s) < r or (r < RUN and len(s) > (1, 5)[r - 1]):
            continue
        x = np.full(len(s) - r + 1, U64(r))
        for i in range(r):
            x = mix(x * _C[1] + s[i : i + len(x)])
        out.append(x)
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def text_tag(docs: DataFrame):
    """Hash that tells texts of one doc_id apart (null and empty text are the same)."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _sketches(words: int, k: int):
    def run(batches):
        for b in batches:
            n, dig, sk = [], [], []
            for t in b.column("text").to_pylist():
                s = shingle_set(t, words)
                n.append(len(s))
                dig.append(digest16(s.tobytes()) if len(s) else None)
                sk.append(s[:k].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("tag"), pa.array(n, pa.int64()), pa.array(dig, pa.binary()), pa.array(sk, pa.binary())],
                names=["doc_id", "tag", "n_shingles", "digest", "sketch"],
            )

    return run


def _postings(batches):
    for b in batches:
        keys = [run_keys(np.frombuffer(x, np.int64)) for x in b.column("sketch").to_pylist()]
        cid = np.repeat(b.column("cid").to_numpy(zero_copy_only=False), [len(x) for x in keys])
        if len(cid):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(cid)], names=["key", "cid"])


def _union_filter(k: int, percent: int, slack: float):
    """Keep pairs whose union-sketch estimate is not clearly below the threshold."""

    def run(batches):
        for b in batches:
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            sa, sb = b.column("sa").to_pylist(), b.column("sb").to_pylist()
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = np.frombuffer(sa[i], np.int64), np.frombuffer(sb[i], np.int64)
                common = np.intersect1d(x, y, assume_unique=True)
                if na[i] <= k and nb[i] <= k:
                    keep[i] = 100 * len(common) >= percent * (na[i] + nb[i] - len(common))
                    continue
                u = np.union1d(x, y)[:k]
                share = np.searchsorted(common, u[-1], "right") / len(u)
                p = percent / 100
                keep[i] = share >= p - slack * (p * (1 - p) / len(u)) ** 0.5
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def _confirm(percent: int):
    def run(batches):
        for b in batches:
            sa, sb = b.column("set_a").to_pylist(), b.column("set_b").to_pylist()
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = np.frombuffer(sa[i], np.int64), np.frombuffer(sb[i], np.int64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * inter >= percent * (len(x) + len(y) - inter)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def _sets(words: int):
    def run(batches):
        for b in batches:
            sets = [shingle_set(t, words).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest16(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())], names=["digest", "shingles"]
            )

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]):
    """Yields (i, intersection sizes of left[i] with every set of ``right``)."""
    nr = len(right)
    values, inverse, count = np.unique(np.concatenate(right), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(nr), [len(x) for x in right])[np.argsort(inverse, kind="stable")]
    first = np.cumsum(count) - count
    frequent = np.flatnonzero(count > max(32, nr // 16))  # at most 16 average sets' worth
    column = np.full(len(values), -1)
    column[frequent] = np.arange(len(frequent))
    for at in range(0, len(left), 256):
        part = left[at : at + 256]
        found = []
        for x in part:
            v = np.minimum(np.searchsorted(values, x), len(values) - 1)
            found.append(v[values[v] == x])
        total = np.zeros((len(part), nr), np.float32)
        for c0 in range(0, len(frequent), 4096):
            width = min(4096, len(frequent) - c0)
            ml, mr = np.zeros((len(part), width), np.float32), np.zeros((nr, width), np.float32)
            for i, v in enumerate(found):
                c = column[v] - c0
                ml[i, c[(c >= 0) & (c < width)]] = 1
            for c in range(width):
                f = frequent[c0 + c]
                mr[rows[first[f] : first[f] + count[f]], c] = 1
            total += ml @ mr.T
        for i, v in enumerate(found):
            v = v[column[v] < 0]
            k = count[v]
            at_rows = np.repeat(first[v] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            yield at + i, total[i].astype(np.int64) + np.bincount(rows[at_rows], minlength=nr)


def _rest_of_block(percent: int):
    """Cogroup of one leader's unlinked members with a block of all its members.

    Returns links that connect what the block's links connect (a spanning forest), so their
    number stays below that of the members.
    """

    def run(left, right):
        import pandas as pd

        edges = []
        if len(left) and len(right):
            ls = [np.frombuffer(x, np.int64) for x in left["shingles"]]
            rs = [np.frombuffer(x, np.int64) for x in right["r_shingles"]]
            ll, lr = left["label"].to_numpy(), right["r_label"].to_numpy()
            cl, cr = left["cid"].to_numpy(), right["r_cid"].to_numpy()
            sizes = np.array([len(x) for x in rs])
            group = dict(zip([*ll.tolist(), *lr.tolist()], [*ll.tolist(), *lr.tolist()]))

            def find(x):
                while group[x] != x:
                    group[x] = x = group[group[x]]
                return x

            for i, c in _common(ls, rs):
                near = np.flatnonzero((100 * c >= percent * (len(ls[i]) + sizes - c)) & (lr != ll[i]))
                labels, one = np.unique(lr[near], return_index=True)
                for label, j in zip(labels.tolist(), near[one].tolist()):
                    a, b = find(int(ll[i])), find(label)
                    if a != b:
                        group[a] = b
                        edges.append((cl[i], cr[j]))
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")

    return run


def _classes(docs: DataFrame, words: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tag, n_shingles, digest) and classes of equal sets (cid, first_doc, digest, n_shingles, sketch)."""
    texts = doc_texts(docs)
    texts = texts.withColumn("tag", text_tag(texts))
    rows = saved(
        texts.mapInArrow(_sketches(words, k), "doc_id bigint, tag bigint, n_shingles bigint, digest binary, sketch binary"), "op10-rows"
    )
    reps = (
        rows.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc"), F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    return rows.drop("sketch"), saved(reps, "op10-classes")


def _candidates(cls: DataFrame, k: int, list_bound: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of the inverted lists, and the stars (leader, cid) of their long lists."""
    posts = cls.select("cid", "sketch").mapInArrow(_postings, "key bigint, cid bigint")
    size = posts.groupBy("key").agg(F.count("*").alias("members"), F.min("cid").alias("leader")).where("members > 1")
    lists = saved(posts.join(size, "key"), "op10-lists")
    short = lists.where(F.col("members") <= list_bound).groupBy("key").agg(F.sort_array(F.collect_set("cid")).alias("m"))
    pairs = short.select(
        F.explode(F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(x as a, y as b))))")).alias("p")
    ).select("p.a", "p.b")

    # a class's long lists as one row: how many, and their leaders
    long_lists = lists.where(F.col("members") > list_bound).groupBy("cid").agg(F.count("*").alias("hot_runs"), F.collect_set("leader").alias("leaders"))
    found_elsewhere = F.when(F.col("n_shingles") <= k, F.col("hot_runs") < 0.25 * F.col("n_shingles") - 2).otherwise(
        F.col("hot_runs") <= 0.22 * (k - RUN + 1)
    )
    stay = long_lists.join(cls.select("cid", "n_shingles"), "cid").where(~found_elsewhere)
    star = saved(stay.select(F.explode("leaders").alias("leader"), "cid"), "op10-star")
    return pairs.union(star.where("leader <> cid").selectExpr("least(leader, cid)", "greatest(leader, cid)")).distinct(), star


def _pass_sketch(pairs: DataFrame, cls: DataFrame, k: int, percent: int) -> DataFrame:
    a = cls.select(F.col("cid").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    b = cls.select(F.col("cid").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    near = pairs.join(a, "a").join(b, "b").where(f"100 * na >= {percent} * nb and 100 * nb >= {percent} * na")
    return near.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_union_filter(k, percent, 7.0), "a bigint, b bigint")


def _full_sets(cids: DataFrame, docs: DataFrame, cls: DataFrame, words: int) -> DataFrame:
    """(cid, shingles) of the named classes, computed from the text of each class's first document."""
    need = cls.join(cids.distinct(), "cid", "left_semi").select("cid", "first_doc", "digest")
    texts = doc_texts(docs).join(need.selectExpr("first_doc as doc_id"), "doc_id", "left_semi")
    found = texts.select("text").mapInArrow(_sets(words), "digest binary, shingles binary")
    return saved(found.join(need.select("digest", "cid"), "digest").dropDuplicates(["cid"]).select("cid", "shingles"), "op10-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = pairs.join(sets.selectExpr("cid as a", "shingles as set_a"), "a").join(sets.selectExpr("cid as b", "shingles as set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), "a bigint, b bigint")


def _rest_of_long_lists(star: DataFrame, links: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links of a long list's members that its leader does not give: unlinked members against all members."""
    linked = links.selectExpr("a as leader", "b as cid").union(links.selectExpr("b as leader", "a as cid"))
    near = star.join(linked, ["leader", "cid"], "left_semi").union(star.where("leader = cid"))
    label = near.groupBy("cid").agg(F.min("leader").alias("label"))
    members = star.join(label, "cid", "left").withColumn("label", F.coalesce("label", F.col("cid")))
    mark = near.withColumn("is_near", F.lit(True))
    members = members.join(mark, ["leader", "cid"], "left")
    blocks = members.groupBy("leader").agg(F.ceil(F.count("*") / block).alias("blocks"), F.count_if(F.col("is_near").isNull()).alias("far"))
    # leaders all of whose members are linked to them have nothing left to compare
    members = members.join(blocks.where("far > 0"), "leader").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    members = saved(members.join(sets, "cid"), "op10-members")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    cols = ["leader", "cid", "label", "shingles"]
    left = members.where("is_near is null").select(*cols, F.col("part").alias("i"), every.alias("j"))
    right = members.select(*(F.col(c).alias(f"r_{c}") for c in cols), F.col("part").alias("r_j"), every.alias("r_i"))
    found = left.groupBy("leader", "i", "j").cogroup(right.groupBy("r_leader", "r_i", "r_j"))
    return found.applyInPandas(_rest_of_block(percent), "a bigint, b bigint")


def _grouped(docs: DataFrame, words: int, percent: int, k: int, list_bound: int, block: int) -> DataFrame:
    """(doc_id, tag, n_shingles, component, component_id, kept) for every row; ``component`` is unique, its least id need not be."""
    rows, cls = _classes(docs, words, k)
    pairs, star = _candidates(cls, k, list_bound)
    pairs = saved(_pass_sketch(pairs, cls, k, percent), "op10-pairs")
    sets = _full_sets(pairs.selectExpr("a as cid").union(pairs.selectExpr("b as cid")).union(star.select("cid")).union(star.select("leader")), docs, cls, words)
    links = saved(_confirmed(pairs, sets, percent), "op10-links")
    links = links.union(_rest_of_long_lists(star, links, sets, percent, block))
    node = components(links)
    of_class = cls.select("cid", "first_doc", "digest").join(node.withColumnRenamed("node", "cid"), "cid", "left")
    of_class = of_class.withColumn("component", F.coalesce("component", "cid"))
    low = of_class.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = of_class.join(low, "component").select("digest", "component", "component_id")
    out = rows.join(named, "digest", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return out.select("doc_id", "tag", "n_shingles", "component", "component_id", kept)


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, k: int = 64, list_bound: int = 32, block: int = 2048
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    ``words``: words per shingle; ``percent``: least similarity; ``k``: retained values;
    ``list_bound``: inverted lists longer than this go the leader's way; ``block``: members per
    block there.
    """
    return _grouped(docs, words, percent, k, list_bound, block).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(
    docs: DataFrame, words: int = 5, percent: int = 80, k: int = 64, list_bound: int = 32, block: int = 2048, one_row_an_id: bool = True
) -> DataFrame:
    """``docs`` with one row for each group of near duplicates, all columns as they were.

    A row is known by its doc_id and text, so an id's texts are kept or not each by its own group.
    Rows without words are in no group and stay, as do rows with a null doc_id.  With
    ``one_row_an_id``, of several groups whose kept row has the same doc_id one row stays; without
    it each group keeps its own.
    """
    out = saved(_grouped(docs, words, percent, k, list_bound, block), "op10-kept")
    first = out.where("kept and doc_id is not null and n_shingles > 0")
    group = "doc_id" if one_row_an_id else "component"
    twice = first.groupBy(group).agg(F.min("tag").alias("first_tag"), F.count("*").alias("n")).where("n > 1")
    twice = saved(twice.select(F.col(group).alias("group"), "first_tag"), "op10-twice")
    gone = out.where("not kept").select("doc_id", "tag")
    repeated = not twice.isEmpty()
    if repeated:
        more = first.join(twice, first[group] == twice["group"]).select("doc_id", "tag", "first_tag")
        gone = gone.union(more.where("tag <> first_tag").select("doc_id", "tag"))
    gone = gone.distinct()
    kept = docs.join(gone, (docs["doc_id"] == gone["doc_id"]) & (text_tag(docs) == gone["tag"]), "left_anti")
    if not repeated:
        return kept
    again = more.where("tag = first_tag").groupBy("doc_id", "tag").count().where("count > 1")
    same = (kept["doc_id"] == again["doc_id"]) & (text_tag(kept) == again["tag"])
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def near_duplicates_sql(words: int = 2, percent: int = 80) -> str:
    """DuckDB twin of ``near_duplicates`` over ``documents`` (all overlaps counted; small tables only)."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    k = words
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {k} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {k - 2}), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) END AS sh
  FROM d),
items AS (SELECT rid, unnest(sh) AS s FROM sets WHERE doc_id IS NOT NULL),
shared_items AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM items a JOIN items b ON a.s = b.s AND a.rid <> b.rid GROUP BY a.rid, b.rid),
links AS (
  SELECT o.a, o.b FROM shared_items o JOIN sets x ON x.rid = o.a JOIN sets y ON y.rid = o.b
  WHERE 100 * o.c >= {percent} * (len(x.sh) + len(y.sh) - o.c)),
reached AS (SELECT rid AS a, rid AS b FROM sets WHERE doc_id IS NOT NULL UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
lowest AS (SELECT r.a AS rid, min(s.doc_id) AS component_id FROM reached r JOIN sets s ON s.rid = r.b GROUP BY r.a)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, coalesce(doc_id = component_id, true) AS kept
FROM sets LEFT JOIN lowest USING (rid)
"""
