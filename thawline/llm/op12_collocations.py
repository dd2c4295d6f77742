"""Phrase collocation mining: HAT-trie counts of phrases in the tasks, merged per prefix, scored by their weakest cut.

Three counts, each a scan of the texts, the next pruned by the one before: words, pairs of words,
triples.  A phrase that occurs ``least`` times is made of parts that do, so pairs are counted only
where both words may be that frequent and triples only where both pairs may be.  "May be" is a bit
filter of fixed size (``2 ** filter_bits`` bits), set from all frequent parts: a bit that is set by
something else lets a phrase be counted in vain and changes no result, and the broadcast stays the
same at every size of the corpus.

In a task, phrases are counted in a trie over word ids: under the first word lies a hash container
of what follows; a container that outgrows ``BURST`` becomes a node with a container for each next
word.  When the trie holds ``ENTRIES`` phrases, whole subtrees leave it as sorted runs, those whose
phrases repeat least first.  A run has one record a prefix (all words but the last): the last words
and their counts.  Runs are dealt by prefix and merged.  A prefix that holds a ``HOT``-th of all
words or more (there are ``HOT`` of them at most) is split by the last word into ``SLICES``.

Texts are read in slices that end at piece borders, so a long text is never held as words at once.

Defined cases: null text is empty, null lang is ``und``; an empty lang is a language of its own.
Repeated rows count each.  Ties of score and count go by the phrase's bytes.  Texts without a
frequent phrase, and the empty table, give no rows.
"""

from __future__ import annotations

import re
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thawline.llm.common import U64, mix, saved, small_batches

GROUP = 3 << 20
BURST = 4096
ENTRIES = 400_000
WORDS = 400_000
SLICES = 64
HOT = 1000
SALTS = 8
BUCKETS = 32
_BORDER = b".,;:!?\n\x0b\x0c\r"
_TO_STOP = bytes.maketrans(_BORDER, b"." * len(_BORDER))
_BORDERS = re.compile(rb"[.,;:!?\x0a-\x0d]")
_LOW32 = (1 << 32) - 1


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words; the word ``.`` stands at every piece border."""
    return data.lower().translate(_TO_STOP).replace(b".", b" . ").split()


def slices(text: bytes, size: int = GROUP):
    """``text`` in parts of ``size`` bytes or a little more that end at piece borders."""
    at = 0
    while len(text) - at > size:
        m = _BORDERS.search(text, at + size)
        if m is None:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


def _by_lang(batches):
    """(lang, bytes of texts of one language, a piece border between texts), about ``GROUP`` bytes at a time."""
    held: dict[bytes, list[bytes]] = {}
    size: dict[bytes, int] = {}
    for b in batches:
        texts, langs = b.column("text"), b.column("lang").to_pylist()
        for i, lang in enumerate(langs):
            for part in slices(texts[i].as_py()):
                held.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part)
                if size[lang] >= GROUP:
                    yield lang, b"\n".join(held.pop(lang))
                    del size[lang]
        if sum(size.values()) >= 4 * GROUP:  # many languages, little of each
            for lang, parts in held.items():
                yield lang, b"\n".join(parts)
            held, size = {}, {}
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


class BitFilter:
    """Which 64-bit hashes may have been seen: one bit for the leading bits of each."""

    def __init__(self, bits: int, words: np.ndarray):
        self.shift, self.bytes = 64 - bits, words.tobytes()

    def has(self, h: int) -> bool:
        p = h >> self.shift
        return self.bytes[p >> 3] >> (p & 7) & 1 == 1

    def has_all(self, h: np.ndarray) -> np.ndarray:
        p = (h >> U64(self.shift)).astype(np.int64)
        return (np.frombuffer(self.bytes, np.uint8)[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1


def lang_seed(lang: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang, 12)


def word_hash(word: bytes, seed: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, seed)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U64(0x9E3779B97F4A7C15) + mix(second))


class _Ids(dict):
    """Ids of one language's words, 0 for words that cannot be frequent."""

    def __init__(self, words: Words, lang: bytes):
        import xxhash

        super().__init__({b".": 0})
        self.words, self.seed, self.digest = words, lang_seed(lang), xxhash.xxh64_intdigest
        self.shift, self.bytes = words.known.shift, words.known.bytes

    def __missing__(self, word: bytes) -> int:
        h = self.digest(word, self.seed)  # word_hash and BitFilter.has, once for every word met
        p = h >> self.shift
        if self.bytes[p >> 3] >> (p & 7) & 1:
            text = self.words.text
            i = self[word] = len(text)
            text.append(word)
            self.words.hash.append(h)
            return i
        self[word] = 0
        return 0


class Words:
    """Ids of the words a task has met, over all languages; ids of a language share nothing with another's."""

    def __init__(self, known: BitFilter):
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.of_lang: dict[bytes, _Ids] = {}
        self.text, self.hash, self.langs = [b""], [0], []

    def held(self) -> int:
        return sum(map(len, self.of_lang.values()))

    def ids(self, lang: bytes, words: list[bytes]) -> np.ndarray:
        known = self.of_lang.get(lang)
        if known is None:
            known = self.of_lang[lang] = _Ids(self, lang)
        a = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self.langs += [lang] * (len(self.text) - 1 - len(self.langs))
        return a


class _Node(dict):
    """A container that burst: the containers of the next words."""


class HatTrie:
    """Counts of phrases of two or three word ids."""

    def __init__(self, size: int):
        self.size, self.entries = size, 0
        self.root: dict[int, dict] = {}

    def add(self, first: np.ndarray, rest: np.ndarray, n: np.ndarray) -> None:
        """Phrases sorted by first word; ``rest`` is the second word, or second * 2**32 + third."""
        starts = np.flatnonzero(np.diff(first, prepend=-1))
        stops = np.append(starts[1:], len(first)).tolist()
        rest, n = rest.tolist(), n.tolist()
        for f, lo, hi in zip(first[starts].tolist(), starts.tolist(), stops):
            under = self.root.get(f)
            if under is None:
                under = self.root[f] = dict(zip(rest[lo:hi], n[lo:hi]))
                self.entries += hi - lo
            elif type(under) is _Node:
                for r, k in zip(rest[lo:hi], n[lo:hi]):
                    leaf = under.setdefault(r >> 32, {})
                    last = r & _LOW32
                    before = len(leaf)
                    leaf[last] = leaf.get(last, 0) + k
                    self.entries += len(leaf) - before
                continue
            else:
                before, new = len(under), rest[lo:hi]
                under.update(zip(new, map(add, map(under.get, new, repeat(0)), n[lo:hi])))
                self.entries += len(under) - before
            if self.size == 3 and len(under) > BURST:
                node = self.root[f] = _Node()
                for r, k in under.items():
                    node.setdefault(r >> 32, {})[r & _LOW32] = k

    def _repeats(self, f: int) -> float:
        """Occurrences for each phrase under a first word."""
        under = self.root[f]
        if type(under) is _Node:
            return sum(sum(leaf.values()) for leaf in under.values()) / sum(map(len, under.values()))
        return sum(under.values()) / len(under)

    def spill(self, keep: int = 0):
        """(first, rest, n) of subtrees that leave, until at most ``keep`` phrases are left."""
        first, sizes, rests, counts = [], [], [], []
        for f in sorted(self.root, key=self._repeats) if keep else list(self.root):
            if self.entries <= keep:
                break
            under, before = self.root.pop(f), len(rests)
            if type(under) is _Node:
                for second, leaf in under.items():
                    rests += [second << 32 | r for r in leaf]
                    counts += leaf.values()
            else:
                rests += under
                counts += under.values()
            first.append(f)
            sizes.append(len(rests) - before)
            self.entries -= sizes[-1]
        return np.repeat(np.array(first, np.int64), np.array(sizes, np.int64)), np.array(rests, np.int64), np.array(counts, np.int64)


def _phrases(a: np.ndarray, words: Words, size: int, pairs: BitFilter | None):
    """Sorted distinct phrases of the id sequence ``a`` and their counts."""
    two = (a[:-1] > 0) & (a[1:] > 0)
    if size == 2:
        at = np.flatnonzero(two)
        code, n = np.unique(a[at] << 32 | a[at + 1], return_counts=True)
        return code >> 32, code & _LOW32, n
    h = np.array(words.hash, np.uint64)
    i = np.flatnonzero(two)
    two[i] = pairs.has_all(pair_hashes(h[a[i]], h[a[i + 1]]))
    at = np.flatnonzero(two[:-1] & two[1:])
    first, rest = a[at], a[at + 1] << 32 | a[at + 2]
    order = np.lexsort((rest, first))
    first, rest = first[order], rest[order]
    new = np.flatnonzero((np.diff(first, prepend=-1) != 0) | (np.diff(rest, prepend=-1) != 0))
    return first[new], rest[new], np.diff(np.append(new, len(first)))


def _hot_ids(words: Words, hot: set) -> np.ndarray:
    """Ids of the hot prefixes a task has met: a word's, or first * 2**32 + second."""
    out = []
    for lang, prefix in hot:
        known = words.of_lang.get(lang, {})
        ids = [known.get(w, 0) for w in prefix.split(b" ")]
        if all(ids):
            out.append(ids[0] if len(ids) == 1 else ids[0] << 32 | ids[1])
    return np.array(out, np.int64)


_RUN = "lang binary, prefix binary, slice int, lasts binary, counts array<bigint>"


def _sorted_run(words: Words, size: int, first, rest, n, hot: set):
    """Arrow batches of spilled phrases, sorted by language, prefix, slice and last word; one row a prefix and slice."""
    import pyarrow.compute as pc

    values = pa.array(words.text, pa.binary())
    last = rest & _LOW32
    prefix = [first] if size == 2 else [first, rest >> 32]
    met = np.zeros(len(values), bool)
    for c in (*prefix, last):
        met[c] = True
    met = np.flatnonzero(met)
    rank = np.zeros(len(values), np.int64)
    rank[met[pc.array_sort_indices(values.take(pa.array(met))).to_numpy()]] = np.arange(len(met))
    langs = {g: i for i, g in enumerate(sorted(words.of_lang))}
    lang = np.array([0] + [langs[g] for g in words.langs], np.int64)
    slice_ = np.zeros(len(first), np.int64)
    if hot:
        at = np.flatnonzero(np.isin(first if size == 2 else first << 32 | prefix[1], _hot_ids(words, hot)))
        slice_[at] = (np.array(words.hash, np.uint64)[last[at]] % U64(SLICES)).astype(np.int64)
    by = np.lexsort([slice_ << 32 | rank[last], *(rank[c] for c in reversed(prefix[1:])), lang[first] << 32 | rank[first]])
    prefix, slice_, last, n = [c[by] for c in prefix], slice_[by], last[by], n[by]
    new = np.diff(slice_, prepend=-1) != 0
    for c in prefix:
        new |= np.diff(c, prepend=-1) != 0
    starts = np.append(np.flatnonzero(new), len(n))
    for at in range(0, len(starts) - 1, 16_384):
        edge = starts[at : at + 16_384 + 1]
        lo, hi = edge[0], edge[-1]
        offsets = pa.array((edge - lo).astype(np.int32))
        lasts = pc.binary_join(pa.ListArray.from_arrays(offsets, values.take(pa.array(last[lo:hi]))), b" ")
        head = edge[:-1]
        names = [values.take(pa.array(c[head])) for c in prefix]
        before = names[0] if size == 2 else pc.binary_join_element_wise(*names, pa.scalar(b" ", pa.binary()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([words.langs[i - 1] for i in prefix[0][head].tolist()], pa.binary()), before, pa.array(slice_[head].astype(np.int32)), lasts,
             pa.ListArray.from_arrays(offsets, pa.array(n[lo:hi]))],
            names=["lang", "prefix", "slice", "lasts", "counts"],
        )


def _count_phrases(size: int, known, pairs, hot: set, entries: int = ENTRIES, held_words: int = WORDS):
    def run(batches):
        words, trie = Words(known.value), HatTrie(size)
        for lang, data in _by_lang(batches):
            a = words.ids(lang, words_of(data))
            if len(a) >= size:
                trie.add(*_phrases(a, words, size, pairs.value if pairs else None))
            full = words.held() > held_words  # ids end with the words, so all phrases leave first
            if full or trie.entries > entries:
                yield from _sorted_run(words, size, *trie.spill(0 if full else entries // 2), hot)
            if full:
                words.clear()
        yield from _sorted_run(words, size, *trie.spill(), hot)

    return run


def _count_words(batches):
    from collections import Counter

    counts: dict[bytes, Counter] = {}
    held = 0

    def rows():
        for lang, c in sorted(counts.items()):
            c.pop(b".", None)
            words, n = list(c), list(c.values())
            for at in range(0, len(words), 65_536):
                part = words[at : at + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.binary()), pa.array(part, pa.binary()), pa.array(n[at : at + 65_536], pa.int64())], names=["lang", "word", "n"])

    for lang, data in _by_lang(batches):
        mine = counts.setdefault(lang, Counter())
        held -= len(mine)
        mine.update(words_of(data))
        held += len(mine)
        if held > WORDS:
            yield from rows()
            counts.clear()
            held = 0
    yield from rows()


def _filter_of(parts: DataFrame, columns: list[str], bits: int) -> BitFilter:
    """Filter of the words or pairs in ``parts`` (lang and ``columns``): at most ``2 ** bits / 64`` words reach the driver."""

    def run(batches):
        seeds: dict[bytes, int] = {}
        for b in batches:
            langs = b.column("lang").to_pylist()
            for lang in set(langs) - seeds.keys():
                seeds[lang] = lang_seed(lang)
            hashes = [np.fromiter((word_hash(w, seeds[g]) for g, w in zip(langs, b.column(c).to_pylist())), np.uint64, len(langs)) for c in columns]
            p = (hashes[0] if len(hashes) == 1 else pair_hashes(*hashes)) >> U64(64 - bits)
            block, at = np.unique(p >> U64(6), return_inverse=True)
            word = np.zeros(len(block), np.uint64)
            np.bitwise_or.at(word, at, U64(1) << (p & U64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int64)), pa.array(word.view(np.int64))], names=["block", "word"])

    set_ = parts.select("lang", *columns).mapInArrow(run, "block bigint, word bigint").groupBy("block").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[set_["block"].to_numpy()] = set_["word"].to_numpy().view(np.uint64)
    return BitFilter(bits, words)


def phrase_counts(docs: DataFrame, least: int, max_words: int, filter_bits: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(word occurrences per lang; frequent words: lang, word, n; frequent phrases of 2 .. max_words words: lang, prefix, last, n)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    words = saved(texts.mapInArrow(_count_words, "lang binary, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")), "op12-words")
    total = saved(words.groupBy("lang").agg(F.sum("n").alias("n")), "op12-totals")
    frequent = words.where(F.col("n") >= least)
    known = spark.sparkContext.broadcast(_filter_of(frequent, ["word"], filter_bits))
    all_words = total.agg(F.sum("n")).first()[0] or 0
    phrases, pairs = [], None
    prefixes = frequent.select("lang", F.col("word").alias("prefix"), "n")
    for size in range(2, max_words + 1):
        hot = {(bytes(r.lang), bytes(r.prefix)) for r in prefixes.where(F.col("n") * HOT >= all_words).collect()}  # HOT rows at most
        runs = texts.mapInArrow(_count_phrases(size, known, pairs, hot), _RUN).repartition("lang", "prefix", "slice")
        pair = F.arrays_zip(F.split(F.col("lasts").cast("string"), " ").alias("last"), F.col("counts").alias("n"))
        merged = runs.select("lang", "prefix", "slice", F.inline(pair)).groupBy("lang", "prefix", "slice", "last").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        found = saved(merged.select("lang", "prefix", F.col("last").cast("binary").alias("last"), "n"), f"op12-phrases-{size}")
        phrases.append(found)
        if size < max_words:
            pairs = spark.sparkContext.broadcast(_filter_of(found, ["prefix", "last"], filter_bits))
            prefixes = found.select("lang", F.concat_ws(" ", F.col("prefix").cast("string"), F.col("last").cast("string")).cast("binary").alias("prefix"), "n")
    return total, frequent, phrases


def _whole(c: str):
    return F.col(c).cast("decimal(38,0)")


def _score(left: str, right: str):
    """floor(1000000 a a / (l r)), exact: decimals of 38 digits, so for counts up to 10**16."""
    product = F.lit(1_000_000).cast("decimal(7,0)") * F.col("a").cast("decimal(16,0)") * F.col("a").cast("decimal(16,0)")
    return F.call_function("div", product, (F.col(left).cast("decimal(19,0)") * F.col(right).cast("decimal(19,0)"))).cast("bigint")


def collocations(docs: DataFrame, least: int = 10, max_words: int = 3, inside: int = 50, top: int = 2000, filter_bits: int = 26) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 .. ``max_words`` (2 or 3) words.

    ``inside``: a phrase goes where a longer candidate that contains it has this percentage of its
    count or more.
    """
    if max_words not in (2, 3):
        raise ValueError("phrases have 2 or 3 words at most")
    total, frequent, phrases = phrase_counts(docs, least, max_words, filter_bits)
    text = [p.select("lang", F.concat_ws(" ", F.col("prefix").cast("string"), F.col("last").cast("string")).alias("phrase"), F.col("n").alias("a")) for p in phrases]
    known = frequent.select("lang", F.col("word").cast("string").alias("part"), F.col("n").alias("f"))
    parts, longer = [], []
    for size, p in enumerate(text, 2):
        w = F.split("phrase", " ")
        sub = lambda i, j, w=w: F.array_join(F.slice(w, i + 1, j - i), " ")
        cuts = [F.struct(F.lit(k).alias("k"), F.lit(left).alias("is_left"), (sub(0, k) if left else sub(k, size)).alias("part")) for k in range(1, size) for left in (True, False)]
        parts.append(p.select("lang", "phrase", "a", F.lit(size).alias("size"), F.inline(F.array(*cuts))))
        if size < max_words:
            known = known.union(p.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
        for m in range(2, size):
            longer.append(p.select("lang", F.explode(F.array(*(sub(i, i + m) for i in range(size - m + 1)))).alias("phrase"), F.col("a").alias("longer")))
    asked = parts[0]
    for p in parts[1:]:
        asked = asked.union(p)
    # a common word is a part of many phrases: those are dealt over copies of its row
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    copies = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    rows = asked.join(copies, ["lang", "part", "salt"]).select("lang", "phrase", "a", "size", "k", "is_left", "f", F.lit(None).cast("bigint").alias("longer"))
    none = {"a": "bigint", "size": "int", "k": "int", "is_left": "boolean", "f": "bigint"}
    for p in longer:
        rows = rows.unionByName(p.select("lang", "phrase", *(F.lit(None).cast(t).alias(c) for c, t in none.items()), "longer"))
    side = lambda k, left: F.max(F.when((F.col("k") == k) & (F.col("is_left") == left), F.col("f"))).alias(f"{'l' if left else 'r'}{k}")
    sides = [side(k, left) for k in range(1, max_words) for left in (True, False)]
    flat = rows.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("size").alias("size"), F.max("longer").alias("longer"), *sides)
    flat = flat.where(F.col("longer").isNull() | (_whole("longer") * 100 < _whole("a") * inside))
    # the least score, the smallest k on ties
    cuts = [F.struct(_score(f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, max_words)]
    worst = F.array_min(F.filter(F.array(*cuts), lambda c: c["k"] < F.col("size")))
    scored = flat.withColumn("cut", worst).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # the first of each bucket, then of these: a language's last task reads BUCKETS * top rows at most
    best = [F.desc("score"), F.desc("a"), "phrase"]
    scored = scored.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*best))).where(F.col("rank") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)
    return first.join(total, "lang").select(F.col("lang").cast("string").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = 10, inside: int = 50, top: int = 2000) -> str:
    """DuckDB twin over ``documents``, phrases of 2 to 3 words."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
lists AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
words AS (SELECT pid, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM lists),
next AS (SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY pid ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY pid ORDER BY i) AS w3 FROM words),
f1 AS (SELECT lang, w1 AS p, count(*) AS f FROM next GROUP BY 1, 2),
f2 AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS p, count(*) AS f FROM next WHERE w2 IS NOT NULL GROUP BY 1, 2, 3),
f3 AS (SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS p, count(*) AS f FROM next WHERE w3 IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) >= {least}),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY 1),
longer AS (SELECT lang, p, max(f) AS f FROM (SELECT lang, w1 || ' ' || w2 AS p, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3) GROUP BY 1, 2),
cuts AS (
  SELECT f2.lang, f2.p, f2.f AS a, 1 AS k, x.f AS l, y.f AS r FROM f2
    JOIN f1 x ON x.lang = f2.lang AND x.p = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.p = f2.w2
    LEFT JOIN longer g ON g.lang = f2.lang AND g.p = f2.p
    WHERE f2.f >= {least} AND (g.f IS NULL OR 100 * g.f < {inside} * f2.f)
  UNION ALL
  SELECT f3.lang, f3.p, f3.f, 1, x.f, y.f FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.p = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.p, f3.f, 2, x.f, y.f FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.p = f3.w3),
scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM weakest)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""
