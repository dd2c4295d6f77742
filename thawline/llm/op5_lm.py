"""LM scoring by cross-entropy difference of two bigram models.

The target model is estimated from target documents, the background model from all documents;
both share one vocabulary, the same order and the same smoothing:
p(w | v) = (c(v, w) + mu * p1(w)) / (c(v) + mu), p1(w) = (c(w) + 1) / (N + words + 1), with a start
symbol before the first word.  A document's score is its mean per-token difference of the two
cross-entropies in bits, target minus background: lower is closer to the target.

Every word of the documents is in the vocabulary, so the models grow with the corpus.  Words and
bigrams are hashes then.  Texts are held in chunks of ``chunk_bytes``; a chunk exchanges each of
its distinct bigrams once with the range of hashes that adds up the counts (a range for each
``part_bytes`` of text, so ranges grow in number, not in size); only the numbers of bytes, tokens and
words reach the driver.

With a number as ``vocabulary`` that many of the most frequent words (ties by word) are told apart and
the others are one unknown symbol.  The models are then tables of at most (vocabulary + 2) *
(vocabulary + 1) cells whatever the corpus, and broadcast.

Words are runs without ASCII white space, A-Z lowered.  Defined cases: null or empty text, or
text without words: no tokens, null entropies and score.  Null doc_ids are scored, and are no
targets.  Repeated rows count and are scored as often as they occur; repeated target ids count
once.  Without a target document the target model is uniform.  Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import U64, WORD_HASHES, doc_texts, mix, saved

TABLE = 300_000
_START, _PREVIOUS = U64(0x9E3779B97F4A7C15), U64(0xD1B54A32D192ED03)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def _word_counts(batches):
    from collections import Counter

    held: Counter = Counter()

    def rows():
        out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for b in batches:
        for t in b.column("text"):
            held.update(words(t.as_py()))
            if len(held) >= TABLE:
                yield rows()
    if held:
        yield rows()


class _Ids(dict):
    """Word numbers; words out of the vocabulary share the last."""

    def __init__(self, vocabulary: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(vocabulary))
        self.unknown = len(vocabulary)

    def __missing__(self, word):
        return self.unknown

    def of(self, text: str) -> np.ndarray:
        w = words(text)
        return np.fromiter(map(self.__getitem__, w), np.int64, len(w))


def _bigrams(ids: _Ids):
    """Cells of a (vocabulary + 2) x (vocabulary + 1) table: previous word (the last row: start), word."""
    width = ids.unknown + 1

    def run(batches):
        dense, pending, size = np.zeros((width + 1) * width, np.int64), [], 0
        for b in batches:
            for t in b.column("text"):
                x = ids.of(t.as_py())
                if len(x):
                    pending.append(np.concatenate([[width], x[:-1]]) * width + x)
                    size += len(x)
                if size >= 1 << 20:
                    dense += np.bincount(np.concatenate(pending), minlength=len(dense))
                    pending, size = [], 0
        if pending:
            dense += np.bincount(np.concatenate(pending), minlength=len(dense))
        cell = np.flatnonzero(dense)
        if len(cell):
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(dense[cell])], names=["cell", "n"])

    return run


def _table(texts: DataFrame, ids: _Ids) -> np.ndarray:
    """Bigram counts of all texts, summed by Spark; one row a cell reaches the driver."""
    width = ids.unknown + 1
    cells = texts.select("text").mapInArrow(_bigrams(ids), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((width + 1) * width)
    out[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return out.reshape(width + 1, width)


def log_probabilities(counts: np.ndarray, mu: float) -> np.ndarray:
    """log2 p(word | previous) of a bigram count table."""
    one = counts.sum(0)
    p1 = (one + 1) / (one.sum() + len(one))
    return np.log2((counts + mu * p1) / (counts.sum(1, keepdims=True) + mu))


def _scores(models, ids):
    def run(batches):
        target, background = models.value
        v = ids.value
        width = v.unknown + 1
        for b in batches:
            n, ht, hb = [], [], []
            for t in b.column("text"):
                x = v.of(t.as_py())
                n.append(len(x))
                if not len(x):
                    ht.append(None)
                    hb.append(None)
                    continue
                prev = np.concatenate([[width], x[:-1]])
                ht.append(float(-target[prev, x].sum() / len(x)))
                hb.append(float(-background[prev, x].sum() / len(x)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ht, pa.float64()), pa.array(hb, pa.float64())], names=["doc_id", "n_tokens", "h_target", "h_background"])

    return run


def _squeezed(x: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, compressed: bytes that are mostly zero cost nearly nothing."""
    return zstandard.compress(x.astype(U64).view(np.uint8).reshape(-1, 8).T.tobytes(), 3)


def _unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(U64).ravel()


def _chunks(chunk_bytes: int):
    """Rows gathered to chunks: a number, the bytes held, and the rows as a compressed Arrow stream."""

    def row(chunk, held, size):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for b in held:
                out.write_batch(b)
        rows = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([size]), rows], names=["chunk", "size", "rows"])

    def run(batches):
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size >= chunk_bytes:
                yield row(chunk, held, size)
                chunk, held, size = chunk + 1, [], 0
        if size:
            yield row(chunk, held, size)

    return run


class _Chunk:
    """Tokens of a chunk and the sorted distinct keys that it counts.

    A token asks for three counts: of its bigram, of its word and of the word before it as a
    previous word.  Keys are hashes of 63 bits; the last bit tells words from the others.
    """

    def __init__(self, rows: bytes):
        self.table = pa.ipc.open_stream(rows).read_all()
        hashes = [WORD_HASHES.of(words(t.as_py())) for t in self.table.column("text")]
        self.lens = np.array([len(h) for h in hashes], np.int64)
        w = np.concatenate(hashes) if hashes else np.empty(0, U64)
        v = np.concatenate([[_START], w[:-1]]).astype(U64) if len(w) else w
        first = np.cumsum(self.lens) - self.lens
        v[first[self.lens > 0]] = _START
        odd = U64(1)
        keys = np.concatenate([mix(mix(v) ^ w) & ~odd, mix(w) | odd, mix(v ^ _PREVIOUS) & ~odd])
        self.keys, back = np.unique(keys, return_inverse=True)
        self.bigram, self.word, self.previous = back.reshape(3, -1)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of the keys in all documents and in target documents."""
        hit = np.repeat(self.table.column("is_target").to_numpy().astype(float), self.lens)
        asked = (self.bigram, self.word, self.previous)
        size = len(self.keys)
        return sum(np.bincount(x, minlength=size) for x in asked), sum(np.bincount(x, hit, size) for x in asked)


def _partial_counts(parts: int):
    """A row for each chunk and range of keys: its distinct keys with their counts."""

    def run(batches):
        for b in batches:
            for chunk, rows in zip(b.column("chunk").to_pylist(), b.column("rows")):
                c = _Chunk(rows.as_py())
                all_, target = c.counts()
                part = ((c.keys >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
                number, at = np.unique(part, return_index=True)
                out = [[], [], []]
                for i, j in zip(at, [*at[1:], len(part)]):
                    for kept, x in zip(out, (np.diff(c.keys[i:j], prepend=U64(0)), all_[i:j], target[i:j])):
                        kept.append(_squeezed(x))
                columns = [pa.array(number), pa.array([chunk] * len(number), pa.int64()), *(pa.array(x, pa.binary()) for x in out)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "keys", "cb", "ct"])

    return run


def _totals(table: pa.Table) -> pa.Table:
    """Counts over all chunks of one range of keys, given back to each chunk in the order of its own keys."""
    keys = [np.cumsum(_unsqueezed(k), dtype=U64) for k in table.column("keys").to_pylist()]
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    of_word = distinct & U64(1) == 1
    ends = np.cumsum([len(k) for k in keys])[:-1]
    out, tokens = {}, {}
    for c in ("cb", "ct"):
        total = np.bincount(back, np.concatenate([_unsqueezed(x) for x in table.column(c).to_pylist()]), len(distinct))
        out[c] = pa.array([_squeezed(x) for x in np.split(total[back], ends)], pa.binary())
        tokens[c] = int(total[of_word].sum())
    once = lambda n: pa.array([n] + [0] * (len(keys) - 1), pa.int64())  # sums over all rows are the whole corpus's
    columns = [table.column("chunk"), table.column("part"), out["cb"], out["ct"], once(int(of_word.sum())), once(tokens["cb"]), once(tokens["ct"])]
    return pa.table(columns, names=["chunk", "part", "cb", "ct", "words", "nb", "nt"])


def _chunk_scores(size: int, nb: int, nt: int, mu: float):
    def run(texts: pa.Table, totals: pa.Table) -> pa.Table:
        c = _Chunk(texts.column("rows")[0].as_py())
        totals = totals.sort_by("part")
        doc = np.repeat(np.arange(len(c.lens)), c.lens)
        entropies = []
        for name, n in (("ct", nt), ("cb", nb)):
            parts = [_unsqueezed(x) for x in totals.column(name).to_pylist()]
            count = np.concatenate(parts).astype(float) if parts else np.empty(0)
            p1 = (count[c.word] + 1) / (n + size)
            bits = -np.log2((count[c.bigram] + mu * p1) / (count[c.previous] + mu))
            mean = np.bincount(doc, bits, len(c.lens)) / np.maximum(c.lens, 1)
            entropies.append(pa.array(mean, pa.float64(), mask=c.lens == 0))
        return pa.table([c.table.column("doc_id"), pa.array(c.lens), *entropies], names=["doc_id", "n_tokens", "h_target", "h_background"])

    return run


def _every_word(texts: DataFrame, chosen: DataFrame, mu: float, chunk_bytes: int, part_bytes: int) -> DataFrame:
    """Scores with every word of the documents in the vocabulary.

    Texts are gathered to chunks, kept as a table.  A chunk sends each distinct key once, with its
    counts, to the key's range; the range adds them up and answers the chunk with the totals, in
    the chunk's own order and without keys.  The commonest bigram is thus one number a chunk.
    """
    # the target ids grow with the input: never a broadcast of them
    marked = texts.where("doc_id is not null").join(chosen.withColumn("hit", F.lit(True)).hint("merge"), "doc_id", "left")
    marked = marked.select("doc_id", "text", F.col("hit").isNotNull().alias("is_target"))
    marked = marked.union(texts.where("doc_id is null").select("doc_id", "text", F.lit(False)))
    chunks = saved(marked.mapInArrow(_chunks(chunk_bytes), "chunk bigint, size bigint, rows binary"), "op5-chunks")
    parts = 1 + (chunks.agg(F.sum("size")).first()[0] or 0) // part_bytes
    sent = chunks.select("chunk", "rows").mapInArrow(_partial_counts(parts), "part bigint, chunk bigint, keys binary, cb binary, ct binary")
    totals = sent.groupBy("part").applyInArrow(_totals, "chunk bigint, part bigint, cb binary, ct binary, words bigint, nb bigint, nt bigint")
    totals = saved(totals, "op5-totals")
    size, nb, nt = totals.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "nb", "nt"))).first()
    answers = totals.select("chunk", "part", "cb", "ct").groupBy("chunk")
    score = _chunk_scores(size + 1, nb, nt, mu)
    return chunks.select("chunk", "rows").groupBy("chunk").cogroup(answers).applyInArrow(score, "doc_id bigint, n_tokens bigint, h_target double, h_background double")


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, vocabulary: int | None = None, mu: float = 100.0, chunk_bytes: int = 8 << 20, part_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, n_tokens, h_target, h_background, score) for every document.

    ``target_ids``: a table with the doc_ids of the target documents; ``vocabulary``: number of
    words that are told apart, None for every word.  ``chunk_bytes`` and ``part_bytes`` only share
    out the work; raise both where the corpus is many terabytes, so that a chunk has many keys in a range.
    """
    spark = docs.sparkSession
    texts = doc_texts(docs)
    chosen = target_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    if vocabulary is None:
        return _every_word(texts, chosen, mu, chunk_bytes, part_bytes).withColumn("score", F.col("h_target") - F.col("h_background"))
    counted = texts.select("text").mapInArrow(_word_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    head = counted.orderBy(F.desc("n"), "word").limit(vocabulary).select("word").toPandas()
    ids = _Ids([w.encode("utf-8") for w in head["word"]])
    # the ids grow with the input: one plan at every size, never a broadcast of them
    target = _table(texts.join(chosen.hint("merge"), "doc_id", "left_semi"), ids)
    background = _table(texts, ids)
    models = spark.sparkContext.broadcast((log_probabilities(target, mu), log_probabilities(background, mu)))
    out = texts.mapInArrow(_scores(models, spark.sparkContext.broadcast(ids)), "doc_id bigint, n_tokens bigint, h_target double, h_background double")
    return out.withColumn("score", F.col("h_target") - F.col("h_background"))


def rounded(scores: DataFrame) -> DataFrame:
    """Entropies and score to six places, comparable between engines."""
    return scores.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("h_target", "h_background", "score")))


def cross_entropy_sql(vocabulary: int | None = None, mu: float = 100.0) -> str:
    """DuckDB twin over ``documents`` with the documents of ``labels.quality = 1`` as target."""
    limit = "" if vocabulary is None else f" LIMIT {vocabulary}"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS is_target,
    list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
tokens AS (SELECT rid, is_target, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM texts),
vocab AS (SELECT word, true AS known FROM (SELECT word, count(*) AS n FROM tokens GROUP BY word ORDER BY n DESC, word{limit})),
mapped AS (SELECT rid, coalesce(is_target, false) AS is_target, place, CASE WHEN known THEN word ELSE ' unknown' END AS w
  FROM tokens LEFT JOIN vocab USING (word)),
pairs AS (SELECT *, coalesce(lag(w) OVER (PARTITION BY rid ORDER BY place), ' start') AS v FROM mapped),
cells AS (SELECT v, w, count(*) FILTER (is_target) AS ct, count(*) AS cb FROM pairs GROUP BY v, w),
ones AS (SELECT w, sum(ct) AS ct, sum(cb) AS cb FROM cells GROUP BY w),
prevs AS (SELECT v, sum(ct) AS ct, sum(cb) AS cb FROM cells GROUP BY v),
total AS (SELECT coalesce(sum(ct), 0) AS ct, coalesce(sum(cb), 0) AS cb FROM ones),
size AS (SELECT (SELECT count(*) FROM vocab) + 1 AS n),
p AS (SELECT c.v, c.w,
    log2((c.ct + {mu} * (o.ct + 1) / (t.ct + s.n)) / (r.ct + {mu})) AS lt,
    log2((c.cb + {mu} * (o.cb + 1) / (t.cb + s.n)) / (r.cb + {mu})) AS lb
  FROM cells c JOIN ones o USING (w) JOIN prevs r USING (v), total t, size s),
sums AS (SELECT rid, count(*) AS n, -sum(lt) / count(*) AS ht, -sum(lb) / count(*) AS hb FROM pairs JOIN p USING (v, w) GROUP BY rid)
SELECT doc_id, coalesce(n, 0) AS n_tokens, round(ht, 6) AS h_target, round(hb, 6) AS h_background, round(ht - hb, 6) AS score
FROM texts LEFT JOIN sums USING (rid)
"""
