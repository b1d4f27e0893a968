"""Exact top-k search by BM25: inverted indexes with block maxima, dynamic pruning, exact merge.

Every input partition becomes one or more shards: an inverted index of its texts, written as a table row. N, the
average length and the query terms' document frequencies are those of the whole corpus, so scores don't depend on
the shards.

A shard is searched as in block-max WAND, for a block of queries at once. Each term's postings carry the greatest
impact of the term in every block of documents. Lists that hold a good part of the shard's documents can't be
skipped; they are scored first, as one matrix product over all documents, and the k-th best partial score is the
threshold. Documents whose partial score and block maxima of the other lists don't reach it are pruned; only what is
left is scored in full. If much is left, the other lists are added up first, which raises the threshold. A worker
that holds several shards carries the threshold over. Pruning works on rounded scores with a margin; full scores
are sums in a fixed order, equal to the last bit for equal texts in any shard. The shards' lists are merged exactly,
ties go to the smaller id.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cliploom.llm._util import Workspace, free_shuffles, plain, rows_at_a_time, text_slices, word_hashes

#: Words in a shard, at least, unless its partition ends.
SHARD = 2_500_000
#: Shards that a search task holds at once.
HELD = 3
#: Documents in a block.
BLOCK = 16
#: Lists with this part of a shard's documents are scored as a matrix.
LONG = 0.06
#: Relative margin for rounding in single precision.
MARGIN = 1e-4


def _runs(order_key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], order_key[1:] != order_key[:-1]])) if len(order_key) else np.empty(0, np.int64)


def _index(ids: np.ndarray, words: np.ndarray, offsets: np.ndarray) -> dict:
    """Terms (sorted hashes), their postings' starts, documents and frequencies, and the documents' lengths."""
    terms, t = np.unique(words, return_inverse=True)
    n = np.diff(offsets)
    key = np.sort(t.astype(np.int64) * len(ids) + np.repeat(np.arange(len(ids)), n))
    first = _runs(key)
    tf = np.diff(np.concatenate([first, [len(key)]]))
    key = key[first]
    term, doc = key // max(len(ids), 1), key % max(len(ids), 1)
    df = np.diff(np.searchsorted(term, np.arange(len(terms) + 1)))
    return {"ids": ids, "lens": _small(n), "terms": terms, "df": _small(df), "docs": _small(doc), "tf": _small(tf)}


def _small(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as the greatest needs."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    shard = TaskContext.get().partitionId() << 32
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        sizes = np.concatenate([np.diff(o) for _, _, o in held])
        x = _index(np.concatenate([i for i, _, _ in held]), np.concatenate([w for _, w, _ in held]), np.concatenate([[0], np.cumsum(sizes)]))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((shard, pa.int64()), (len(x["ids"]), pa.int64()), (int(x["lens"].sum(dtype=np.int64)), pa.int64()), (x["terms"].tobytes(), pa.binary()), (x["df"].astype(np.int64).tobytes(), pa.binary()), (pickle.dumps(x), pa.binary()))], names=["shard", "n", "words", "terms", "df", "payload"])

    for s in text_slices(batches):
        held.append((s.column("id").to_numpy().astype(np.int64), *word_hashes(s.column("text"))))
        if sum(len(w) for _, w, _ in held) >= SHARD:
            yield out()
            shard += 1
    if held:
        yield out()
    pa.default_memory_pool().release_unused()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for terms, df in zip(b.column("terms").to_pylist(), b.column("df").to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, np.int64)), pa.array(np.frombuffer(df, np.int64))], names=["term", "df"])


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in text_slices(batches):
        words, offsets = word_hashes(s.column("text"))
        query, term, count = [], [], []
        for i, a, b in zip(s.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            t, c = np.unique(words[a:b], return_counts=True)
            query.append(np.full(len(t), i, np.int64))
            term.append(t.view(np.int64))
            count.append(c.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (query, term, count)], names=["query_id", "term", "qtf"])


class Shard:
    """One shard's index, ready for search."""

    def __init__(self, x: dict, average: float, k1: float, b: float) -> None:
        self.ids, self.terms, self.n = x["ids"], x["terms"], len(x["ids"])
        df = x["df"].astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(df)])
        self.scale, self.gain = k1 * (1 - b + b * x["lens"].astype(np.float64) / average), k1 + 1
        self.docs = x["docs"]
        self.impact = (x["tf"] * self.gain / (x["tf"] + self.scale[self.docs])).astype(np.float32)
        term = np.repeat(np.arange(len(df), dtype=np.uint32), df)
        # Forward index: each document's postings in order of their terms.
        order = np.argsort(self.docs, kind="stable")
        self.own_terms, self.own_tf = term[order], x["tf"][order]
        del order
        self.own_starts = np.concatenate([[0], np.cumsum(np.bincount(self.docs, minlength=self.n))])
        # Long lists, as a dense matrix of documents by lists.
        self.long = np.flatnonzero(df >= max(LONG * self.n, 16))
        self.column = np.full(len(df), -1, np.int32)
        self.column[self.long] = np.arange(len(self.long))
        at, n = _gather(self.starts, self.long)
        self.matrix = np.zeros((self.n, len(self.long)), np.float32)
        self.matrix[self.docs[at], np.repeat(np.arange(len(self.long)), n)] = self.impact[at]
        # The greatest impact of each list in each block of documents.
        block = self.docs // BLOCK
        first = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (term[1:] != term[:-1])])) if len(block) else np.empty(0, np.int64)
        self.block = block[first]
        self.block_max = np.maximum.reduceat(self.impact, first) if len(first) else np.empty(0, np.float32)
        self.block_starts = np.searchsorted(term[first], np.arange(len(df) + 1))
        self.weight = np.zeros(len(df))

    def _full(self, docs: list[int]) -> list[float]:
        """Scores by the weights that are set, each a sum over the document's terms in order."""
        out = []
        for d in docs:
            s = slice(self.own_starts[d], self.own_starts[d + 1])
            tf = self.own_tf[s].astype(np.float64)
            out.append(float(np.add.reduce(self.weight[self.own_terms[s]] * (tf * self.gain / (tf + self.scale[d])))))
        return out

    def search(self, queries: list[tuple[int, np.ndarray, np.ndarray]], k: int, floors: list[float]) -> list[list[tuple[int, float]]]:
        """The best (id, score) of each (query, terms, weights): all that can be among the k best.

        floors: scores that k documents of other shards reach, raised in place.
        """
        found = []
        for _, terms, weights in queries:
            at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
            hit = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
            found.append((at[hit], weights[hit]))
        dense = np.zeros((len(queries), len(self.long)), np.float32)
        for row, (rows, w) in zip(dense, found, strict=True):
            long = self.column[rows] >= 0
            row[self.column[rows[long]]] = w[long]
        scores = dense @ self.matrix.T
        out = []
        for i, (rows, w) in enumerate(found):
            out.append(self._one(rows, w, scores[i], k, floors, i) if len(rows) else [])
        return out

    def _one(self, rows: np.ndarray, w: np.ndarray, score: np.ndarray, k: int, floors: list[float], i: int) -> list[tuple[int, float]]:
        short = self.column[rows] < 0
        left, lw = rows[short], w[short]
        kth = lambda x: float(np.partition(x, -k)[-k]) if len(x) > k else 0.0
        margin = 1 - MARGIN
        floor = max(floors[i], kth(score) * margin)
        if len(left):
            at, n = _gather(self.block_starts, left)
            bound = np.bincount(self.block[at], weights=self.block_max[at] * np.repeat(lw, n), minlength=self.n // BLOCK + 1) / margin
            reach = score + np.repeat(bound, BLOCK)[: self.n]
        else:
            reach = score
        live = np.flatnonzero((reach >= floor * margin) & (reach > 0))
        if len(live) > 4 * k and len(left):
            at, n = _gather(self.starts, left)
            score = score + np.bincount(self.docs[at], weights=self.impact[at] * np.repeat(lw, n), minlength=self.n)
            floor = max(floor, kth(score) * margin)
            live = np.flatnonzero((score >= floor * margin) & (score > 0))
        self.weight[rows] = w
        full = self._full(live.tolist())
        self.weight[rows] = 0.0
        best = sorted(((s, int(self.ids[d])) for s, d in zip(full, live.tolist(), strict=True) if s > 0), key=lambda x: (-x[0], x[1]))[:k]
        if len(best) == k:
            floors[i] = max(floors[i], best[-1][0])
        return [(d, s) for s, d in best]


def _gather(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows' entries, and how many each has."""
    n = starts[rows + 1] - starts[rows]
    return np.arange(n.sum()) + np.repeat(starts[rows] - (np.cumsum(n) - n), n), n


def _search(k: int, k1: float, b: float, average: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, shards = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                g, kind = batch.column("g")[at].as_py(), batch.column("kind")[at].as_py()
                if g != group:
                    group, shards = g, []
                held = pickle.loads(batch.column("payload")[at].as_buffer())
                if kind == 0:
                    shards.append(Shard(held, average, k1, b))
                    continue
                held = _unpacked(held)
                found, floors = [[] for _ in held], [0.0] * len(held)
                for s in shards:
                    for all_, some in zip(found, s.search(held, k, floors), strict=True):
                        all_ += some
                rows = [(q[0], d, x) for q, some in zip(held, found, strict=True) for d, x in sorted(some, key=lambda x: (-x[1], x[0]))[:k]]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "doc_id", "score"])

    return run


def _packed(held: list[tuple[int, list, list, list]]) -> pa.RecordBatch:
    """A block of queries as a row: the distinct terms and their weights once, and each query's terms by number."""
    size = np.array([len(t) for _, t, _, _ in held], np.int64)
    term, qtf, idf = (np.concatenate([np.array(x[i], kind) for x in held]) for i, kind in ((1, np.int64), (2, np.int64), (3, np.float64)))
    terms, at, number = np.unique(term.view(np.uint64), return_index=True, return_inverse=True)
    order = np.lexsort((number, np.repeat(np.arange(len(held)), size)))
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(([q for q, *_ in held], size, _small(number[order]), _small(qtf[order]), terms, idf[at]))], pa.binary())], names=["payload"])


def _unpacked(payload: tuple) -> list[tuple[int, np.ndarray, np.ndarray]]:
    ids, size, number, qtf, terms, idf = payload
    ends = np.cumsum(size)
    return [(q, terms[number[e - n : e]], qtf[e - n : e] * idf[number[e - n : e]]) for q, n, e in zip(ids, size.tolist(), ends.tolist(), strict=True)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of queries, about 60,000 terms each."""
    held, size = [], 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("query_id", "t", "qtf", "idf")), strict=True):
            held.append(row)
            size += len(row[1])
            if size > 60_000:
                yield _packed(held)
                held, size = [], 0
    if held:
        yield _packed(held)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query, best first, ties to the smaller id.

    Words are lower-cased (A-Z) and split at ASCII white space; a query word counts as often as it stands in the
    query. score = sum of qtf * ln(1 + (N - df + 0.5) / (df + 0.5)) * tf (k1 + 1) / (tf + k1 (1 - b + b len / avg)).
    Documents that share no word with a query aren't returned; null and empty texts find nothing and aren't
    found, but count in N; rows of equal id are documents of their own; queries of equal id are joined into one;
    rows with a null id are left out; an empty table gives an empty result; extra columns are ignored.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "bm25")
    rows = plain(docs, id_col, text_col).toDF("id", "text").filter("id is not null")
    with rows_at_a_time(spark, 1000):
        index = ws.save(rows.mapInArrow(_build, "shard long, n long, words long, terms binary, df binary, payload binary"))
    total = index.agg(F.sum("n"), F.sum("words"), F.count("*")).first()
    n, words, shards = total[0] or 0, total[1] or 0, total[2]
    average = max(words / n, 1e-9) if n else 1.0
    df = index.select("terms", "df").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    asked = plain(queries, id_col, text_col).toDF("id", "text").filter("id is not null")
    asked = asked.mapInArrow(_query_terms, "query_id long, term long, qtf long").groupBy("query_id", "term").agg(F.sum("qtf").alias("qtf"))
    weighed = asked.join(df, "term").withColumn("idf", F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    blocks = weighed.groupBy("query_id").agg(F.collect_list(F.struct("term", "qtf", "idf")).alias("x")).select("query_id", F.col("x.term").alias("t"), F.col("x.qtf").alias("qtf"), F.col("x.idf").alias("idf"))
    with rows_at_a_time(spark, 1000):
        blocks = ws.save(blocks.mapInArrow(_blocks, "payload binary"))
    groups = max(1, -(-shards // HELD))
    own = F.pmod(F.shiftright("shard", 32) + F.col("shard").bitwiseAND(0xFFFF), F.lit(groups)).cast("int")
    placed = index.select(own.alias("g"), F.lit(0).alias("kind"), "payload")
    sent = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("kind"), "payload")
    ordered = placed.unionByName(sent).repartitionByRange(groups, "g").sortWithinPartitions("g", "kind")
    free_shuffles(spark)
    with rows_at_a_time(spark, 1):
        found = ws.save(ordered.mapInArrow(_search(k, k1, b, average), "query_id long, doc_id long, score double"))
    ws.drop(index, blocks)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
