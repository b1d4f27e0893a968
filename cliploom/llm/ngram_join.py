"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its k-word shingles (64-bit hashes). Two documents link when
100 * |intersection| >= percent * |union|. The join runs in four steps.

1. Prune. A document of n shingles can only link if at least t = ceil(percent * n / 100) of its shingles
   occur elsewhere, so documents with too many unique shingles leave before anything is indexed. Shingles are
   counted in groups by hash range; each Python batch counts its own repeats first, so a shingle held by a
   third of all documents reaches a group once a batch, not once a document.
2. Collapse. Documents with equal sets become one representative; pruning is then repeated on those.
3. Index. Shingles are ordered rare first. Those of document frequency up to `classes[0][0]` are indexed
   singly, more frequent classes by combinations of k tokens. Let c_j be the number of a document's prefix
   tokens in class j (of combination size k_j); the prefix is extended until
   sum_j max(0, c_j - k_j + 1) >= n - t + 1. If x and y link, take the one whose prefix ends first in the
   common order: its shared prefix tokens all lie in the other's prefix, and fewer than k_j of them in every
   class would leave more than n - t unshared tokens. So the two share a combination. Frequent classes are
   cut by hash into parts that hold about three prefix tokens each, which keeps the combinations linear in
   the text; the parts depend on the power of two below n, and a document near the next power signs for both.
4. Verify candidates on the sets (see graph.similar).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.llm import graph
from cliploom.llm._util import Workspace, free_shuffles, mix, plain, shingle_sets, text_slices, word_hashes, work_units

#: (largest document frequency, tokens in a combination), rare first.
CLASSES = ((64, 1), (4096, 2), (1 << 62, 3))


def needed(n, percent: int):
    """Least overlap of a set of n elements with any set that it links with."""
    return (percent * n + 99) // 100


def _sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(*word_hashes(batch.column("text")), k)


def _blob_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    blobs = batch.column("tokens").to_pylist()
    d = np.repeat(np.arange(len(blobs)), [len(b) // 8 for b in blobs])
    return d, np.frombuffer(b"".join(blobs), np.uint64)


#: Hash ranges at least: a document's tokens meet many ranges at any size, so the tally's rows grow as the tokens.
FEWEST = 64

#: Ids from here on stand for rows without one, by the hash of their text: greater than any id.
UNNAMED = 1 << 62

CELLS = "bucket int, ids binary, sizes binary, home binary, counts binary, tokens binary, shared binary"


def _column_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    names = [c for c in batch.schema.names if c != "id"]
    return np.repeat(np.arange(batch.num_rows), len(names)), np.stack([batch.column(c).to_numpy() for c in names], axis=1).reshape(-1).view(np.uint64)


def _row_slices(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _cells(units: int, k: int, kind: str):
    """Map side of pruning: this batch's tokens by hash range, once each; 6 bytes a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, kind) if kind else _row_slices(batches):
            d, h = _column_sets(b) if not kind else _blob_sets(b) if kind == "tokens" else _sets(b, k)
            ids = b.column("id").to_numpy().astype(np.int64)
            n = np.bincount(d, minlength=len(ids)).astype(np.int64)
            value, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
            again = count[inverse] > 1
            here = np.bincount(d[again], minlength=len(ids)).astype(np.int64)  # tokens known to be shared
            home = (mix(ids.astype(np.uint64)) % np.uint64(units)).astype(np.int64)
            d1, h1, d2, h2 = d[~again], h[~again], None, value[count > 1]
            b1 = ((h1 >> np.uint64(32)) * np.uint64(units) >> np.uint64(32)).astype(np.int64)
            b2 = ((h2 >> np.uint64(32)) * np.uint64(units) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(b1 * (len(ids) + 1) + d1, kind="stable")
            d1, h1, b1 = d1[order], h1[order], b1[order]
            c1, c2 = np.searchsorted(b1, np.arange(units + 1)), np.searchsorted(b2, np.arange(units + 1))
            by_home = np.argsort(home, kind="stable")
            ch = np.searchsorted(home[by_home], np.arange(units + 1))
            low6 = lambda x: np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
            rows = []
            for u in range(units):
                s, own = slice(c1[u], c1[u + 1]), by_home[ch[u] : ch[u + 1]]
                if s.start == s.stop and c2[u] == c2[u + 1] and not len(own):
                    continue
                doc, counts = np.unique(d1[s], return_counts=True)
                rows.append((u, ids[doc].tobytes(), counts.astype(np.uint32).tobytes(), ids[own].tobytes(), np.stack([n[own], here[own]]).tobytes(), low6(h1[s]), low6(h2[c2[u] : c2[u + 1]])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 6, strict=True)], names=[c.split()[0] for c in CELLS.split(", ")])

    return run


def _tally(table: pa.Table) -> pa.Table:
    """Reduce side: for each document of this hash range, its size (at its home) and its shared tokens."""
    wide = lambda name: _six(b"".join(table.column(name).to_pylist()))
    ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), np.int64)
    sizes = np.frombuffer(b"".join(table.column("sizes").to_pylist()), np.uint32)
    single, shared = wide("tokens"), np.unique(wide("shared"))
    order = np.argsort(single, kind="stable")
    s = single[order]
    twin = np.zeros(len(s), bool)
    if len(s):
        same = s[1:] == s[:-1]
        twin[1:] |= same
        twin[:-1] |= same
        if len(shared):
            twin |= shared[np.minimum(np.searchsorted(shared, s), len(shared) - 1)] == s
    found = np.empty(len(s), bool)
    found[order] = twin
    of = np.repeat(np.arange(len(ids)), sizes)
    c = np.bincount(of[found], minlength=len(ids)).astype(np.int64)
    home = np.frombuffer(b"".join(table.column("home").to_pylist()), np.int64)
    counts = [np.frombuffer(x, np.int64).reshape(2, -1) for x in table.column("counts").to_pylist()]
    n, here = np.concatenate(counts, axis=1) if counts else np.zeros((2, 0), np.int64)
    seen = c > 0
    none = np.zeros(seen.sum(), np.int64)
    return pa.table({"id": np.concatenate([home, ids[seen]]), "n": np.concatenate([n, none]), "shared": np.concatenate([here, c[seen]]), "times": np.concatenate([np.ones(len(home), np.int64), none])})


def _six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def tally(rows: DataFrame, units: int, k: int = 0) -> DataFrame:
    """(id, n, shared, times): size of each row's set, how many of its tokens other rows hold too, and rows of the id.

    rows: (id, text), (id, tokens) with 8 bytes a token, or id and bigint columns of one token each. shared may be too large by hash collisions, never
    too small. Several rows of one id count as rows that share.
    """
    kind = next((c for c in ("tokens", "text") if c in rows.columns), "")
    cells = rows.mapInArrow(_cells(max(units, FEWEST), k, kind), CELLS)
    parts = cells.groupBy("bucket").applyInArrow(_tally, "id long, n long, shared long, times long")
    return parts.groupBy("id").agg(F.max("n").alias("n"), F.sum("shared").alias("shared"), F.sum("times").alias("times"))


def _tokens(k: int):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            d, h = _sets(b, k)
            cut = np.searchsorted(d, np.arange(b.num_rows + 1))
            blobs = [h[cut[i] : cut[i + 1]].tobytes() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in blobs], pa.binary()), pa.array(blobs, pa.binary())], names=["id", "key", "tokens"])

    return run


def _signatures(percent: int, classes: tuple):
    """Signatures of one document's extended prefix; see the module's text for why linked documents share one."""

    def sign(n: int, h: np.ndarray, df: np.ndarray) -> set[int]:
        goal, unique = n - needed(n, percent) + 1, n - len(h)
        if unique >= goal or not len(h):
            return set()
        order = np.lexsort((h, df))
        h, df = h[order], df[order]
        kind = np.searchsorted([c[0] for c in classes], df)
        out: set[int] = set()
        for level in {n.bit_length(), (n * 100 // percent).bit_length()}:
            parts = max(1, (1 << level) * (100 - percent) // 300)
            seen: dict[tuple[int, int], list[int]] = {}
            got = unique
            for token, j in zip(h.tolist(), kind.tolist(), strict=True):
                if got >= goal:
                    break
                k = classes[j][1]
                held = seen.setdefault((j, token % parts if k > 1 else 0), [])
                held.append(token)
                got += k == 1 or len(held) >= k
            for (j, part), held in seen.items():
                k = classes[j][1]
                if k == 1:
                    out.update(held)
                else:
                    out.update(hash((level, part, *sorted(c))) for c in combinations(held, k))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sigs = [], []
            for i, n, h, df in zip(*(b.column(c).to_pylist() for c in ("id", "n", "h", "df")), strict=True):
                found = sign(n, np.array(h, np.int64).view(np.uint64), np.array(df, np.int64))
                ids += [i] * len(found)
                sigs += [s & 0xFFFFFFFFFFFFFFFF for s in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(sigs, np.uint64).view(np.int64)), pa.array(ids, pa.int64())], names=["sig", "id"])

    return run


def join(docs: DataFrame, k: int = 5, percent: int = 80, classes: tuple = CLASSES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    component_id is the smallest id reachable by links, the row's own id included. Null, empty and wordless
    texts have no shingles and link with nothing. Texts of fewer than k words are one shingle. Rows with equal
    text link with each other; rows of one id are one document and get equal results, a row each. Rows with a null
    id are documents too, one for each text; their component_id is null unless they link with a row that has an id.
    An empty table gives an empty result; extra columns are ignored. Ids must be under 2**62 (UNNAMED).
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "join")
    rows = plain(docs, id_col, text_col).toDF("id", "text")
    own = F.xxhash64("text").bitwiseAND(F.lit(UNNAMED - 1)).bitwiseOR(F.lit(UNNAMED))
    rows = rows.withColumn("id", F.coalesce(F.col("id").cast("long"), own))
    units = work_units(rows)
    sizes = ws.save(tally(rows, units, k))
    free_shuffles(spark)
    live = sizes.filter((F.col("n") > 0) & (F.col("shared") >= needed_col("n", percent)))
    sets = ws.save(rows.hint("merge").join(live.select("id"), "id", "left_semi").mapInArrow(_tokens(k), "id long, key binary, tokens binary"))
    free_shuffles(spark)
    members = ws.save(sets.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("m")))
    member_of = ws.save(sets.select("id", "key").hint("merge").join(members, "key").select("id", "rep").distinct())
    reps = ws.save(sets.hint("merge").join(members.select(F.col("rep").alias("id"), "key"), ["id", "key"], "left_semi").dropDuplicates(["id"]).select("id", "tokens"))
    left = tally(reps, units)
    kept = left.filter(F.col("shared") >= needed_col("n", percent)).select("id", "n")
    work = ws.save(reps.hint("merge").join(kept, "id"))
    ws.drop(reps, sets)
    exploded = ws.save(work.mapInArrow(_explode, "id long, n long, h long"))
    df = exploded.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    listed = exploded.hint("merge").join(df, "h").groupBy("id", "n").agg(F.collect_list(F.struct("h", "df")).alias("t")).select("id", "n", F.col("t.h").alias("h"), F.col("t.df").alias("df"))
    postings = ws.save(listed.mapInArrow(_signatures(percent, classes), "sig long, id long"))
    ws.drop(exploded)
    free_shuffles(spark)

    comp = graph.similar(ws, postings, work.select("id", "tokens"), percent, units)
    ws.drop(work, postings, members)
    free_shuffles(spark)
    # A rep is the smallest id of its class, so the smallest rep of a component is the smallest id in it.
    found = member_of.join(comp.withColumnRenamed("id", "rep"), "rep", "left").groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    out = sizes.select("id", "n", "times").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    out = out.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))))
    named = lambda c: F.when(F.col(c) < UNNAMED, F.col(c))
    return out.select(named("id").alias("doc_id"), F.col("n").alias("n_shingles"), named("component").alias("component_id"))


def needed_col(n: str, percent: int):
    return F.floor((F.lit(percent) * F.col(n) + 99) / 100)


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_slices(batches, "tokens"):
        d, h = _blob_sets(b)
        yield pa.RecordBatch.from_arrays([pa.array(b.column("id").to_numpy()[d]), pa.array(b.column("n").to_numpy()[d]), pa.array(h.view(np.int64))], names=["id", "n", "h"])
