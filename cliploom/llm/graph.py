"""Distributed union-find: connected components, and components of a similarity graph given by postings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cliploom.llm._util import Workspace


def _marked(ws: Workspace, edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """edges written, with their number and a hash of them, observed while writing."""
    seen = Observation()
    kept = ws.save(edges.observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")))
    return kept, (seen.get["n"], seen.get["x"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's links as links to its components' smallest members: the same components, fewer and shorter paths."""
    for b in batches:
        root: dict[int, int] = {}
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            while (x := root.setdefault(u, u)) != u:
                root[u] = u = root[x]
            while (x := root.setdefault(v, v)) != v:
                root[v] = v = root[x]
            if u != v:
                root[max(u, v)] = min(u, v)
        for u in sorted(root):  # smaller ones first, so that one step reaches the root
            root[u] = root[root[u]]
        rows = [(u, v) for u, v in root.items() if u != v]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["u", "v"])


def components(ws: Workspace, links: DataFrame) -> DataFrame:
    """(id, component) for every id in links(a, b); component is the smallest id reachable.

    Alternates large-star and small-star steps, so the rounds grow with the logarithm of the graph's
    diameter; nothing is gathered on the driver but two numbers a round. Links with a null end are ignored,
    repeated and self links are harmless, no links give an empty table.
    """
    first = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v and a is not null and b is not null")
    edges, mark = _marked(ws, first.mapInArrow(_contract, "u long, v long").distinct())
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        held = large.join(low, "u")
        small = held.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        before, (after, now) = edges, _marked(ws, small.distinct())
        ws.drop(before)
        edges, same, mark = after, now == mark, now
        if same:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _resolve(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (row, row) that join the rows' components; sets are sorted distinct tokens.

    Rows are compared with all others through an inverted index, the most central first. A row need not be
    compared if it is in the largest component of those not yet compared, so like rows cost one pass, not all pairs.
    """
    m, size = len(sets), np.array([len(x) for x in sets], np.int64)
    if m == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if both and 100 * both >= percent * (size.sum() - both) else []
    col = np.unique(np.concatenate(sets), return_inverse=True)[1]
    row = np.repeat(np.arange(m), size)
    begin = np.concatenate([[0], np.cumsum(size)])
    by_col = row[np.argsort(col, kind="stable")]
    count = np.bincount(col)
    start = np.cumsum(count) - count
    central = np.bincount(row, weights=count[col], minlength=m) / np.maximum(size, 1)
    order = np.argsort(-central, kind="stable")
    label, todo, links = np.arange(m), np.ones(m, bool), []
    x = int(order[0]) if m > 1 else None
    while x is not None:
        todo[x] = False
        c = col[begin[x] : begin[x + 1]]
        n = count[c]
        at = np.arange(n.sum()) + np.repeat(start[c] - (np.cumsum(n) - n), n)
        both = np.bincount(by_col[at], minlength=m)
        near = np.flatnonzero((100 * both >= percent * (size + size[x] - both)) & (both > 0) & (label != label[x]))
        for y in near[np.unique(label[near], return_index=True)[1]].tolist():
            links.append((x, y))
        if len(near):
            label[np.isin(label, label[near])] = label[x]
        rest = order[todo[order]]
        if not len(rest):
            break
        most = np.bincount(label[rest], minlength=m).argmax()
        rest = rest[label[rest] != most]
        x = int(rest[0]) if len(rest) else None
    return links


def hashes(blobs: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in blobs]


def _resolve_bucket(percent: int, unpack: Callable[[list[bytes]], list[np.ndarray]]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("i", "ascending"), ("j", "ascending"), ("id", "ascending")])
        key = np.stack([table.column(c).to_numpy() for c in ("cluster", "i", "j")])
        ids = table.column("id").to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
        a, b = [], []
        begin, ends, many = 0, [*cut[1:].tolist(), len(ids)], table.column("tokens").to_pylist()
        for k, (s, e) in enumerate(zip(cut.tolist(), ends, strict=True)):
            if s >= begin:  # unpack whole clusters, about a thousand rows at a time
                done = max(e, next((x for x in ends[k:] if x >= s + 1000), ends[-1]))
                held, at, begin = unpack(many[s:done]), s, done
            for x, y in _resolve(held[s - at : e - at], percent):
                a.append(int(ids[s + x]))
                b.append(int(ids[s + y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def similar(ws: Workspace, postings: DataFrame, items: DataFrame, percent: int, units: int, unpack: Callable[[list[bytes]], list[np.ndarray]] = hashes, block: int = 8_000_000) -> DataFrame:
    """(id, component) of the links among ids that share a posting; ids without a link aren't returned.

    postings(sig, id): ids with a common sig are candidates. items(id, tokens): what unpack makes each id's sorted
    distinct tokens from (8 bytes a token, if it isn't given). Ids link when 100 * |intersection| >= percent * |union|. The candidates' connected
    clusters are compared inside workers; a cluster of more than `block` bytes is cut into blocks by hash, and
    every two blocks meet in a worker, so the rows in a worker are bounded and no pair is left out. Small clusters
    share `units` buckets; two blocks of a large one are a bucket of their own, so a task holds two blocks at a time.
    """
    marks = postings.groupBy("sig").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(7))).alias("y"), F.min("id").alias("lead")
    )
    once = marks.filter("n > 1").groupBy("n", "x", "y").agg(F.min("sig").alias("sig"), F.first("lead").alias("lead"))  # one posting of those with equal members
    clusters = components(ws, postings.join(once.select("sig", "lead"), "sig").select(F.col("id").alias("a"), F.col("lead").alias("b")))
    rows = ws.save(items.hint("merge").join(clusters.withColumnRenamed("component", "cluster"), "id").select("id", "cluster", "tokens"))
    blocks = rows.groupBy("cluster").agg(F.ceil(F.sum(F.octet_length("tokens")) / block).alias("blocks"))
    placed = rows.join(blocks, "cluster").withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
    other = F.when(F.col("blocks") < 2, F.array(F.lit(0).cast("long"))).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda x: x != F.col("own")))
    placed = placed.withColumn("other", F.explode(other))
    placed = placed.select("id", "cluster", "blocks", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "tokens")
    spot = F.xxhash64("cluster", "i", "j")
    placed = placed.withColumn("bucket", F.when(F.col("blocks") < 2, F.pmod(spot, F.lit(units))).otherwise(spot)).drop("blocks")
    links = ws.save(placed.groupBy("bucket").applyInArrow(_resolve_bucket(percent, unpack), "a long, b long"))
    found = ws.save(components(ws, links))
    ws.drop(rows, links)
    return found
