"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard, one line kept per component.

Lines are compared lower-cased (A-Z), trimmed and with white space collapsed; a line's set is its distinct
`shingle`-character strings, or the whole line if it is shorter. Equal lines fall together by a 64-bit hash
first. Lines that share a band of `rows` of their `bands * rows` minima are candidates: at similarity 0.8 the
chance to meet is 1 - (1 - 0.8^4)^10 = 0.995. Candidates are compared exactly on their sets, components are
found by distributed union-find, and of each component the first line by document id and line number stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.llm import graph
from cliploom.llm._util import Workspace, free_shuffles, mix, plain, text_slices, without_lines, work_units
from cliploom.llm.ngram_join import tally

_ODD = [np.uint64(int(x) | 1) for x in mix(np.arange(2000, 2064, dtype=np.uint64))]


def normal(line: str) -> bytes:
    return normal_bytes(line.encode().lower())


def normal_bytes(raw: bytes) -> bytes:
    """The line, in lower case, trimmed and with white space collapsed."""
    raw = raw.strip(b" \t\n\x0b\x0c\r")
    plain = b"  " not in raw and len(raw.translate(None, b"\t\n\x0b\x0c\r")) == len(raw)
    return raw if plain else b" ".join(raw.split())


def normals(text: bytes) -> list[bytes]:
    """normal() of each line of a text in UTF-8: most texts need one look, not one a line."""
    raw = text.lower()
    if b"  " not in raw and len(raw.translate(None, b"\t\x0b\x0c\r")) == len(raw):
        return [x.strip(b" ") for x in raw.split(b"\n")]
    return [normal_bytes(x) for x in raw.split(b"\n")]


def _hash(lines: list[bytes]) -> list[int]:
    import xxhash

    return [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in lines]


_CODE = mix(np.arange(1 << 16, dtype=np.uint64))


def shingles(lines: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k-character string of the lines (with repeats), lines in order, and each line's number of them."""
    texts = [x.decode("utf-8", "replace") for x in lines]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    n = np.maximum(size - k + 1, 0)
    n[(size < k) & (size > 0)] = 1
    out, at = np.empty(n.sum(), np.uint64), 0
    for a, b in _cache_sized(size):
        h = _shingles(texts[a:b], lines[a:b], size[a:b], k)
        out[at : at + len(h)] = h
        at += len(h)
    return out, n


def _cache_sized(size: np.ndarray, most: int = 1 << 15) -> list[tuple[int, int]]:
    """Ranges of lines of about `most` elements each, so that arrays of them stay in cache."""
    starts = np.cumsum(size) - size
    marks = np.unique(np.concatenate([np.searchsorted(starts, np.arange(0, size.sum(), most)), [len(size)]])).tolist()
    return list(zip(marks[:-1], marks[1:], strict=True))


def _shingles(texts: list[str], lines: list[bytes], size: np.ndarray, k: int) -> np.ndarray:
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    h = _CODE[code & np.uint32(0xFFFF)]
    if len(code) and code.max() > 0xFFFF:
        h = np.where(code > 0xFFFF, mix(code.astype(np.uint64)), h)
    many = max(0, len(code) - k + 1)
    at, left, out, length = 0, k, None, 1
    while left:  # the string as parts of power-of-two length; one multiplication and addition each
        if left & 1:
            part = h[at : at + many]
            out = part if out is None else out * _ODD[length % 31] + part
            at += length
        left >>= 1
        if left:
            h = h[: max(0, len(h) - length)] * _ODD[32 + length.bit_length()] + h[length:]
            length *= 2
    n = np.maximum(size - k + 1, 0)
    first = np.cumsum(size) - size
    h = mix(out[np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)])
    short = np.flatnonzero((size < k) & (size > 0))
    if len(short):
        extra = mix(np.array([x & 0xFFFFFFFFFFFFFFFF for x in _hash([lines[i] for i in short])], np.uint64))
        h = np.insert(h, (np.cumsum(n) - n)[short], extra)
    return h


def sets(lines: list[bytes], k: int) -> list[np.ndarray]:
    """Each line's distinct shingle hashes, sorted."""
    h, n = shingles(lines, k)
    out, cut = [], [0, *np.cumsum(n).tolist()]
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        x = h[a:b]
        x.sort()
        new = x[1:] != x[:-1]
        out.append(x if new.all() else x[np.concatenate([[True], new])])
    return out


def minima(h: np.ndarray, n: np.ndarray, perms: int) -> np.ndarray:
    """The least value of each line under `perms` permutations (odd multiples of 32-bit hashes): (perms, lines).

    n: each line's number of hashes, at least one.
    """
    h = (h >> np.uint64(32)).astype(np.uint32)
    odd = [np.uint32(int(x) >> 32 | 1) for x in _ODD]
    out = np.empty((perms, len(n)), np.uint32)
    ends = np.concatenate([[0], np.cumsum(n)])
    marks = np.unique(np.concatenate([np.searchsorted(ends[:-1], np.arange(0, len(h), 1 << 16)), [len(n)]]))  # lines at a time, to stay in cache
    for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
        cut, x = ends[a:b] - ends[a], h[ends[a] : ends[b]]
        v = np.empty_like(x)
        for p in range(perms):
            np.multiply(x, odd[p], out=v)
            out[p, a:b] = np.minimum.reduceat(v, cut)
    return out


def _occurrences(k: int, bands: int, rows: int):
    """(line hash, id, th, line number, band hashes) of each line that isn't blank; band hashes once a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches):
            out, fresh = [], {}
            for i, th, text in zip(s.column("id").to_pylist(), s.column("th").to_pylist(), s.column("text").cast(pa.binary()).to_pylist(), strict=True):
                lines = [(no, x) for no, x in enumerate(normals(text or b"")) if x]
                for (no, x), lh in zip(lines, _hash([x for _, x in lines]), strict=True):
                    out.append((lh, i, th, no, fresh.setdefault(lh, (len(fresh), x))[0]))
            if not out:
                continue
            low = minima(*shingles([x for _, x in fresh.values()], k), bands * rows).astype(np.uint64)
            lh, i, th, no, which = (np.array(c, np.int64) for c in zip(*out, strict=True))
            first = np.zeros(len(which), bool)
            first[np.unique(which, return_index=True)[1]] = True
            columns = [pa.array(x) for x in (lh, i, th, no)]
            for b in range(bands):
                v = np.full(len(fresh), b + 1, np.uint64)
                for r in range(rows):
                    v = mix(v ^ low[b * rows + r])
                columns.append(pa.array(v.view(np.int64)[which], mask=~first))
            yield pa.RecordBatch.from_arrays(columns, names=["lh", "id", "th", "no", *(f"b{b}" for b in range(bands))])

    return run


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines of each document, normalised."""
    for s in text_slices(batches):
        ids, lines = [], []
        for text, want in zip(s.column("text").cast(pa.binary()).to_pylist(), s.column("want").to_pylist(), strict=True):
            split = text.split(b"\n")
            ids += [w["lh"] for w in want]
            lines += [normal_bytes(split[w["no"]].lower()) for w in want]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.binary())], names=["id", "tokens"])


def removed(ws: Workspace, base: DataFrame, percent: int = 80, shingle: int = 10, bands: int = 10, rows: int = 4) -> DataFrame:
    """(id, th, gone array of line numbers) of the rows base(id, th, text) that lose lines."""
    spark = base.sparkSession
    units = work_units(base)
    band = [f"b{i}" for i in range(bands)]
    occ = ws.save(base.mapInArrow(_occurrences(shingle, bands, rows), "lh long, id long, th long, no long, " + ", ".join(f"{b} long" for b in band)))
    # Summed up before rows move, so that a line that very many documents hold is a few rows of any task.
    lines = ws.save(occ.groupBy("lh").agg(F.count("*").alias("n"), F.min(F.struct("id", "no", "th")).alias("first"), *[F.max(b).alias(b) for b in band]))
    free_shuffles(spark)
    bands_of, occ = occ, ws.save(occ.select("lh", "id", "th", "no"))
    ws.drop(bands_of)
    one = lines.select(F.col("lh").alias("id"), "first", *band)
    near = tally(one.select("id", *band), units).filter("shared > 0").select("id")
    near = ws.save(one.join(near.hint("shuffle_hash"), "id", "left_semi"))
    bands_of, lines = lines, ws.save(lines.select("lh", "n", "first"))
    ws.drop(bands_of)
    free_shuffles(spark)
    postings = near.select(F.explode(F.array(*band)).alias("sig"), "id")
    want = near.groupBy("first.id", "first.th").agg(F.collect_list(F.struct(F.col("id").alias("lh"), F.col("first.no").alias("no"))).alias("want"))
    items = ws.save(base.join(want.hint("shuffle_hash"), ["id", "th"]).select("text", "want").mapInArrow(_wanted, "id long, tokens binary"))
    free_shuffles(spark)
    comp = graph.similar(ws, postings, items, percent, units, unpack=partial(sets, k=shingle)).select(F.col("id").alias("lh"), F.col("component").alias("c"))
    ws.drop(items, near)
    linked = lines.join(comp.hint("shuffle_hash"), "lh").select("lh", "c", "first")
    equal = lines.filter("n > 1").join(comp, "lh", "left_anti").select("lh", F.col("lh").alias("c"), "first")
    groups = ws.save(linked.unionByName(equal))
    keep = groups.groupBy("c").agg(F.min("first").alias("k"))
    kept = groups.select("lh", "c").join(keep, "c").select("lh", "k")
    gone = occ.join(kept.hint("shuffle_hash"), "lh").filter("id <> k.id or th <> k.th or no <> k.no")
    gone = ws.save(gone.groupBy("id", "th").agg(F.collect_set(F.col("no").cast("int")).alias("gone")))
    ws.drop(occ, lines, groups)
    free_shuffles(spark)
    return gone


def _keys(id_col: str, text_col: str) -> dict:
    return {"id": F.coalesce(F.col(id_col), F.lit(-(2**63))), "th": F.xxhash64(id_col, text_col)}


def dedup(docs: DataFrame, percent: int = 80, shingle: int = 10, bands: int = 10, rows: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, n_lines, n_removed, kept_sha256, kept) for each row of docs.

    Removed are the lines that aren't the first of their component; kept is the text without them (null where
    nothing was removed), kept_sha256 the hash of its UTF-8 bytes. Blank lines always stay. Null and empty texts
    have no lines. Of equal lines in one document the first stays. Rows of equal id and text count as one
    document and get equal results, a row each. An empty table gives an empty result; a null id is one id like
    any other; extra columns are ignored. Lines whose 64-bit hashes agree count as equal.
    """
    ws = Workspace(docs.sparkSession, "lines")
    base = plain(docs, id_col, text_col).select(*(c.alias(k) for k, c in _keys(id_col, text_col).items()), F.col(text_col).alias("text"))
    gone = removed(ws, base, percent, shingle, bands, rows)
    split = F.split(F.col("text"), "\n")
    out = base.join(gone.hint("shuffle_hash"), ["id", "th"], "left").withColumn("kept", without_lines("text"))
    return out.select(
        F.when(F.col("id") != -(2**63), F.col("id")).alias("doc_id"), "th",
        F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("kept", "text", F.lit("")).cast("binary"), 256).alias("kept_sha256"), "kept",
    )


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with their texts' repeated lines taken out; a document that thereby has no line left goes.

    Rows of null, empty or blank text have no lines and stay as they are; a null id is one id like any other;
    repeated rows stay together; all columns are kept, whatever their names; an empty table gives an empty one.
    """
    ws = Workspace(docs.sparkSession, "lines")
    keys = _keys(id_col, text_col)
    gone = removed(ws, docs.select(*(c.alias(k) for k, c in keys.items()), F.col(text_col).alias("text")), **how)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *(c.alias(k) for k, c in keys.items()))
    rows = rows.join(gone.hint("shuffle_hash"), ["id", "th"], "left")
    rows = rows.withColumn("rest", without_lines(f"row.`{text_col}`"))
    rows = rows.filter(F.col("rest").isNull() | F.col("rest").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(*[F.coalesce("rest", f"row.`{c}`").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
