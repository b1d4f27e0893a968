"""Suffix-array dedup: removes text covered by long strings that occur more than once in a corpus.

Every string of `width` bytes belongs to the anchor that it selects by its own content: the leftmost gram of
least hash inside it. The strings of one document that select the same anchor position form one region (the
anchor's surroundings), and equal strings anywhere select anchors of equal hash. So the corpus splits into
independent groups by anchor hash, without any string being cut:

1. A pass over the texts lists anchors: (gram hash, hash of the region, document, region). About one anchor
   per 185 bytes, no text. Equal regions of a slice of documents are one row with their number; which of its
   documents hold them stays in one row a slice, so a passage in very many documents is a row a slice.
2. Anchors that occur once can't hold a repeat and go. Equal regions are counted and become one class.
3. (Regions of an anchor over GROUP bytes are cut into blocks; every two blocks meet in a worker, so groups are
   bounded and no pair of regions is left out.) Only one representative of each class of a shared anchor brings its region's bytes. In each bin of anchor
   hashes an enhanced suffix array is built over the suffixes whose first `width` bytes recur; a stack scan of
   its common-prefix interval tree tests each interval for left-extension diversity and yields the maximal
   repeats with all occurrences.
4. The classes' spans go back to the slices, there to every document of the classes, are merged, and are cut out.

Passages counted in words go the same way with words for bytes: each is its 64-bit hash, whatever its length and the
white space around it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.llm._util import Workspace, free_shuffles, mix, plain, text_slices, word_hashes, work_units

#: Bytes, and words, of the grams that anchors are.
GRAM, WORDS = 32, 8
#: Bytes of different regions about one anchor that are compared in one worker; more are cut into blocks by hash.
GROUP = 8 << 20
#: Bytes that code a word.
CODE = 8
_BYTE = mix(np.arange(256, dtype=np.uint64))
_ODD = [np.uint64(int(x) | 1) for x in mix(np.arange(1000, 1064, dtype=np.uint64))]


def _doubled(b: np.ndarray, width: int, only: tuple[int, ...] = ()) -> dict[int, np.ndarray]:
    """Hashes of the power-of-two strings at every position (short at the end: meaningless there); b: bytes or words."""
    out, size, h = {}, 1, _BYTE[b] if b.dtype == np.uint8 else mix(b)
    while True:
        if not only or size in only:
            out[size] = h
        if size * 2 > width:
            return out
        nxt = h * _ODD[size.bit_length()]
        nxt[:-size] += h[size:]
        h = mix(nxt)
        size *= 2


def window_hash(b: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the `width` bytes or words at every position where they exist."""
    if len(b) < width:
        return np.empty(0, np.uint64)
    sizes = tuple(1 << i for i in range(width.bit_length()) if width >> i & 1)
    by, out, at = _doubled(b, width, sizes), None, 0
    count = len(b) - width + 1
    for size in reversed(sizes):
        part = by[size][at : at + count]
        out = part if out is None else mix(out * _ODD[32 + size.bit_length()] + part)
        at += size
    return out


def _worded(raw: bytes, spans) -> list[tuple[int, int]]:
    """Spans of raw in bytes from those in words."""
    at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    return [(at[s][0], at[e - 1][1]) for s, e in _merged(spans, True)]


def _units(col: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes (or words' hashes) of a slice and its row offsets; null is empty."""
    if words:
        return word_hashes(col, lower=False)
    texts = [t if t is not None else b"" for t in col.cast(pa.binary()).to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def regions(b: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, gram hash, region start, region end) of every anchor; positions are in b."""
    w = width - gram + 1
    size = np.diff(offsets)
    ok = np.repeat(offsets[1:], size) - np.arange(len(b)) >= width
    starts = np.flatnonzero(ok)
    if not len(starts):
        return (np.empty(0, np.int64), np.empty(0, np.uint64), starts, starts)
    h = _doubled(b, gram, (gram,))[gram]
    key = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(b), dtype=np.uint64)
    pad = -len(key) % w
    grid = np.concatenate([key, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, w)
    head = np.minimum.accumulate(grid, axis=1).reshape(-1)
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    anchor = (np.minimum(tail[starts], head[starts + w - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.concatenate([cut[1:], [len(starts)]]) - 1
    lo, hi = starts[cut], starts[last] + width
    return np.searchsorted(offsets, lo, side="right") - 1, h[anchor[cut]], lo, hi


ANCHORS = "batch long, no int, h long, rh long, n long, id long, th long, lo long, hi long, docs binary, held binary"


def _anchors(width: int, gram: int, words: bool = False):
    """A row for each different region of a slice, with its number and first occurrence, and one of all occurrences."""
    import xxhash
    from pyspark import TaskContext

    names = [c.split()[0] for c in ANCHORS.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in ANCHORS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        for s in text_slices(batches):
            b, offsets = _units(s.column("text"), words)
            row, h, lo, hi = regions(b, offsets, width, gram)
            if not len(row):
                continue
            view, unit = memoryview(np.ascontiguousarray(b).view(np.uint8)), b.itemsize
            rh = np.fromiter((xxhash.xxh3_64_intdigest(view[x * unit : y * unit]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)), np.uint64, len(lo))
            ids, th = s.column("id").to_numpy(), s.column("th").to_numpy()
            lo, hi = lo - offsets[row], hi - offsets[row]
            order = np.lexsort((lo, th[row], ids[row], rh, h))
            h, rh, row, lo, hi = (x[order] for x in (h, rh, row, lo, hi))
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (rh[1:] != rh[:-1])])
            at = np.flatnonzero(new)
            n = np.diff(np.concatenate([at, [len(h)]]))
            different = [np.full(len(at), batch), np.arange(len(at)), h[at].view(np.int64), rh[at].view(np.int64), n, ids[row[at]], th[row[at]], lo[at], hi[at]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(different, types, strict=False)), *(pa.nulls(len(at), t) for t in types[9:])], names=names)
            docs, held = np.stack([ids, th]).astype(np.int64), np.stack([np.cumsum(new) - 1, row, lo]).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([batch], types[0]), *(pa.nulls(1, t) for t in types[1:9]), pa.array([docs.tobytes()], types[9]), pa.array([held.tobytes()], types[10])], names=names)
            batch += 1

    return run


def _placed(words: bool):
    """A slice's classes' spans (no, s, e) as spans of its documents."""
    kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for docs, held, spots in zip(*(b.column(c).to_pylist() for c in ("docs", "held", "spots")), strict=True):
                ids, th = np.frombuffer(docs, np.int64).reshape(2, -1)
                which, row, lo = np.frombuffer(held, np.uint32).reshape(3, -1)
                known: dict[int, list] = {}
                for x in spots:
                    known.setdefault(x["no"], []).append((x["s"], x["e"]))
                out: dict[int, list] = {}
                for i in np.flatnonzero(np.isin(which, list(known))).tolist():
                    start = int(lo[i])
                    out.setdefault(int(row[i]), []).extend((start + x, start + y) for x, y in known[int(which[i])])
                if out:
                    found = [[{"s": x, "e": y} for x, y in _merged(spans, words)] for spans in out.values()]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[list(out)]), pa.array(th[list(out)]), pa.array(found, kind)], names=["id", "th", "spans"])

    return run


def _fetch(bins: int, words: bool = False):
    """Region bytes of the representatives that a document holds, once for each pair of blocks that they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches):
            out = []
            b, offsets = _units(s.column("text"), words)
            raw, unit = memoryview(np.ascontiguousarray(b).view(np.uint8)), b.itemsize
            for first, want in zip(offsets[:-1].tolist(), s.column("want").to_pylist(), strict=True):
                for x in want:
                    own, region = x["rh"] % x["blocks"], bytes(raw[(first + x["lo"]) * unit : (first + x["hi"]) * unit])
                    for other in [0] if x["blocks"] == 1 else [o for o in range(x["blocks"]) if o != own]:
                        i, j = sorted((own, other))
                        out.append((hash((x["h"], i, j)) % bins, x["h"], i, j, x["rh"], x["n"], region))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 6, pa.binary()), strict=True)], names=["bin", "h", "i", "j", "rh", "n", "region"])

    return run


def _shared(x: bytes, y: bytes, start: int) -> int:
    """Length of the common prefix, known to be at least `start` if the strings' first bytes agree."""
    n = min(len(x), len(y))
    if x[:start] != y[:start]:
        return 0
    lo, hi = start, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def intervals(suffixes: list[bytes], left: list[int], width: int, unit: int = 1) -> Iterator[tuple[int, int, int]]:
    """Maximal repeats among sorted suffixes: (length, first, last) of each left-diverse interval of the tree.

    left holds the byte before each suffix; values under 0 are unlike any other. Bottom-up stack scan of the
    common-prefix lengths, in bytes and whole units; intervals shorter than `width` aren't opened.
    """
    many = -(2**40)  # marks an interval whose members have different left neighbours
    meet = lambda x, y: x if x == y and x >= 0 else many
    stack: list[list[int]] = []  # [length, first, left]
    for i in range(1, len(suffixes) + 1):
        length = _shared(suffixes[i - 1], suffixes[i], width) if i < len(suffixes) else 0
        length = length - length % unit if length >= width else 0
        first, side = i - 1, left[i - 1]
        while stack and stack[-1][0] > length:
            n, first, held = stack.pop()
            side = meet(held, side)
            if side == many:
                yield n, first, i - 1
        if stack and stack[-1][0] == length:
            stack[-1][2] = meet(stack[-1][2], side)
        elif length:
            stack.append([length, first, side])


def maximal_repeats(texts: list[bytes], width: int, words: bool = False) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, [(text, start), ...]) of every left- and right-maximal repeat of at least `width` bytes (or coded words).

    A text's ends count as maximal on their side. Only suffixes whose first `width` units recur enter the array.
    """
    b = np.frombuffer(b"".join(texts), np.uint64 if words else np.uint8)
    unit = b.itemsize
    size = np.array([len(t) // unit for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    h = window_hash(b, width)
    if not len(h):
        return
    at = np.flatnonzero(np.repeat(offsets[1:], size)[: len(h)] - np.arange(len(h)) >= width)
    at = at[np.argsort(h[at], kind="stable")]
    k = h[at]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    if not len(cut):
        return
    end = np.concatenate([cut[1:], [len(k)]])
    row = np.searchsorted(offsets, at, side="right") - 1
    beside = b[np.maximum(at - 1, 0)]
    before = np.where(at == offsets[row], -1 - at, (beside >> np.uint64(1) if words else beside).astype(np.int64))
    diverse = np.minimum.reduceat(before, cut) != np.maximum.reduceat(before, cut)
    for c, e in zip(cut[diverse & (end - cut > 1)].tolist(), end[diverse & (end - cut > 1)].tolist(), strict=True):
        tails = sorted((texts[r][(p - offsets[r]) * unit :], r, int(p - offsets[r]), x) for p, r, x in zip(at[c:e].tolist(), row[c:e].tolist(), before[c:e].tolist(), strict=True))
        for n, i, j in intervals([t[0] for t in tails], [t[3] for t in tails], width * unit, unit):
            yield n // unit, [(t[1], t[2]) for t in tails[i : j + 1]]


def _repeats(width: int, words: bool = False, chunk: int = 2 << 20):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("h", "i", "j", "rh")])
        h, first, second, rh, n, text = (table.column(c).to_pylist() for c in ("h", "i", "j", "rh", "n", "region"))
        group = list(zip(h, first, second, strict=True))
        out: list[tuple[int, int, int, int]] = []
        at = 0
        while at < len(h):
            end, held = at, 0
            while end < len(h) and (end == at or group[end] == group[end - 1] or held < chunk and h[end] != h[end - 1]):  # blocks of one anchor stay apart
                held += len(text[end])
                end += 1
            rows = [i for i in range(at, end) if i == at or rh[i] != rh[i - 1] or group[i] != group[i - 1]]
            texts = [text[i] for i in rows] + [text[i] for i in rows if n[i] > 1]  # a class of several stands twice
            spans: dict[int, set[tuple[int, int]]] = {}
            for length, where in maximal_repeats(texts, width, words):
                for t, s in where:
                    if t < len(rows):
                        spans.setdefault(rows[t], set()).add((s, s + length))
            for i, found in spans.items():
                out += [(h[i], rh[i], s, e) for s, e in _merged(found, words)]
            at = end
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], names=["h", "rh", "s", "e"])

    return run


def _merged(spans, words: bool = False) -> list[tuple[int, int]]:
    """Spans that overlap as one; those that only touch too, but in words, where the white space between them stays."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1] - words:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in text_slices(batches):
        rows = []
        for text, spans in zip(s.column("text").cast(pa.binary()).to_pylist(), s.column("spans").to_pylist(), strict=True):
            text, at, kept = text or b"", 0, []
            found = _merged((x["s"], x["e"]) for x in spans or ())
            for a, b in found:
                kept.append(text[at:a])
                at = b
            rest = b"".join(kept) + text[at:] if found else text
            rows.append((len(text), len(text) - len(rest), len(found), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore") if found else None))
        n, gone, count, sha, rest = zip(*rows)
        yield pa.RecordBatch.from_arrays([s.column("id"), s.column("th"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sha), pa.array(rest, pa.string())], names=["id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def spans(ws: Workspace, rows: DataFrame, width: int, words: bool = False) -> DataFrame:
    """(id, th, spans array<struct<s, e>>) of the rows (id, th, text) that hold repeated strings.

    With `words`, width and spans are in words.
    """
    spark = rows.sparkSession
    units, unit = work_units(rows), CODE if words else 1
    gram = min(WORDS if words else GRAM, 1 << width.bit_length() - 1)
    anchors = ws.save(rows.mapInArrow(_anchors(width, gram, words), ANCHORS))
    different = anchors.filter("no is not null")
    classes = different.groupBy("h", "rh").agg(F.sum("n").alias("n"), F.min(F.struct("id", "th", "lo", "hi")).alias("rep"))
    classes = ws.save(classes)
    often = classes.groupBy("h").agg(F.sum("n").alias("t"), F.ceil(F.sum(F.col("rep.hi") - F.col("rep.lo")) * unit / GROUP).alias("blocks")).filter("t > 1").select("h", "blocks")
    want = classes.join(often, "h").groupBy(F.col("rep.id").alias("id"), F.col("rep.th").alias("th"))
    want = want.agg(F.collect_list(F.struct("h", "rh", "n", "blocks", F.col("rep.lo").alias("lo"), F.col("rep.hi").alias("hi"))).alias("want"))
    fetched = rows.join(want, ["id", "th"]).select("text", "want").mapInArrow(_fetch(units * 4, words), "bin long, h long, i long, j long, rh long, n long, region binary")
    found = ws.save(fetched.groupBy("bin").applyInArrow(_repeats(width, words), "h long, rh long, s long, e long"))
    ws.drop(classes)
    free_shuffles(spark)
    spots = different.select("batch", "no", "h", "rh").join(found, ["h", "rh"]).groupBy("batch").agg(F.collect_list(F.struct("no", "s", "e")).alias("spots"))
    slices = anchors.filter("docs is not null").select("batch", "docs", "held").join(spots, "batch")
    placed = slices.select("docs", "held", "spots").mapInArrow(_placed(words), "id long, th long, spans array<struct<s: bigint, e: bigint>>")
    placed = ws.save(placed.groupBy("id", "th").agg(F.first("spans").alias("spans")))  # repeated rows have equal spans
    ws.drop(anchors, found)
    free_shuffles(spark)
    return placed


def remove(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row of docs.

    Removed is every byte covered by a string of `width` bytes that also starts elsewhere, in the same text or
    another; strings are judged on the input. kept is the rest as text, null where nothing was removed (bytes
    of characters that a span cuts are dropped there, while kept_sha256 is of the exact bytes). Null texts
    count as empty; texts under `width` bytes lose nothing; repeated rows give repeated results, and their
    texts count as occurrences of each other; rows are told apart by id and text (th is their hash). An empty
    table gives an empty result; a null id is one id like any other; extra columns are ignored.
    """
    ws = Workspace(docs.sparkSession, "suffix")
    rows = plain(docs, id_col, text_col).select(*(c.alias(k) for k, c in _keys(id_col, text_col).items()), F.col(text_col).alias("text"))
    found = spans(ws, rows, width)
    out = rows.hint("merge").join(found, ["id", "th"], "left").mapInArrow(_cut, "id long, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
    return out.withColumn("doc_id", F.when(F.col("id") != -(2**63), F.col("id"))).select("doc_id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def _keys(id_col: str, text_col: str) -> dict:
    return {"id": F.coalesce(F.col(id_col), F.lit(-(2**63))), "th": F.xxhash64(id_col, text_col)}


def clean(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text", words: int | None = None) -> DataFrame:
    """docs with the repeated strings taken out of their texts; a document that thereby has no word left goes.

    With `words`, every passage of so many words that stands more than once goes too, however short in bytes; words
    are what ASCII white space separates. Both are judged on the input. Of a character that a removed span cuts, the
    remaining bytes go too. Rows of null, empty or blank text stay as they are; a null id is one id like any other;
    repeated rows count as occurrences of each other; all columns are kept, whatever their names; an empty table
    gives an empty one.
    """
    ws = Workspace(docs.sparkSession, "suffix")
    keys = _keys(id_col, text_col)
    held = docs.select(*(c.alias(k) for k, c in keys.items()), F.col(f"`{text_col}`").alias("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *(c.alias(k) for k, c in keys.items()))
    rows = rows.hint("merge").join(spans(ws, held, width), ["id", "th"], "left")
    if words:
        rows = rows.hint("merge").join(spans(ws, held, words, words=True).withColumnRenamed("spans", "worded"), ["id", "th"], "left")
    worded = F.col("worded") if words else F.lit(None).cast("array<struct<s: bigint, e: bigint>>")
    names, at = docs.columns, docs.columns.index(text_col)
    # numbered names, because the columns of docs may have any
    rows = rows.select(*[F.col(f"row.`{c}`").alias("text" if i == at else f"c{i}") for i, c in enumerate(names)], "spans", worded.alias("worded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches):
            texts, keep = s.column(at).to_pylist(), []
            for i, (spans, worded) in enumerate(zip(s.column("spans").to_pylist(), s.column("worded").to_pylist(), strict=True)):
                if spans or worded:
                    raw, last, parts = texts[i].encode(), 0, []
                    found = [(x["s"], x["e"]) for x in spans or ()] + _worded(raw, [(x["s"], x["e"]) for x in worded or ()])
                    for a, b in _merged(found):
                        parts.append(raw[last:a])
                        last = b
                    texts[i] = (b"".join(parts) + raw[last:]).decode("utf-8", "ignore")
                keep.append(not (spans or worded) or bool(texts[i].strip()))
            columns = [pa.array(texts, pa.string()) if i == at else s.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, docs.schema)
