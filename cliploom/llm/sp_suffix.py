"""SentencePiece BPE encoding by suffix-array matching, and decoding.

The distinct chunks (spaces and the word after them) of a batch are concatenated and indexed by a suffix array.
Every piece of the vocabulary is binary-searched in it; its range of suffixes lists all its occurrences. These
edges (start, length, piece) are sorted by position, and the chunks' symbols are relaxed along them: BPE takes
the best-ranked edge over two neighbouring symbols, leftmost first, until no edge spans two neighbours. (Shortest
path relaxation, as for unigram models, gives other ids than BPE; the edges are the same, their order of use is
by rank.) Pieces never run from a word into the next space, so chunks are independent and each is encoded once.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cliploom.llm._util import text_slices

SPACE = "▁"
#: Distinct chunks whose ids a worker remembers.
REMEMBERED = 400_000
#: Symbols up to which chunks are relaxed together; longer ones go through a queue each.
SHORT = 48


class Model:
    """Pieces, ranks and byte pieces of a BPE model file; checks what the method relies on."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.piece[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.kind = ["byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "piece" for i in range(n)]
        self.ids = np.array([i for i in range(n) if self.kind[i] == "piece"], np.int64)
        score = np.array([sp.get_score(int(i)) for i in self.ids])
        self.rank = np.empty(n, np.int64)
        self.rank[self.ids] = np.unique(-score, return_inverse=True)[1]
        if any(re.search(f"[^{SPACE}]{SPACE}", self.piece[i]) for i in self.ids) or len(self.byte) != 256:
            raise ValueError("the model has pieces across words, or no byte pieces")
        self.longest = max(len(self.piece[i]) for i in self.ids)
        self.unknown = sp.unk_id()


class SuffixArray:
    """Suffixes of a text of code points, sorted by their first `depth` symbols (0 ends a chunk)."""

    def __init__(self, codes: np.ndarray, depth: int) -> None:
        alphabet = np.flatnonzero(np.bincount(codes))
        self.dense = np.full(0x110000, -1, np.int64)
        self.dense[alphabet] = np.arange(len(alphabet)) + (alphabet[0] != 0 if len(alphabet) else 0)
        self.bits = max(1, int(len(alphabet)).bit_length())
        self.per = 64 // self.bits
        self.words = -(-depth // self.per)
        padded = np.concatenate([self.dense[codes].astype(np.uint64), np.zeros(self.per * self.words, np.uint64)])
        keys = []
        for w in range(self.words):
            key = np.zeros(len(codes), np.uint64)
            for j in range(self.per):
                key <<= np.uint64(self.bits)
                key |= padded[w * self.per + j :][: len(codes)]
            keys.append(key)
        self.order = np.lexsort(keys[::-1])
        self.sorted = self._bytes(np.stack([k[self.order] for k in keys], axis=1))

    def _bytes(self, keys: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(keys.astype(">u8")).view(f"S{8 * self.words}").reshape(-1)

    def ranges(self, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patterns are rows of codes, size symbols each: which of them may occur, and their ranges of suffixes."""
        inside = np.arange(codes.shape[1]) < size[:, None]
        dense = np.where(inside, self.dense[codes], 0)
        which = np.flatnonzero((dense >= 0).all(axis=1) & (size <= self.per * self.words))
        dense, inside = dense[which].astype(np.uint64), inside[which]
        low, high = np.zeros((2, len(which), self.words), np.uint64)
        one = np.uint64((1 << self.bits) - 1)
        for w in range(self.words):
            for j in range(self.per):
                at = w * self.per + j
                held = at < codes.shape[1]
                low[:, w] = (low[:, w] << np.uint64(self.bits)) | (dense[:, at] if held else np.uint64(0))
                high[:, w] = (high[:, w] << np.uint64(self.bits)) | (np.where(inside[:, at], dense[:, at], one) if held else one)
        return which, np.searchsorted(self.sorted, self._bytes(low), "left"), np.searchsorted(self.sorted, self._bytes(high), "right")


class Encoder:
    """Ids of texts, chunk by chunk."""

    def __init__(self, path: str) -> None:
        self.model = Model(path)
        pieces = [self.model.piece[i] for i in self.model.ids]
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.codes = np.array([[ord(c) for c in p.ljust(self.model.longest, "\0")] for p in pieces], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences of pieces in a text of code points: sorted start * 32 + length, and the piece."""
        suffixes = SuffixArray(text, self.model.longest)
        which, lo, hi = suffixes.ranges(self.codes, self.size)
        n = hi - lo
        start = suffixes.order[np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)]
        key = start * 32 + np.repeat(self.size[which], n)
        order = np.argsort(key)
        return key[order], np.repeat(self.model.ids[which], n)[order]

    def relax(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks (spaces already as the space symbol), and each chunk's end in them."""
        joined = np.frombuffer(("\0".join(chunks) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.array([len(c) for c in chunks], np.int64)
        first = np.cumsum(size + 1) - (size + 1)
        key, piece = self.edges(joined)

        def find(start, end):
            """Piece over [start, end), or -1."""
            want = np.where(end - start <= self.model.longest, start * 32 + (end - start), -1)
            at = np.minimum(np.searchsorted(key, want), max(len(key) - 1, 0))
            return np.where(key[at] == want, piece[at], -1) if len(key) else np.full(len(want), -1)

        done_start, done_end = [], []
        short = np.flatnonzero(size <= SHORT)
        n = size[short]
        start = np.arange(n.sum()) + np.repeat(first[short] - (np.cumsum(n) - n), n)
        end, chunk = start + 1, np.repeat(short, n)
        worst = np.int64(2**62)
        cost = self._costs(find, start, end, chunk, worst)
        while len(start):
            cut = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            best = np.minimum.reduceat(cost, cut)
            live = best < worst
            each = np.diff(np.concatenate([cut, [len(start)]]))
            over = np.repeat(~live, each)
            done_start.append(start[over])
            done_end.append(end[over])
            hit = np.flatnonzero((cost == np.repeat(best, each)) & ~over)  # one a chunk: positions are part of the cost
            end[hit] = end[hit + 1]
            drop = over.copy()
            drop[hit + 1] = True
            moved = np.cumsum(~drop) - 1
            keep = ~drop
            start, end, chunk, cost = start[keep], end[keep], chunk[keep], cost[keep]
            mark = np.zeros(len(start) + 1, bool)
            mark[moved[hit]] = mark[moved[hit] - 1] = True  # -1 falls on the spare place
            again = np.flatnonzero(mark[:-1])
            cost[again] = self._costs(find, start, end, chunk, worst, again)
        for i in np.flatnonzero(size > SHORT).tolist():
            a, b = self._queue(find, int(first[i]), int(size[i]))
            done_start.append(a)
            done_end.append(b)
        start, end = np.concatenate(done_start), np.concatenate(done_end)
        order = np.argsort(start)
        start, end = start[order], end[order]
        ids = find(start, end)
        ends = np.searchsorted(start, np.append(first[1:], len(joined)))
        odd = np.flatnonzero(ids < 0)  # symbols without a piece become byte pieces
        if len(odd):
            raw = [[self.model.byte[b] for b in chr(joined[x]).encode("utf-8", "surrogatepass")] for x in start[odd].tolist()]
            more = np.ones(len(ids), np.int64)
            more[odd] = [len(r) for r in raw]
            held = np.repeat(ids, more)
            held[np.repeat(ids < 0, more)] = [b for r in raw for b in r]
            ids, ends = held, np.concatenate([[0], np.cumsum(more)])[ends]
        return ids.astype(np.int32), ends

    def _costs(self, find, start, end, chunk, worst, at=None) -> np.ndarray:
        """Rank and position of the edge over each symbol and its right neighbour."""
        at = np.arange(len(start)) if at is None else at
        out = np.full(len(at), worst)
        inside = np.flatnonzero(at + 1 < len(start))
        inside = inside[chunk[at[inside]] == chunk[at[inside] + 1]]
        left = at[inside]
        p = find(start[left], end[left + 1])
        out[inside] = np.where(p >= 0, self.model.rank[p] * 2**40 + start[left], worst)
        return out

    def _queue(self, find, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long chunk, in n log n."""
        end, before = list(range(first + 1, first + n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = end[i] - first
            if 0 <= i and j < n and end[j] - first - i <= self.model.longest:
                p = int(find(np.array([first + i]), np.array([end[j]]))[0])
                if p >= 0:
                    heapq.heappush(heap, (int(self.model.rank[p]), i, end[i], end[j]))

        starts = np.arange(first, first + n - 1)
        pairs = find(starts, starts + 2)
        heap = [(int(self.model.rank[p]), i, first + i + 1, first + i + 2) for i, p in enumerate(pairs.tolist()) if p >= 0]
        heapq.heapify(heap)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            j = mid - first
            if not alive[i] or end[i] != mid or j >= n or not alive[j] or end[j] != stop:
                continue
            alive[j], end[i] = False, stop
            if stop - first < n:
                before[stop - first] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        at = [i for i in range(n) if alive[i]]
        return np.array(at) + first, np.array([end[i] for i in at])

    def __call__(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the rows' offsets; empty and null texts have none.

        A chunk of one space and a word goes by the word. Texts without other spaces are split in Arrow.
        """
        text = pc.fill_null(text, "")
        other = pc.match_substring_regex(text, "^ |  | $|^$").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(other), "", text), " ")
        flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        slow = {i: [c[1:] if c[:2].strip(" ") else c for c in re.findall(" +[^ ]*", " " + text[i].as_py())] if text[i].as_py() else [] for i in np.flatnonzero(other).tolist()}
        if len(self.known) > REMEMBERED:
            self._forget()
        fresh = list(dict.fromkeys(c for chunks in ([d for d in distinct if d], *slow.values()) for c in chunks if c not in self.known))
        if fresh:
            ids, ends = self.relax([(c if c[0] == " " else " " + c).replace(" ", SPACE) for c in fresh])
            first = len(self.ends) - 1
            self.known.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            ends = ends + len(self.ids)
            self.ids.frombytes(ids.tobytes())
            self.ends.frombytes(ends.astype(np.int64).tobytes())
        which = np.array([self.known.get(d, -1) for d in distinct], np.int64)
        chunk = which[coded.indices.to_numpy()] if len(distinct) else np.empty(0, np.int64)
        size = np.diff(offsets)
        if slow:
            rows = np.split(chunk, offsets[1:-1])
            for i, chunks in slow.items():
                rows[i] = np.array([self.known[c] for c in chunks], np.int64)
            chunk, size = np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
        ends, table = np.frombuffer(self.ends, np.int64), np.frombuffer(self.ids, np.int32)
        begin, n = ends[chunk], ends[chunk + 1] - ends[chunk]
        last = np.cumsum(n)
        at = np.arange(last[-1] if len(last) else 0) + np.repeat(begin - (last - n), n)
        return table[at], np.concatenate([[0], last])[np.concatenate([[0], np.cumsum(size)])]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """A worker's encoder: chunks that it has met stay known in later tasks."""
    return Encoder(path)


class Decoder:
    """Text of ids: pieces joined, byte pieces as UTF-8, space symbols as spaces, the first space taken off."""

    def __init__(self, path: str) -> None:
        model = Model(path)
        self.raw = [bytes([int(p[1:-1], 16)]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "piece" else b" \xe2\x81\x87 " if i == model.unknown else b"" for i, (p, k) in enumerate(zip(model.piece, model.kind, strict=True))]

    def __call__(self, ids: list[int]) -> str:
        raw = b"".join([self.raw[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def decoder_of(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, model_path: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """docs with an array<int> column of ids. Null and empty texts get an empty array."""
    names, width = docs.columns, len(docs.columns)
    if name in names:
        raise ValueError(f"there is a column {name} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model_path)
        for b in text_slices(batches, text_col):
            ids, offsets = encoder(b.column(text_col))
            arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:width], arrays], names=[*names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """rows with a string column: the text of their ids. Null arrays give null, empty ones an empty text."""
    names, width = rows.columns, len(rows.columns)
    if name in names:
        raise ValueError(f"there is a column {name} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(model_path)
        for b in batches:
            texts = [None if x is None else decoder(x) for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(texts, pa.string())], names=[*names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (ids as little-endian 32 bits), round_trip (decoding gives the text) per row.

    Null and empty texts have no ids (round_trip is true); repeated rows are rows of their own; an empty table
    gives an empty result; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = encoder_of(model_path), decoder_of(model_path)
        for b in text_slices(batches, limit=12 << 20):
            ids, offsets = encoder(b.column("text"))
            out = []
            for t, x, y in zip(b.column("text").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = ids[x:y]
                out.append((y - x, zlib.crc32(own.astype("<i4").tobytes()), decoder(own.tolist()) == (t or "")))
            n, crc, same = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    rows = docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
