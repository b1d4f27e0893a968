"""Best-fit packing of tokenised documents into fixed-length sequences, certified by dual-feasible functions.

Pieces are dealt at random into partitions of bounded size and packed by best-fit decreasing. Each partition
compares its bin count with lower bounds from dual-feasible functions. A partition that meets its bound is
certified: it keeps all its sequences but the emptiest. A partition with a gap keeps only its full sequences.
What is not kept is exchanged: dealt anew into fewer partitions and packed again, until one partition is left
or a round brings nothing.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.llm._util import Workspace, plain, text_slices

#: Pieces in one packing partition (a few MB).
PARTITION = 40_000
#: Distinct words whose ids a worker remembers.
REMEMBERED = 250_000

#: The rules of tokenizer files whose words can be encoded one by one.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Ids of texts by a BPE tokenizer that lower-cases, splits at white space and between letters and other
    characters, and then works on bytes: each distinct word is encoded once and remembered.

    White space set between a letter or digit and a following full stop or comma changes no id, as they are
    split there anyway; it leaves fewer distinct words. Words of lower-case letters alone go straight to the
    model, all others through the whole tokenizer. Files with other rules than RULES, and texts that name a special
    token, are left to the library as they are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's threads would each keep memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.by_word = all(told.get(k) == v for k, v in RULES.items()) and told["model"]["type"] == "BPE" and not told["model"].get("dropout")
        self.special = [t["content"] for t in told.get("added_tokens") or ()]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; others follow 256
        hidden = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: 256 + n for n, b in enumerate(hidden)}
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def _learn(self, words: list[str]) -> None:
        rest, ids = [], []
        tokenize = self.tokenizer.model.tokenize
        for w in words:
            if w.isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w) and w == w.lower()):
                own = w if w.isascii() else w.encode().decode("latin-1").translate(self.shown)
                ids.append((w, [t.id for t in tokenize(own)]))
            else:
                rest.append(w)
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            ids += [(w, e.ids) for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True)]
        for w, x in ids:
            self.known[w] = len(self.ends) - 1
            self.ids.extend(x)
            self.ends.append(len(self.ids))

    def __call__(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the rows' offsets."""
        whole = np.full(len(text), not self.by_word)
        for t in self.special:
            whole |= pc.fill_null(pc.match_substring(text, t, ignore_case=True), False).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_words(text)
        ids, at = [], 0
        for end in [*(np.flatnonzero(whole[1:] != whole[:-1]) + 1).tolist(), len(text)]:  # runs of one kind
            if whole[at]:  # a text at a time: the library's rows take some hundred bytes a token
                ids += [np.array(self.tokenizer.encode(t or "", add_special_tokens=False).ids, np.uint32) for t in text.slice(at, end - at).to_pylist()]
            else:
                found, ends = self._by_words(text.slice(at, end - at))
                ids += np.split(found, ends[1:-1])
            at = end
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])

    def _by_words(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lower = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(text, "")), r"([a-z0-9])([.,])", r"\1 \2")
        words = pc.ascii_split_whitespace(lower)
        flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self._reset()
        self._learn([w for w in distinct if w not in self.known])
        which = np.array([self.known[w] for w in distinct], np.int64)
        ends, table = np.frombuffer(self.ends, np.int64), np.frombuffer(self.ids, np.uint32)
        word = which[coded.indices.to_numpy()] if len(distinct) else which
        begin, n = ends[word], ends[word + 1] - ends[word]
        last = np.cumsum(n)
        at = np.arange(last[-1] if len(last) else 0) + np.repeat(begin - (last - n), n)
        return table[at], np.concatenate([[0], last])[offsets]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """A worker's encoder: words that it has met stay known in later tasks."""
    return WordIds(path)


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        for s in text_slices(batches):
            ids, offsets = encode(s.column("text"))
            out = []
            for doc, a, b in zip(s.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                out += [(doc, p, x, len(own[x : x + capacity]), zlib.crc32(own[x : x + capacity].tobytes())) for p, x in enumerate(range(0, len(own), capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    return run


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of the dual-feasible functions' bounds on the number of bins.

    u_e: sizes over capacity - e count as capacity, sizes under e as nothing (all e up to capacity / 2);
    u_k: rounds (k + 1) * size / capacity down unless whole (k up to 20).
    """
    have = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    count, total = np.cumsum(have), np.cumsum(have * size)
    e = np.arange(1, capacity // 2 + 1)
    eased = (count[-1] - count[capacity - e]) * capacity + total[capacity - e] - total[e - 1]
    best = max(-(-int(total[-1]) // capacity), -(-int(eased.max()) // capacity) if len(e) else 0)
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((have * value).sum()) // (capacity * k)))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: each item's bin and offset, and the room left in each bin. Ties go in given order."""
    bins, offsets, room = [0] * len(lengths), [0] * len(lengths), []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                rooms &= ~(1 << r)
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i], room[b] = b, capacity - r, r - n
        free[r - n].append(b)
        if r > n:
            rooms |= 1 << (r - n)
    return bins, offsets, room


def _pack(capacity: int, step: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table.column("length").to_pylist()
        bins, offsets, room = best_fit(lengths, capacity)
        gap = len(room) - lower_bound(np.array(lengths), capacity)
        if last:
            keep = [True] * len(room)
        elif gap > 0:
            keep = [r == 0 for r in room]
        else:
            emptiest = max(range(len(room)), key=lambda b: room[b])
            keep = [b != emptiest or r == 0 for b, r in enumerate(room)]
        g = table.column("g")[0].as_py()
        seq = [(step << 56) + (g << 24) + b for b in bins]
        return table.append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(offsets, pa.int64())).append_column("done", pa.array([keep[b] for b in bins], pa.bool_()))

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, partition: int = PARTITION, rounds: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids followed by end_id; only documents over `capacity` are cut. Null and empty texts are
    end_id alone. Repeated rows and repeated or null ids are packed as documents of their own. An empty table
    gives an empty result; extra columns are ignored.
    """
    ws = Workspace(docs.sparkSession, "packing")
    rows = plain(docs, id_col, text_col).toDF("doc_id", "text")
    pieces = ws.save(rows.mapInArrow(_pieces(tokenizer_path, capacity, end_id), PIECES))
    pool, kept = pieces, []
    count = pool.count()
    for step in range(rounds):
        groups = max(1, -(-count // partition))
        last = groups == 1 or step == rounds - 1
        dealt = pool.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(step)), F.lit(groups)))
        packed = ws.save(dealt.groupBy("g").applyInArrow(_pack(capacity, step, last), f"{PIECES}, g long, sequence_id long, offset long, done boolean"))
        kept.append(packed.filter("done").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
        pool = packed.filter("not done").select(*[x.split()[0] for x in PIECES.split(", ")])
        if last:
            break
        count = pool.count()
        if not count:
            break
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out
