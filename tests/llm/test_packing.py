import random
import zlib
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from cliploom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, out, capacity):
    t = Tokenizer.from_file(PATH)
    want = {}
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for p, x in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[x : x + capacity], "<u4")
            want[i, p] = (x, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == want
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs), -(-sum(n for _, n, _ in want.values()) // capacity)


def test_whole_table(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "  \t\n"), (10**6 + 3, "Don't Á b C!'s ΣΑΣ 12 " * 3), (10**6 + 4, "́ x\x1cy")]
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, length int").repartition(3)
    used, least = check(rows, packing.pack(df, PATH).collect(), 4096)
    assert used <= least + 1
    used, least = check(rows, packing.pack(df, PATH, capacity=64, partition=300).collect(), 64)
    assert used <= 1.02 * least


def test_ids_equal_the_library():
    t, own = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    odd = ["don't you're I'LL x's, 3.14 a.b,c ..., x.'s y,'t", "Straße ÉCOLE école e\u0301cole ﬁ ǅ İstanbul ΑΣ ας", "北京 abc北京. 1٢3 a_b #x ａ.", "a\u00a0b\u2003c\u0085d\x1ce", "<|endoftext|> x<|startoftext|>y", "the.The.THE,the , . 's", "ªº¼ aª.", ""]
    odd += [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' limit 300").fetchall()]
    ids, offsets = own(pa.array(odd))
    for text, a, b in zip(odd, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_empty_and_repeated(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    out = packing.pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id long, text string"), PATH).collect()
    assert sorted((r.doc_id or 0, r.offset, r.length) for r in out) == [(0, 6, 2), (1, 0, 3), (1, 3, 3)]


def test_bounds_never_exceed_the_best():
    def best(sizes, capacity):
        bins = []

        def place(i):
            if i == len(sizes):
                return len(bins)
            found = len(sizes)
            for b in range(len(bins)):
                if bins[b] + sizes[i] <= capacity:
                    bins[b] += sizes[i]
                    found = min(found, place(i + 1))
                    bins[b] -= sizes[i]
            bins.append(sizes[i])
            found = min(found, place(i + 1))
            bins.pop()
            return found

        return place(0)

    r = random.Random(5)
    for _ in range(60):
        sizes = [r.randint(1, 20) for _ in range(7)]
        least, (bins, offsets, room) = best(sizes, 20), packing.best_fit(sizes, 20)
        assert packing.lower_bound(np.array(sizes), 20) <= least <= len(room)
        assert all(bins[i] != bins[j] or offsets[i] + sizes[i] <= offsets[j] or offsets[j] + sizes[j] <= offsets[i] for i, j in combinations(range(7), 2))
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3


def test_other_tokenizers_and_special_tokens():
    """A file with other rules, and texts that name a special token, get the library's own ids."""
    texts = ["Some Words, here 12", None, "", "it's <|endoftext|> and <|ENDOFTEXT|>x", "é\u00a0Straße\n\n  x.y"]
    for name, by_word in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        path = public_tokenizers.path(name)
        library, own = Tokenizer.from_file(path), packing.WordIds(path)
        assert own.by_word == by_word
        for some in (texts, texts[:3], texts[4:]):
            ids, offsets = own(pa.array(some, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in some]


def test_only_texts_that_name_special_tokens_go_to_the_library(monkeypatch):
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["one two", None, "a <|endoftext|> b", "", "<|STARTOFTEXT|>", "three, four.", "five"]
    want = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    by_word = []
    held = words._by_words
    monkeypatch.setattr(words, "_by_words", lambda text: by_word.extend(text.to_pylist()) or held(text))
    ids, ends = words(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == want
    assert by_word == [t for t in texts if "<|" not in (t or "")]
