import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cliploom.llm import sp_suffix

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER, DECODER = sp_suffix.Encoder(PATH), sp_suffix.Decoder(PATH)
ODD = ["", " ", "  ", "a  b   c", " lead", "trail ", "tab\tand\nline\r\n", "▁ a▁b", "😀 émigré — 北京 \x7f", "x" * 300, "the" * 100, " " * 70, "1234567890" * 20, "<s> </s> <unk> <0x0A>", "ạ̈"]


def test_whole_table(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall() + [(10**6 + i, t) for i, t in enumerate(ODD)] + [(None, None), (5, "a"), (5, "a")]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, ids string").repartition(3)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32, r.round_trip) for r in sp_suffix.digests(df, PATH).collect())
    want = []
    for i, t in rows:
        ids = SP.encode(t or "")
        want.append((i if i is not None else -1, len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()), SP.decode(ids) == (t or "")))
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert sp_suffix.digests(df.limit(0), PATH).collect() == []


def test_columns(spark):
    df = spark.createDataFrame([(1, "the cat"), (2, None)], "doc_id long, text string")
    out = sp_suffix.decode(sp_suffix.encode(df, PATH), PATH).collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in out] == [(1, SP.encode("the cat"), "the cat"), (2, [], "")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" the in ing\n1é"), st.characters(exclude_categories=["Cs"], exclude_characters="\0")), max_size=80), max_size=4))
def test_equals_library(texts):
    ids, offsets = ENCODER(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [SP.encode(t) for t in texts]


def test_decodes_like_library():
    r = random.Random(2)
    for _ in range(200):
        ids = SP.encode("".join(r.choice("ab é▁😀\n  ") for _ in range(r.randint(0, 30))))
        assert DECODER(ids) == SP.decode(ids)


def test_suffix_ranges_are_all_occurrences():
    text = np.array([ord(c) for c in "banana\0ananas\0"], np.int64)
    array = sp_suffix.SuffixArray(text, 4)
    which, lo, hi = array.ranges(np.array([[ord(c) for c in "ana\0"], [ord(c) for c in "xyz\0"]], np.int64), np.array([3, 3]))
    assert which.tolist() == [0]
    assert sorted(array.order[lo[0] : hi[0]].tolist()) == [1, 3, 7, 9]
