import random

import brute
import duckdb
import test_passages

from cliploom.llm import suffix_dedup

SCHEMA = "doc_id long, text string, th string, h int"


def run(spark, rows, width):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove(df, width).collect()}


def test_equals_brute_force(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 9)))
    passages = [" ".join(word() for _ in range(r.randint(5, 40))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = [r.choice(passages) if r.random() < 0.4 else " ".join(word() for _ in range(r.randint(0, 25))) for _ in range(r.randint(0, 6))]
        rows.append((i, "\n".join(parts)))
    rows += [(200, None), (201, ""), (202, "ab" * 150), (203, "x" * 90), (204, "y" * 59), (205, "z" * 60), (206, rows[5][1])]
    assert run(spark, rows, 60) == brute.repeats(rows, 60)


def test_blocks_of_a_hot_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 600)
    r = random.Random(9)
    text = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    passage = text(90)
    rows = [(i, text(r.randint(0, 80)) + passage[: r.choice([70, 90])] + text(r.randint(0, 80))) for i in range(60)]
    assert run(spark, rows, 60) == brute.repeats(rows, 60)


def test_whole_table(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert run(spark, rows, 400) == brute.repeats(rows, 400)


def test_empty_and_repeated_rows(spark):
    assert run(spark, [], 60) == {}
    df = spark.createDataFrame([(1, "q" * 10 + "abcdefgh" * 9), (1, "q" * 10 + "abcdefgh" * 9), (None, "short")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in suffix_dedup.remove(df, 60).collect()) == [("1", 82), ("1", 82), ("None", 0)]


def test_all_occurrences_of_maximal_repeats():
    found = {texts: n for n, texts in ((n, tuple(sorted(w))) for n, w in suffix_dedup.maximal_repeats([b"1abcdef2", b"3abcdef4", b"5abcd6"], 4))}
    assert found == {((0, 1), (1, 1)): 6, ((0, 1), (1, 1), (2, 1)): 4}


def test_repeats_of_words():
    """Maximal repeats in whole words: the same bytes at the edge of another word don't count."""
    code = lambda *words: b"".join((w * 256 + 7).to_bytes(8, "little") for w in words)  # noqa: E731  all end alike
    found = {tuple(sorted(w)): n for n, w in suffix_dedup.maximal_repeats([code(1, 2, 3, 4, 5), code(9, 2, 3, 4, 6), code(2, 3, 8)], 2, words=True)}
    assert found == {((0, 1), (1, 1)): 3, ((0, 1), (1, 1), (2, 0)): 2}


def test_words_of_any_width(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice("abcd") * r.randint(1, 2) for _ in range(r.randint(0, 60))) for _ in range(60)] + [None, "", "a  b\tc\na b c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for least in (3, 5, 9):
        out = {x.doc_id: x.text for x in suffix_dedup.clean(df, width=10**6, words=least).collect()}
        assert out == {i: t for i, t in enumerate(test_passages.brute(texts, 10**6, least)) if t is not None} | {60: None, 61: ""}
