"""Every operator and stage on nulls, empty and very long texts, repeated rows, clashing extra columns and empty tables."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cliploom.llm import bm25, line_dedup, line_frequency, ngram_join, packing, pairwise_quality, queries, sharding, sp_suffix, suffix_dedup, url_rules

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
EXTRA = ("id", "th", "h", "n", "key", "tokens", "row", "shard", "part", "words", "hashes", "host", "score", "rest", "gone", "spans", "lh", "no", "x", "y", "term", "length", "g", "_spans", "_worded", "worded", "spans_", "c0", "c1", "first", "k", "want", "a.b")


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(1)
    long = " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9))) for _ in range(200_000))
    rows = [(0, long, "en", "s", 5), (1, None, None, None, None), (2, "", "de", "s", 0), (3, "  \n\t\n ", "de", None, 3), (None, "no id at all in this row of words", "en", "s", 9)]
    rows += [(4, "the same row twice, word for word, to see", "en", "s", 7)] * 2 + [(5, "x" * 300_000, "en", "t", 1), (6, "\n" * 50_000, "fr", "t", 1), (7, "a b\n" * 30_000, "fr", "t", 1), (8, long[:50_000], "en", "s", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit(c) for c in EXTRA}).cache()


OPERATORS = {
    "join": (lambda d: ngram_join.join(d, 4, 85), 11),
    "suffix": (lambda d: suffix_dedup.remove(d, 400), 11),
    "shard": (sharding.shard, 11),
    "lines": (line_dedup.dedup, 11),
    "pack": (lambda d: packing.pack(d, WORDS), None),
    "frequency": (line_frequency.judge, 11),
    "pieces": (lambda d: sp_suffix.digests(d, PIECES), 11),
    "search": (lambda d: bm25.search(d, d.filter("doc_id % 4 = 0")), None),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, odd, name):
    run, rows = OPERATORS[name]
    got = run(odd).collect()
    assert rows is None or len(got) == rows
    assert run(odd.limit(0)).collect() == []
    if name == "join":
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got if r.doc_id not in (0, 5, 8)) == [
            ("1", 0, "1"), ("2", 0, "2"), ("3", 0, "3"), ("4", 6, "4"), ("4", 6, "4"), ("6", 0, "6"), ("7", 2, "7"), ("None", 6, "None")
        ]
        assert {r.doc_id: r.component_id for r in got}[8] == 8
    if name == "search":
        best = {r.query_id: r.doc_id for r in got if r["rank"] == 1}
        assert best == {0: 0, 4: 4, 8: 8}
    if name == "suffix":
        assert next(r for r in got if r.doc_id == 5).n_removed == 300_000
    if name == "pieces":
        assert all(r.round_trip for r in got)
    if name == "pack":
        assert sum(r.length for r in got if r.doc_id == 1) == 1


def test_urls(spark):
    pages = spark.createDataFrame([(1, None), (1, None), (2, "http://" + "a" * 100_000 + ".com/"), (None, "x://y/1")], "page_id long, url string").withColumns({c: F.lit(c) for c in ("host", "path", "rule", "items", "token", "doc_id", "verdict")})
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(url_rules.judge(pages, labels).collect()) == 4


def test_quality(spark, odd):
    labels = spark.createDataFrame([(0, 1), (None, 0), (7, 0), (4, None), (4, 1)], "doc_id long, quality int")
    model = pairwise_quality.fit(odd, labels)
    assert pairwise_quality.score(odd, model, name="own").count() == 11
    with pytest.raises(ValueError, match="already"):
        pairwise_quality.score(odd, model)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, odd, tmp_path, name, stage):
    spark.createDataFrame([(0, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = stage(spark, odd, str(tmp_path))
    assert name == "packing" or out.columns == odd.columns
    rows = out.collect()
    assert rows and stage(spark, odd.limit(0), str(tmp_path)).collect() == []
    if name != "packing":
        assert all(r[c] == c for r in rows for c in EXTRA)  # extra columns come through unchanged


def test_tokenizer_is_a_parameter():
    assert queries.tokenizer() == WORDS
