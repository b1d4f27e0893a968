import brute
import duckdb
import test_packing
from test_line_dedup import rest as brute_lines
from test_passages import brute as brute_passages

import corpus_pipeline
from cliploom.llm import pairwise_quality

SF = "/root/testdata/sf0.001"


def table(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, every = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        every[name] = (docs, out)
        if name != "packing":
            assert out.columns == columns
        docs = out
    before, after = (table(x) for x in every["quality"])
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    assert all(after.get(i) == r for i, r in before.items() if labels.get(i) == 1)
    assert sum(i in after for i, y in labels.items() if y == 0) <= 1

    before, after = (table(x) for x in every["lines"])
    want = brute_lines([(i, r.text) for i, r in before.items()], 80, 10)
    kept = {i: text for i, (_, gone, text) in want.items() if not gone or text.split()}
    assert {i: r.text or "" for i, r in after.items()} == kept and len(kept) < len(before)
    assert sum(gone for _, gone, _ in want.values()) > 100
    assert all(r == before[i] or r.n_chars == len(r.text) for i, r in after.items())

    before, after = (table(x) for x in every["near_duplicates"])
    groups = brute.join([(i, r.text) for i, r in before.items()], 5, 80)
    assert after == {i: r for i, r in before.items() if groups[i][1] == i}

    before, after = (table(x) for x in every["repeats"])
    want = brute_passages([r.text for r in before.values()], 400, 51)
    assert {i: r.text for i, r in after.items()} == {i: t for i, t in zip(before, want, strict=True) if t is not None}

    rows = [(i, r.text) for i, r in after.items()]
    used, least = test_packing.check(rows, every["packing"][1].collect(), 4096)
    assert used <= least + 1


def test_near_copies_of_the_table(spark):
    """On the texts as they came, where near copies are whole: one document of each group stays, that of least id."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = table(docs)
    groups = brute.join([(i, r.text) for i, r in before.items()], 5, 80)
    out = table(corpus_pipeline.near_duplicates(spark, docs, SF))
    assert out == {i: r for i, r in before.items() if groups[i][1] == i} and len(out) < len(before)


def test_repeats_of_the_table(spark):
    """On the texts as they came: passages of over 50 words in several documents go everywhere, other texts stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = table(docs)
    want = brute_passages([r.text for r in before.values()], 400, 51)
    out = {i: r.text for i, r in table(corpus_pipeline.repeats(spark, docs, SF)).items()}
    assert out == {i: t for i, t in zip(before, want, strict=True) if t is not None}
    assert sum(out.get(i) != r.text for i, r in before.items()) > 10


def test_run(spark):
    assert pairwise_quality.SAMPLE > 0
    assert corpus_pipeline.run(spark, SF).count() > 0
