import random

import brute
import duckdb

from cliploom.llm import graph, ngram_join
from cliploom.llm._util import Workspace

SCHEMA = "doc_id long, text string, id string, tokens int"


def corpus(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "Straße", "ABC"]
    base = [[r.choice(vocab) for _ in range(r.randint(1, 120))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i * 3 + 1, r.choice([" ", "  ", "\t", "\n"]).join(w)))
    return rows + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n\t"), (10**6 + 3, "w1"), (10**6 + 4, "W1"), (10**6 + 5, "w1 w2"), (10**6 + 6, "w1\x0bw2 ")]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df, **kw).collect()}


def test_equals_brute_force(spark):
    rows = corpus(1, 240)
    for classes in (ngram_join.CLASSES, ((2, 1), (6, 2), (1 << 62, 3))):
        assert run(spark, rows, k=4, percent=85, classes=classes) == brute.join(rows, 4, 85)


def test_whole_table(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert run(spark, rows, k=4, percent=85) == brute.join(rows, 4, 85)


def test_empty_and_repeated(spark):
    assert run(spark, [], k=4, percent=85) == {}
    assert run(spark, [(5, "a b c d e"), (5, "a b c d e"), (2, "A B C D E")], k=4, percent=85) == {5: (2, 2), 2: (2, 2)}


def test_rows_without_an_id(spark):
    rows = [(None, "a b c d e f"), (None, "A b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (None, "x y z"), (None, "x y z"), (9, "q"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.join(df, k=4, percent=85).collect())
    assert out == [("7", 3, "7"), ("9", 1, "9"), ("None", 0, "None"), ("None", 1, "None"), ("None", 1, "None")] + [("None", 3, "7")] * 3


def test_blocks_of_a_large_cluster(spark):
    """Near copies over several blocks: every two blocks meet, and the links are those of one block."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(300)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ws = Workspace(spark, "test")
    items = df.withColumnRenamed("doc_id", "id").mapInArrow(ngram_join._tokens(4), "id long, key binary, tokens binary").select("id", "tokens")
    postings = df.selectExpr("0L AS sig", "doc_id AS id")
    want = brute.join(rows, 4, 85)
    for block in (3_000, 20_000, 8_000_000):
        out = {x.id: x.component for x in graph.similar(ws, postings, items, 85, 3, block=block).collect()}
        assert {i: out.get(i, i) for i, _ in rows} == {i: c for i, (_, c) in want.items()}
