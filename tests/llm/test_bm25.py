import math
import random
from collections import Counter

import brute
import duckdb

from cliploom.llm import bm25


def plain(rows, queries, k, k1=1.2, b=0.75):
    docs = [(i, Counter(brute.words(t))) for i, t in rows if i is not None]
    n, size = len(docs), [sum(c.values()) for _, c in docs]
    average = sum(size) / n
    df = Counter(w for _, c in docs for w in c)
    asked = {}
    for i, t in queries:
        asked.setdefault(i, Counter()).update(brute.words(t))
    out = {}
    for q, terms in asked.items():
        found = []
        for (i, c), m in zip(docs, size, strict=True):
            parts = [f * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * m / average)) for w, f in terms.items() if c[w]]
            if parts:
                found.append((-math.fsum(parts), i))
        out[q] = sorted(found)[:k]
    return {q: v for q, v in out.items() if v}


def same(got, want):
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((-r.score, r.doc_id))
    assert set(by) == set(want)
    for q, own in want.items():
        assert [r for r, _ in enumerate(by[q])] == [r for r, _ in enumerate(own)]
        assert all(math.isclose(x[0], y[0], rel_tol=1e-9) for x, y in zip(by[q], own, strict=True)), q
        assert [(round(x, 7), i) for x, i in by[q]] == [(round(x, 7), i) for x, i in own], q


def test_whole_table(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    queries = [r for r in rows if r[0] % 20 == 0]
    got = bm25.search(df, df.filter("doc_id % 20 = 0"), k=10).collect()
    same(got, plain(rows, queries, 10))


def test_short_queries_and_many_shards(spark, monkeypatch):
    r = random.Random(4)
    vocab = [f"w{int(r.paretovariate(0.7))}" for _ in range(400)]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(0, 60)))) for i in range(900)] + [(1000, None), (1001, ""), (5, "w1 w2"), (None, "w1")]
    queries = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(1, 6)))) for i in range(60)] + [(70, None), (71, "unknown"), (72, "W1"), (72, "w2")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, term string").repartition(7)
    same(bm25.search(df, spark.createDataFrame(queries, "doc_id long, text string"), k=5).collect(), plain(rows, queries, 5))
    assert bm25.search(df.limit(0), df).collect() == []
    assert bm25.search(df, df.limit(0)).collect() == []
