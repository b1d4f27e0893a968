import zlib

from cliploom.llm import pairwise_quality, queries

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = queries.op9_pairwise_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [(r.predicted, r.quality) for r in out if r.held_out]
    for label in (0, 1):
        own = [p == q for p, q in held if q == label]
        print(label, len(own), sum(own) / len(own))
        assert sum(own) / len(own) > 0.95


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (4, " \n "), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = pairwise_quality.fit(docs, labels)
    out = {r.doc_id: r.score for r in pairwise_quality.score(docs.withColumn("x", docs.doc_id), model).collect()}
    assert len(out) == 5 and out[2] == out[3] == out[4] and all(0.5 <= s <= 1 for s in out.values())
    assert pairwise_quality.score(docs.limit(0), model).collect() == []
