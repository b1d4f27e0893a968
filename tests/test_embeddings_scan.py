"""The scan returns every embedding: its SQL without a filter on ids."""

from test_oracles import ORACLES, QUERIES, SF, duck, ordered  # noqa: F401


def test_scan_is_whole(spark, duck):  # noqa: F811
    got = QUERIES["embeddings_scan"](spark, SF).select("vec_id", "pos", "value").collect()
    want = duck.sql(ORACLES["embeddings_scan"].replace(" WHERE vec_id % 10 = 0", "")).fetchall()
    assert ordered(got) == ordered(want) and len(got) == 64 * duck.sql("select count(*) from embeddings").fetchall()[0][0]
