"""Features of the frames of every clip: the query's SQL without a filter on clips."""

from test_oracles import ORACLES, QUERIES, SF, duck, ordered  # noqa: F401


def test_features_are_whole(spark, duck):  # noqa: F811
    got = QUERIES["frame_features"](spark, SF).select("motion_id", "step", "pos", "value").collect()
    want = duck.sql(ORACLES["frame_features"].replace(" WHERE motion_id % 5 = 0", "")).fetchall()
    assert ordered(got) == ordered(want) and len(got) == 17 * duck.sql("select count(*) from events").fetchall()[0][0]
