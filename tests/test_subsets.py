"""Subsets of a table whose largest one has over 20 members, against a greedy order in NumPy."""

import duckdb
import numpy as np

from cliploom import plans
from cliploom.plans.views import prelude

SF = "/root/testdata/sf0.1"


def test_subsets_are_whole(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    sql = "SELECT r.vec_id, round(r.rank_norm, 9) AS c, b.embedding AS v FROM v_ranked r JOIN embeddings b USING (vec_id) ORDER BY vec_id"
    rows = con.execute(sql if sql.startswith("WITH") else prelude(sql)).fetchall()
    ids, c, x = [r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows], np.float64)
    sizes = {r: max(1, round(len(ids) * r)) for r in (0.01, 0.02, 0.04)}
    assert sorted(sizes.values()) == [20, 40, 80]
    order = [int(np.argmax(c))]
    while len(order) < 80:
        near = np.min([np.sqrt(((x - x[i]) ** 2).sum(axis=1)) for i in order], axis=0)
        score = 0.6 * near / near.max() + 0.4 * c
        score[order] = -1
        order.append(int(np.argmax(score)))
    got = plans.queries()["nested_subsets"](spark, SF).collect()
    assert sorted((r.ratio, r["rank"], r.vec_id) for r in got) == sorted((q, k, ids[order[k]]) for q, n in sizes.items() for k in range(n))
    [m] = plans.queries()["subset_manifest"](spark, SF).collect()
    assert (m.num_motions, m.total_frames) == (80, 80 * 64)
