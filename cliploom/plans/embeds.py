"""Plans over the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.operators import learn, select
from cliploom.plans.registry import plan
from cliploom.plans.views import Views, r9


@plan("SELECT vec_id, CAST(step AS INTEGER) AS pos, round(v, 9) + 0.0 AS value FROM v_elements")
def embeddings_scan(v: Views) -> DataFrame:
    return v.elements.select("vec_id", F.col("step").cast("int").alias("pos"), r9("v").alias("value"))


@plan("SELECT vec_id, round(rank_norm, 9) AS rank_norm FROM v_ranked")
def rank_normalize(v: Views) -> DataFrame:
    return v.ranked.select("vec_id", r9("rank_norm").alias("rank_norm"))


@plan("SELECT r.vec_id, 64 AS length, round(r.complexity, 6) AS complexity_raw, round(r.rank_norm, 9) AS complexity_norm, s.score AS physical_score FROM v_ranked r LEFT JOIN v_scores s ON s.motion_id = r.vec_id")
def complexity_report(v: Views) -> DataFrame:
    held = v.ranked.join(v.scores.select(F.col("motion_id").alias("vec_id"), "score"), "vec_id", "left")
    return held.select("vec_id", F.lit(64).alias("length"), F.round("complexity", 6).alias("complexity_raw"), r9("rank_norm").alias("complexity_norm"), F.col("score").alias("physical_score"))


@plan("SELECT vec_id, CAST(floor(greatest(least((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) * 255, 255.0), 0.0)) AS INTEGER) AS color_x, CAST(floor(greatest(least((y - min(y) OVER ()) / (max(y) OVER () - min(y) OVER ()) * 255, 255.0), 0.0)) AS INTEGER) AS color_y FROM v_points")
def minmax_colors(v: Views) -> DataFrame:
    return select.minmax_colors(v.points, ["x", "y"]).select("vec_id", "color_x", "color_y")


DIST = "round(sqrt(pow(x - 0.1 - a * 0.6, 2) + pow(y - 0.0 - a * 0.0, 2) + pow(z + 0.1 - a * 0.8, 2)), 9)"


@plan(f"SELECT vec_id, {DIST} AS distance FROM (SELECT *, (x - 0.1) * 0.6 + (z + 0.1) * 0.8 AS a FROM v_points) ORDER BY distance, vec_id LIMIT 1")
def nearest_to_ray(v: Views) -> DataFrame:
    return select.nearest_to_ray(v.points, ["x", "y", "z"], "vec_id", (0.1, 0.0, -0.1), (3.0, 0.0, 4.0))


CENTRED = "SELECT vec_id, x - avg(x) OVER () AS x, y - avg(y) OVER () AS y, z - avg(z) OVER () AS z FROM v_points"


@plan(f"SELECT vec_id, round(x / s, 7) + 0.0 AS x, round(y / s, 7) + 0.0 AS y, round(z / s, 7) + 0.0 AS z FROM ({CENTRED}), (SELECT quantile_cont(sqrt(x * x + y * y + z * z), 0.95) AS s FROM ({CENTRED}) WHERE x * x + y * y + z * z > 0)")
def normalize_points(v: Views) -> DataFrame:
    return select.normalize_points(v.points, ["x", "y", "z"]).select("vec_id", *[r9(c, 7).alias(c) for c in "xyz"])


SHUFFLED = "SELECT vec_id, row_number() OVER (ORDER BY sha256('7:' || CAST(vec_id AS VARCHAR)), vec_id) AS i, count(*) OVER () AS n FROM embeddings"


@plan(f"SELECT vec_id FROM ({SHUFFLED}) WHERE i <= least(ceil(n * 0.1), 150)")
def sample_fraction(v: Views) -> DataFrame:
    return select.sample_fraction(v.embed.select("vec_id"), "vec_id", 0.1, 7, 150)


def _picks(v: Views, n: int) -> DataFrame:
    rows = v.ranked.select("vec_id", r9("rank_norm").alias("c")).join(v.embed.select("vec_id", "embedding"), "vec_id")
    return select.weighted_fps(rows, "embedding", "c", "vec_id", n)


FPS = """WITH RECURSIVE many AS ({picks}), e AS (SELECT r.vec_id, round(r.rank_norm, 9) AS c, CAST(b.embedding AS DOUBLE[64]) AS v FROM v_ranked r JOIN embeddings b USING (vec_id)),
    s AS (SELECT vec_id AS first_id, v AS first_v FROM e ORDER BY c DESC, vec_id LIMIT 1),
    g(it, vec_id, near, chosen, pick, last) AS (
    SELECT 0, e.vec_id, array_distance(e.v, s.first_v), e.vec_id = s.first_id, s.first_id, s.first_v FROM e, s
    UNION ALL SELECT it + 1, vec_id, least(near, array_distance(v, new_v)), chosen OR vec_id = new_id, new_id, new_v FROM (
      SELECT it, vec_id, near, chosen, v, first(vec_id) OVER o AS new_id, first(v) OVER o AS new_v FROM (
        SELECT g.it, g.vec_id, g.near, g.chosen, e.v, CASE WHEN g.chosen THEN -1.0 ELSE 0.6 * CASE WHEN max(g.near) OVER () > 1e-8 THEN g.near / max(g.near) OVER () ELSE g.near END + 0.4 * e.c END AS score FROM g JOIN e USING (vec_id) WHERE g.it + 1 < (SELECT picks FROM many))
      WINDOW o AS (ORDER BY score DESC, vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)))"""


@plan(f"{FPS.format(picks='SELECT 20 AS picks')} SELECT DISTINCT pick AS vec_id, CAST(it AS BIGINT) AS rank FROM g")
def weighted_fps(v: Views) -> DataFrame:
    return _picks(v, 20)


RATIOS = (0.01, 0.02, 0.04)
LARGEST = "SELECT greatest(round_even(count(*) * CAST(0.04 AS DOUBLE), 0), 1) AS picks FROM embeddings"


@plan(f"{FPS.format(picks=LARGEST)}, n AS (SELECT count(*) AS n FROM embeddings), p AS (SELECT DISTINCT pick AS vec_id, CAST(it AS BIGINT) AS rank FROM g) SELECT r AS ratio, vec_id, rank FROM p, n, (SELECT unnest([CAST(0.01 AS DOUBLE), 0.02, 0.04]) AS r) WHERE rank < greatest(round_even(n * r, 0), 1)")
def nested_subsets(v: Views) -> DataFrame:
    sizes = select.subset_sizes(v.embed.count(), RATIOS)
    limits = v.spark.createDataFrame(list(sizes.items()), "ratio double, n long")
    return _picks(v, max(sizes.values())).join(F.broadcast(limits), F.col("rank") < F.col("n")).select("ratio", "vec_id", "rank")


@plan(f"{FPS.format(picks=LARGEST)} SELECT count(*) AS num_motions, CAST(sum(64) AS BIGINT) AS total_frames, round(sum(64) * 0.02 / 3600, 9) AS total_hours FROM embeddings WHERE vec_id IN (SELECT pick FROM g)")
def subset_manifest(v: Views) -> DataFrame:
    from cliploom.operators.catalog import manifest_summary

    most = max(select.subset_sizes(v.embed.count(), RATIOS).values())
    kept = v.embed.join(_picks(v, most), "vec_id", "left_semi").select("vec_id", F.lit(64).cast("long").alias("frames"))
    return manifest_summary(kept, "frames", 0.02).withColumn("total_hours", r9("total_hours"))


@plan()
def pca_variance(v: Views) -> DataFrame:
    """Rows only: coordinates of every vector on the three main components."""
    return learn.pca(v.embed, "embedding", "vec_id").select("vec_id", *[F.col("pc")[i].alias(f"pc{i}") for i in range(3)])
