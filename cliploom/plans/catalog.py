"""Plans over v_catalog: documents as files of clips, labels as a whitelist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions import hub_reference, path_stem
from cliploom.operators import catalog
from cliploom.plans.registry import plan
from cliploom.plans.views import Views, r9


@plan("SELECT path, frames, row_number() OVER (ORDER BY path) - 1 AS motion_id FROM v_catalog")
def scan_catalog(v: Views) -> DataFrame:
    from cliploom.operators.select import global_rank

    placed = v.catalog.select("path", "frames", F.ascii("path").alias("_f"))
    return global_rank(placed, [F.col("_f"), F.col("path")], "_r").select("path", "frames", (F.col("_r") - 1).alias("motion_id"))


@plan("SELECT path, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem FROM v_catalog", name="path_stem")
def stems(v: Views) -> DataFrame:
    return v.catalog.select("path", path_stem(F.col("path")).alias("stem"))


KEEP = "SELECT DISTINCT c.stem FROM v_catalog c JOIN labels l USING (doc_id)"


def _keep(v: Views) -> DataFrame:
    return v.catalog.join(v.table("labels"), "doc_id", "left_semi").select("stem").distinct()


@plan(f"SELECT c.doc_id, c.stem, CASE WHEN k.stem IS NULL THEN 'rejected' ELSE 'kept' END AS status, CASE WHEN k.stem IS NULL THEN 'not_in_keep_filenames' END AS reason FROM v_catalog c LEFT JOIN ({KEEP}) k USING (stem)")
def keep_whitelist(v: Views) -> DataFrame:
    return catalog.kept_by_names(v.catalog.select("doc_id", "stem"), _keep(v), "stem")


@plan(f"SELECT count(*) AS total, count(*) FILTER (hit) AS matched, count(*) FILTER (NOT hit) AS missing FROM (SELECT stem, stem IN (SELECT stem FROM v_catalog WHERE lang = 'en') AS hit FROM ({KEEP}))")
def whitelist_coverage(v: Views) -> DataFrame:
    return catalog.whitelist_coverage(v.catalog.filter("lang = 'en'"), _keep(v), "stem")


LINES = "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '# ' || stem WHEN 1 THEN '   ' WHEN 2 THEN '  ' || path || chr(9) ELSE path END AS line FROM v_catalog"


@plan(f"SELECT doc_id, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS line FROM ({LINES}) WHERE regexp_replace(line, '^\\s+|\\s+$', '', 'g') <> '' AND NOT starts_with(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '#')")
def view_lines(v: Views) -> DataFrame:
    kind = F.col("doc_id") % 5
    line = F.when(kind == 0, F.concat(F.lit("# "), "stem")).when(kind == 1, "   ").when(kind == 2, F.concat(F.lit("  "), "path", F.lit("\t"))).otherwise(F.col("path"))
    return catalog.view_lines(v.catalog.select("doc_id", line.alias("line")), "line")


@plan("SELECT c.path, l.pos, c.frames FROM (SELECT doc_id, 1000000 - doc_id AS pos FROM labels WHERE quality = 1) l JOIN v_catalog c USING (doc_id)")
def filenames_view(v: Views) -> DataFrame:
    listed = v.catalog.join(v.table("labels").filter("quality = 1"), "doc_id").select(F.concat(F.lit("motions/"), F.regexp_replace("path", "^motions/", "")).alias("name"), (F.lit(1000000) - F.col("doc_id")).alias("pos"))
    relative = v.catalog.withColumn("rel", catalog.view_path(F.col("path")))
    view = listed.withColumn("name", catalog.view_path(F.col("name")))
    return catalog.filenames_view(view, relative, "name", "pos", "rel").select("path", "pos", "frames")


@plan("SELECT DISTINCT path FROM v_catalog WHERE lang = 'en' OR doc_id % 3 = 0")
def multi_path_union(v: Views) -> DataFrame:
    return catalog.union_paths(v.catalog.filter("lang = 'en'").select("path"), v.catalog.filter("doc_id % 3 = 0").select("path"))


@plan("SELECT DISTINCT source FROM v_catalog WHERE lang = 'en' INTERSECT SELECT source FROM v_catalog WHERE lang = 'de'")
def name_collisions(v: Views) -> DataFrame:
    side = lambda x: v.catalog.filter(F.col("lang") == x).select("source")
    return catalog.collisions(side("en"), side("de"))


@plan("SELECT DISTINCT source || '_' || lang AS name FROM v_catalog EXCEPT SELECT source || '_' || lang FROM v_catalog WHERE doc_id % 2 = 0")
def missing_names(v: Views) -> DataFrame:
    name = F.concat_ws("_", "source", "lang").alias("name")
    return catalog.missing(v.catalog.select(name), v.catalog.filter("doc_id % 2 = 0").select(name), "name")


@plan("SELECT lang, count(*) AS num_motions, CAST(sum(frames) AS BIGINT) AS total_frames, round(sum(frames) * 0.02 / 3600, 9) AS total_hours FROM v_catalog GROUP BY lang")
def manifest_summary(v: Views) -> DataFrame:
    return catalog.manifest_summary(v.catalog, "frames", 0.02, ["lang"]).withColumn("total_hours", r9("total_hours"))


@plan("SELECT doc_id, substr(sha256('2|' || path || '|' || frames || '|' || lang), 1, 16) AS cache_key FROM v_catalog")
def cache_key(v: Views) -> DataFrame:
    return v.catalog.select("doc_id", catalog.cache_key(2, [F.col("path"), F.col("frames"), F.col("lang")]).alias("cache_key"))


URI = "SELECT page_id, 'hf://' || regexp_extract(url, '://([^/?#]*)', 1) || '/ds' || (page_id % 7) || CASE WHEN page_id % 3 = 0 THEN '@v' || (page_id % 5) ELSE '' END || CASE WHEN page_id % 2 = 0 THEN '/a/' || page_id ELSE '' END AS uri FROM pages"


@plan(
    f"SELECT page_id, regexp_extract(uri, '^[a-z]+://([^/@?#]+)', 1) AS namespace, regexp_extract(uri, '^[a-z]+://[^/@?#]+/([^/@?#]+)', 1) AS name, CASE WHEN contains(uri, '@') THEN regexp_extract(uri, '@([^/?#]+)', 1) ELSE 'main' END AS revision, regexp_extract(uri, '^[a-z]+://[^/]+/[^/]+/(.*)$', 1) AS path FROM ({URI})"
)
def hf_uri_parse(v: Views) -> DataFrame:
    i = F.col("page_id")
    uri = F.concat(
        F.lit("hf://"), F.regexp_extract("url", "://([^/?#]*)", 1), F.lit("/ds"), (i % 7).cast("string"),
        F.when(i % 3 == 0, F.concat(F.lit("@v"), (i % 5).cast("string"))).otherwise(""), F.when(i % 2 == 0, F.concat(F.lit("/a/"), i.cast("string"))).otherwise(""),
    )
    parts = hub_reference(uri)
    return v.table("pages").select("page_id", *[c.alias(k) for k, c in parts.items()])


@plan("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, round(1 / (CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1), 9) AS timestep FROM events")
def manifest_json(v: Views) -> DataFrame:
    parsed = v.table("events").select("event_id", F.from_json("props", "k bigint").alias("m"))
    return parsed.select("event_id", F.col("m.k").alias("k"), r9(1 / (F.col("m.k") + 1.0)).alias("timestep"))
