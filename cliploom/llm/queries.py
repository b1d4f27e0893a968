"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.llm import bm25, line_dedup, line_frequency, ngram_join, packing, pairwise_quality, sharding, sp_suffix, suffix_dedup, url_rules


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_documents(spark, sf_dir), k=4, percent=85)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(_documents(spark, sf_dir), width=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_documents(spark, sf_dir), shards=24)


def op4_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(_documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "kept_sha256")


def op5_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return bm25.search(docs, docs.filter("doc_id % 100 = 0"), k=10).withColumn("score", F.round("score", 6))


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer(), capacity=4096)


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.judge(_documents(spark, sf_dir))


def remainder(column: str):
    """crc32 of the id as text, mod 3; rows with 1 are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = pairwise_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), use=remainder("id") != 1)
    scored = pairwise_quality.score(docs, model)
    return scored.select("doc_id", F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sp_suffix.digests(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (
        op1_ngram_jaccard_join, op2_suffix_array_dedup, op3_jump_sharding, op4_fuzzy_line_dedup, op5_block_max_search,
        op6_best_fit_packing, op7_url_rules, op8_line_frequency, op9_pairwise_quality, op10_suffix_array_pieces,
    )
    return {f.__name__: f for f in each}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = "'[^\\x20\\x09-\\x0D]+'"

_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(g) AS n FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id),
near AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM near JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, seen) AS (SELECT a, a FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.seen)
SELECT n.doc_id, n.n AS n_shingles, coalesce(min(r.seen), n.doc_id) AS component_id FROM n LEFT JOIN reach r USING (doc_id) GROUP BY n.doc_id, n.n"""

_SEARCH = f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, {_WORD})) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM w GROUP BY ALL),
size AS (SELECT doc_id, sum(tf) AS len FROM tf GROUP BY doc_id),
total AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(len) FROM size) / (SELECT count(*) FROM documents) AS average),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
scored AS (SELECT q.doc_id AS query_id, d.doc_id, sum(q.tf * ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * len / average))) AS score
FROM tf q JOIN tf d USING (t) JOIN df USING (t) JOIN size ON size.doc_id = d.doc_id, total WHERE q.doc_id % 100 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"""

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LINES = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
twice AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS at FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM p) WHERE c > 1),
covered AS (SELECT doc_id, count(*) AS n FROM twice GROUP BY doc_id),
raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM raw WHERE translate(line, {_SPACE}, '') <> '' GROUP BY doc_id),
base AS (SELECT w.doc_id, len(w) AS n_words, length(translate(text, {_SPACE}, '')) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
norm AS (SELECT d.doc_id, coalesce(d.source, '') AS host, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS line FROM raw JOIN documents d USING (doc_id) WHERE d.text IS NOT NULL),
l AS (SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS w FROM norm WHERE line <> ''),
hosts AS (SELECT host, count(DISTINCT doc_id) AS docs FROM l GROUP BY host),
often AS (SELECT host, line, count(DISTINCT doc_id) AS n FROM l GROUP BY host, line),
bad AS (SELECT host, line FROM often JOIN hosts USING (host) WHERE n > 10 AND n > 0.01 * docs),
spent AS (SELECT l.doc_id, coalesce(sum(l.w) FILTER (bad.line IS NOT NULL), 0) / sum(l.w) AS gone FROM l LEFT JOIN bad ON bad.host = l.host AND bad.line = l.line GROUP BY l.doc_id)
SELECT base.*, failed AS base_failed, NOT failed AND coalesce(gone, 0) <= 0.7 AS kept, round(coalesce(gone, 0), 6) AS boilerplate_share
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS failed FROM base) base LEFT JOIN spent USING (doc_id)"""


# The table of CRC-32 by its polynomial, the checksum byte by byte, and the paper's jumps on 128-bit numbers.
_SHARDS = """
WITH RECURSIVE bits AS (SELECT list(c ORDER BY i) AS crcs FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT row, doc_id, len(h) // 2 AS n, list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM d),
sums AS (SELECT row, doc_id, n + 8 AS size, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM b, bits),
jumps(key, k, j) AS (SELECT doc_id, CAST(coalesce(doc_id, 0) AS HUGEINT) + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END, CAST(0 AS BIGINT) FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL SELECT key, n, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST((n // 8589934592) + 1 AS DOUBLE))) AS BIGINT) FROM (SELECT key, j, (k * 2862933555777941757 + 1) % 18446744073709551616 AS n FROM jumps WHERE j < 25)),
ends AS (SELECT key, max(j) FILTER (j < 24) AS shard, max(j) FILTER (j < 25) AS grown FROM jumps GROUP BY key)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard FROM sums JOIN ends ON doc_id IS NOT DISTINCT FROM key"""


# Every set of tokens of every labelled page is counted; the operator's pruning then applies to all of them.
_RULES = r"""
WITH h AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
t AS (SELECT *, CASE WHEN host = '' THEN [] ELSE list_sort(list_distinct(list_filter(list_concat(['scheme=' || split_part(url, '://', 1), 'host=' || host, 'first=' || split_part(host, '.', 1)],
  list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda i: 'domain=' || array_to_string(string_split(host, '.')[i + 1:], '.')),
  list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path=' || regexp_replace(x, '[0-9]+', '0', 'g')),
  list_transform(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: 'query=' || split_part(x, '=', 1))), lambda x: NOT ends_with(x, '=')))) END AS items FROM h),
known AS (SELECT doc_id, max(coalesce(quality = 0 OR toxic = 1, false)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
lab AS (SELECT items, bad FROM t JOIN known ON doc_id = try_cast(regexp_extract(path, '/([0-9]{1,18})(?:\.[a-z]+)?/?$', 1) AS BIGINT) WHERE len(items) > 0),
n AS (SELECT count(*) AS n, count(*) FILTER (bad) / count(*) AS base, ceil(least(1.0::DOUBLE, greatest(0.002::DOUBLE, 5.0::DOUBLE / count(*))) * count(*)) AS least FROM lab),
sets AS (SELECT s, count(*) AS c, count(*) FILTER (bad) AS k FROM (SELECT bad, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS s FROM (SELECT items, bad, unnest(range(1, 1 << len(items))) AS m FROM lab)) GROUP BY s),
tried AS (SELECT greatest(count(*), 1) AS tried FROM sets, n WHERE c >= n.least),
found AS (SELECT s, k / c AS conf, array_to_string(s, ' & ') AS rule FROM sets, n, tried WHERE base > 0 AND base < 1 AND k >= n.least AND k / c >= greatest(0.5, 1.5 * base)
  AND ln(tried) - c * (k / c * ln(k / c / base) + CASE WHEN k < c THEN (1 - k / c) * ln((1 - k / c) / (1 - base)) ELSE 0 END) <= ln(0.05)),
rules AS (SELECT * FROM found y WHERE NOT EXISTS (SELECT 1 FROM found x WHERE len(x.s) < len(y.s) AND x.conf >= y.conf AND list_has_all(y.s, x.s))),
hit AS (SELECT url, max_by(rule, (conf, rule)) AS mined FROM (SELECT DISTINCT url, items FROM t) JOIN rules ON list_has_all(items, s) GROUP BY url),
fixed AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) f(fh, fp, fv)),
own AS (SELECT page_id, t.url, host, path, mined, (SELECT max_by((fh || fp, fv), length(fh || fp)) FROM fixed WHERE (host = fh OR ends_with(host, '.' || fh)) AND starts_with(path, fp)) AS f FROM t LEFT JOIN hit USING (url))
SELECT page_id, host, path, f[1] AS rule, coalesce(f[2], CASE WHEN mined IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, mined AS mined_rule FROM own"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    held = _LINES.replace("SELECT base.*, failed", "SELECT base.* EXCLUDE (failed), failed")
    return {"op1_ngram_jaccard_join": _JOIN, "op3_jump_sharding": _SHARDS, "op5_block_max_search": _SEARCH, "op7_url_rules": _RULES, "op8_line_frequency": held}
