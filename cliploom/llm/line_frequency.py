"""Quality rules: figures of each text, and the frequency of its lines across a host's documents.

DataFrame expressions only. The base figures come from one projection over the text. For the frequencies each
document's normalised lines are hashed; a line's count is the number of its host's distinct documents that have
it, and lines over a host's limit are boilerplate. They are removed; a document that loses most of its words with
them is depleted and rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.llm._util import Workspace, without_lines

_SPACE = " \t\n\x0b\f\r"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeat_words() -> Column:
    """Words covered by windows whose hash recurs: sort (hash, position), take equal neighbours, merge spans."""
    at = "transform(array(sort_array(transform(hashes, (h, i) -> struct(h, i)))), s -> sort_array(transform(filter(s, (x, k) -> (k > 0 and s[k - 1].h = x.h) or (k < size(s) - 1 and s[k + 1].h = x.h)), x -> x.i)))[0]"
    merged = f"aggregate({at}, named_struct('e', 0, 'n', 0L), (a, p) -> named_struct('e', p + 5, 'n', a.n + (p + 5 - greatest(a.e, p))), a -> a.n)"
    return F.when(F.size(F.array_distinct("hashes")) == F.size("hashes"), F.lit(0).cast("long")).otherwise(F.expr(merged))


def base(rows: DataFrame) -> DataFrame:
    """rows(text, ...) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce("text", F.lit(""))
    bare = F.length(F.translate(text, _SPACE, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, _SPACE, "") != "")
    out = rows.withColumns({
        "words": _words(text),
        "worded": lines,
        "word_chars": bare.cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
    })
    hashes = F.expr("if(size(words) < 5, cast(array() as array<bigint>), transform(sequence(0, size(words) - 5), i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])))")
    out = out.withColumns({"n_words": F.size("words").cast("long"), "n_dup_lines": (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long"), "hashes": hashes})
    out = out.withColumn("n_repeat_words", _repeat_words()).drop("words", "hashes", "worded")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _normal(text: str) -> Column:
    """The text's lines, lower-cased, with numbers masked and white space collapsed."""
    return F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " ")))


def _occurrences(rows: DataFrame) -> DataFrame:
    """(th, host, doc, no, line, w): hash, number and words of each line that isn't blank, of rows(th, doc_id, text, host)."""
    doc = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    each = rows.filter("text is not null").select("th", "host", doc.alias("doc"), F.posexplode(_normal("text")).alias("no", "line")).filter("line <> ''")
    return each.select("th", "host", "doc", "no", F.xxhash64("line").alias("line"), (F.length("line") - F.length(F.translate("line", " ", "")) + 1).alias("w"))


def _boilerplate(lines: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, line, hit) of the lines that more than max(min_docs, share * documents) of the host's documents have."""
    held = lines.groupBy("host", "line", "doc").agg(F.lit(1))
    counts = held.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > min_docs)
    hosts = lines.groupBy("host", "doc").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("docs"))
    return counts.join(hosts, "host").filter(F.col("n") > share * F.col("docs")).select("host", "line", F.lit(True).alias("hit"))


def _rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> list[Column]:
    named = {"doc_id": F.col(f"`{id_col}`"), "text": F.col(f"`{text_col}`"), "host": F.coalesce(F.col(f"`{host_col}`"), F.lit(""))}
    return [c.alias(k) for k, c in named.items()] + [F.xxhash64(*named.values()).alias("th")]


def judge(docs: DataFrame, min_docs: int = 10, share: float = 0.01, depleted: float = 0.7, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, boilerplate_share.

    A line is boilerplate if more than max(min_docs, share * the host's documents) of the host's documents have it;
    documents are told apart by id, those without one by text. Lines are compared lower-cased, with numbers masked
    and white space collapsed. Depleted is a document that has more than `depleted` of its words in boilerplate
    lines. kept is false for documents that fail the base rules or are depleted. Null and empty texts have no words
    and fail; a null host is a host; repeated rows get equal results, a row each; an empty table gives an empty
    result; extra columns are ignored. clean() gives the texts without boilerplate.
    """
    ws = Workspace(docs.sparkSession, "frequency")
    rows = docs.select(*_rows(docs, id_col, text_col, host_col))
    figures = ws.save(base(rows).drop("text", "host"))
    lines = ws.save(_occurrences(rows).drop("no"))
    frequent = ws.save(_boilerplate(lines, min_docs, share))
    out = figures.join(_spent(lines, frequent), "th", "left").withColumn("gone", F.coalesce("gone", F.lit(0.0)))
    kept = ~F.col("base_failed") & (F.col("gone") <= depleted)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.round("gone", 6).alias("boilerplate_share"))


def _spent(lines: DataFrame, frequent: DataFrame, *more: Column) -> DataFrame:
    """(th, gone): the part of a document's words in boilerplate lines; with columns aggregated over (no, hit)."""
    spent = lines.join(frequent, ["host", "line"], "left").groupBy("th")
    spent = spent.agg(F.sum("w").alias("w"), F.sum(F.when(F.col("hit"), F.col("w")).otherwise(0)).alias("g"), *more)
    return spent.withColumn("gone", F.col("g") / F.col("w")).drop("w", "g")


def clean(docs: DataFrame, min_docs: int = 10, share: float = 0.01, depleted: float = 0.7, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """docs without their boilerplate lines, and without the documents that judge() doesn't keep.

    The base rules are those of the text as it came. All columns are kept, whatever their names; repeated rows are
    treated alike; an empty table gives an empty one.
    """
    ws = Workspace(docs.sparkSession, "frequency")
    keys = _rows(docs, id_col, text_col, host_col)
    lines = ws.save(_occurrences(docs.select(*keys)))
    frequent = ws.save(_boilerplate(lines, min_docs, share))
    spent = _spent(lines, frequent, F.collect_set(F.when(F.col("hit"), F.col("no"))).alias("hits")).filter("gone > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys[1:])
    rows = base(rows).filter("not base_failed").join(spent, "th", "left").filter(F.col("gone").isNull() | (F.col("gone") <= depleted))
    rest = F.coalesce(without_lines("text", "hits"), "text")
    return rows.select(*[rest.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
