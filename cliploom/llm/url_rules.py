"""URL filter: fixed host and path rules, then association rules mined from labelled URLs by FP-growth."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD, GOOD = "label=bad", "label=good"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: str) -> Column:
    """What follows the host, up to ? or #."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: str) -> Column:
    """A URL's distinct tokens: scheme, host, its parent domains, first label, folders, ending, query names.

    Numbers are masked, so that identifiers don't make tokens of their own.
    """
    labels = F.split("host", r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat(F.lit("domain="), F.array_join(F.slice(labels, i + 1, n), ".")))
    folders = F.filter(F.split("path", "/"), lambda x: x != "")
    folders = F.transform(folders, lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(F.col(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1)))
    single = F.array(F.concat(F.lit("scheme="), F.substring_index(F.col(url), "://", 1)), F.concat(F.lit("host="), F.col("host")), F.concat(F.lit("first="), labels[0]))
    found = F.concat(single, parents, folders, names)
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(found, lambda x: ~x.endswith("="))))


def mine(items: DataFrame, support: float = 0.002, confidence: float = 0.5, least: int = 5, lift: float = 1.5, chance: float = 0.05) -> DataFrame:
    """Rules (rule, antecedent, confidence, support, key) for the bad label, from transactions(items).

    Pruned by support (a share of the transactions, and `least` of them), by confidence, by lift over the share of
    bad transactions, and by chance: were the label drawn apart from the URL, k bad ones of n would come up with a
    probability of at most exp(-n KL(k / n, share)) (Chernoff), and over all sets of tokens tried the sum of it must
    stay within `chance`. Of two rules the longer goes if the shorter one is contained in it and no less confident.
    key is a rule's rarest token. Without labelled rows, or with one label only, there are no rules.
    """
    n, bad = items.agg(F.count("*"), F.count_if(F.array_contains("items", BAD))).first()
    if not 0 < bad < n:
        empty = "rule string, antecedent array<string>, confidence double, support double, key string"
        return items.sparkSession.createDataFrame([], empty)
    share = min(1.0, max(support, least / n))
    base, floor = bad / n, max(confidence, lift * bad / n)
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min(1.0, floor)).fit(items)
    sets = model.freqItemsets
    tried = sets.filter(~F.array_contains("items", BAD) & ~F.array_contains("items", GOOD)).count()
    rules = model.associationRules.filter(F.array_contains("consequent", BAD)).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    c, rows = F.col("confidence"), F.col("support") * n / F.col("confidence")
    nats = c * F.log(c / base) + F.when(c < 1, (1 - c) * F.log((1 - c) / (1 - base))).otherwise(0.0)
    rules = rules.filter((c >= floor) & (F.log(F.lit(float(max(tried, 1)))) - rows * nats <= F.log(F.lit(chance))))
    rules = rules.withColumn("rule", F.array_join("antecedent", " & "))
    single = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = rules.select("rule", F.explode("antecedent").alias("token")).join(single, "token").groupBy("rule").agg(F.min(F.struct("freq", "token")).alias("r"))
    rules = rules.join(rarest, "rule").select("rule", "antecedent", "confidence", "support", F.col("r.token").alias("key"))
    wide = rules.select("rule", "antecedent", "confidence", F.explode("antecedent").alias("key"))
    inside = F.size(F.array_except("x.antecedent", "y.antecedent")) == 0
    covered = rules.alias("x").join(wide.alias("y"), "key").filter(inside & (F.size("x.antecedent") < F.size("y.antecedent")) & (F.col("x.confidence") >= F.col("y.confidence")))
    return rules.join(covered.select("y.rule").distinct(), "rule", "left_anti")


def matches(rows: DataFrame, key: list[str], rules: DataFrame) -> DataFrame:
    """key, rule_id (most confident) of rows(key, items) that hold all tokens of a rule.

    The inverted index holds a rule once, under its rarest token, so common tokens meet only the rules made of
    nothing rarer; the other tokens are checked on the row.
    """
    index = rules.select(F.col("key").alias("token"), "rule", "antecedent", "confidence")
    hits = rows.select(*key, "items", F.explode("items").alias("token")).join(index, "token").filter(F.size(F.array_except("antecedent", "items")) == 0)
    return hits.groupBy(*key).agg(F.max_by("rule", F.struct("confidence", "rule")).alias("rule_id"))


#: (host and all its subdomains, path prefix, verdict): fixed values.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple = RULES, support: float = 0.002, confidence: float = 0.5, least: int = 5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule for each row of pages.

    The longest fitting rule decides; otherwise a page is blocked if a mined rule matches, else allowed. Labels
    are those of the document that a URL's last path segment numbers; a document of quality 0 or toxic is bad.
    Null URLs and those without :// have empty host and path, fit no rule and are allowed. Repeated pages are
    judged alike, each in a row of its own; without labels nothing is mined; extra columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host("url"), "path": path("url")})
    rows = rows.withColumn("items", tokens("url"))
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1).try_cast("bigint")
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad"))
    labelled = rows.withColumn("doc_id", number).join(known, "doc_id").filter(F.size("items") > 0)
    labelled = labelled.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.concat("items", F.array(F.lit(GOOD)))).alias("items"))
    mined = mine(labelled, support, confidence, least)
    distinct = rows.filter("size(items) > 0").select("url", "items").distinct()
    hit = matches(distinct, ["url"], mined)
    fits = lambda h, p: ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
    chosen = F.coalesce(*[F.when(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))])
    out = rows.withColumn("fixed", chosen).join(hit, "url", "left")
    method = F.when(F.col("rule_id").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce("fixed.verdict", method).alias("verdict"), F.col("rule_id").alias("mined_rule"))
