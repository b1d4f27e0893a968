"""Sharding, URL rules and line frequency: brute force on small fixtures, and plans without Python."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import pyarrow as pa

from cliploom.llm import line_frequency, queries, sharding, url_rules

SF = "/root/testdata/sf0.01"


def jump(key, n):
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def plain_plan(df):
    return not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_jump_and_slots(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall() + [(-1, "x"), (2**63 - 1, None), (-(2**63), "é"), (None, ""), (7, "a"), (7, "a")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, shard int, part int")
    res = sharding.shard(df)
    assert plain_plan(res)
    out = res.collect()
    size = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == size
    assert all(r.shard == jump(r.doc_id or 0, 24) and r.grown_shard == jump(r.doc_id or 0, 25) and r.law == "key" for r in out)
    assert all(r.grown_shard in (r.shard, 24) for r in out)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(df.limit(0)).collect() == []


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/1?x#y", "https://a.example.com/en/", "ftp://example.com/de", "x://com", "http://x.net/es/1", "http://x.net/frx/", "http://x.net/fr/#z", "http://net/es", "no url", None, "", "a://", "a://b://c/d", "http://notexample.com/en/", "http://x.org/en/1"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = url_rules.judge(pages, none)
    assert plain_plan(out)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 1: ("a.example.com", "/en/", "example.com/en/", "block"), 2: ("example.com", "/de", "com/", "allow"),
        3: ("com", "", None, "allow"), 4: ("x.net", "/es/1", "net/es/", "block"), 5: ("x.net", "/frx/", None, "allow"), 6: ("x.net", "/fr/", "net/fr/", "block"), 7: ("net", "/es", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"), 12: ("b:", "//c/d", None, "allow"), 13: ("notexample.com", "/en/", "com/", "allow"), 14: ("x.org", "/en/1", None, "allow"),
    }
    assert url_rules.judge(pages.limit(0), none).collect() == []


def test_mined_rules(spark):
    rows = [(i, f"http://{'bad' if i % 3 == 0 else 'good'}.example.org/{'casino' if i % 2 else 'news'}/{i}") for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 and i % 2 else 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    out = {r.page_id: (r.verdict, r.mined_rule) for r in url_rules.judge(pages, labels, support=0.05, confidence=0.9, least=3).collect()}
    assert all(out[i][0] == ("block" if i % 3 == 0 and i % 2 else "allow") for i in range(120))


def blocked(rows, bad, support, confidence, least, lift, chance):
    """Rows whose tokens hold all of a rule's, from every set of tokens of every labelled row; rows: {id: tokens}."""
    known = {i: t for i, t in rows.items() if i in bad and t}
    sets, hits = Counter(), Counter()
    for i, t in known.items():
        for k in range(1, len(t) + 1):
            for c in combinations(sorted(t), k):
                sets[c] += 1
                hits[c] += bad[i]
    n, base = len(known), sum(bad[i] for i in known) / max(1, len(known))
    if not 0 < base < 1:
        return set()
    share = min(1.0, max(support, least / n))
    tried, rules = sum(c >= share * n for c in sets.values()), []
    for s, c in sets.items():
        p = hits[s] / c
        if hits[s] >= share * n and p >= max(confidence, lift * base):
            nats = c * (p * math.log(p / base) + ((1 - p) * math.log((1 - p) / (1 - base)) if p < 1 else 0))
            if math.log(tried) - nats <= math.log(chance):
                rules.append(set(s))
    return {i for i, t in rows.items() if any(r <= set(t) for r in rules)}


def test_shipped_parameters(spark):
    """A known signal is found by the registered query's parameters and none by labels that ignore the URL: as brute force."""
    r = random.Random(11)
    urls = {i: f"{r.choice(['http', 'https'])}://{r.choice(['www', 'm', 'win'])}.site{r.randrange(4)}.org/{r.choice(['en', 'de'])}/{r.choice(['casino/', 'news/', ''])}{i}.html" for i in range(900)}
    spam = {i: "://win." in u and "/casino/" in u for i, u in urls.items()}
    noisy = {i: r.random() < (0.9 if spam[i] else 0.15) for i in range(0, 900, 2)}
    chance = {i: r.random() < 0.25 for i in range(0, 900, 2)}
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string").repartition(3)
    cut = pages.withColumns({"host": url_rules.host("url"), "path": url_rules.path("url")})
    items = {x.page_id: x.t for x in cut.select("page_id", url_rules.tokens("url").alias("t")).collect()}
    for bad, some in ((noisy, True), (chance, False)):
        labels = spark.createDataFrame([(i, 0 if b else 1, 0) for i, b in bad.items()], "doc_id long, quality int, toxic int")
        out = {x.page_id: x for x in url_rules.judge(pages, labels).collect()}
        want = blocked(items, bad, 0.002, 0.5, 5, 1.5, 0.05)
        assert {i for i, x in out.items() if x.verdict == "block"} == want and (len(want) > 50) == some
        assert all(x.mined_rule is not None for i, x in out.items() if i in want)
        con = duckdb.connect()
        con.register("pages", pa.table({"page_id": list(urls), "url": list(urls.values())}))
        con.register("labels", pa.table({"doc_id": list(bad), "quality": [int(not b) for b in bad.values()], "toxic": [0] * len(bad)}))
        told = {r[0]: r[1:] for r in con.execute(queries.oracle_sql()["op7_url_rules"]).fetchall()}
        assert told == {i: (x.host, x.path, x.rule, x.verdict, x.mined_rule) for i, x in out.items()}
    assert want == set()


def test_line_figures(spark):
    rows = duckdb.sql(f"select doc_id, text, source from '{SF}/documents.parquet'").fetchall()
    rows += [(10**6, None, None), (10**6 + 1, "", "s"), (10**6 + 2, "a b c d e a b c d e f", "s"), (10**6 + 3, "x " * 30 + "\nq\nq\n \n#", "s"), (10**6 + 4, "a b c d e \n a  b\tc d\x0be g\x1ch", "s")]
    df = spark.createDataFrame([(i, t, s, "c", 1) for i, t, s in rows], "doc_id long, text string, source string, words string, n_words int")
    res = line_frequency.judge(df)
    assert plain_plan(res)
    out = {r.doc_id: r for r in res.collect()}
    assert len(out) == len(rows)
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        seen = Counter(zip(w, w[1:], w[2:], w[3:], w[4:]))
        covered = {p + q for p, x in enumerate(zip(w, w[1:], w[2:], w[3:], w[4:])) if seen[x] > 1 for q in range(5)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def test_line_limits(spark):
    common = "This line 12 stands in all the texts of one host"
    rows = [(i, f"{common.replace('12', str(i))}\n" + ("one more word" if i < 5 else " ".join(chr(97 + i % 26) * (1 + i // 26) + chr(97 + j) for j in range(26))), "a") for i in range(40)]
    rows += [(100 + i, common + "\nshort", "b") for i in range(3)] + [(200 + i, "exact copy of a text of more than ten words in one host", "c") for i in range(30)]
    out = {r.doc_id: r.kept for r in line_frequency.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert sorted(i for i, k in out.items() if not k) == [0, 1, 2, 3, 4, *range(200, 230)]


def test_lines_are_removed(spark):
    """clean() takes out the lines that over ten documents of a host have, and the documents that judge() rejects."""
    menu = "Home  About Contact 12"
    body = lambda i: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(14))
    rows = [(i, f"{menu.upper() if i % 2 else menu}\n{body(i)}\n\n{menu}", "a") for i in range(11)] + [(20, f"{menu}\n{body(20)}", "b"), (21, f"{menu}\n" * 20 + "three own words", "a"), (22, "too short", "a"), (23, None, "a")]
    rows += [(None, f"{menu}\n{body(30)}", "a"), (None, f"{menu}\n{body(30)}", "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, gone string, `hits.no` int").repartition(3)
    out = line_frequency.clean(df)
    assert out.columns == df.columns
    want = [(str(i), f"{body(i)}\n") for i in range(11)] + [("20", f"{menu}\n{body(20)}")] + [("None", body(30))] * 2
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted(want)
    kept = {str(r.doc_id) for r in line_frequency.judge(df).filter("kept").collect()}
    assert kept == {i for i, _ in want} and line_frequency.clean(df.limit(0)).collect() == []


def test_registered(spark):
    assert plain_plan(queries.op3_jump_sharding(spark, SF)) and plain_plan(queries.op8_line_frequency(spark, SF))
    assert queries.op7_url_rules(spark, SF).count() == 250
