import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from cliploom.llm import line_dedup

SCHEMA = "doc_id long, text string, th int, lines string"


def brute(rows, percent, k):
    """Per id: (lines, removed lines, sha256 of the rest)."""
    return {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in rest(rows, percent, k).items()}


def rest(rows, percent, k):
    """Per id: (lines, removed lines, the text without them)."""
    lines = []
    for i, t in rows:
        for no, x in enumerate((t or "").split("\n")):
            x = line_dedup.normal(x).decode()
            if x:
                lines.append((i, no, {x} if len(x) < k else {x[j : j + k] for j in range(len(x) - k + 1)}))
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(lines)):
        for b in range(a):
            both = len(lines[a][2] & lines[b][2])
            if both and 100 * both >= percent * (len(lines[a][2]) + len(lines[b][2]) - both):
                root[find(a)] = find(b)
    first = {}
    for a, (i, no, _) in enumerate(lines):
        first[find(a)] = min(first.get(find(a), (i, no)), (i, no))
    gone = {(i, no) for a, (i, no, _) in enumerate(lines) if (i, no) != first[find(a)]}
    out = {}
    for i, t in rows:
        split = (t or "").split("\n")
        kept = "\n".join(x for no, x in enumerate(split) if (i, no) not in gone)
        out[i] = (len(split) if t else 0, sum((i, no) in gone for no in range(len(split))), kept)
    return out


def test_equals_brute_force(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdeéß ") for _ in range(r.randint(2, 8)))
    pool = [" ".join(word() for _ in range(r.randint(1, 30))) for _ in range(60)]
    rows = []
    for i in range(90):
        lines = []
        for _ in range(r.randint(0, 7)):
            x = list(r.choice(pool))
            for _ in range(r.choice([0, 0, 0, 1, 2])):
                x[r.randrange(len(x))] = r.choice("XYZ")
            lines.append(r.choice(["", " "]) + "".join(x) + r.choice(["", "\t"]))
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "x\nX\n x \ny"), (204, "abcdefghi\nabcdefghj")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3)
    out = {x.doc_id: (x.n_lines, x.n_removed, x.kept_sha256) for x in line_dedup.dedup(df, bands=15, rows=2).collect()}
    assert out == brute(rows, 80, 10)


def test_empty_and_repeated_rows(spark):
    assert line_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "same line here\nother"), (1, "same line here\nother"), (None, "other")], "doc_id long, text string")
    assert sorted((str(x.doc_id), x.n_removed) for x in line_dedup.dedup(df).collect()) == [("1", 1), ("1", 1), ("None", 0)]


def test_a_document_of_very_many_equal_lines(spark):
    many = "one line\n" * 80_000 + "another line"
    df = spark.createDataFrame([(1, many), (2, "One  line")], "doc_id long, text string")
    start = time.monotonic()
    out = {r.doc_id: r for r in line_dedup.dedup(df).collect()}
    assert time.monotonic() - start < 60
    assert (out[1].n_lines, out[1].n_removed, out[1].kept) == (80_001, 79_999, "one line\nanother line") and out[2].n_removed == 1
    assert [r.text for r in line_dedup.clean(df).collect()] == ["one line\nanother line"]


def links(lines, percent, k):
    """Pairs of distinct normalised lines that are alike, by an inverted index over all their shingles."""
    sets = [{x} if len(x) < k else {x[j : j + k] for j in range(len(x) - k + 1)} for x in lines]
    held, both = defaultdict(list), Counter()
    for n, s in enumerate(sets):
        for g in s:
            for m in held[g]:
                both[m, n] += 1
            held[g].append(n)
    return [(a, b) for (a, b), c in both.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]


def test_recall_of_the_shipped_bands(spark):
    """Every pair of alike lines of a table must end in one component; measured on the links brute force finds."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null")
    lines = sorted({x for r in docs.collect() for x in map(line_dedup.normal, r.text.split("\n")) if x})
    lines = [x.decode() for x in lines]
    want = links(lines, 80, 10)
    assert len(want) > 100
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.dedup(df).filter("n_removed > 0").collect()}
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in want:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    alike = {n for n in range(len(lines)) if find(n) != n}  # all but the first line of each component
    assert gone <= alike and len(gone) >= 0.9 * len(alike)
    print("recall", len(gone) / len(alike), "of", len(alike))


def test_lines_of_a_text_are_normalised_as_each_alone():
    texts = ["", "\n", "One two\nOne  two\n", " A\tb \n\x0bC\x0c\r\nd", "ÉtÉ \u0085 x\n y", "plain\n lead\ntrail \n\n", "a\x1cb \x1c\nB"]
    for x in texts:
        assert line_dedup.normals(x.encode()) == [line_dedup.normal(line) for line in x.split("\n")]


def test_sets_do_not_depend_on_the_parts_that_are_hashed_at_once():
    lines = [b"", b"ab", b"x" * 70_000, "é\U0001d11e".encode() * 9, *(f"line {i} of words {i * 7919 % 104729}".encode() for i in range(3000)), b"0123456789"]
    alone = [line_dedup.sets([x], 10)[0] for x in lines]
    assert all(np.array_equal(a, b) for a, b in zip(line_dedup.sets(lines, 10), alone, strict=True))
    assert [len(x) for x in alone[:4]] == [0, 1, 1, 2]
    assert len(line_dedup._cache_sized(np.array([len(x) for x in lines]))) > 3


def test_no_sort_of_all_shingles_at_once(monkeypatch):
    monkeypatch.setattr(np, "lexsort", lambda *_: pytest.fail("all lines' shingles are sorted together"))
    assert [len(x) for x in line_dedup.sets([b"0123456789ab", b"0000000000000"], 10)] == [3, 1]
