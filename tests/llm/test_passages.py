"""The pipeline's repeats stage: passages of over 50 words go however short in bytes, shorter ones stay."""

import random
import re

import corpus_pipeline

WORD = r"[^\x20\x09-\x0D]+"


def words(seed, n, size=5):
    r = random.Random(seed)
    return ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=size)) for _ in range(n)]


def brute(rows, width, least):
    """Texts without the bytes in strings of `width` bytes or passages of `least` words that recur; None: no word left."""
    raw = [(t or "").encode() for t in rows]
    mask, seen = [bytearray(len(b)) for b in raw], {}
    for n, b in enumerate(raw):
        for p in range(len(b) - width + 1):
            seen.setdefault(b[p : p + width], []).append((n, p, p + width))
        at = [m.span() for m in re.finditer(WORD.encode(), b)]
        for p in range(len(at) - least + 1):
            seen.setdefault(tuple(b[x:y] for x, y in at[p : p + least]), []).append((n, at[p][0], at[p + least - 1][1]))
    for where in seen.values():
        for n, a, e in where if len(where) > 1 else ():
            mask[n][a:e] = b"\1" * (e - a)
    kept = [bytes(x for x, y in zip(b, m, strict=True) if not y).decode("utf-8", "ignore") for b, m in zip(raw, mask, strict=True)]
    return [k if k.strip() or not any(m) else None for k, m in zip(kept, mask, strict=True)]


def test_passages_of_over_50_words(spark):
    short, fifty, tiny, longer, own = words(1, 51), words(2, 50), words(3, 51, 1), words(4, 51, 9), words(8, 55)
    assert len(" ".join(short)) < 400 and len(" ".join(tiny)) == 101
    texts = []
    for i, passage in enumerate((short, fifty, tiny, longer)):
        texts += [" ".join(words(100 + i, 30) + passage + words(200 + i, 40)), " ".join(words(300 + i, 7) + passage) + "\n" + " ".join(words(400 + i, 25))]
    texts += ["é " + "\n".join(short) + "\tü", " ".join(words(9, 20) + own + words(10, 9) + own), " ".join(short).upper(), " ".join(words(11, 60)), " ".join(words(11, 60)), "y " * 52, "", None]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long").repartition(3)
    out = {r.doc_id: r for r in corpus_pipeline.repeats(spark, df, "").collect()}
    want = brute(texts, 400, 51)
    assert {i: r.text or "" for i, r in out.items()} == {i: t for i, t in enumerate(want) if t is not None}
    assert all(r.n_chars == len(r.text) for r in out.values() if r.text is not None)
    assert " ".join(short) not in out[0].text and " ".join(tiny) not in out[4].text and out[2].text == texts[2]


def test_passages_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, docs, "").collect()}
    want = brute([t for _, t in rows], 400, 51)
    assert out == {i: w for (i, _), w in zip(rows, want, strict=True) if w is not None}
