"""Quality scores learned from preference pairs (Bradley-Terry).

P(document i is preferred to j) = sigmoid(w . (x_i - x_j)), with x a document's features. Pairs are drawn
between documents of label 1 and of label 0 in a bounded sample of labelled rows; w minimises the logistic loss
on the feature differences with a ridge. A quantile of the sample's scores is the threshold: the one with the
best balanced accuracy on the sample. It becomes score 0.5 of a logistic scale.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.llm._util import plain, text_slices

#: Labelled rows that a model is fitted on, at most: those of least hash of their id.
SAMPLE = 12_000
#: Preference pairs drawn for each sampled row of the rarer label.
PAIRS = 12

NAMES = ("log_words", "word_length", "distinct", "adjacent", "upper", "digits", "symbols", "shouts", "ends", "commas", "line_words", "same_lines", "top_word", "repeats", "other", "long_words", "no_words")


def features(text: str | None) -> list[float]:
    """Numbers from the whole text alone; an empty or null text gets zeros but for its last feature."""
    words = (text or "").split()
    if not words:
        return [0.0] * (len(NAMES) - 1) + [1.0]
    n, chars = len(words), sum(map(len, words))
    count = Counter(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    fives = Counter(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    letters = sum(map(str.isalpha, text)) or 1
    return [
        np.log1p(n),
        min(chars / n, 30),
        len(count) / n ** 0.8,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        sum(map(str.isupper, text)) / letters,
        sum(map(str.isdigit, text)) / chars,
        min(1.0, 10 * sum(text.count(c) for c in "#*$%&|<>{}[]=_~^\\") / chars),
        min(1.0, 5 * (text.count("!") + text.count("?")) / n),
        min(1.0, 5 * sum(w[-1] in ".!?:;" for w in words) / n),
        min(1.0, 5 * text.count(",") / n),
        np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        max(count.values()) / n,
        1 - len(fives) / max(1, sum(fives.values())),
        sum(not c.isalnum() and not c.isspace() for c in text) / chars,
        sum(len(w) > 20 for w in words) / n,
        0.0,
    ]


def _wide(x: np.ndarray) -> np.ndarray:
    """Each feature with its excess over three points, so that a score can rise and fall."""
    return np.concatenate([x, *(np.maximum(x - c, 0) for c in (0.0, 1.0, 2.0))], axis=1)


class Ranker:
    """Standardised features -> score in (0, 1)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = 17) -> None:
        self.mean = x.mean(axis=0) if len(x) else np.zeros(len(NAMES))
        self.scale = x.std(axis=0) + 1e-6 if len(x) else np.ones(len(NAMES))
        self.w, self.cut, self.width = np.zeros(4 * len(NAMES)), 0.0, 1.0
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            self.cut = -1.0 if len(good) or not len(bad) else 1.0  # one label only, or none: as it says, else good
            return
        z = self._z(x)
        rng = np.random.default_rng(seed)
        few = pairs * min(len(good), len(bad))
        few = max(few, max(len(good), len(bad)))
        diff = z[good[rng.permutation(few) % len(good)]] - z[bad[rng.permutation(few) % len(bad)]]
        for _ in range(25):  # Newton's steps on the mean logistic loss
            p = 1 / (1 + np.exp(np.clip(diff @ self.w, -35, 35)))
            grad = -(diff * p[:, None]).mean(axis=0) + ridge * self.w
            hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(self.w))
            step = np.linalg.solve(hess, grad)
            self.w -= step / max(1.0, np.abs(step).max())
            if np.abs(step).max() < 1e-6:
                break
        s = z @ self.w
        q = np.unique(np.quantile(s, np.arange(1, 400) / 400))
        right = [(s[good] >= c).mean() + (s[bad] < c).mean() for c in q]
        best = np.flatnonzero(np.array(right) >= max(right) - 1e-12)
        self.cut = float(q[best[len(best) // 2]])

    def _z(self, x: np.ndarray) -> np.ndarray:
        return _wide(np.clip((x - self.mean) / self.scale, -8, 8))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self._z(x) @ self.w - self.cut) / self.width, -35, 35)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_slices(batches):
        x = [features(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "x"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", use=None) -> Ranker:
    """Fit on at most `sample` labelled rows (those of least hash of their id) for which `use` (a Column) holds.

    Rows with a null label, id or text are left out; of an id labelled twice the greatest label counts, of an id
    with several texts the least; without rows of both labels every document scores alike.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label).alias("y")).filter("id is not null and y is not null")
    known = known.filter(F.lit(True) if use is None else use).groupBy("id").agg(F.max("y").alias("y"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = plain(docs, id_col, text_col).toDF("id", "text").filter("text is not null")
    held = rows.join(F.broadcast(known), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    table = held.mapInArrow(_features, "id long, y int, x array<double>")
    got = sorted((r.id, r.y, tuple(r.x)) for r in table.collect())  # at most `sample` short rows
    return Ranker(np.array([r[2] for r in got]).reshape(-1, len(NAMES)), np.array([r[1] for r in got]))


def score(docs: DataFrame, model: Ranker, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with a score column (0 to 1) from the text alone; null and empty texts get the empty text's score."""

    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    names, width = docs.columns, len(docs.columns)
    numbered = [f"c{i}" for i in range(width)]  # names that Python workers can be given, whatever those of docs
    text = numbered[names.index(text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            x = np.array([features(t) for t in b.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(model(x))], names=[*names, name])

    return docs.toDF(*numbered).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
