"""Window encoders, embeddings and principal components."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_embedding(rows: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(key, pos, value): the mean of each column over a clip's windows, one plain aggregate."""
    means = rows.groupBy(key).agg(*[F.avg(c).alias(f"_{i}") for i, c in enumerate(columns)])
    return means.select(key, F.posexplode(F.array(*[f"_{i}" for i in range(len(columns))])).alias("pos", "value"))


@dataclass
class Encoder:
    """Convolutions over a window, each with scale, shift and ELU; weights [out, in, size]."""

    layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    seconds: float

    @classmethod
    def random(cls, channels: int, hidden: Sequence[int], latent: int, size: int, seconds: float, seed: int) -> Encoder:
        if size % 2 == 0:
            raise ValueError("the window must have an odd number of samples")
        rng = np.random.default_rng(seed)
        widths = [channels, *hidden, latent]
        layers = [(rng.normal(0, 1 / np.sqrt(i * size), (o, i, size)), np.ones(o), np.zeros(o)) for i, o in zip(widths, widths[1:], strict=False)]
        return cls(layers, seconds)

    def to_json(self) -> str:
        return json.dumps({"seconds": self.seconds, "layers": [[w.tolist(), a.tolist(), b.tolist()] for w, a, b in self.layers]})

    @classmethod
    def from_json(cls, text: str) -> Encoder:
        held = json.loads(text)
        return cls([tuple(np.array(x) for x in layer) for layer in held["layers"]], held["seconds"])

    def latent(self, x: np.ndarray) -> np.ndarray:
        """[windows, channels, size] -> [windows, latent, size]."""
        for weight, scale, shift in self.layers:
            half = weight.shape[2] // 2
            padded = np.pad(x, ((0, 0), (0, 0), (half, half)))
            view = np.lib.stride_tricks.sliding_window_view(padded, weight.shape[2], axis=2)
            x = np.einsum("ncts,ocs->not", view, weight) * scale[:, None] + shift[:, None]
            x = np.where(x > 0, x, np.expm1(np.minimum(x, 0)))
        return x

    def parameters(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Amplitude, frequency and offset of each latent channel, from its Fourier power."""
        z = np.fft.rfft(self.latent(x), axis=-1)
        n = x.shape[-1]
        power = np.abs(z[..., 1:]) ** 2
        total = power.sum(-1) + 1e-8
        freq = (np.arange(1, power.shape[-1] + 1) / self.seconds * power).sum(-1) / total
        return 2 * np.sqrt(total) / n, freq, z[..., 0].real / n


def samples(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """[windows, columns, samples] of array columns of one length."""
    size = pc.list_value_length(batch.column(columns[0])).to_numpy(zero_copy_only=False)
    if any(not np.array_equal(pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False), np.full(len(size), size[0])) for c in columns):
        raise ValueError("windows must have one length")
    return np.stack([batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(size), -1) for c in columns], axis=1)


def encode(rows: DataFrame, encoder: Encoder, by: Sequence[str], pos: str, columns: Sequence[str]) -> DataFrame:
    """by, amp, freq, offset (arrays): the windows' samples are packed to a row each and encoded in Arrow batches."""
    packed = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(pos, *columns))).alias("_w"))
    return encode_packed(packed.select(*by, *[F.col(f"_w.{c}").alias(c) for c in columns]), encoder, by, columns)


def encode_packed(packed: DataFrame, encoder: Encoder, by: Sequence[str], columns: Sequence[str], most: int = 2048) -> DataFrame:
    """by, amp, freq, offset (arrays) of windows that are a row each, an array a column; `most` at once."""
    kinds = dict(packed.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                b = whole.slice(at, most)
                found = [pa.array(list(v), pa.list_(pa.float64())) for v in encoder.parameters(samples(b, columns))]
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in by), *found], names=[*by, "amp", "freq", "offset"])

    return packed.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in by), "amp array<double>", "freq array<double>", "offset array<double>"]))


def pca(rows: DataFrame, vector: str, name: str, components: int = 3) -> DataFrame:
    """(name, pc): coordinates on the main components, padded with zeros to `components`.

    The covariance is a tree aggregate in the JVM; each component's sign makes its largest loading positive.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.feature import PCA

    size = rows.select(F.size(vector).alias("d")).agg(F.max("d"), F.count("*")).first()
    k = min(components, size[0] or 0, size[1])
    if k == 0:
        return rows.select(name, F.array(*[F.lit(0.0)] * components).alias("pc")).limit(0)
    features = rows.select(name, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(features)
    loadings = model.pc.toArray()
    sign = [1.0 if loadings[np.argmax(np.abs(loadings[:, i])), i] >= 0 else -1.0 for i in range(k)]
    mean = rows.select(F.posexplode(F.col(vector).cast("array<double>"))).groupBy("pos").agg(F.avg("col").alias("m")).orderBy("pos")
    centre = np.array([r.m for r in mean.collect()]) @ loadings  # one number a dimension
    out = model.transform(features).select(name, vector_to_array("_p").alias("_p"))
    return out.select(name, F.array(*[(F.col("_p")[i] - float(centre[i])) * sign[i] for i in range(k)], *[F.lit(0.0)] * (components - k)).alias("pc"))


def perplexity(wanted: float, rows: int) -> float:
    """A perplexity that t-SNE accepts for so many rows."""
    return min(wanted, max(1.0, (rows - 1) / 3))


def train(windows: np.ndarray, encoder: Encoder, epochs: int = 1, rate: float = 1e-3, batch: int = 256) -> list[float]:
    """Fit a linear read-out of the latent sinusoids to the windows by least squares steps; losses by epoch.

    A small single-node trainer for windows that fit in memory: batches in order, the last short one left out.
    """
    n, channels, size = windows.shape
    time = np.linspace(-encoder.seconds / 2, encoder.seconds / 2, size)
    read = np.zeros((channels, encoder.layers[-1][0].shape[0]))
    losses = []
    for _ in range(epochs):
        total, seen = 0.0, 0
        for at in range(0, n - batch + 1, batch):
            x = windows[at : at + batch]
            amp, freq, offset = encoder.parameters(x)
            wave = amp[..., None] * np.sin(2 * np.pi * freq[..., None] * time) + offset[..., None]
            error = np.einsum("cl,nlt->nct", read, wave) - x
            read -= rate * np.einsum("nct,nlt->cl", error, wave) / (batch * size)
            total, seen = total + float((error**2).mean()) * batch, seen + batch
        losses.append(total / max(seen, 1))
    return losses
