"""Periodic autoencoder of windows: convolutions to latent curves, one sinusoid a curve, convolutions back.

Training is data-parallel: every epoch each partition steps through its own batches with AdamW from the shared
weights, and the weights and moments come back averaged by windows. Only a model a partition reaches the driver.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.operators.learn import Encoder, samples
from cliploom.operators.ranges import settled

#: Bounds of the training step.
CLIP, MOMENTUM, DECAY, TINY = 10.0, 0.1, 1e-2, 1e-5


def _views(x: np.ndarray, size: int) -> np.ndarray:
    half = size // 2
    return np.lib.stride_tricks.sliding_window_view(np.pad(x, ((0, 0), (0, 0), (half, half))), size, axis=2)


def _conv(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.einsum("ncts,ocs->not", _views(x, w.shape[2]), w, optimize=True)


def _conv_back(grad: np.ndarray, x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and of the weights of an odd-sized convolution."""
    weights = np.einsum("not,ncts->ocs", grad, _views(x, w.shape[2]), optimize=True)
    return _conv(grad, np.ascontiguousarray(w.transpose(1, 0, 2)[:, :, ::-1])), weights


@dataclass
class Autoencoder:
    """weights: name -> array; means, variances: running statistics of the normalised layers."""

    weights: dict[str, np.ndarray]
    seconds: float
    running: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def random(cls, channels: int, hidden: Sequence[int], latent: int, size: int, seconds: float, seed: int) -> Autoencoder:
        if size % 2 == 0:
            raise ValueError("the window must have an odd number of samples")
        rng, out, running = np.random.default_rng(seed), {}, {}
        widths = [channels, *hidden, latent]
        for side, sizes in (("enc", widths), ("dec", widths[::-1])):
            for i, (a, b) in enumerate(zip(sizes, sizes[1:], strict=False)):
                name = f"{side}{i}"
                out[f"{name}.w"] = rng.normal(0, 1 / np.sqrt(a * size), (b, a, size))
                if side == "dec" and i == len(sizes) - 2:
                    out[f"{name}.b"] = np.zeros(b)
                else:
                    out |= {f"{name}.scale": np.ones(b), f"{name}.shift": np.zeros(b)}
                    running |= {f"{name}.mean": np.zeros(b), f"{name}.var": np.ones(b)}
        out |= {"phase.w": rng.normal(0, 1 / np.sqrt(size), (latent, 2, size)), "phase.b": np.zeros((latent, 2))}
        return cls(out, seconds, running)

    def _names(self, side: str) -> list[str]:
        return sorted({k.split(".")[0] for k in self.weights if k.startswith(side)}, key=lambda n: int(n[3:]))

    def loss(self, x: np.ndarray, grads: dict[str, np.ndarray] | None = None) -> float:
        """Mean squared error of the windows x [n, channels, size]; fills grads and the running statistics if asked."""
        w, kept, training = self.weights, [], grads is not None

        def layer(name: str, h: np.ndarray) -> np.ndarray:
            a = _conv(h, w[f"{name}.w"])
            if f"{name}.b" in w:
                kept.append((name, h, None, None, None))
                return a + w[f"{name}.b"][:, None]
            mean, var = (a.mean((0, 2)), a.var((0, 2))) if training else (self.running[f"{name}.mean"], self.running[f"{name}.var"])
            if training:
                for k, v in (("mean", mean), ("var", var)):
                    self.running[f"{name}.{k}"] = (1 - MOMENTUM) * self.running[f"{name}.{k}"] + MOMENTUM * v
            root = np.sqrt(var + TINY)[:, None]
            unit = (a - mean[:, None]) / root
            y = unit * w[f"{name}.scale"][:, None] + w[f"{name}.shift"][:, None]
            kept.append((name, h, unit, root, y))
            return np.where(y > 0, y, np.expm1(np.minimum(y, 0)))

        z = x
        for name in self._names("enc"):
            z = layer(name, z)
        n, size = len(x), x.shape[2]
        f = np.fft.rfft(z, axis=-1)
        power = np.abs(f[..., 1:]) ** 2
        total = power.sum(-1) + 1e-8
        rate = np.arange(1, power.shape[-1] + 1) / self.seconds
        amp, freq, offset = 2 * np.sqrt(total) / size, (rate * power).sum(-1) / total, f[..., 0].real / size
        v = np.einsum("nlt,lat->nla", z, w["phase.w"]) + w["phase.b"]
        time = np.linspace(-self.seconds / 2, self.seconds / 2, size)
        turn = 2 * np.pi * freq[..., None] * time + np.arctan2(v[..., 1], v[..., 0])[..., None]
        y = amp[..., None] * np.sin(turn) + offset[..., None]
        for name in self._names("dec"):
            y = layer(name, y)
        error = y - x
        if training:
            self._back(grads, kept, 2 * error / error.size, (z, f, power, total, rate, amp, freq, v, time, turn, n, size))
        return float((error**2).mean())

    def _back(self, grads: dict[str, np.ndarray], kept: list, d: np.ndarray, middle: tuple) -> None:
        def layer(d: np.ndarray) -> np.ndarray:
            name, h, unit, root, y = kept.pop()
            if unit is None:
                grads[f"{name}.b"] = d.sum((0, 2))
            else:
                d = d * np.where(y > 0, 1.0, np.exp(np.minimum(y, 0)))
                grads[f"{name}.scale"], grads[f"{name}.shift"] = (d * unit).sum((0, 2)), d.sum((0, 2))
                d = d * self.weights[f"{name}.scale"][:, None]
                d = (d - d.mean((0, 2), keepdims=True) - unit * (d * unit).mean((0, 2), keepdims=True)) / root
            d, grads[f"{name}.w"] = _conv_back(d, h, self.weights[f"{name}.w"])
            return d

        for _ in self._names("dec"):
            d = layer(d)
        z, f, power, total, rate, amp, freq, v, time, turn, n, size = middle
        d_turn = d * amp[..., None] * np.cos(turn)
        d_phase, d_freq = d_turn.sum(-1), (2 * np.pi * time * d_turn).sum(-1)
        square = (v**2).sum(-1) + 1e-12
        d_v = np.stack([-v[..., 1] / square * d_phase, v[..., 0] / square * d_phase], axis=-1)
        grads["phase.w"], grads["phase.b"] = np.einsum("nla,nlt->lat", d_v, z), d_v.sum(0)
        d_power = ((d * np.sin(turn)).sum(-1) / (size * np.sqrt(total)))[..., None] + d_freq[..., None] * (rate - freq[..., None]) / total[..., None]
        spectrum = np.concatenate([np.zeros_like(f[..., :1]), d_power * f[..., 1:]], axis=-1)
        d = np.einsum("nla,lat->nlt", d_v, self.weights["phase.w"]) + (d.sum(-1) / size)[..., None] + size * np.fft.irfft(spectrum, size, axis=-1)
        for _ in self._names("enc"):
            d = layer(d)

    def encoder(self) -> Encoder:
        """The trained convolutions, with the running statistics folded into scale and shift."""
        layers = []
        for name in self._names("enc"):
            gain = self.weights[f"{name}.scale"] / np.sqrt(self.running[f"{name}.var"] + TINY)
            layers.append((self.weights[f"{name}.w"], gain, self.weights[f"{name}.shift"] - gain * self.running[f"{name}.mean"]))
        return Encoder(layers, self.seconds)


@dataclass
class Training:
    """A model with its AdamW moments, finished epochs and their losses: what a checkpoint holds."""

    model: Autoencoder
    first: dict[str, np.ndarray] = field(default_factory=dict)
    second: dict[str, np.ndarray] = field(default_factory=dict)
    steps: int = 0
    losses: list[float] = field(default_factory=list)

    def step(self, x: np.ndarray, rate: float) -> float:
        grads: dict[str, np.ndarray] = {}
        loss = self.model.loss(x, grads)
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        self.steps += 1
        for k, g in grads.items():
            g = g * min(1.0, CLIP / max(norm, 1e-12))
            m = self.first[k] = 0.9 * self.first.get(k, 0.0) + 0.1 * g
            s = self.second[k] = 0.999 * self.second.get(k, 0.0) + 0.001 * g * g
            unbiased = m / (1 - 0.9**self.steps) / (np.sqrt(s / (1 - 0.999**self.steps)) + 1e-8)
            self.model.weights[k] = self.model.weights[k] * (1 - rate * DECAY) - rate * unbiased
        return loss

    def to_json(self) -> str:
        plain = lambda x: {k: v.tolist() for k, v in x.items()}
        m = self.model
        return json.dumps({"seconds": m.seconds, "weights": plain(m.weights), "running": plain(m.running), "first": plain(self.first), "second": plain(self.second), "steps": self.steps, "losses": self.losses})

    @classmethod
    def from_json(cls, text: str) -> Training:
        x = json.loads(text)
        back = lambda k: {n: np.array(v) for n, v in x[k].items()}
        return cls(Autoencoder(back("weights"), x["seconds"], back("running")), back("first"), back("second"), x["steps"], x["losses"])


def one_cycle(epoch: float, epochs: int, most: float, rising: float = 0.3) -> float:
    """A rate that rises from most / 25 and falls to most / 250,000 along cosines."""
    part = min(1.0, epoch / max(1, epochs))
    low, high, at = (most / 25, most, part / rising) if part < rising else (most / 250_000, most, 1 - (part - rising) / (1 - rising))
    return low + (high - low) * (1 - np.cos(np.pi * at)) / 2


def fit(windows: DataFrame, columns: Sequence[str], model: Autoencoder | Training, epochs: int, rate: float = 1e-3, batch: int = 256, workers: int = 8, schedule=one_cycle) -> Training:
    """Train on windows (a row each, an array a column of one length) and return the checkpoint, also to go on from.

    Windows are dealt by a hash of their samples and come in its order, the same in every run and epoch. A partition's
    last short batch is left out, unless it is the only one; the epoch's loss is the mean over all windows used. Rows with a null array are left out; no rows leave the model as it is.
    """
    state = model if isinstance(model, Training) else Training(model)
    spot = F.xxhash64(*columns)
    held = settled(windows.select(*columns).dropna().repartition(workers, spot).sortWithinPartitions(spot))
    done = len(state.losses)
    for epoch in range(done, done + epochs):
        now, step = pickle.dumps(state), schedule(epoch, done + epochs, rate)

        def run(batches: Iterator[pa.RecordBatch], now: bytes = now, step: float = step) -> Iterator[pa.RecordBatch]:
            own, total, seen = pickle.loads(now), 0.0, 0
            rest = np.zeros((0, 0, 0))
            for b in batches:
                if not b.num_rows:
                    continue
                x = samples(b, columns)
                rest = np.concatenate([rest, x]) if len(rest) else x
                while len(rest) >= batch:
                    total, seen, rest = total + own.step(rest[:batch], step) * batch, seen + batch, rest[batch:]
            if not seen and len(rest):
                total, seen = own.step(rest, step) * len(rest), len(rest)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(own)], pa.binary()), pa.array([total]), pa.array([seen], pa.int64())], names=["state", "total", "seen"])

        got = held.mapInArrow(run, "state binary, total double, seen long").orderBy("total").collect()  # one row a worker
        if not got:
            break
        parts, share = [pickle.loads(r.state) for r in got], [r.seen / sum(x.seen for x in got) for r in got]
        mean = lambda pick: {k: sum(s * pick(p)[k] for p, s in zip(parts, share, strict=True)) for k in pick(parts[0])}  # noqa: B023, E731
        merged = Autoencoder(mean(lambda p: p.model.weights), state.model.seconds, mean(lambda p: p.model.running))
        losses = [*state.losses, sum(r.total for r in got) / sum(r.seen for r in got)]
        state = Training(merged, mean(lambda p: p.first), mean(lambda p: p.second), max(p.steps for p in parts), losses)
    return state


def packed(rows: DataFrame, by: Sequence[str], pos: str, columns: Sequence[str]) -> DataFrame:
    """A row a window: its samples in order, an array a column."""
    out = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(pos, *columns))).alias("_w"))
    return out.select(*by, *[F.col(f"_w.{c}").alias(c) for c in columns])
