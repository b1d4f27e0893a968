"""Datasets that serve frames by request tables: whole clips, windows of fixed length, and a router over several."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.operators import segments, serve


@dataclass
class ClipDataset:
    """Frames (motion_id, step, ...) with ids 0 to n - 1.

    requests of sample: (env, terminated_t, rewind, rewind_steps); a rewound env keeps the clip of its last sample.
    """

    frames: DataFrame
    seed: int = 0
    assigned: DataFrame | None = None
    draws: int = field(default=0, init=False)

    def __post_init__(self) -> None:
        self.lengths = self.frames.groupBy("motion_id").agg(F.count("*").alias("length"))
        self.index = segments.clip_index(self.lengths)

    @property
    def span(self) -> int:
        return self.index.count()

    def draw(self, requests: DataFrame) -> DataFrame:
        self.draws += 1
        drawn = serve.uniform_frames(requests.select("env"), self.index, "env", self.seed + self.draws)
        return drawn.select("env", "motion_id", "start_t")

    def sample(self, requests: DataFrame) -> DataFrame:
        """(env, motion_id, motion_len, start_t): a uniformly drawn frame each, or the rewound clip."""
        drawn = self.draw(requests)
        held = self.assigned if self.assigned is not None else drawn.limit(0)
        out = serve.rewind_sample(requests, drawn, held, self.lengths, "env")
        kept = held.select("env", "motion_id").join(requests.select("env"), "env", "left_anti")
        self.assigned = kept.unionByName(out.select("env", "motion_id"))
        return out

    def get_slice(self, requests: DataFrame, steps: Sequence[int]) -> DataFrame:
        """Frames at start_t + steps for requests(motion_id, start_t, ...), held at the clip's ends."""
        return serve.get_slice(requests, steps, self.lengths, self.frames)


@dataclass
class WindowDataset:
    """Windows of `size` frames: each env holds a current and a next window, and moves on unless it is rewound."""

    clips: ClipDataset
    size: int = 512
    current: DataFrame | None = None

    def windows(self, requests: DataFrame) -> DataFrame:
        """(env, motion_id, start_t): window starts so far back that the window fits, 0 in short clips."""
        return serve.window_starts(self.clips.draw(requests), self.clips.lengths, self.size)

    def sample(self, requests: DataFrame) -> DataFrame:
        """(env, motion_len, start_t) within each env's window; motion_len is the window's size, also for short clips."""
        fresh = self.windows(requests)
        held = self.current if self.current is not None else fresh.limit(0)
        asked = requests.select("env", "rewind", "terminated_t", "rewind_steps")
        kept = held.join(asked.filter("rewind").select("env"), "env", "left_semi")
        moved = fresh.join(kept.select("env"), "env", "left_anti")
        others = held.join(asked.select("env"), "env", "left_anti")
        self.current = kept.unionByName(moved).unionByName(others)
        back = asked.join(kept.select("env", F.lit(True).alias("_kept")), "env", "left")
        start = F.when(F.col("_kept"), F.greatest(F.col("terminated_t") - F.col("rewind_steps"), F.lit(0))).otherwise(0)
        return back.select("env", F.lit(self.size).alias("motion_len"), start.cast("long").alias("start_t"))

    def get_slice(self, requests: DataFrame, steps: Sequence[int]) -> DataFrame:
        """Frames of requests(env, at) at the window's start + at + steps, held at the window's and the clip's ends."""
        placed = requests.join(self.current, "env")
        wide = placed.withColumn("offset", F.explode(F.array(*[F.lit(int(s)) for s in steps])))
        inside = F.greatest(F.lit(0), F.least(F.col("at") + F.col("offset"), F.lit(self.size - 1)))
        wide = wide.withColumn("start_t", F.col("start_t") + inside)
        return serve.get_slice(wide.withColumnRenamed("offset", "_at"), [0], self.clips.lengths, self.clips.frames).drop("offset").withColumnRenamed("_at", "offset")


class Router:
    """Several clip datasets as one: each takes a span of ids, in the given order."""

    def __init__(self, children: Sequence[ClipDataset]) -> None:
        if not children:
            raise ValueError("a router needs a dataset")
        if len({tuple(sorted(c.frames.columns)) for c in children}) > 1:
            raise ValueError("the datasets must have the same columns")
        self.spans = [c.span for c in children]
        offset, frames = 0, []
        for child, span in zip(children, self.spans, strict=True):
            frames.append(child.frames.withColumn("motion_id", F.col("motion_id") + offset))
            offset += span
        whole = frames[0]
        for f in frames[1:]:
            whole = whole.unionByName(f)
        self.all = ClipDataset(whole, children[0].seed)

    def route(self, requests: DataFrame, column: str = "motion_id") -> DataFrame:
        return serve.route(requests, self.spans, column)

    def sample(self, requests: DataFrame) -> DataFrame:
        return self.all.sample(requests)

    def get_slice(self, requests: DataFrame, steps: Sequence[int]) -> DataFrame:
        return self.all.get_slice(requests, steps)
