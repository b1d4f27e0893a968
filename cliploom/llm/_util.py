"""Shared helpers: tables written in the cluster's shared folder, text batches, 64-bit hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once; a single longer text is still handled whole.
SLICE_BYTES = 4 << 20
#: Input bytes (compressed) for one unit of reduce-side work.
UNIT_BYTES = 16 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (spark.checkpoint.dir).

    Only where the setting is absent, as in local tests, a temporary folder of this machine is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = getattr(spark.sparkContext, "_cliploom_root", None)
        if root is None:
            root = tempfile.mkdtemp(prefix="cliploom-")
            spark.sparkContext._cliploom_root = root
    return root


class Workspace:
    """Tables written to the shared folder, so that a lost executor costs no recomputation of earlier steps."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_root(spark)}/cliploom/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        atexit.register(self.close)

    def save(self, df: DataFrame) -> DataFrame:
        """Write df, and return it as read back."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._saved_at = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for df in dfs:
            self._delete(df._saved_at)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def close(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session has ended; nothing depends on the tables any more
            pass


def work_units(df: DataFrame) -> int:
    """Reduce-side groups for df's data: proportional to its size, and at least the shuffle partitions."""
    spark = df.sparkSession
    parts = df.rdd.getNumPartitions()
    per = spark.conf.get("spark.sql.files.maxPartitionBytes")
    per_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(per)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-parts * max(per_bytes, UNIT_BYTES) // UNIT_BYTES))


def plain(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; extra columns of any name are ignored."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def without_lines(text: str, gone: str = "gone") -> Column:
    """The text without the lines whose numbers the array column `gone` has (null: the result is null): one pass."""
    left = f"array_join(transform(array_except(sequence(0, size(s) - 1), {gone}), i -> s[i]), '\\n')"
    return F.expr(f"if({gone} is null, null, transform(array(split({text}, '\\n')), s -> {left})[0])")


def give_back() -> None:
    """Return this process's freed memory to the system: workers stay for later tasks, beside the JVM's heap."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `limit` bytes of text; no text is cut.

    What earlier tasks and slices have freed is given back before the first and after the last one.
    """
    give_back()
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            base = size[at - 1] if at else 0
            end = min(max(int(np.searchsorted(size, base + limit, side="right")), at + 1), at + rows, b.num_rows)
            yield b.slice(at, end - at)
            at = end
    give_back()


_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), elementwise."""
    x = x + _G
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's words, A-Z lower-cased unless told, split at ASCII white space; row offsets (len + 1)."""
    import xxhash

    text = pc.fill_null(text, "")
    words = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    keep = pc.greater(pc.binary_length(flat), 0)
    held = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    coded = flat.filter(keep).dictionary_encode()
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in pc.cast(coded.dictionary, pa.binary()).to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    ids = coded.indices.to_numpy()
    return (table[ids] if len(ids) else np.empty(0, np.uint64)), held[offsets]


def shingle_sets(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of each document's distinct k-word shingles, sorted by both.

    A document of fewer than k words has its whole sequence as one shingle; one without words has none.
    """
    n, total = np.diff(offsets), len(words)
    doc_of = np.repeat(np.arange(len(n)), n)
    parts_d, parts_h = [], []
    for length in range(1, k + 1):
        if length == k:
            at = np.flatnonzero(np.arange(total) + k <= offsets[1:][doc_of]) if total else np.empty(0, np.int64)
        else:
            at = offsets[:-1][n == length]
        h = np.full(len(at), length, np.uint64)
        for i in range(length):
            h = mix(h ^ words[at + i])
        parts_d.append(doc_of[at])
        parts_h.append(h)
    d, h = np.concatenate(parts_d), np.concatenate(parts_h)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    if len(h):
        first = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
        d, h = d[first], h[first]
    return d, h


@contextmanager
def rows_at_a_time(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, Spark hands Python workers batches of at most so many rows: for rows of several megabytes each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_shuffles(spark: SparkSession) -> None:
    """Let the JVM notice that earlier steps' shuffle files are no longer needed."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
