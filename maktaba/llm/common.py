"""Helpers shared by the training-data operators: shared folder, staged tables, Arrow batches, byte hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd multiplier of the byte polynomial; its inverse modulo 2**64 undoes a shift of position.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which the driver and all executors share.

    Where the setting is missing, as in tests, a local session gets a temporary folder; a cluster must set it. The folder
    goes when the application ends, unless drop() deletes it before.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    elif "://" not in base and base.startswith("/"):
        base = "file://" + base
    folder = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    for made in _collectors.get():
        made.append(folder)
    return folder


#: Lists that want to hear of new folders, in this thread of the driver: queries in other threads have lists of their own.
_collectors: ContextVar[tuple[list[str], ...]] = ContextVar("collectors", default=())


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The shared folders that this thread makes in the block and nobody has dropped."""
    made: list[str] = []
    before = _collectors.set((*_collectors.get(), made))
    try:
        yield made
    finally:
        _collectors.reset(before)


def drop(spark: SparkSession, folders: list[str]) -> None:
    """Deletes shared folders whose data nothing will read any more."""
    for folder in list(folders):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        for made in _collectors.get():
            if folder in made:
                made.remove(folder)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a shared folder or file."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def partitions(df: DataFrame, factor: int = 1) -> int:
    """How many partitions a wide step over df gets: the session's setting, which grows with the data on a cluster."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) * factor)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about max_bytes of text each (one row at least), so that memory doesn't follow the batch size."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts (null: empty) as one byte array without a copy, and the n+1 offsets of the texts in it."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[name] = np.cumprod(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """Hashes of any byte ranges of a buffer in constant time each: prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        up, self._down = powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        spread = _byte_table()[data]
        spread *= up[: len(data)]
        np.cumsum(spread, out=self._sums[1:])

    def every(self, length: int) -> np.ndarray:
        """The hashes of all ranges of this length, in order."""
        n = len(self._sums) - length
        return mix((self._sums[length:] - self._sums[:n]) * self._down[:n]) if n > 0 else np.zeros(0, np.uint64)

    def __call__(self, starts, ends) -> np.ndarray:
        out = self._sums[ends] - self._sums[starts]
        out *= self._down[starts]
        return mix(out)


def _byte_table() -> np.ndarray:
    if "bytes" not in _POWERS:
        _POWERS["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    return _POWERS["bytes"]


def id_ranges(df: DataFrame, column: str, n: int) -> DataFrame:
    """df with _bucket: n ranges of the id column in ascending order, null first, of about equal row counts.

    Only the ids are read to find the n - 1 bounds. Rows with equal ids share a bucket.
    """
    if n <= 1:
        return df.withColumn("_bucket", F.lit(0))
    shares = [i / n for i in range(1, n)]
    found = df.select(F.percentile_approx(column, shares, max(10_000, 20 * n)).alias("b")).first()["b"] or []
    bounds = sorted(set(found))
    if not bounds:
        return df.withColumn("_bucket", F.lit(0))
    if len(bounds) <= 512:
        return df.withColumn("_bucket", F.when(F.col(column).isNull(), F.lit(0)).otherwise(_upper_bound(bounds, F.col(column))))

    @F.pandas_udf("int")
    def position(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(bounds), ids.to_numpy(), side="right").astype(np.int32))

    return df.withColumn("_bucket", F.when(F.col(column).isNull(), F.lit(0)).otherwise(position(F.coalesce(column, F.lit(bounds[0])))))


def _upper_bound(bounds: list, column):
    """Nested when() over the sorted bounds, halved at each level: about log2(n) comparisons a row, inside generated code."""

    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))
