"""Helpers of the corpus operators: null-safe inputs, written stages, text buffers."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.sources import folders

T = TypeVar("T")

#: Spaces between words; a word is a longest run of anything else.
SPACES = " \t\n\x0b\x0c\r"
#: Stands for a null id inside a job: a null id counts as the smallest id.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, text) with null text as the empty text, and ``more`` columns; all others are left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    digits = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(digits, F.lit("")).cast("binary")) % F.lit(folds)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = "spark-warehouse/stages"  # only in tests: driver and executors are one process
    return f"{root.rstrip('/')}/stage-{uuid.uuid4().hex}"


def written(frame: DataFrame) -> DataFrame:
    """``frame`` as Parquet in the shared folder: computed once, and safe when executors are lost."""
    folder = shared_folder(frame.sparkSession)
    frame.write.parquet(folder)
    copy = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    copy._written_to = folder
    return copy


def discard(*frames: DataFrame) -> None:
    """Delete the folders of ``written`` frames. What was made from them must be written itself."""
    for frame in frames:
        folders.delete(frame.sparkSession, frame._written_to)


def kept_by_worker(kind: str, key: object, make: Callable[[], T]) -> T:
    """An object that a Python worker builds once and keeps for its later tasks; one of each kind.

    Task functions travel by value, so their own globals live for one task only.
    """
    kept = sys.modules.setdefault("_worker_keeps", types.ModuleType("_worker_keeps")).__dict__
    if kind not in kept or kept[kind][0] != key:
        kept.pop(kind, None)  # before the next is built, so that a worker never holds both
        kept[kind] = key, make()
    return kept[kind][1]


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text or binary column and the offsets of its rows, without a copy."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at.astype(np.int64)


def pieces(offsets: np.ndarray, target: int, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of text parts of about ``target`` bytes: (row, first byte, byte after the last).

    A text longer than ``target`` is cut; each part then holds ``overlap`` bytes of the next.
    So memory is bounded by ``target`` whatever the length of a text.
    """
    rows: list[int] = []
    begin: list[int] = []
    end: list[int] = []
    total = 0
    for row in range(len(offsets) - 1):
        at, stop = int(offsets[row]), int(offsets[row + 1])
        while at < stop:
            last = stop if stop - at <= target + overlap else at + target + overlap
            rows.append(row)
            begin.append(at)
            end.append(last)
            total += last - at
            if total >= target:
                yield np.array(rows), np.array(begin), np.array(end)
                rows, begin, end, total = [], [], [], 0
            at = stop if last == stop else at + target
    if rows:
        yield np.array(rows), np.array(begin), np.array(end)


def small(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` takes about ``size`` bytes in each, or one row."""
    for batch in batches:
        _, offsets = buffer(batch[column])
        low = 0
        while low < len(batch):
            high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
            high = min(max(high, low + 1), len(batch))
            yield batch.slice(low, high - low)
            low = high


def mixed(value: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    value = value ^ (value >> np.uint64(32))
    value = value * np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(29)
    return value


class Rolling:
    """Hashes of all substrings of a buffer by prefix sums of byte codes times powers of an odd base."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, seed: int) -> None:
        self.codes = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, size: int) -> None:
        if len(self.up) < size:
            size = max(size, 1 << 20)
            inverse = pow(self.BASE, -1, 2**64)
            for name, factor in (("up", self.BASE), ("down", inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[begin]) * self.down[begin])

    def grams(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hash of every substring of ``size`` items."""
        count = max(len(sums) - size, 0)
        return mixed((sums[size:] - sums[:count]) * self.down[:count])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values, in about log2(width) passes."""
    if len(values) < width:
        return values[:0]
    low, span = values, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
