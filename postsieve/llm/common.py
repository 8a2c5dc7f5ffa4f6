"""What the operators of this subpackage share."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run without ASCII white space


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a batch of texts; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a function to every Arrow batch; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def hashed_share(key: str, rows: int, about: int) -> Column:
    """Condition that holds for about ``about`` of ``rows`` rows, chosen by a hash of the key; for all, if there are fewer."""
    whole = 1 << 40
    return F.pmod(F.xxhash64(key), F.lit(whole)) < F.lit(min(whole, -(-about * whole // max(rows, 1))))


class Memo(dict):
    """Results by key, computed on first use and forgotten together when there are ``most``; only a matter of speed.

    Keys longer than ``longest`` are computed each time, so that a few huge keys cannot fill memory.
    """

    everyone: list[weakref.ref[Memo]] = []  # of this Python worker

    def __init__(self, fn: Callable, most: int = 300_000, longest: int = 64):
        super().__init__()
        self.fn, self.most, self.longest = fn, most, longest
        Memo.everyone.append(weakref.ref(self))

    @staticmethod
    def leave_only(*kept: Memo) -> None:
        """Clear all others: workers outlive stages, and each operator would leave its own results behind."""
        for memo in [m() for m in Memo.everyone]:
            if memo is not None and not any(memo is k for k in kept):
                memo.clear()
        pa.default_memory_pool().release_unused()

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value
