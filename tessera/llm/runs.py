"""Sorted runs of hashes as binary columns, and how many buckets to deal them to."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import mix


def planes(values: np.ndarray) -> bytes:
    """Byte planes of an array: planes that hardly vary take no room once compressed."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def unplanes(raw: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)


def deltas(values: np.ndarray) -> bytes:
    """A sorted uint64 array as planes of its differences."""
    return planes(np.diff(values, prepend=np.uint64(0)))


def undeltas(raw: bytes) -> np.ndarray:
    return np.cumsum(unplanes(raw, np.uint64), dtype=np.uint64)


def squeezed(raw: bytes) -> bytes:
    """raw in zstd, after its length: planes that vary in part take their entropy, where Spark's own lz4 finds only repeats."""
    return np.uint64(len(raw)).tobytes() + pa.Codec("zstd", 1).compress(raw, asbytes=True) if raw else b""


def unsqueezed(raw: bytes) -> bytes:
    return pa.Codec("zstd").decompress(raw[8:], int(np.frombuffer(raw, np.uint64, 1)[0]), asbytes=True) if raw else b""


def bytes_of(text: str) -> int:
    """Spark's byte sizes: 128m, 134217728b, 1g."""
    text = text.strip().lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(float(text[:-1] if unit else text)) << unit


def bucket_count(df: DataFrame, per_16mb: int = 2, least: int = 16) -> int:
    """Buckets in proportion to the input: per_16mb for every 16 MB of scan that a partition may hold."""
    size = bytes_of(df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    return max(least, int(per_16mb * df.rdd.getNumPartitions() * max(1.0, size / (16 << 20))))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by range of the hash, so that a sorted array is in bucket order."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def count_run(values: np.ndarray, buckets: int, shift: int = 0) -> list[tuple[int, bytes, bytes]]:
    """(bucket, values, times) of the distinct values, a row for each bucket of their range; shift brings them to 64 bits."""
    value, times = np.unique(values, return_counts=True)
    if not len(value):
        return []
    b = bucket_of(mix(value) if shift < 0 else value << np.uint64(shift), buckets)
    if shift < 0:
        order = np.argsort(b, kind="stable")
        b, value, times = b[order], value[order], times[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]])
    return [(int(b[i]), deltas(value[i:j]), planes(times[i:j].astype(np.uint32))) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def sum_runs(values, times) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a bucket's runs with their total times."""
    value = np.concatenate([undeltas(x) for x in values])
    count = np.concatenate([unplanes(x, np.uint32) for x in times]).astype(np.int64)
    order = np.argsort(value)
    value, count = value[order], count[order]
    heads = np.flatnonzero(np.diff(value, prepend=value[:1] + np.uint64(1)))
    return value[heads], np.add.reduceat(count, heads)
