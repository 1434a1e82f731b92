"""Vectors of Arrow batches as matrices, and a sample of bounded size to learn from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import texts

_READ = pa.schema(
    [("vec_id", pa.int64()), ("sound", pa.bool_()), ("key", pa.int64()), ("key2", pa.int64()), ("vector", pa.binary())]
)


def read(vectors: DataFrame, dim: int) -> DataFrame:
    """vec_id, sound, key, key2 (hashes of the components) and vector (doubles as bytes).

    A vector is sound if it is not null, not zero, and has only finite components.
    Shorter vectors count as padded with zeros to `dim`.
    """

    def pad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            sizes = np.diff(column.offsets.to_numpy()) * column.is_valid().to_numpy(zero_copy_only=False)
            held = column.flatten()
            values = held.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            found = np.zeros((batch.num_rows, dim))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            found[row, texts.ranges(np.zeros(batch.num_rows, dtype=np.int64), sizes)] = values
            found += 0.0
            sound = np.isfinite(found).all(axis=1) & (found != 0).any(axis=1)
            data = np.ascontiguousarray(found).view(np.uint8).ravel()
            at = np.arange(batch.num_rows) * dim * 8
            keys = [
                texts.span_hashes(texts.prefix_sums(data, base), at, at + dim * 8, base).view(np.int64)
                for base in (texts.BASE, texts.SECOND_BASE)
            ]
            yield texts.rows(
                _READ, vec_id=batch.column("vec_id"), sound=sound, key=keys[0], key2=keys[1],
                vector=pa.array([row.tobytes() for row in found], pa.binary()),
            )

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        pad, "vec_id long, sound boolean, key long, key2 long, vector binary"
    )


def dimension(vectors: DataFrame) -> int:
    """The longest vector's number of components, at least 1."""
    return max(1, vectors.agg(F.max(F.size("embedding"))).first()[0] or 1)


def matrix(held, dim: int) -> np.ndarray:
    """Vectors kept as bytes, one row each."""
    return np.frombuffer(b"".join(held.to_pylist()), dtype=np.float64).reshape(-1, dim)


def unit(found: np.ndarray) -> np.ndarray:
    """Vectors of length one; they are scaled by powers of two first, so that no square leaves the range of doubles."""
    largest = np.abs(found).max(axis=1, initial=0.0)
    scaled = np.ldexp(found, -np.frexp(largest)[1][:, None])
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def sample(sound: DataFrame, total: int, most: int, dim: int) -> np.ndarray:
    """About `most` vectors, chosen by a hash of their components, in a stable order."""
    draw = F.pmod(F.xxhash64("key", "key2"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    found = sound.where(draw < min(1.0, most / max(total, 1))).select("key", "key2", "vector")
    found = found.dropDuplicates(["key", "key2"]).toPandas().sort_values(["key", "key2"])
    return np.frombuffer(b"".join(map(bytes, found["vector"])), dtype=np.float64).reshape(-1, dim)
