"""Whole texts of Arrow batches as flat byte arrays, and hashes of spans in them.

A batch is cut into runs of rows of about 256 KB of text, so that a Python
worker holds small arrays whatever the batch size; a longer text is a run of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xC2B2AE3D27D4EB4F
WORD = 2**64
# Longer spans are hashed in chunks of so many symbols.
CHUNK = 128

# White space between words: blank, and the bytes 9 to 13.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, which the session names in `spark.checkpoint.dir`.

    A temporary one serves only where that is unset and the session is local, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        import tempfile

        folder = tempfile.mkdtemp(prefix="granary-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def checkpointed(frame: DataFrame) -> DataFrame:
    """The rows, cut off from their lineage.

    Spark removes the files once they are out of use if the session says so
    (`spark.cleaner.referenceTracking.cleanCheckpoints`); else they stay.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def written(frame: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, read again.

    Unlike a checkpoint the table is as large to the optimizer as it is, not as what it was
    made from; a loop of joins needs that. Its files stay, as checkpoints of a lost driver do.
    """
    path = f"{shared_folder(frame.sparkSession)}/granary-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def added_up(partial: DataFrame, keys: list[str], add: Callable[[Sequence[bytes]], bytes], groups: int = 256) -> DataFrame:
    """Sums of `held` (binary) by integer keys, where `part` numbers the tasks that made them.

    Parts are added in two steps, so that no task takes what all tasks have made.
    """
    schema = ", ".join([f"{key} int" for key in keys] + ["part int", "held binary"])

    def total(group: pd.DataFrame) -> pd.DataFrame:
        first = group[[*keys, "part"]].iloc[:1]
        return first.assign(held=[add(sorted(group["held"]))])

    some = partial.withColumn("part", F.pmod("part", F.lit(groups)).cast("int"))
    some = some.groupBy(*keys, "part").applyInPandas(total, schema)
    return some.withColumn("part", F.lit(0)).groupBy(*keys).applyInPandas(total, schema).drop("part")


def runs(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches, sliced into runs of rows with about so many bytes of text each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if high > low:
                yield batch.slice(low, high - low)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins; null counts as empty."""
    texts = pc.fill_null(texts, "" if not pa.types.is_binary(texts.type) else b"").cast(pa.large_binary())
    _, where, held = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches of true cells that cross no text: starts, ends, and the first of each text."""
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    power = np.full(size, base, dtype=np.uint64)
    inverse = np.full(size, pow(base, -1, WORD), dtype=np.uint64)
    power[0] = inverse[0] = 1
    return np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


def powers(size: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least so many places."""
    return _powers(1 << max(19, int(size).bit_length()), base)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the splitmix64 finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(codes: np.ndarray, base: int = BASE) -> np.ndarray:
    """Running sums from which the hash of any span of codes follows."""
    power, _ = powers(len(codes) + 1, base)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=total[1:])
    return total


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hashes of spans; equal spans have equal hashes wherever they stand."""
    _, inverse = powers(len(total), base)
    return mix((total[ends] - total[starts]) * inverse[starts])


def whole_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hashes of spans of any length; longer ones are hashed by chunks, and the mixed hashes added up.

    A polynomial over 64 bits is the same for some texts of a thousand symbols and more whatever
    its base (Thue-Morse words and their complements); over a chunk it tells them apart, and what
    is mixed does not cancel out.
    """
    found = span_hashes(total, starts, ends, base)
    long = np.flatnonzero(ends - starts > CHUNK)
    if len(long):
        counts = -(-(ends[long] - starts[long]) // CHUNK)
        place = ranges(np.zeros(len(long), dtype=np.int64), counts)
        low = np.repeat(starts[long], counts) + place * CHUNK
        parts = span_hashes(total, low, np.minimum(low + CHUNK, np.repeat(ends[long], counts)), base)
        parts = mix(parts + mix(place.astype(np.uint64) + np.uint64(1)))
        found[long] = mix(np.add.reduceat(parts, np.cumsum(counts) - counts) + counts.astype(np.uint64))
    return found


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the first word of each text."""
    starts, ends, bounds = spans(~SPACE[data], offsets)
    return whole_hashes(prefix_sums(LOWER[data]), starts, ends), bounds


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `size` words, and the text of each; a shorter text is one run."""
    counts = np.diff(bounds)
    texts = np.repeat(np.arange(len(counts)), counts)
    weights = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, WORD)) for k in range(size)]
    n = len(hashes)
    total = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for k in range(size):
        total += hashes[k : n - size + 1 + k] * weights[k] if len(total) else np.uint64(0)
    place = np.arange(len(total)) - bounds[texts[: len(total)]] if len(total) else np.zeros(0, int)
    whole = place + size <= counts[texts[: len(total)]]
    short = np.flatnonzero((counts > 0) & (counts < size))
    rest = np.zeros(len(short), dtype=np.uint64)
    for k in range(size - 1):
        there = counts[short] > k
        rest[there] += hashes[bounds[short[there]] + k] * weights[k]
    rest += counts[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    return (
        mix(np.concatenate([total[whole], rest])),
        np.concatenate([texts[: len(total)][whole], short]),
    )


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch in the given column order."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(k).type) for k, c in ((n, columns[n]) for n in schema.names)],
        schema=schema,
    )


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one stretch after the other."""
    return np.arange(int(counts.sum())) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows alike in the integer keys, from sorted batches; a run is held whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        first = tuple(column[0] for column in columns)
        new[0] = last is not None and first != last
        last = tuple(column[-1] for column in columns)
        cuts = np.flatnonzero(new).tolist()
        at = 0
        for cut in cuts:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)
