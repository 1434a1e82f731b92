"""Quality scores: ridge regression on random Fourier features, calibrated by isotonic steps.

The features are cosines of random projections of document statistics, so that their
products approximate a Gaussian kernel. Partitions add up their parts of the normal
equations; only the sums, whose size is fixed, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import texts
from granary.llm.op2_language import held_out

COSINES = 256
BINS = 2048
BLOCKS = 16


def _bytes(*chosen) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    for part in chosen:
        mask[[part] if isinstance(part, int) else list(part)] = True
    return mask


_UPPER, _LOWER, _DIGIT = _bytes(range(65, 91)), _bytes(range(97, 123)), _bytes(range(48, 58))
_HIGH, _NEWLINE = _bytes(range(128, 256)), _bytes(10)
_STOPS, _COMMAS = _bytes(b".!?"), _bytes(b",;:'\"-()")
_LETTER = _UPPER | _LOWER | _HIGH
_SYMBOL = ~(_LETTER | _DIGIT | _STOPS | _COMMAS | texts.SPACE)


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each owner."""
    order = np.lexsort((hashes, owner))
    own, held = owner[order], hashes[order]
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (held[1:] != held[:-1])
    return np.bincount(own[new], minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Statistics of each text, one row each; an empty text has zeros."""
    n = len(offsets) - 1

    def count(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])[offsets])

    size = np.diff(offsets)
    visible = count(~texts.SPACE)
    letters, upper, high = count(_LETTER), count(_UPPER), count(_HIGH)
    stops = count(_STOPS)
    starts, ends, bounds = texts.spans(~texts.SPACE[data], offsets)
    total = texts.prefix_sums(texts.LOWER[data])
    hashes = texts.span_hashes(total, starts, ends)
    words = np.diff(bounds)
    owner = np.repeat(np.arange(n), words)
    triples, triple_owner = texts.shingles(hashes, bounds, 3)
    again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    line_starts, line_ends, line_bounds = texts.spans(~_NEWLINE[data], offsets)
    lines = np.diff(line_bounds)
    line_hashes = texts.span_hashes(total, line_starts, line_ends)
    line_owner = np.repeat(np.arange(n), lines)
    letters_so_far = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int64)])
    wordless = letters_so_far[ends] == letters_so_far[starts]
    odd_end = _SYMBOL[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    loud_end = (data[ends - 1] == ord("!")) if len(ends) else np.zeros(0, bool)

    def ratio(a, b):
        return a / np.maximum(b, 1)

    return np.stack(
        [
            np.log1p(size),
            np.log1p(words),
            np.log1p(lines),
            ratio(letters, visible),
            ratio(upper, letters),
            ratio(high, letters),
            ratio(count(_DIGIT), visible),
            ratio(count(_SYMBOL), visible),
            ratio(count(_COMMAS), visible),
            ratio(stops, words),
            ratio(count(texts.SPACE), size),
            ratio(visible, words),
            np.log1p(ratio(words, lines)),
            np.log1p(ratio(words, stops)),
            ratio(_distinct(owner, hashes, n), words),
            ratio(_distinct(triple_owner, triples, n), np.bincount(triple_owner, minlength=n)),
            ratio(_distinct(line_owner, line_hashes, n), lines),
            ratio(np.bincount(owner[1:][again], minlength=n), words),
            ratio(np.bincount(owner, weights=wordless, minlength=n), words),
            ratio(np.bincount(owner, weights=odd_end, minlength=n), words),
            ratio(np.bincount(owner, weights=loud_end, minlength=n), words),
        ],
        axis=1,
    )


_MEASURED = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts.runs(batches):
        found = statistics(*texts.flat(batch.column("text")))
        values = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1], found.ravel())
        yield texts.rows(_MEASURED, doc_id=batch.column("doc_id"), stats=values.cast(_MEASURED.field("stats").type))


def measured(documents: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text; null text counts as empty."""
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(measure, "doc_id long, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Model:
    """Scaling, random projections, ridge weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    projections: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    levels: np.ndarray | None = None

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.scale, -6, 6)
        found = np.cos(scaled @ self.projections + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([found, np.ones((len(found), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        """Uncalibrated scores, without the last digits, which depend on a row's place in its batch."""
        return np.round(self.cosines(stats) @ self.weights, 9)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        return np.clip(np.interp(raw, self.knots, self.levels), 0, 1) if len(self.knots) else np.clip(raw, 0, 1)


def normal_equations(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows of products of features, and of features with labels."""
    schema = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("held", pa.binary())])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = COSINES + 1
        sums = np.zeros((size, size + 1))
        for batch in batches:
            found = model.cosines(_matrix(batch.column("stats")))
            label = batch.column("label").to_numpy(zero_copy_only=False)
            sums += found.T @ np.hstack([found, label[:, None]])
        held = [part.tobytes() for part in np.array_split(sums, BLOCKS)]
        part = np.full(BLOCKS, TaskContext.get().partitionId(), dtype=np.int32)
        yield texts.rows(schema, block=np.arange(BLOCKS, dtype=np.int32), part=part, held=pa.array(held, pa.binary()))

    def add(held: Sequence[bytes]) -> bytes:
        return sum(map(np.frombuffer, held)).tobytes()

    partial = labelled.select("stats", "label").mapInArrow(multiply, "block int, part int, held binary")
    found = texts.added_up(partial, ["block"], add).collect()
    sums = np.vstack([np.frombuffer(row["held"]).reshape(-1, COSINES + 2) for row in sorted(found, key=lambda r: r["block"])])
    return sums[:, :-1], sums[:, -1]


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest never falling steps (pool adjacent violators)."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            value, weight, n = pools.pop()
            last = pools[-1]
            last[0] = (last[0] * last[1] + value * weight) / (last[1] + weight)
            last[1] += weight
            last[2] += n
    return np.repeat([p[0] for p in pools], [p[2] for p in pools])


def fit(labelled: DataFrame, ridge: float = 1e-5, seed: int = 6) -> Model | None:
    """Learn from all rows of doc_id, stats, label; a fifth of them serves calibration alone.

    Returns nothing if no row is labelled.
    """
    labelled = texts.checkpointed(labelled.withColumn("late", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 4))
    width = len(statistics(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0])
    stat = [F.col("stats")[k] for k in range(width)]
    sums = labelled.agg(F.count("*").alias("n"), *[F.avg(s).alias(f"m{k}") for k, s in enumerate(stat)], *[F.stddev_pop(s).alias(f"s{k}") for k, s in enumerate(stat)]).first()
    if not sums["n"]:
        return None
    scale = np.array([sums[f"s{k}"] for k in range(width)])
    draws = np.random.default_rng(seed)
    model = Model(
        mean=np.array([sums[f"m{k}"] for k in range(width)]),
        scale=np.where(scale > 1e-9, scale, 1.0),
        projections=draws.standard_normal((width, COSINES)) / np.sqrt(width),
        phases=draws.uniform(0, 2 * np.pi, COSINES),
    )
    products, target = normal_equations(labelled.where(~F.col("late")), model)
    n = max(products[-1, -1], 1.0)
    model.weights = np.linalg.solve(products / n + ridge * np.eye(len(products)), target / n)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bin", pa.int32()), ("raw", pa.float64()), ("label", pa.float64())])
        for batch in batches:
            raw = model.raw(_matrix(batch.column("stats")))
            bins = np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield texts.rows(schema, bin=bins, raw=raw, label=batch.column("label"))

    late = labelled.where("late").select("stats", "label").mapInArrow(binned, "bin int, raw double, label double")
    steps = late.groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count("*").alias("n"))
    steps = steps.orderBy("bin").toPandas()
    model.knots = steps["raw"].to_numpy(dtype=float)
    model.levels = isotonic(steps["label"].to_numpy(dtype=float), steps["n"].to_numpy(dtype=float))
    if len(np.unique(model.levels)) < 2:  # too few labels to calibrate by
        model.knots = model.knots[:0]
    return model


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row of statistics; 0.5 throughout if nothing was learned."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(_matrix(batch.column("stats"))) if model else np.full(batch.num_rows, 0.5)
            yield texts.rows(schema, doc_id=batch.column("doc_id"), score=found)

    return stats.mapInArrow(apply, "doc_id long, score double")


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """One row per labelled document; repeated labels count by their majority, ties as 1."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    mean = F.avg(F.col(column).cast("double"))
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((mean >= 0.5).cast("double").alias("label"))


def keep_good(documents: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, least: float = 0.3) -> DataFrame:
    """The documents, in all their columns, that score at least `least`.

    Learns as `assess` does. Texts are measured again as they are judged, so that none is
    shuffled.
    """
    stats = measured(documents).where(~held_out(F.col("doc_id"), parts, part))
    model = fit(stats.join(one_label(labels, "quality"), "doc_id"))
    if model is None:
        return documents

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.runs(batches):
            good = model.score(statistics(*texts.flat(batch.column("text")))) >= least
            yield batch.filter(pa.array(good))

    return documents.mapInArrow(judge, documents.schema)


def assess(documents: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, least: float = 0.3) -> DataFrame:
    """Score every whole text; learn from labelled documents outside one part of ids.

    Returns doc_id, held_out, score, predicted: one row per input row, also for null and
    empty texts, which have statistics of zero, and for null ids, which count as held
    out. Repeated rows score alike. Extra columns are ignored.
    """
    stats = texts.checkpointed(measured(documents))
    hidden = held_out(F.col("doc_id"), parts, part)
    model = fit(stats.where(~hidden).join(one_label(labels, "quality"), "doc_id"))
    return score(stats, model).select(
        "doc_id", hidden.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )
