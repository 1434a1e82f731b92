"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is halved again and again along its
weakest cuts into parts of equal size, and a small classifier learns to tell the part
from the vector. It places every vector in a part and routes a query to the parts most
likely to hold its neighbours. Parts that hold too many vectors are divided the same way,
each by a router learned in a task from a sample of its own, until all are small: there are
as many parts as the vectors need. Exact cosines rank what is found there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import texts, vectors

# Vectors of one part that one task ranks at a time; a part of more is divided again.
BLOCK_VECTORS = 5000
# Vectors of one part that one task routes further.
ROUTED_VECTORS = 50_000
# Parts are named by their path: one digit to this base a level, from 1 on.
PATH_BASE = 1024
LEVELS = 6
# A part that a router leaves with more than this share of its vectors is not divided again.
UNDIVIDED = 0.95
# Sampled vectors whose nearest among all tell how many parts a query has to visit.
TRIALS = 500


def neighbours(units: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of every row."""
    found = np.empty((len(units), min(k, len(units) - 1)), dtype=np.int64)
    for start in range(0, len(units), 512):
        near = units[start : start + 512] @ units.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        found[start : start + len(near)] = np.argsort(-near, axis=1, kind="stable")[:, : found.shape[1]]
    return found


def balanced_parts(near: np.ndarray, parts: int, seed: int = 10, steps: int = 60) -> np.ndarray:
    """Parts of equal size (a power of two of them) that cut few edges of the neighbour graph.

    Each part is halved at the median of a slow mode of its own graph: averaging over
    neighbours lets differences between loosely linked rows die last.
    """
    draws = np.random.default_rng(seed)
    n = len(near)
    owner = np.zeros(n, dtype=np.int64)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    for _ in range(int(np.log2(max(parts, 1)))):
        inner = owner[a] == owner[b]
        x, y = a[inner], b[inner]
        degree = np.bincount(x, minlength=n) + 1.0
        total = np.bincount(owner, weights=degree)
        mode = draws.standard_normal(n)
        for _ in range(steps):
            mode -= (np.bincount(owner, weights=mode * degree) / total)[owner]
            mode = (mode + np.bincount(x, weights=mode[y], minlength=n)) / degree
            mode /= np.sqrt(np.bincount(owner, weights=mode * mode))[owner] + 1e-30
        order = np.lexsort((np.arange(n), mode, owner))
        sizes = np.bincount(owner)
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        owner = 2 * owner + (place >= (sizes // 2)[owner])
        _, owner = np.unique(owner, return_inverse=True)
    return owner


@dataclass
class Router:
    """A linear classifier of unit vectors into parts, and how many parts a query visits."""

    weights: np.ndarray
    offsets: np.ndarray
    visits: int

    def scores(self, units: np.ndarray) -> np.ndarray:
        return units @ self.weights + self.offsets

    def packed(self) -> bytes:
        return np.vstack([self.weights, self.offsets]).tobytes()

    @staticmethod
    def unpacked(held: bytes, dim: int, visits: int) -> Router:
        both = np.frombuffer(held, dtype=np.float64).reshape(dim + 1, -1)
        return Router(both[:-1], both[-1], visits)

    @staticmethod
    def learn(units: np.ndarray, near: np.ndarray, parts: int, k: int, recall: float, steps: int = 300) -> Router:
        """Learn parts of a row's neighbours, as a query sees them; then visit as many parts as the
        sample needs for its own neighbours to be found at this rate."""
        owner = balanced_parts(near, parts)
        parts = int(owner.max()) + 1
        target = np.zeros((len(units), parts))
        np.add.at(target, (np.repeat(np.arange(len(units)), near.shape[1]), owner[near].ravel()), 1.0 / (near.shape[1] + 1))
        target[np.arange(len(units)), owner] += 1.0 / (near.shape[1] + 1)
        weights, offsets = np.zeros((units.shape[1], parts)), np.zeros(parts)
        momentum = np.zeros_like(weights)
        for _ in range(steps):
            scores = units @ weights + offsets
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            slope = scores / scores.sum(axis=1, keepdims=True) - target
            momentum = 0.9 * momentum + units.T @ slope / len(units)
            weights -= 20.0 * (momentum + 1e-4 * weights)
            offsets -= slope.mean(axis=0)
        router = Router(weights, offsets, parts)
        scores = router.scores(units)
        placed = scores.argmax(axis=1)
        rank = np.argsort(np.argsort(-scores, axis=1, kind="stable"), axis=1)
        needed = rank[np.repeat(np.arange(len(units)), min(k, near.shape[1])), placed[near[:, :k]].ravel()]
        reached = np.cumsum(np.bincount(needed, minlength=parts)) / max(len(needed), 1)
        router.visits = int(np.searchsorted(reached, recall)) + 1
        router.visits = min(router.visits, parts)
        return router


_PLACED = pa.schema(
    [("node", pa.int64()), ("above", pa.int64()), ("asks", pa.bool_()), ("turn", pa.int32()), ("draw", pa.float64()),
     ("vec_id", pa.int64()), ("vector", pa.binary())]
)
_PLACED_DDL = "node long, above long, asks boolean, turn int, draw double, vec_id long, vector binary"
_RANKED = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _sent(batch: pa.RecordBatch, router: Router | None, dim: int, node: int, held: int) -> pa.RecordBatch:
    """A vector goes to its likeliest part of `node`, which holds so many, and a query to those it visits."""
    n = batch.num_rows
    if router is None:
        best = np.zeros((n, 1), dtype=np.int64)
    else:
        scores = router.scores(vectors.unit(vectors.matrix(batch.column("vector"), dim)))
        best = np.argsort(-scores, axis=1, kind="stable")[:, : router.visits]
    goes = np.ones(best.shape, dtype=bool)
    goes[:, 1:] = batch.column("asks").to_numpy(zero_copy_only=False)[:, None]
    row, choice = np.nonzero(goes)
    kept = batch.select(["asks", "turn", "draw", "vec_id", "vector"]).take(pa.array(row))
    return texts.rows(
        _PLACED, node=node * PATH_BASE + best[row, choice] + 1, above=np.full(len(row), held),
        **{name: kept.column(name) for name in kept.schema.names},
    )


def _route_root(router: Router | None, dim: int, total: int):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _sent(batch, router, dim, 0, total)

    return route


def _by_router(batches: Iterator[pa.RecordBatch], dim: int, visits: int | None):
    """Slices of rows of one node with the router before them, or None if their node has none."""
    at, router = None, None
    for batch in batches:
        node = batch.column("node").to_numpy()
        learned = batch.column("learned").is_valid().to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((node[1:] != node[:-1]) | learned[:-1]) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if high == low:
                continue
            if node[low] != at:
                at, router = node[low], None
            if learned[low]:
                router = Router.unpacked(batch.column("learned")[low].as_py(), dim, visits or batch.column("turn")[low].as_py())
            else:
                yield batch.slice(low, high - low), router, int(at)


def _route_nodes(dim: int, visits: int | None):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a node follow its router; without one they stay together."""
        for own, router, node in _by_router(batches, dim, visits):
            yield _sent(own, router, dim, node, own.column("above")[0].as_py())

    return route


_TRIED = pa.schema([("node", pa.int64()), ("place", pa.int64()), ("query", pa.binary()), ("vector", pa.binary())])
_TRIED_DDL = "node long, place long, query binary, vector binary"


def _places(router: Router, queries: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of each neighbour found, and how many parts its query would visit before it."""
    part = router.scores(found).argmax(axis=1)
    scores = router.scores(queries)
    return part, (scores > scores[np.arange(len(part)), part][:, None]).sum(axis=1)


def _try_nodes(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, router, node in _by_router(batches, dim, None):
            if router is not None:
                units = [vectors.unit(vectors.matrix(own.column(name), dim)) for name in ("query", "vector")]
                part, place = _places(router, *units)
                yield texts.rows(_TRIED, node=node * PATH_BASE + part + 1, place=place, query=own.column("query"), vector=own.column("vector"))

    return run


def _visits(places: np.ndarray, recall: float) -> int | None:
    """Parts to visit for this share of the neighbours; `places` counts them by place."""
    if not places.sum():
        return None
    return min(int(np.searchsorted(np.cumsum(places) / places.sum(), recall)) + 1, len(places))


def _trials(members: DataFrame, sample: np.ndarray, dim: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a sampled vector and one of its k nearest among all that differ from it."""
    asked = sample[:TRIALS]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held = np.zeros((len(asked), 0)), np.zeros((len(asked), 0, dim))
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                units = vectors.unit(vectors.matrix(batch.column("vector").slice(start, 1024), dim))
                scores = asked @ units.T
                scores[scores > 1 - 1e-12] = -np.inf
                some = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                best = np.hstack([best, np.take_along_axis(scores, some, axis=1)])
                held = np.concatenate([held, units[some]], axis=1)
                some = np.argsort(-best, axis=1, kind="stable")[:, :k]
                best = np.take_along_axis(best, some, axis=1)
                held = np.take_along_axis(held, some[:, :, None], axis=1)
        trial, turn = np.nonzero(best > -np.inf)
        yield texts.rows(
            pa.schema([("trial", pa.int32()), ("score", pa.float64()), ("vector", pa.binary())]),
            trial=trial.astype(np.int32), score=best[trial, turn], vector=pa.array([row.tobytes() for row in held[trial, turn]], pa.binary()),
        )

    near = members.select("vector").mapInArrow(rank, "trial int, score double, vector binary")
    order = Window.partitionBy("trial").orderBy(F.col("score").desc(), "vector")
    near = near.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k).toPandas()
    found = np.frombuffer(b"".join(map(bytes, near["vector"])), dtype=np.float64).reshape(-1, dim)
    return asked[near["trial"].to_numpy(dtype=np.int64)], found


def _learn_nodes(dim: int, parts: int, k: int, recall: float, leaf: int):
    def learn(group: pd.DataFrame) -> pd.DataFrame:
        """The router of one node, from the sample of its vectors."""
        group = group.sort_values(["draw", "vec_id"])
        units = vectors.unit(np.frombuffer(b"".join(map(bytes, group["vector"])), dtype=np.float64).reshape(-1, dim))
        into = min(parts, 1 << int(np.ceil(np.log2(max(group["above"].iloc[0] / leaf, 2)))))
        while into > 1 and len(units) < 4 * into:
            into //= 2
        if into < 2:
            return group.iloc[:0].assign(visits=0, learned=b"")[["node", "visits", "learned"]]
        router = Router.learn(units, neighbours(units, 2 * k), into, k, recall)
        return pd.DataFrame({"node": group["node"].iloc[:1], "visits": router.visits, "learned": [router.packed()]})

    return learn


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
    else:
        some = np.flatnonzero(score > -np.inf)
    some = some[score[some] > -np.inf]
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def _rank(dim: int, k: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of each block for every query sent there; a block's vectors precede its queries."""
        at, held, ids, units = None, [], None, None
        for batch in batches:
            part, block = batch.column("part").to_numpy(), batch.column("block").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = (part[1:] != part[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])
            cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                own = batch.slice(low, high - low)
                if (part[low], block[low]) != at:
                    at, held, units = (part[low], block[low]), [], None
                if not asks[low]:
                    held.append(own)
                    continue
                if not held:
                    continue
                if units is None:
                    found = pa.Table.from_batches(held).combine_chunks()
                    ids = found.column("vec_id").to_numpy()
                    units = vectors.unit(vectors.matrix(found.column("vector"), dim))
                queries = vectors.unit(vectors.matrix(own.column("vector"), dim))
                query_ids = own.column("vec_id").to_numpy()
                for start in range(0, len(queries), 256):
                    scores = queries[start : start + 256] @ units.T
                    out: list[tuple] = []
                    for query, row in zip(query_ids[start : start + 256], scores):
                        row[ids == query] = -np.inf
                        out += [(query, ids[c], row[c]) for c in _best(row, ids, k)]
                    yield texts.rows(_RANKED, **{name: list(values) for name, values in zip(_RANKED.names, zip(*out))} if out else {name: [] for name in _RANKED.names})

    return rank


def _candidates(read: DataFrame, k: int) -> DataFrame:
    """Of rows with one and the same vector, those with the k + 1 smallest ids.

    They score alike, ties go to smaller ids, and a query leaves out its own id alone, so no
    other can be among k nearest. Spark keeps as many a task before it shuffles.
    """
    alike = Window.partitionBy("key", "key2", "vector").orderBy("vec_id")
    return read.withColumn("turn", F.row_number().over(alike)).where(F.col("turn") <= k + 1)


def place(
    rows: DataFrame, dim: int, total: int, k: int, parts: int, sample_vectors: int, recall: float, leaf: int
) -> DataFrame:
    """node, asks, vec_id and vector: every candidate in its part, every query in those it visits.

    How many those are, at each level, is measured: the nearest of some sampled vectors are
    looked for among all, and as many parts are visited as hold their share of them. `rows` holds asks, turn, draw, key, key2, vec_id and vector. A part of more than `leaf`
    vectors is divided by a router of its own; rows are dealt to the routers, which are not broadcast.
    """
    depth = 1 + max(0, math.ceil(math.log(max(total, 1) / (leaf * parts)) / math.log(max(parts, 2))))
    recall = recall ** (1 / depth)
    sample = vectors.unit(vectors.sample(rows.where(~F.col("asks")), total, sample_vectors, dim))
    router = Router.learn(sample, neighbours(sample, 2 * k), parts, k, recall) if len(sample) >= 4 * parts else None
    tried = None
    if router is not None:
        queries, found = _trials(rows.where(~F.col("asks")), sample, dim, k)
        part, place = _places(router, queries, found)
        router.visits = _visits(np.bincount(place, minlength=router.weights.shape[1]), recall) or router.visits
        if len(part) and total > leaf:
            held = [[int(p) + 1, q.tobytes(), v.tobytes()] for p, q, v in zip(part, queries, found)]
            tried = rows.sparkSession.createDataFrame(held, "node long, query binary, vector binary")
    plain = ("asks", "turn", "draw", "vec_id", "vector")
    placed = rows.select(*plain).mapInArrow(_route_root(router, dim, total), _PLACED_DDL)
    if total <= leaf:
        return placed
    placed, done = texts.checkpointed(placed), []
    for _ in range(LEVELS - 1):
        sizes = placed.where(~F.col("asks")).groupBy("node", "above").agg(F.count("*").alias("held"))
        large = texts.checkpointed(sizes.where((F.col("held") > leaf) & (F.col("held") <= UNDIVIDED * F.col("above"))).drop("above"))
        if large.isEmpty():
            break
        done.append(placed.join(large, "node", "left_anti"))
        growing = placed.drop("above").join(large.withColumnRenamed("held", "above"), "node")
        drawn = growing.where(~F.col("asks") & (F.col("turn") == 1) & (F.col("draw") < F.lit(sample_vectors) / F.col("above")))
        learn = _learn_nodes(dim, parts, k, recall, leaf)
        learned = drawn.select("node", "above", "draw", "vec_id", "vector").groupBy("node").applyInPandas(learn, "node long, visits int, learned binary")
        learned = texts.checkpointed(learned)
        visits = None
        if tried is not None:
            routers = learned.select("node", F.col("visits").alias("turn"), "learned")
            trying = tried.join(large, "node").select("node", "query", "vector").unionByName(routers, allowMissingColumns=True)
            trying = trying.repartition("node").sortWithinPartitions("node", F.col("learned").isNull())
            tried = texts.checkpointed(trying.mapInArrow(_try_nodes(dim), _TRIED_DDL))
            counts = np.zeros(parts, dtype=np.int64)
            for place, times in tried.groupBy("place").count().collect():
                counts[place] = times
            visits = _visits(counts, recall)
            tried = tried.drop("place")
        salts = F.ceil(F.col("above") / ROUTED_VECTORS).cast("int")
        moving = growing.withColumn("salt", F.pmod(F.xxhash64("vec_id"), salts).cast("int")).withColumn("learned", F.lit(None).cast("binary"))
        routers = learned.join(large.withColumnRenamed("held", "above"), "node").select(
            "node", "above", F.lit(None).cast("boolean").alias("asks"), F.col("visits").alias("turn"), F.lit(None).cast("double").alias("draw"),
            F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("binary").alias("vector"),
            F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "learned",
        )
        dealt = moving.unionByName(routers).repartition("node", "salt")
        dealt = dealt.sortWithinPartitions("node", "salt", F.col("learned").isNull()).drop("salt")
        placed = texts.checkpointed(dealt.mapInArrow(_route_nodes(dim, visits), _PLACED_DDL))
    return reduce(DataFrame.unionByName, [*done, placed])


def _nearest(placed: DataFrame, dim: int, k: int) -> DataFrame:
    """The k nearest candidates of every query, of those that share a part with it."""
    sizes = texts.checkpointed(
        placed.where(~F.col("asks")).groupBy("node").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("blocks"))
    )
    block = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    )
    dealt = placed.join(sizes, "node").select(F.col("node").alias("part"), F.explode(block).alias("block"), "asks", "vec_id", "vector")
    found = (
        dealt.repartition("part", "block")
        .sortWithinPartitions("part", "block", "asks")
        .mapInArrow(_rank(dim, k), "query_id long, vec_id long, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    parts: int = 32,
    sample_vectors: int = 8192,
    recall: float = 0.97,
    leaf: int = BLOCK_VECTORS,
) -> DataFrame:
    """The k nearest other vectors found for each query: query_id, rank, vec_id, score.

    Nearness is the cosine, in double precision, on the original vectors; ties go to the
    smaller vec_id. `is_query` is a condition on vec_id. Each router is fitted on about
    `sample_vectors` vectors and visits as many of its `parts` (at most 1,023) as hold their share
    of the nearest, among all rows, of 500 of these: `recall` in all, whatever the number of levels.
    A part of more than `leaf` vectors is divided again. Queries whose parts hold fewer than k
    candidates are compared with all; with fewer candidates than k, all are returned.

    Vectors that are null, zero or hold null or non-finite components take no part, nor
    do rows with null vec_id. A query's own id is never among its neighbours; of rows
    that share id and vector one counts. Extra columns are ignored, and an empty table gives no rows.
    """
    dim = vectors.dimension(embeddings)
    read = texts.checkpointed(
        vectors.read(embeddings.where(F.col("vec_id").isNotNull()), dim).where("sound").dropDuplicates(["vec_id", "key", "key2"])
    )
    draw = F.pmod(F.xxhash64("key", "key2"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    columns = ("asks", "turn", "draw", "key", "key2", "vec_id", "vector")
    members = _candidates(read, k).withColumns({"asks": F.lit(False), "draw": draw}).select(*columns)
    members = texts.checkpointed(members)
    asked = read.where(is_query).withColumns({"asks": F.lit(True), "draw": draw, "turn": F.lit(0)}).select(*columns)
    total = members.count()
    placed = place(members.unionByName(asked), dim, total, k, parts, sample_vectors, recall, leaf)
    found = texts.checkpointed(_nearest(placed, dim, k))
    served = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = texts.checkpointed(asked.join(served, "vec_id", "left_anti").select(*columns))
    if short.isEmpty():
        return found
    again = _nearest(members.unionByName(short).withColumn("node", F.lit(0).cast("long")), dim, k)
    return found.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
