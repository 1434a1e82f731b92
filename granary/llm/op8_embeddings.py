"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations learned on a bounded sample turn vectors into binary codes whose bits are
balanced. Every table is keyed by a part of the code, as wide as there are vectors for, and
finds codes that agree in this part but for one bit at most. How many tables that takes, and
in how many bits codes of near vectors differ, is learned from pairs made at the wanted
cosine out of the sample. Codes found near form clusters, and there the original vectors
decide, in blocks of a matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import graph, texts, vectors
from granary.llm.op3_ngram_join import blocked

WORD = 64
# Vectors a bucket of a table should hold, widest part of a table, and most words of a code.
BUCKET, WIDEST, MOST_WORDS = 16, 26, 48
# Pairs made of the sample, and rounds of learning of each rotation.
PAIRS, ROUNDS = 4000, 30
# Codes in a block of a table's bucket; vectors in a block of a cluster; components of the
# vectors in a block of all, and blocks that many vectors are dealt to at least.
BLOCK_CODES, BLOCK_VECTORS = 4000, 2000
BLOCK_COMPONENTS, LEAST_BLOCKS = 1 << 19, 8


def near_pairs(units: np.ndarray, mean: np.ndarray, least: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at cosine `least`, made of a sample as codes can tell them worst.

    Partners keep what they share with the mean, so that their whole difference is in what
    codes see; it points anywhere in one half and along differences of the sample in the other.
    """
    draw = np.random.default_rng(seed)
    first = np.repeat(units[draw.permutation(len(units))[:PAIRS]], 2, axis=0)
    length = np.linalg.norm(mean)
    main = mean / length if length > 0 else mean
    rest = first - (first @ main)[:, None] * main
    size = np.linalg.norm(rest, axis=1, keepdims=True)
    own = rest / np.maximum(size, 1e-300)
    turn = draw.standard_normal(first.shape)
    turn[1::2] = units[draw.integers(0, len(units), len(first) // 2)] - units[draw.integers(0, len(units), len(first) // 2)]
    for axis in (np.broadcast_to(main, own.shape), own):
        turn = turn - np.einsum("ij,ij->i", turn, axis)[:, None] * axis
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-300)
    cosine = np.clip(1 - (1 - least) / np.maximum(size**2, 1e-300), -1, 1)
    return first, first - rest + size * (cosine * own + np.sqrt(1 - cosine**2) * turn)


@dataclass
class Rotation:
    """Binary codes, the signs of rotated principal components; tables of their parts; and a radius."""

    mean: np.ndarray
    axes: np.ndarray
    tables: list[tuple[int, int, int]]
    radius: int

    @staticmethod
    def rotated(projected: np.ndarray, seed: int) -> np.ndarray:
        """Alternate between the nearest corners of the cube and the rotation that fits them best."""
        size = projected.shape[1]
        rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
        for _ in range(ROUNDS):
            corners = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(corners.T @ projected)
            rotation = (left @ right).T
        return rotation

    @staticmethod
    def learn(sample: np.ndarray, least: float, total: int, seed: int = 8) -> Rotation:
        """Codes and tables for `total` vectors.

        Words are added until tables find every pair made of the sample, and half as many again.
        If that takes too many words, tables of narrower parts find more of the pairs.
        """
        units = vectors.unit(sample)
        mean = units.mean(axis=0)
        _, _, main = np.linalg.svd((units - mean).T @ (units - mean))
        main = main[: min(WORD, sample.shape[1])].T
        projected = (units - mean) @ main
        pairs = near_pairs(units, mean, least, seed)
        width = int(np.clip(np.ceil(np.log2(max(total, 2) / BUCKET)), 4, WIDEST))
        words: list[np.ndarray] = []
        apart: list[np.ndarray] = []
        while True:
            tables = []
            missed = np.ones(len(pairs[0]), dtype=bool)
            wanted = None
            for word in range(MOST_WORDS):
                if word == len(words):
                    turns = [main @ Rotation.rotated(projected, seed + 1000 * word + k) for k in range(-(-WORD // main.shape[1]))]
                    words.append(np.concatenate(turns, axis=1)[:, :WORD])
                    a, b = ((side - mean) @ words[word] >= 0 for side in pairs)
                    apart.append(a != b)
                for first in range(0, WORD - width + 1, width):
                    if wanted is None or len(tables) < wanted:
                        tables.append((word, first, width))
                        missed &= apart[word][:, first : first + width].sum(axis=1) > 1
                        if wanted is None and not missed.any():
                            wanted = len(tables) + -(-len(tables) // 2)
                if wanted is not None and len(tables) >= wanted and word >= 1:
                    radius = max(int(sum(bits.sum(axis=1) for bits in apart[: word + 1]).max()), 1)
                    return Rotation(mean, np.concatenate(words[: word + 1], axis=1), tables, radius)
            width = max(1, width - 2)

    def codes(self, found: np.ndarray) -> np.ndarray:
        """One row of 64-bit words per vector."""
        signs = (vectors.unit(found) - self.mean) @ self.axes >= 0
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint64)


_PROBES = pa.schema([("table", pa.int32()), ("bucket", pa.int64()), ("node", pa.int64()), ("code", pa.binary()), ("own", pa.bool_())])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _words(codes) -> np.ndarray:
    held = codes.to_pylist()
    return np.frombuffer(b"".join(held), dtype=np.uint64).reshape(len(held), -1)


def _deal(tables: list[tuple[int, int, int]]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each code in its own bucket of every table, and in those one cleared bit away."""
        for batch in batches:
            if not batch.num_rows:
                continue
            node, code = batch.column("node"), batch.column("code")
            words = _words(code)
            for table, (word, first, width) in enumerate(tables):
                bucket = (words[:, word] >> np.uint64(first)) & np.uint64((1 << width) - 1)
                found = [(bucket, np.arange(len(bucket)), True)]
                for bit in range(width):
                    there = np.flatnonzero((bucket >> np.uint64(bit)) & np.uint64(1) == 1)
                    found.append((bucket[there] ^ np.uint64(1 << bit), there, False))
                for buckets, rows, own in found:
                    yield texts.rows(
                        _PROBES,
                        table=np.full(len(rows), table, dtype=np.int32),
                        bucket=buckets.view(np.int64),
                        node=node.take(pa.array(rows)),
                        code=code.take(pa.array(rows)),
                        own=np.full(len(rows), own),
                    )

    return deal


def _near(radius: int):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Codes within the radius, as few pairs as join what all of them join, per bucket."""
        for group in texts.groups(batches, ["table", "bucket", "i", "j"]):
            node, own, block = (group.column(name).to_numpy() for name in ("node", "own", "block"))
            codes = np.ascontiguousarray(_words(group.column("code")).T)
            across = group.column("i")[0] != group.column("j")[0]
            forest = graph.Forest(len(node))
            at_home, found = np.flatnonzero(own), []
            step = max(1, (1 << 20) // max(1, len(node)))
            for start in range(0, len(at_home), step):
                rows = at_home[start : start + step]
                differing = np.zeros((len(rows), len(node)), dtype=np.uint16)
                for word in codes:
                    differing += np.bitwise_count(word[rows][:, None] ^ word[None, :])
                close = differing <= radius
                # Two codes at home in the bucket are looked at once.
                close &= ~own[None, :] | (np.arange(len(node))[None, :] > rows[:, None])
                if across:
                    close &= block[rows][:, None] != block[None, :]
                for a, b in zip(*np.nonzero(close)):
                    if forest.join(int(rows[a]), int(b)):
                        found.append((rows[a], b))
            if found:
                pairs = np.array(found)
                yield texts.rows(_EDGES, a=node[pairs[:, 0]], b=node[pairs[:, 1]])

    return near


_LINKED = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])


def _compare(dim: int, least: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each vector within a block of a cluster, and edges that join what links join."""
        for group in texts.groups(batches, ["cluster", "i", "j"]):
            rep, copies, block = (group.column(name).to_numpy() for name in ("rep", "copies", "block"))
            units = vectors.unit(vectors.matrix(group.column("vector"), dim))
            across = group.column("i")[0] != group.column("j")[0]
            forest = graph.Forest(len(rep))
            counts = np.zeros(len(rep), dtype=np.int64)
            edges = []
            for start in range(0, len(rep), 512):
                rows = np.arange(start, min(start + 512, len(rep)))
                linked = units[rows] @ units.T >= least
                linked[rows - start, rows] = False
                if across:
                    linked &= block[rows][:, None] != block[None, :]
                counts[rows] = linked @ copies
                for row, hits in zip(rows, linked):
                    hits = np.flatnonzero(hits)
                    if len(hits) and not (forest.parent[hits] == forest.parent[row]).all():
                        edges += [(rep[row], rep[hit]) for hit in hits if forest.join(int(row), int(hit))]
                        forest.roots()
            to = [b for _, b in edges]
            yield texts.rows(
                _LINKED,
                rep=np.concatenate([rep, np.array([a for a, _ in edges], dtype=np.int64)]),
                links=np.concatenate([counts, np.zeros(len(edges), dtype=np.int64)]),
                to=pa.concat_arrays([pa.nulls(len(rep), pa.int64()), pa.array(to, pa.int64())]),
            )

    return compare


def _apart(dim: int, least: float):
    # Products in single precision are off by less than this.
    slack = 1e-6 + 2e-7 * dim

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between vectors of different clusters in two blocks, and edges that join what links join."""
        for group in texts.groups(batches, ["i", "j"]):
            rep, copies, block, cluster = (group.column(name).to_numpy() for name in ("rep", "copies", "block", "cluster"))
            units = vectors.unit(vectors.matrix(group.column("vector"), dim))
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            low, high = np.flatnonzero(block == i), np.flatnonzero(block == j)
            other = units[high].astype(np.float32)
            forest = graph.Forest(len(rep))
            counts = np.zeros(len(rep), dtype=np.int64)
            edges = []
            for start in range(0, len(low), 512):
                rows = low[start : start + 512]
                a, b = np.nonzero(units[rows].astype(np.float32) @ other.T >= least - slack)
                a, b = rows[a], high[b]
                wanted = cluster[a] != cluster[b]
                if i == j:
                    wanted &= a < b
                a, b = a[wanted], b[wanted]
                step = max(1, (1 << 22) // dim)
                for at in range(0, len(a), step):
                    x, y = a[at : at + step], b[at : at + step]
                    linked = np.einsum("ij,ij->i", units[x], units[y]) >= least
                    x, y = x[linked], y[linked]
                    np.add.at(counts, x, copies[y])
                    np.add.at(counts, y, copies[x])
                    edges += [(rep[p], rep[q]) for p, q in zip(x, y) if forest.join(int(p), int(q))]
            some = np.flatnonzero(counts)
            to = [b for _, b in edges]
            yield texts.rows(
                _LINKED,
                rep=np.concatenate([rep[some], np.array([a for a, _ in edges], dtype=np.int64)]),
                links=np.concatenate([counts[some], np.zeros(len(edges), dtype=np.int64)]),
                to=pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(to, pa.int64())]),
            )

    return apart


def deduplicate(
    embeddings: DataFrame, least: float = 0.95, sample_vectors: int = 20_000, exhaustive: bool = False
) -> DataFrame:
    """Links between vectors whose cosine is at least `least`: vec_id, n_links, component_id, kept.

    One row per input row. n_links counts other vectors linked directly, component_id is
    the smallest vec_id reachable by links, itself included, and kept tells whether it is
    the vector's own. Pairs are found by codes, and counted only if their original vectors are
    that near, in double precision. Tables are learned to find all of 8,000 pairs just at `least`
    and then get half as many again; `exhaustive` adds a product of all blocks, which finds
    every pair, and whose work grows with the square of the distinct vectors.

    Vectors that are null, zero or hold null or non-finite components link with nothing.
    Equal vectors are copies: they link with each other and are compared as one. Shorter
    vectors count as padded with zeros. A row with null vec_id counts as a link of others,
    and is kept only if it links with nothing. Extra columns are ignored; an empty table
    gives an empty result.
    """
    dim = vectors.dimension(embeddings)
    read = texts.checkpointed(vectors.read(embeddings, dim))
    classes = (
        read.where("sound")
        .groupBy("key", "key2")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .where(F.col("rep").isNotNull())
    )
    total = read.where("sound").count()
    sample = vectors.sample(read.where("sound"), total, sample_vectors, dim)
    if len(sample):
        found = _linked(classes, Rotation.learn(sample, least, total), dim, least, exhaustive)
    else:
        found = classes.select("key", "key2", "copies", F.lit(0).cast("long").alias("links"), F.col("rep").alias("component"))
    own = read.join(found, ["key", "key2"], "left")
    links = F.when(F.col("sound"), F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0))).otherwise(0)
    component = F.when(F.col("sound"), F.col("component")).otherwise(F.col("vec_id"))
    return own.select("vec_id", links.cast("long").alias("n_links"), component.alias("component_id")).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0).alias("kept")
    )


def _linked(classes: DataFrame, rotation: Rotation, dim: int, least: float, exhaustive: bool) -> DataFrame:
    """key, key2, copies, links and component of every class of equal vectors."""
    schema = pa.schema([("key", pa.int64()), ("key2", pa.int64()), ("rep", pa.int64()), ("copies", pa.int64()), ("vector", pa.binary()), ("code", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = rotation.codes(vectors.matrix(batch.column("vector"), dim))
            held = pa.array([row.tobytes() for row in codes], pa.binary())
            yield texts.rows(schema, **{name: batch.column(name) for name in schema.names[:-1]}, code=held)

    coded = texts.checkpointed(
        classes.select(*schema.names[:-1]).mapInArrow(
            encode, "key long, key2 long, rep long, copies long, vector binary, code binary"
        )
        # Codes that share a node are near each other for the tables, and vectors decide.
        .withColumn("node", F.xxhash64("code"))
    )
    probes = coded.groupBy("node").agg(F.first("code").alias("code")).mapInArrow(
        _deal(rotation.tables), "table int, bucket long, node long, code binary, own boolean"
    )
    sizes = probes.groupBy("table", "bucket").agg(F.count("*").alias("rows"), F.max("own").alias("home"))
    sizes = sizes.where(F.col("home") & (F.col("rows") > 1))
    sized = probes.join(sizes.withColumn("blocks", F.ceil(F.col("rows") / BLOCK_CODES)).drop("rows", "home"), ["table", "bucket"])
    dealt = blocked(sized, F.col("bucket"), "blocks", "node").repartition("table", "bucket", "i", "j")
    near = (
        dealt.sortWithinPartitions("table", "bucket", "i", "j")
        .select("table", "bucket", "i", "j", "block", "node", "code", "own")
        .mapInArrow(_near(rotation.radius), "a long, b long")
    )
    clusters = graph.components(near).select("node", F.col("component").alias("near"))
    clustered = texts.checkpointed(
        coded.join(clusters, "node", "left").withColumn("cluster", F.coalesce("near", "node")).drop("near", "code")
    )
    several = clustered.groupBy("cluster").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    several = several.withColumn("blocks", F.ceil(F.col("rows") / BLOCK_VECTORS)).drop("rows")
    rows = blocked(clustered.join(several, "cluster"), F.col("cluster"), "blocks", "rep")
    near_by = (
        rows.select("cluster", "i", "j", "block", "rep", "copies", "vector")
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(_compare(dim, least), "rep long, links long, to long")
    )
    if exhaustive:
        near_by = near_by.unionAll(_all_blocks(clustered, dim, least))
    compared = texts.checkpointed(near_by)
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = compared.where(F.col("to").isNotNull()).select(F.col("rep").alias("a"), F.col("to").alias("b"))
    components = graph.components(edges).select(F.col("node").alias("rep"), "component")
    return coded.join(links, "rep", "left").join(components, "rep", "left").select(
        "key", "key2", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component")
    )


def _all_blocks(clustered: DataFrame, dim: int, least: float) -> DataFrame:
    """Links between vectors of different clusters, by a product of all blocks."""
    total = clustered.count()
    most = max(1, BLOCK_COMPONENTS // dim)
    blocks = max(-(-total // most), min(LEAST_BLOCKS, -(-total // 256)))
    everything = blocked(clustered.withColumn("blocks", F.lit(blocks)), F.lit(0), "blocks", "rep")
    return (
        everything.select("i", "j", "block", "cluster", "rep", "copies", "vector")
        .repartition("i", "j")
        .sortWithinPartitions("i", "j")
        .mapInArrow(_apart(dim, least), "rep long, links long, to long")
    )
