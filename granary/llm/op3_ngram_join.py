"""N-gram Jaccard join as a blocked sparse product of documents by n-grams.

Two documents whose sets are alike enough share an n-gram among the rarest of each;
how many count as rarest follows from the set's size. Only those n-grams become columns
of the first product. Its pairs are discarded where sizes, or a lower bound on what
differs (bits that tell whether a part of the set is odd), rule them out. What remains
falls into clusters; each is multiplied out with whole sets, in blocks, and overlap
counts decide. Equal sets are one row of the products throughout, named by their
signature, so that texts that share a doc_id stay apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import graph, texts

# Cells of the frequency sketch, and the parts in which partial sketches are added up.
CELLS, CELL_PARTS = 1 << 20, 64
# Rows of a block in the first product; set elements of a block in the second.
BLOCK_ROWS, BLOCK_ELEMENTS = 2000, 1_000_000


def sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text in ascending order, and the first of each text."""
    hashes, bounds = texts.words(*texts.flat(column))
    grams, owner = texts.shingles(hashes, bounds, size)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.searchsorted(owner[new], np.arange(len(column) + 1))


def signatures(grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that do not depend on order; equal sets have equal ones."""
    sums = []
    for values in (grams, texts.mix(grams ^ np.uint64(0x5851F42D4C957F2D))):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        sums.append(texts.mix(running[bounds[1:]] - running[bounds[:-1]]).view(np.int64))
    return sums[0], sums[1]


def odd_bits(grams: np.ndarray) -> np.ndarray:
    """Bit k tells whether an odd number of the set's members falls in part k.

    Two sets differ in at least as many members as their bits differ. The number of bits
    is a power of two near two thirds of the set's size, at least 256; folding halves it.
    """
    width = 1 << max(8, int(len(grams) * 2 // 3).bit_length())
    odd = np.bincount((grams >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


_MEASURED = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("sig2", pa.int64()), ("bits", pa.binary()), ("part", pa.int32()), ("cells", pa.binary())]
)


def measurer(size: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Signatures and odd bits of each text, and at the end the partition's n-gram frequencies."""
        cells = np.zeros(CELLS, dtype=np.int64)
        for batch in texts.runs(batches):
            grams, bounds = sets(batch.column("text"), size)
            np.add.at(cells, (grams >> np.uint64(44)).astype(np.int64), 1)
            sig, sig2 = signatures(grams, bounds)
            bits = [odd_bits(grams[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            blank = pa.nulls(batch.num_rows)
            yield texts.rows(
                _MEASURED, doc_id=batch.column("doc_id"), n=np.diff(bounds), sig=sig, sig2=sig2, bits=pa.array(bits, pa.binary()),
                part=blank.cast(pa.int32()), cells=blank.cast(pa.binary()),
            )
        parts = [zlib.compress(part.tobytes(), 1) for part in np.split(np.minimum(cells, 65535).astype(np.uint16), CELL_PARTS)]
        blank = pa.nulls(CELL_PARTS)
        yield texts.rows(
            _MEASURED, doc_id=blank.cast(pa.int64()), n=np.full(CELL_PARTS, TaskContext.get().partitionId()), sig=blank.cast(pa.int64()), sig2=blank.cast(pa.int64()),
            bits=blank.cast(pa.binary()), part=np.arange(CELL_PARTS, dtype=np.int32), cells=pa.array(parts, pa.binary()),
        )

    return measure


def frequencies(measured: DataFrame) -> np.ndarray:
    """How often n-grams of each cell occur, up to 65,535: a fixed two megabytes."""

    def add(held: Sequence[bytes]) -> bytes:
        summed = np.zeros(CELLS // CELL_PARTS, dtype=np.int64)
        for cells in held:
            summed += np.frombuffer(zlib.decompress(cells), dtype=np.uint16)
        return zlib.compress(np.minimum(summed, 65535).astype(np.uint16).tobytes(), 1)

    partial = measured.where(F.col("part").isNotNull()).select(
        F.col("part").alias("place"), F.col("n").cast("int").alias("part"), F.col("cells").alias("held")
    )
    cells = np.zeros((CELL_PARTS, CELLS // CELL_PARTS), dtype=np.uint16)
    for row in texts.added_up(partial, ["place"], add).collect():
        cells[row["place"]] = np.frombuffer(zlib.decompress(row["held"]), dtype=np.uint16)
    return cells.ravel()


def _rare(per_cent: int, size: int, cells: np.ndarray):
    schema = pa.schema([("gram", pa.int64()), ("sig", pa.int64())])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rarest n-grams of each set, as many as its size asks for; equal sets of a run once."""
        for batch in texts.runs(batches):
            grams, bounds = sets(batch.column("text"), size)
            sig, _ = signatures(grams, bounds)
            counts = np.diff(bounds)
            _, once = np.unique(sig, return_index=True)
            wanted = np.zeros(len(counts), dtype=np.int64)
            wanted[once] = (counts - -(-counts * per_cent // 100) + 1)[once]
            wanted[counts == 0] = 0
            owner = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((grams, cells[(grams >> np.uint64(44)).astype(np.int64)], owner))
            chosen = order[texts.ranges(bounds[:-1], wanted)]
            yield texts.rows(schema, gram=grams[chosen].view(np.int64), sig=sig[owner[chosen]])

    return rare


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Odd bits brought down to a smaller number of parts."""
    return np.bitwise_xor.reduce(bits.reshape(-1, width), axis=0)


def near(n: np.ndarray, bits: list[np.ndarray], per_cent: int, across: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs that sizes and odd bits allow, as few as join what they join; rows ascend by size.

    With `across`, only pairs of rows from different sides are looked at.
    """
    forest, found = graph.Forest(len(n)), []
    widths = np.array([len(b) for b in bits])
    stacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for width in np.unique(widths):
        rows = np.flatnonzero((widths == width) | (widths == 2 * width))
        stacked[int(width)] = rows, np.stack([fold(bits[row], int(width)) for row in rows])
    low = np.searchsorted(n, -(-n * per_cent // 100))
    for i in range(1, len(n)):
        for width in {int(widths[i]), int(widths[i]) // 2} & stacked.keys():
            rows, folded = stacked[width]
            a, b = np.searchsorted(rows, (low[i], i))
            own = rows[a:b][widths[rows[a:b]] == width]
            if across is not None:
                own = own[across[own] != across[i]]
            if not len(own):
                continue
            differ = np.bitwise_count(folded[np.searchsorted(rows, own)] ^ fold(bits[i], width)).sum(axis=1)
            both = n[own] + n[i]
            shared = -(-both * per_cent // (100 + per_cent))
            for j in own[differ <= both - 2 * shared]:
                if forest.join(int(j), i):
                    found.append((int(j), i))
    return found


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _candidates(per_cent: int):
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges of the first product, one column (or block of one) after the other."""
        held: list[tuple[int, int]] = []
        for group in texts.groups(batches, ["gram", "i", "j"]):
            n, node, block = (group.column(name).to_numpy() for name in ("n", "node", "block"))
            order = np.argsort(n, kind="stable")
            bits = [np.frombuffer(b, dtype=np.uint64) for b in group.column("bits").to_pylist()]
            across = block[order] if group.column("i")[0] != group.column("j")[0] else None
            pairs = near(n[order], [bits[k] for k in order], per_cent, across)
            held += [(node[order[a]], node[order[b]]) for a, b in pairs]
            if len(held) > 10_000:
                yield texts.rows(_EDGES, a=[a for a, _ in held], b=[b for _, b in held])
                held = []
        yield texts.rows(_EDGES, a=[a for a, _ in held], b=[b for _, b in held])

    return candidates


def blocked(rows: DataFrame, key: Column, blocks: str, row: str) -> DataFrame:
    """Deal rows of a key to blocks i <= j of it, so that any two meet in one; i, j, block."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(row, key), F.col(blocks)).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int"))))
    return other.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", blocks)


def links(members: list[np.ndarray], per_cent: int, across: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between sets by overlap counts, as few as join what all of them join."""
    n = np.array([len(m) for m in members])
    owner = np.repeat(np.arange(len(n)), n)
    _, column, times = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    by_column = np.argsort(column, kind="stable")
    posts = owner[by_column]
    at = np.searchsorted(column[by_column], np.arange(len(times) + 1))
    row_at = np.searchsorted(owner, np.arange(len(n) + 1))
    forest, found = graph.Forest(len(n)), []
    for i in range(len(n)):
        own = column[row_at[i] : row_at[i + 1]]
        reached = posts[texts.ranges(at[own], at[own + 1] - at[own])]
        overlap = np.bincount(reached, minlength=len(n))[:i]
        for j in np.flatnonzero((overlap > 0) & (100 * overlap >= per_cent * (n[:i] + n[i] - overlap))):
            if (across is None or across[j] != across[i]) and forest.join(int(j), i):
                found.append((int(j), i))
    return found


def _verify(per_cent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges of the second product, cluster by cluster."""
        for group in texts.groups(batches, ["cluster", "i", "j"]):
            node, first = np.unique(group.column("node").to_numpy(), return_index=True)
            held = group.column("grams").to_pylist()
            members = [np.frombuffer(held[k], dtype=np.uint64) for k in first]
            across = group.column("block").to_numpy()[first] if group.column("i")[0] != group.column("j")[0] else None
            pairs = links(members, per_cent, across)
            yield texts.rows(_EDGES, a=[node[a] for a, _ in pairs], b=[node[b] for _, b in pairs])

    return verify


def _whole(size: int):
    schema = pa.schema([("node", pa.int64()), ("cluster", pa.int64()), ("blocks", pa.int64()), ("grams", pa.binary())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole sets of the texts that are the ones meant."""
        for batch in texts.runs(batches):
            grams, bounds = sets(batch.column("text"), size)
            sig, sig2 = signatures(grams, bounds)
            meant = (sig == batch.column("sig").to_numpy()) & (sig2 == batch.column("sig2").to_numpy())
            rows = np.flatnonzero(meant)
            part = batch.select(["sig", "cluster", "blocks"]).take(pa.array(rows))
            held = pa.array([grams[bounds[k] : bounds[k + 1]].tobytes() for k in rows], pa.binary())
            yield texts.rows(schema, node=part.column("sig"), cluster=part.column("cluster"), blocks=part.column("blocks"), grams=held)

    return whole


def join(documents: DataFrame, size: int = 5, per_cent: int = 80) -> DataFrame:
    """Groups of documents whose sets of `size`-word n-grams are at least `per_cent` % alike.

    Words are what stands between ASCII white space, A-Z lower-cased; fewer words than
    `size` are one n-gram. Documents link when the intersection is at least that share of
    the union. Returns doc_id, n_shingles, component_id (the smallest doc_id reachable by
    links, itself included): one row per input row.

    Null, empty and blank texts have no n-grams and link with nothing. Repeated rows link
    with each other. Rows with null doc_id name no component: theirs is the smallest id
    they reach, or null. Rows of one doc_id with different texts are rows of their own: each
    has the smallest doc_id that its own text reaches. Extra columns are ignored; an empty table gives an empty result.
    """
    return _grouped(documents, size, per_cent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _grouped(documents: DataFrame, size: int, per_cent: int) -> DataFrame:
    """doc_id, n, sig, sig2, group (null without n-grams) and component_id of every row."""
    own = documents.select(F.col("doc_id").cast("long"), "text")
    measured = texts.checkpointed(
        own.mapInArrow(measurer(size), "doc_id long, n long, sig long, sig2 long, bits binary, part int, cells binary")
    )
    cells = frequencies(measured)
    docs = measured.where(F.col("part").isNull()).select("doc_id", "n", "sig", "sig2", "bits")
    classes = (
        docs.where(F.col("n") > 0)
        .groupBy("sig", "sig2")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"))
        .where(F.col("rep").isNotNull())
    )
    rare = own.mapInArrow(_rare(per_cent, size, cells), "gram long, sig long")
    columns = (
        rare.repartition("gram")
        .dropDuplicates(["gram", "sig"])
        .withColumn("rows", F.count("*").over(Window.partitionBy("gram")))
        .where(F.col("rows") > 1)
        .withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS))
        .drop("rows")
    )
    incidence = blocked(columns.join(classes, "sig").withColumn("node", F.col("sig")), F.col("gram"), "blocks", "node")
    dealt = incidence.select("gram", "i", "j", "block", "node", "n", "bits").repartition("gram", "i", "j")
    candidates = dealt.sortWithinPartitions("gram", "i", "j").mapInArrow(_candidates(per_cent), "a long, b long")
    clusters = graph.components(candidates).select(F.col("node").alias("sig"), F.col("component").alias("cluster"))
    clustered = clusters.join(classes.select("rep", "sig", "sig2", "n"), "sig")
    sizes = clustered.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_ELEMENTS).alias("blocks"))
    wanted = texts.checkpointed(clustered.join(sizes, "cluster"))
    sources = own.join(wanted, own["doc_id"] == wanted["rep"]).select("cluster", "blocks", "sig", "sig2", "text")
    rows = blocked(
        sources.mapInArrow(_whole(size), "node long, cluster long, blocks long, grams binary"), F.col("cluster"), "blocks", "node"
    )
    multiplied = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    edges = multiplied.select("cluster", "i", "j", "block", "node", "grams").mapInArrow(_verify(per_cent), "a long, b long")
    found = graph.components(edges).select(F.col("node").alias("sig"), F.col("component").alias("group"))
    named = classes.select("sig", "sig2", "rep").join(found, "sig", "left").withColumn("group", F.coalesce("group", "sig"))
    named = texts.checkpointed(named)
    firsts = named.groupBy("group").agg(F.min("rep").alias("component_id"))
    linked = docs.where(F.col("n") > 0).join(named.join(firsts, "group").drop("rep"), ["sig", "sig2"], "left")
    columns = ("doc_id", "n", "sig", "sig2", "group", "component_id")
    blank = docs.where(F.col("n") == 0).withColumn("group", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id"))
    return linked.select(*columns).unionAll(blank.select(*columns))


def _own_text(size: int):
    def own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose signatures are those of their text."""
        for batch in texts.runs(batches):
            sig, sig2 = signatures(*sets(batch.column("text"), size))
            meant = (sig == batch.column("sig").to_numpy()) & (sig2 == batch.column("sig2").to_numpy())
            yield batch.filter(pa.array(meant))

    return own_text


def first_of_each_group(documents: DataFrame, size: int = 5, per_cent: int = 80) -> DataFrame:
    """The documents in all their columns, of each linked group the one with the smallest doc_id.

    Of rows that share a doc_id and a group the first by text stays; their texts in other
    groups are judged there. Texts without n-grams link with nothing: all stay, but equal
    ones of one doc_id once. Rows with null doc_id cannot be named as the one that stays or
    goes, and stay.
    """
    joined = texts.checkpointed(_grouped(documents, size, per_cent).where(F.col("doc_id").isNotNull()).drop("n").distinct())
    kinds = joined.groupBy("doc_id").agg(F.count("*").alias("kinds"))
    firsts = joined.where(F.col("doc_id") == F.col("component_id")).drop("component_id").join(kinds, "doc_id")
    whole = documents.select(F.col("doc_id").cast("long"), "text", F.struct("*").alias("document"))

    def first(held: DataFrame) -> DataFrame:
        blank = F.when(F.col("group").isNull(), F.col("text"))
        turn = F.row_number().over(Window.partitionBy("doc_id", "group", blank).orderBy("text"))
        return held.withColumn("turn", turn).where(F.col("turn") == 1).select("document.*")

    alone = whole.join(firsts.where(F.col("kinds") == 1).drop("kinds", "sig", "sig2"), "doc_id")
    # Only where a doc_id has different texts does a row's own text have to tell which one it is.
    several = whole.join(firsts.where(F.col("kinds") > 1).drop("kinds"), "doc_id")
    several = several.mapInArrow(_own_text(size), several.schema)
    return first(alone).unionAll(first(several)).unionAll(documents.where(F.col("doc_id").isNull()))
