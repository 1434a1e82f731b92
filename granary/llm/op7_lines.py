"""Line deduplication by sharded minimal perfect hashes.

Lines that several documents hold are indexed by a minimal perfect hash per shard: it
numbers the keys of the shard without gaps and without storing them. Under a key's
number stand a fingerprint, the count of documents and the first document. Documents
send the hashes of their lines to the shards and probe these arrays; no line is joined
with another, and no text leaves its document before the last step.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import texts

# Probes of one shard are dealt to so many tasks for each SHARD_LINES of repeats begun, for lines that very many documents hold.
SALTS = 16
# Lines that one shard answers for, repeats included, unless a single line is more often.
SHARD_LINES = 500_000
LEAST_CODE_POINTS = 10
NO_ID = 2**63 - 1

_NOT_SPACE = ~texts.SPACE


@dataclass
class MinimalPerfectHash:
    """Levels of bits: a key's number is the rank of its bit on the first level where it is alone."""

    sizes: list[int]
    bits: np.ndarray
    ranks: np.ndarray

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (texts.mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % texts.WORD)) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def build(keys: np.ndarray) -> MinimalPerfectHash:
        """Over distinct keys. Those that collide on a level go on to the next."""
        sizes, levels = [], []
        while len(keys):
            size = 2 * len(keys) + 1
            place = MinimalPerfectHash._place(keys, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[place]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        return MinimalPerfectHash(sizes, bits, np.cumsum(bits) - 1)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of keys; a key that was not built in gets some number, or -1."""
        found = np.full(len(keys), -1, dtype=np.int64)
        rest, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            place = self._place(keys[rest], level, size) + base
            here = self.bits[place]
            found[rest[here]] = self.ranks[place[here]]
            rest, base = rest[~here], base + size
        return found


@dataclass
class LineIndex:
    """One shard: the hash, and the arrays it points into.

    The hash is over keys, or if two lines of one key meet, over keys moved by their fingerprints
    and an odd number, which sets them apart.
    """

    hash: MinimalPerfectHash
    seed: int
    prints: np.ndarray
    counts: np.ndarray
    first: np.ndarray

    @staticmethod
    def build(keys: np.ndarray, prints: np.ndarray, counts: np.ndarray, first: np.ndarray) -> LineIndex:
        seed = 0
        while len(np.unique(LineIndex._moved(keys, prints, seed))) < len(keys):
            seed += 1 + seed % 2
        keys = LineIndex._moved(keys, prints, seed)
        hashed = MinimalPerfectHash.build(keys)
        order = np.argsort(hashed.number(keys))
        return LineIndex(hashed, seed, prints[order], np.minimum(counts[order], 2**32 - 1).astype(np.uint32), first[order])

    @staticmethod
    def _moved(keys: np.ndarray, prints: np.ndarray, seed: int) -> np.ndarray:
        return keys + np.uint64(seed) * texts.mix(prints) if seed else keys

    def to_bytes(self) -> bytes:
        head = np.array([len(self.hash.sizes), len(self.prints), self.seed, *self.hash.sizes], dtype=np.int64)
        return b"".join(
            [head.tobytes(), np.packbits(self.hash.bits).tobytes(), self.prints.tobytes(), self.first.tobytes(), self.counts.tobytes()]
        )

    @staticmethod
    def from_bytes(held: bytes) -> LineIndex:
        levels, n, seed = np.frombuffer(held, np.int64, 3)
        sizes = np.frombuffer(held, np.int64, levels, 24)
        at, total = 24 + 8 * int(levels), int(sizes.sum())
        packed = np.frombuffer(held, np.uint8, (total + 7) // 8, at)
        at += len(packed)
        bits = np.unpackbits(packed, count=total).astype(bool)
        prints, first = np.frombuffer(held, np.uint64, n, at), np.frombuffer(held, np.int64, n, at + 8 * n)
        counts = np.frombuffer(held, np.uint32, n, at + 16 * n)
        return LineIndex(MinimalPerfectHash(sizes.tolist(), bits, np.cumsum(bits) - 1), int(seed), prints, counts, first)

    def repeats(self, keys: np.ndarray, prints: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether each line is held by several documents of which its own is not the first."""
        number = self.hash.number(self._moved(keys, prints, self.seed))
        known = number >= 0
        known[known] = self.prints[number[known]] == prints[known]
        found = np.zeros(len(keys), dtype=bool)
        found[known] = (self.counts[number[known]] > 1) & (self.first[number[known]] != doc[known])
        return found


def lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key hash, fingerprint, text and place of every line whose key is long enough."""
    data, offsets = texts.flat(column)
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    n = len(offsets) - 1
    before = np.searchsorted(breaks, offsets)
    starts = np.empty(len(breaks) + n, dtype=np.int64)
    ends = np.empty_like(starts)
    firsts = np.arange(n) + before[:-1]
    starts[firsts] = offsets[:-1]
    starts[owner + np.arange(len(breaks)) + 1] = breaks + 1
    ends[np.arange(n) + before[1:]] = offsets[1:]
    ends[owner + np.arange(len(breaks))] = breaks
    text = np.repeat(np.arange(n), np.diff(before) + 1)
    solid = np.flatnonzero(_NOT_SPACE[data])
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    some = np.flatnonzero(first <= last)
    starts, ends = solid[first[some]], solid[last[some]] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = points[ends] - points[starts] >= LEAST_CODE_POINTS
    some, starts, ends = some[long], starts[long], ends[long]
    lowered = texts.LOWER[data]
    keys = texts.whole_hashes(texts.prefix_sums(lowered), starts, ends)
    prints = texts.whole_hashes(texts.prefix_sums(lowered, texts.SECOND_BASE), starts, ends, texts.SECOND_BASE)
    return keys, prints, text[some], some - firsts[text[some]]


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)


_KEYS = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("n", pa.int64())])
_PROBES = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("line", pa.int32())])
_HITS = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("line", pa.int32())])


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of a run of texts, each with its lowest and highest document."""
    for batch in texts.runs(batches):
        keys, prints, text, _ = lines(batch.column("text"))
        doc = _ids(batch)[text]
        order = np.lexsort((doc, prints, keys))
        keys, prints, doc = keys[order], prints[order], doc[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(keys)) - 1 if len(at) else at
        yield texts.rows(
            _KEYS, key=keys[at].view(np.int64), print=prints[at].view(np.int64), low=doc[at], high=doc[last], n=last - at + 1
        )


def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The probes of every line with a key."""
    for batch in texts.runs(batches):
        keys, prints, text, place = lines(batch.column("text"))
        yield texts.rows(
            _PROBES,
            key=keys.view(np.int64),
            print=prints.view(np.int64),
            doc=_ids(batch)[text],
            tag=batch.column("tag").to_numpy(zero_copy_only=False)[text],
            line=place.astype(np.int32),
        )


def build(group: pd.DataFrame) -> pd.DataFrame:
    """The index of one shard, and how many lines it answers for."""
    group = group.sort_values(["key", "print"])
    index = LineIndex.build(
        group["key"].to_numpy().view(np.uint64), group["print"].to_numpy().view(np.uint64), group["n"].to_numpy(), group["low"].to_numpy()
    )
    return pd.DataFrame({"shard": group["shard"].iloc[:1].to_numpy(), "lines": [int(group["n"].sum())], "held": [index.to_bytes()]})


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to drop, from rows sorted so that a shard's index precedes its probes."""
    index, shard = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        held = batch.column("held")
        cuts = sorted({0, batch.num_rows, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), *np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False)).tolist()})
        for low, high in zip(cuts, cuts[1:]):
            part = batch.slice(low, high - low)
            if part.column("held")[0].is_valid:
                index, shard = LineIndex.from_bytes(part.column("held")[0].as_py()), shards[low]
                part = part.slice(1)
            if not part.num_rows or index is None or shard != shards[low]:
                continue
            get = lambda name: part.column(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            drop = pa.array(index.repeats(get("key").view(np.uint64), get("print").view(np.uint64), get("doc")))
            hits = part.select(_HITS.names).filter(drop)
            if hits.num_rows:
                yield pa.RecordBatch.from_arrays(hits.columns, schema=_HITS)


def dropped_lines(documents: DataFrame) -> DataFrame:
    """doc, tag and the sorted places of lines to drop, for documents (doc_id, tag, text) that lose any."""
    own = documents.select("doc_id", "tag", "text")
    found = own.mapInArrow(gather, "key long, print long, low long, high long, n long")
    counted = found.groupBy("key", "print").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    total = F.sum("n")
    keys = texts.checkpointed(counted.groupBy(F.when(F.col("low") < F.col("high"), F.col("key")).alias("key"), F.when(F.col("low") < F.col("high"), F.col("print")).alias("print")).agg(F.min("low").alias("low"), total.alias("n")))
    shards = 1 + (keys.agg(F.sum("n")).first()[0] or 0) // SHARD_LINES

    def shard() -> Column:
        return F.pmod(F.col("key"), F.lit(shards)).cast("int")

    held = keys.where(F.col("key").isNotNull()).withColumn("shard", shard())
    indexes = held.groupBy("shard").applyInPandas(build, "shard int, lines long, held binary")
    salts = (F.lit(SALTS) * (1 + F.floor(F.col("lines") / SHARD_LINES))).cast("int")
    # At most one shard in SHARD_LINES lines; a written table, so that Spark knows its size.
    crowded = held.groupBy("shard").agg(F.sum("n").alias("lines")).where(F.col("lines") >= SHARD_LINES)
    crowded = texts.written(crowded.select("shard", salts.alias("salts")))
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("key", "long"), ("print", "long"), ("doc", "long"), ("tag", "long"), ("line", "int"))]
    copies = indexes.select("shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "held", *none)
    probes = own.mapInArrow(ask, "key long, print long, doc long, tag long, line int").withColumn("shard", shard())
    probes = probes.join(crowded, "shard", "left").select(
        "shard",
        F.pmod(F.xxhash64("doc", "tag", "line"), F.coalesce("salts", F.lit(SALTS))).cast("int").alias("salt"),
        F.lit(None).cast("binary").alias("held"),
        "key", "print", "doc", "tag", "line",
    )
    dealt = copies.unionAll(probes).repartition("shard", "salt")
    hits = dealt.sortWithinPartitions("shard", "salt", F.col("held").isNull()).drop("salt").mapInArrow(answer, "doc long, tag long, line int")
    return hits.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("line")).alias("drops"))


def unused(names: Sequence[str]) -> str:
    """A name for a field that keeps a struct from being empty, longer than all of these."""
    return "_" * (1 + max(map(len, names), default=0))


def dedup_lines(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Documents without the lines that an earlier document holds.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. A key
    of at least ten code points that several documents hold stays in the one with the
    smallest id only, there in all its lines. Returns doc_id, the columns in `keep`, text
    (what stays, joined by newlines), n_lines, n_dropped: one row per input row.

    A null or empty text is one empty line and becomes an empty text. Rows with the same
    doc_id are one document for the rule, and null ids are one document after all others.
    Columns not named are ignored. An empty table gives an empty result.
    """
    tagged = documents.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.struct(*keep, F.lit(0).alias(unused(keep))).alias("kept")
    ).withColumn("tag", F.xxhash64("text"))
    drops = dropped_lines(tagged).withColumnRenamed("tag", "drop_tag")
    joined = tagged.join(drops, (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("doc")) & (F.col("tag") == F.col("drop_tag")), "left")
    split = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(split, lambda _, at: ~F.array_contains("drops", at)), "\n")
    return joined.select(
        "doc_id",
        *[F.col("kept").getField(name).alias(name) for name in keep],
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def lined_documents(documents: DataFrame) -> DataFrame:
    """The documents in all their columns, texts without repeated lines and n_chars brought up to date."""
    rest = [name for name in documents.columns if name not in ("doc_id", "text")]
    whole = documents.select("doc_id", "text", F.struct(*rest, F.lit(0).alias(unused(rest))).alias("rest"))
    kept = dedup_lines(whole, keep=("rest",))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text"), **{name: F.col("rest").getField(name) for name in rest}}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(documents.schema["n_chars"].dataType)
    return kept.select(*[columns[name].alias(name) for name in documents.columns])
