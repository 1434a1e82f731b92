"""Removal of long repeated byte strings, found by suffix arrays over shards.

A string of `size` bytes has anchors: the short grams in it whose hash is smallest.
Equal strings have equal anchors at equal places, so only strings around anchors that
occur twice can repeat. Those surroundings are dealt to shards by the anchor, equal
surroundings once. Each shard sorts its suffixes by induced sorting, and neighbours in
that order that share `size` bytes repeat. A string is judged at its leftmost anchor
alone, so it stands in one shard only, and once for each place where it starts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import suffixes, texts

# Bytes of an anchor's gram, and of the surroundings that one shard sorts.
GRAM = 64
SHARD_BYTES = 1 << 19
# An anchor with more different surroundings than this has its strings counted one by one:
# they would not fit into one shard.
SHARD_SURROUNDINGS = 4000
# Cells of the frequency sketch of anchors, and the parts in which partial sketches are
# added up. A cell with more than one in CROWD of all anchors is crowded; the anchors of
# crowded cells are dealt to SALTS tasks each.
CELLS, CELL_PARTS = 1 << 20, 64
CROWD, SALTS = 10_000, 64
# Neighbouring strings at a crowded anchor that are told apart only where they have to be.
BLOCK_STRINGS = 16

_HIGHEST = np.uint32(2**32 - 1)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or greatest of every `width` neighbours."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[:-rest], values[rest:]) if rest else values


def gram_hashes(total: np.ndarray, ends: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram at every place, from 1 on; the highest number where it would cross its text's end.

    The upper half of a rolling hash serves: grams need only be put in some order.
    """
    if len(total) <= gram:
        return np.zeros(0, dtype=np.uint32)
    _, inverse = texts.powers(len(total))
    hashes = (((total[gram:] - total[:-gram]) * inverse[: len(total) - gram]) >> np.uint64(32)).astype(np.uint32)
    np.maximum(hashes, np.uint32(1), out=hashes)
    hashes[np.arange(gram, gram + len(hashes)) > ends[: len(hashes)]] = _HIGHEST
    return hashes


def anchors(total: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> np.ndarray:
    """Places whose gram has the smallest hash of some string of `size` bytes, ties included."""
    if len(total) - 1 < size:
        return np.zeros(0, dtype=np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    hashes, width = gram_hashes(total, ends, gram), size - gram + 1
    least = _sliding(hashes, width, np.minimum)
    starts = np.arange(len(least))
    least[starts + size > ends[: len(least)]] = 0
    blank = np.zeros(width - 1, dtype=np.uint32)
    return np.flatnonzero(_sliding(np.concatenate([blank, least, blank]), width, np.maximum) == hashes)


_ANCHORS = pa.schema(
    [("gram", pa.int64()), ("around", pa.int64()), ("row", pa.int64()), ("at", pa.int64()), ("crowded", pa.bool_())]
)
_CELLS = pa.schema([("place", pa.int32()), ("part", pa.int32()), ("held", pa.binary())])
_SPANS = pa.schema([("row", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_AROUND = pa.schema(
    [("gram", pa.int64()), ("row", pa.int64()), ("at", pa.int64()), ("same", pa.int64()), ("kinds", pa.int64()),
     ("low", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("held", pa.binary())]
)
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("row", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("same", pa.int64()), ("held", pa.binary())]
)
_STRINGS = pa.schema([("string", pa.int64()), ("n", pa.int64()), ("places", pa.binary())])


def _surroundings(places: np.ndarray, low: np.ndarray, high: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings around an anchor begin and end, inside its text."""
    return np.maximum(places - (size - gram), low), np.minimum(places + size, high)


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(44)).astype(np.int64)


def _count_anchors(size: int, gram: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many anchors of the partition fall in each cell."""
        cells = np.zeros(CELLS, dtype=np.uint32)
        for batch in texts.runs(batches):
            data, offsets = texts.flat(batch.column("text"))
            total = texts.prefix_sums(data)
            places = anchors(total, offsets, size, gram)
            np.add.at(cells, _cell(texts.span_hashes(total, places, places + gram)), 1)
        held = [zlib.compress(part.tobytes(), 1) for part in np.split(cells, CELL_PARTS)]
        part = np.full(CELL_PARTS, TaskContext.get().partitionId(), dtype=np.int32)
        yield texts.rows(_CELLS, place=np.arange(CELL_PARTS, dtype=np.int32), part=part, held=pa.array(held, pa.binary()))

    return count


def crowded_cells(rows: DataFrame, size: int, gram: int) -> np.ndarray:
    """Which cells hold so many anchors that one task should not take an anchor of theirs: a fixed megabyte."""

    def add(held: Sequence[bytes]) -> bytes:
        summed = np.zeros(CELLS // CELL_PARTS, dtype=np.uint64)
        for cells in held:
            summed += np.frombuffer(zlib.decompress(cells), dtype=np.uint32)
        return zlib.compress(np.minimum(summed, 2**32 - 1).astype(np.uint32).tobytes(), 1)

    partial = rows.select("text").mapInArrow(_count_anchors(size, gram), "place int, part int, held binary")
    cells = np.zeros((CELL_PARTS, CELLS // CELL_PARTS), dtype=np.uint32)
    for row in texts.added_up(partial, ["place"], add).collect():
        cells[row["place"]] = np.frombuffer(zlib.decompress(row["held"]), dtype=np.uint32)
    cells = cells.ravel()
    return cells > max(1, int(cells.sum(dtype=np.uint64)) // CROWD)


def _find_anchors(size: int, gram: int, crowded: np.ndarray):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.runs(batches):
            data, offsets = texts.flat(batch.column("text"))
            total = texts.prefix_sums(data)
            places = anchors(total, offsets, size, gram)
            owner = np.searchsorted(offsets, places, side="right") - 1
            low, high = _surroundings(places, offsets[owner], offsets[owner + 1], size, gram)
            around = texts.span_hashes(total, low, high) + texts.mix((places - low).astype(np.uint64) + np.uint64(1))
            grams = texts.span_hashes(total, places, places + gram)
            yield texts.rows(
                _ANCHORS,
                gram=grams.view(np.int64),
                around=around.view(np.int64),
                row=batch.column("row").to_numpy()[owner],
                at=places - offsets[owner],
                crowded=crowded[_cell(grams)],
            )

    return find


def _cut_out(size: int, gram: int):
    """Bytes around chosen anchors, and the first and last string that is judged there."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.runs(batches):
            data, offsets = texts.flat(batch.column("text"))
            chosen = batch.column("chosen")
            counts = np.diff(chosen.offsets.to_numpy())
            fields = chosen.flatten()
            get = lambda name: fields.field(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            owner = np.repeat(np.arange(batch.num_rows), counts)
            places = get("at") + offsets[owner]
            low, high = _surroundings(places, offsets[owner], offsets[owner + 1], size, gram)
            hashes = gram_hashes(texts.prefix_sums(data), np.repeat(offsets[1:], np.diff(offsets)), gram)
            # Grams that a string around the anchor may hold, row by row.
            grams = high - gram - low + 1
            row = np.repeat(np.arange(len(places)), grams)
            where = texts.ranges(low, grams)
            own = hashes[places][row]
            earlier = np.where((where < places[row]) & (hashes[where] <= own), where, -1)
            later = np.where((where > places[row]) & (hashes[where] < own), where, np.int64(2**62))
            at = np.cumsum(grams) - grams
            if not len(places):
                continue
            first = np.maximum(low, np.maximum.reduceat(earlier, at) + 1)
            last = np.minimum(np.minimum(places, high - size), np.minimum.reduceat(later, at) - (size - gram) - 1)
            yield texts.rows(
                _AROUND,
                gram=get("gram"),
                row=batch.column("row").to_numpy()[owner],
                at=get("at"),
                same=get("same"),
                kinds=get("kinds"),
                low=low - offsets[owner],
                first=first - low,
                last=last - low,
                held=pa.array([data[a:b].tobytes() for a, b in zip(low, high)], pa.binary()),
            )

    return cut


def repeats(held: Sequence[bytes], first: np.ndarray, last: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of `size` bytes, starting first to last in each piece, that another piece or place has too.

    Returns the piece and the start of each, by the suffix array of all pieces.
    """
    lengths = np.array([len(piece) for piece in held])
    starts = np.cumsum(lengths + 1) - lengths - 1
    text = np.ones(int(lengths.sum()) + len(held) + 1, dtype=np.uint16)
    text[-1] = 0
    text[texts.ranges(starts, lengths)] = np.frombuffer(b"".join(held), dtype=np.uint8).astype(np.uint16) + 2
    total = texts.prefix_sums(text)
    counts = np.maximum(last - first + 1, 0)
    judged = np.zeros(len(text), dtype=bool)
    judged[texts.ranges(starts + first, counts)] = True
    order = suffixes.suffix_array(text, total)
    order = order[judged[order]]
    alike = suffixes.common_prefixes(total, order, size) == size
    alike[:-1] |= alike[1:]
    found = np.sort(order[alike])
    piece = np.searchsorted(starts, found, side="right") - 1
    return piece, found - starts[piece]


def _merged(row: np.ndarray, low: np.ndarray, size: int) -> pa.RecordBatch:
    """Spans that strings starting at `low` cover, from starts sorted by row."""
    # Starts less than a string apart cover one span.
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (low[1:] > low[:-1] + size)
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(row)) - 1 if len(at) else at
    return texts.rows(_SPANS, row=row[at], low=low[at], high=low[end] + size)


def _sort_shards(size: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in texts.groups(batches, ["shard"]):
            get = lambda name: group.column(name).to_numpy()  # noqa: B023, E731
            piece, start = repeats(group.column("held").to_pylist(), get("first"), get("last"), size)
            # Surroundings that occur twice are removed anyway.
            once = get("same")[piece] == 1
            row, low = get("row")[piece[once]], (get("low")[piece] + start)[once]
            order = np.lexsort((low, row))
            yield _merged(row[order], low[order], size)

    return sort


def _blocks(size: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of neighbouring strings judged at an anchor, cut at equal distances from it."""
        for batch in texts.runs(batches, "held"):
            data, offsets = texts.flat(batch.column("held"))
            get = lambda name: batch.column(name).to_numpy()  # noqa: B023, E731
            counts = np.maximum(get("last") - get("first") + 1, 0)
            piece = np.repeat(np.arange(batch.num_rows), counts)
            within = texts.ranges(get("first"), counts)
            block = ((get("at") - get("low"))[piece] - within) // BLOCK_STRINGS
            new = np.ones(len(piece), dtype=bool)
            new[1:] = (piece[1:] != piece[:-1]) | (block[1:] != block[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(piece)))
            piece, within = piece[at], within[at]
            start = within + offsets[piece]
            end = start + n - 1 + size
            hashes = texts.span_hashes(texts.prefix_sums(data), start, end)
            held = pa.array([data[a:b].tobytes() for a, b in zip(start, end)], pa.binary())
            yield texts.rows(
                _BLOCKS, block=hashes.view(np.int64), row=get("row")[piece], low=get("low")[piece] + within, n=n, same=get("same")[piece], held=held
            )

    return blocks


def _strings(size: int):
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct strings judged at the anchors of a run, how often, and where they are to be removed."""
        for batch in texts.runs(batches, "held"):
            data, offsets = texts.flat(batch.column("held"))
            get = lambda name: batch.column(name).to_numpy()  # noqa: B023, E731
            counts = np.maximum(get("last") - get("first") + 1, 0)
            piece = np.repeat(np.arange(batch.num_rows), counts)
            within = texts.ranges(get("first"), counts)
            where = within + offsets[piece]
            hashes = texts.span_hashes(texts.prefix_sums(data), where, where + size)
            order = np.argsort(hashes, kind="stable")
            hashes, piece, within = hashes[order], piece[order], within[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = hashes[1:] != hashes[:-1]
            at = np.flatnonzero(new)
            once = get("same")[piece] == 1
            places = np.stack([get("row")[piece], get("low")[piece] + within], axis=1)[once].tobytes()
            edges = 16 * np.concatenate([[0], np.cumsum(once)])[np.append(at, len(hashes))]
            yield texts.rows(
                _STRINGS,
                string=hashes[at].view(np.int64),
                n=np.diff(np.append(at, len(hashes))),
                places=pa.array([places[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist())], pa.binary()),
            )

    return strings


def _places(size: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans that the places of repeated strings cover."""
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column("places").to_pylist()), dtype=np.int64).reshape(-1, 2)
            found = found[np.lexsort((found[:, 1], found[:, 0]))]
            yield _merged(found[:, 0], found[:, 1], size)

    return unpack


def repeated_spans(rows: DataFrame, size: int, gram: int) -> DataFrame:
    """row, low, high: bytes that strings found elsewhere cover, for rows (row, text)."""
    crowded = crowded_cells(rows, size, gram)
    found = rows.mapInArrow(
        _find_anchors(size, gram, crowded), "gram long, around long, row long, at long, crowded boolean"
    )
    salt = F.when(F.col("crowded"), F.pmod(F.xxhash64("row", "at"), F.lit(SALTS)).cast("int")).otherwise(0)
    alike = Window.partitionBy("gram", "salt", "around")
    # Anchors of crowded cells are all kept here: what is counted of them is in parts.
    shared = texts.checkpointed(
        found.withColumn("salt", salt)
        .repartition("gram", "salt")
        .withColumn("turn", F.row_number().over(alike.orderBy("row", "at")))
        .withColumn("same", F.count("*").over(alike))
        .withColumn("kinds", F.sum(F.when(F.col("turn") == 1, 1)).over(Window.partitionBy("gram", "salt")))
        .where(F.col("crowded") | (F.col("same") > 1) | (F.col("kinds") > 1))
        .select("gram", "around", "row", "at", "turn", "same", "kinds", "crowded")
    )
    chosen_columns = ("gram", "row", "at", "same", "kinds")
    apart = shared.where(~F.col("crowded"))
    lone = apart.where((F.col("turn") == 1) & (F.col("kinds") > 1)).select(*chosen_columns)
    # Crowded anchors are counted with partial sums and joined back, which Spark may split.
    crowd = shared.where(F.col("crowded")).select("gram", "around", "row", "at")
    counted_crowd = crowd.groupBy("gram", "around").agg(F.count("*").alias("same"), F.min("row").alias("first"))
    told = crowd.join(counted_crowd, ["gram", "around"])
    each = told.where(F.col("row") == F.col("first")).groupBy("gram", "around", "row", "same").agg(F.min("at").alias("at"))
    kinds = each.groupBy("gram").agg(F.count("*").alias("kinds")).where(F.col("kinds") > 1)
    differing = texts.checkpointed(lone.unionAll(each.join(kinds, "gram").select(*chosen_columns)))
    # Surroundings that occur twice repeat throughout.
    whole = (
        apart.select("row", "at", "same")
        .unionAll(told.select("row", "at", "same"))
        .where(F.col("same") > 1)
        .select("row", (F.col("at") - (size - gram)).alias("low"), (F.col("at") + size).alias("high"))
    )
    shards = 1 + differing.count() * (2 * size - gram) // SHARD_BYTES
    chosen = differing.groupBy("row").agg(F.collect_list(F.struct("gram", "at", "same", "kinds")).alias("chosen"))
    around = rows.join(chosen, "row").mapInArrow(
        _cut_out(size, gram),
        "gram long, row long, at long, same long, kinds long, low long, first long, last long, held binary",
    )
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards))
    around = texts.checkpointed(around.withColumn("shard", F.when(F.col("kinds") <= SHARD_SURROUNDINGS, shard)))
    dealt = around.where(F.col("shard").isNotNull()).select("shard", "row", "same", "low", "first", "last", "held")
    sorted_spans = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _sort_shards(size), "row long, low long, high long"
    )
    # Blocks of strings that repeat as a whole are settled by one row; of others, and of one
    # of each that repeats, single strings are counted.
    blocks = texts.checkpointed(
        around.where(F.col("shard").isNull())
        .select("row", "at", "same", "low", "first", "last", "held")
        .mapInArrow(_blocks(size), "block long, row long, low long, n long, same long, held binary")
    )
    repeated = blocks.groupBy("block").agg(F.count("*").alias("times"), F.min("row").alias("least"))
    settled = blocks.join(repeated, "block")
    whole_blocks = settled.where((F.col("times") > 1) & (F.col("same") == 1)).select(
        "row", "low", (F.col("low") + F.col("n") - 1 + size).alias("high")
    )
    rest = settled.where((F.col("times") == 1) | (F.col("row") == F.col("least"))).select(
        "row", "low", F.lit(0).cast("long").alias("first"), (F.col("n") - 1).alias("last"),
        F.when(F.col("times") == 1, F.col("same")).otherwise(2).cast("long").alias("same"), "held",
    )
    strings = rest.mapInArrow(_strings(size), "string long, n long, places binary")
    often = strings.groupBy("string").agg(F.sum("n").alias("times")).where(F.col("times") > 1).select("string")
    counted = strings.join(often, "string").select("places").mapInArrow(_places(size), "row long, low long, high long")
    return whole.unionAll(sorted_spans).unionAll(whole_blocks).unionAll(counted)


_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
     ("spans", pa.list_(pa.int64())), ("kept", pa.binary())]
)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts.runs(batches):
        data, offsets = texts.flat(batch.column("text"))
        found = batch.column("found")
        counts = np.diff(found.offsets.to_numpy()) * found.is_valid().to_numpy(zero_copy_only=False)
        fields = found.flatten()
        owner = np.repeat(np.arange(batch.num_rows), counts)
        low = np.maximum(fields.field("low").to_numpy(zero_copy_only=False) + offsets[owner], offsets[owner])
        high = np.minimum(fields.field("high").to_numpy(zero_copy_only=False) + offsets[owner], offsets[owner + 1])
        depth = np.bincount(low, minlength=len(data) + 1) - np.bincount(high, minlength=len(data) + 1)
        gone = np.cumsum(depth)[: len(data)] > 0
        starts, ends, bounds = texts.spans(gone, offsets)
        first = offsets[np.repeat(np.arange(batch.num_rows), np.diff(bounds))]
        pairs = np.stack([starts - first, ends - first], axis=1).ravel()
        kept = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        left = data[~gone].tobytes()
        yield texts.rows(
            _KEPT,
            doc_id=batch.column("doc_id"),
            n_bytes=np.diff(offsets),
            n_removed=np.diff(offsets) - np.diff(kept),
            n_spans=np.diff(bounds),
            spans=pa.ListArray.from_arrays((2 * bounds).astype(np.int32), pa.array(pairs, pa.int64())).cast(_KEPT.field("spans").type),
            kept=pa.array([left[a:b] for a, b in zip(kept[:-1], kept[1:])], pa.binary()),
        )


def remove_repeats(documents: DataFrame, size: int = 200, gram: int = GRAM) -> DataFrame:
    """Documents without the bytes that a string of `size` bytes starting elsewhere too covers.

    Texts are UTF-8 bytes; strings do not cross documents, may overlap, and are judged on
    the input, not on what is left. Returns doc_id, n_bytes, n_removed, n_spans, spans
    (starts and ends of maximal removed runs, one after the other) and kept (the remaining
    bytes; they need not be valid UTF-8): one row per input row.

    Null and empty texts have no bytes. Repeated rows are separate documents and repeat
    each other. Null ids are kept, extra columns ignored; an empty table gives an empty
    result. `gram` has to be less than `size`.
    """
    own = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "row", F.xxhash64("doc_id", "text")
    )
    spans = repeated_spans(own.select("row", "text"), size, gram)
    gathered = spans.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("found"))
    return own.join(gathered, "row", "left").select("doc_id", "text", "found").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary"
    )
