"""Best-fit packing of token pieces into sequences, by hashed exact complements.

Packing needs only how many pieces there are of each length: at most as many numbers
as a sequence has tokens. Over that histogram, a plan lists which lengths share a
sequence and how often. Ranks of pieces among those of their length then say which
sequence each goes to, without any task that sees all pieces.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from granary.llm import texts

# Pieces of one length are ranked in so many parts, each by its own task.
PARTS = 64
# Strings between white space whose ids a worker remembers at most.
REMEMBERED = 1_500_000
# Bytes of text encoded at a time; more of them share more words.
ENCODED_BYTES = 1 << 20


_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[code for code in range(33, 127) if not chr(code).isalnum() and chr(code) != "'"]] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def separated(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts lower-cased in ASCII, with a blank wherever ASCII letters and punctuation meet.

    The apostrophe does not count, as it may begin an ending of its own.
    """
    letter, sign = _ASCII_LETTER[data], _PUNCTUATION[data]
    meets = np.flatnonzero((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])) + 1
    return np.insert(texts.LOWER[data], meets, 32), offsets + np.searchsorted(meets, offsets)


class Encoder:
    """Ids of whole texts, as bytes of little-endian 32-bit numbers.

    It serves tokenizers that lower-case, and split at white space, which they drop, and
    between letters and other signs: the ids of a text are then those of its strings one
    after the other. Each distinct string is encoded once and remembered by its hash.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Hashes of known strings in ascending order, and where their ids stand in `flat`.
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.flat, self.used = np.zeros(1 << 16, dtype="<u4"), 0
        self.room = remembered
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # A word's last id is one that stands at word ends only.
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[place for token, place in vocabulary.items() if token.endswith("</w>")]] = True
        # Lower-case ASCII words pass normalizing and splitting as they are, so the bare model serves them.
        bare = json.loads(self.tokenizer.to_str())
        bare |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        trial = sorted(token[:-4].encode() for token in vocabulary if token.endswith("</w>") and token[:-4].isascii() and token[:-4].islower() and token[:-4].isalpha())
        trial = [a + b for a, b in zip(trial[:500], reversed(trial))]
        if self._ids(self.bare, trial).tolist() != self._ids(self.tokenizer, trial).tolist():
            self.bare = self.tokenizer

    @staticmethod
    def _ids(tokenizer: Tokenizer, words: list[bytes]) -> np.ndarray:
        lines = [b" ".join(words[at : at + 100]).decode() for at in range(0, len(words), 100)]
        encoded = tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        return np.array([i for line in encoded for i in line.ids], dtype="<u4")

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode(self, strings: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct strings; plain words are encoded many at a time."""
        found: dict[bytes, bytes] = {}
        ascii_words, rest = [], []
        for string in strings:
            (ascii_words if string.isalpha() else rest).append(string)
        other_words = [string for string in rest if string.decode("utf-8", "replace").isalpha()]
        for tokenizer, plain in ((self.bare, ascii_words), (self.tokenizer, other_words)):
            ids = self._ids(tokenizer, plain)
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(plain):
                held = ids.tobytes()
                found |= {string: held[a:b] for string, a, b in zip(plain, [0, *cuts], cuts)}
        for string in rest if len(found) == len(ascii_words) + len(other_words) else strings:
            if string not in found:
                found[string] = self._whole(string)
        return found

    def _learn(self, hashes: np.ndarray, strings: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode new strings; where their ids begin and how many they are.

        They are remembered while there is room, else their ids are overwritten next time.
        """
        fresh = self._encode(strings)
        ids = np.frombuffer(b"".join(map(fresh.__getitem__, strings)), dtype="<u4")
        length = np.array([len(fresh[string]) for string in strings], dtype=np.int64) // 4
        begin = self.used + np.cumsum(length) - length
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(ids), dtype="<u4")])
        self.flat[self.used : self.used + len(ids)] = ids
        if len(self.hashes) + len(hashes) <= self.room:
            self.used += len(ids)
            self.hashes = np.insert(self.hashes, at, hashes)
            self.begin = np.insert(self.begin, at, begin)
            self.length = np.insert(self.length, at, length)
        return begin, length

    def encode_all(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of each text; null counts as empty."""
        data, offsets = texts.flat(column)
        held, bounds = separated(data, offsets)
        starts, ends, first = texts.spans(~texts.SPACE[held], bounds)
        hashes = texts.whole_hashes(texts.prefix_sums(held), starts, ends)
        order = np.argsort(hashes)
        new = np.ones(len(order), dtype=bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        each = np.empty(len(order), dtype=np.int64)
        each[order] = np.cumsum(new) - 1
        example = order[new]
        distinct = hashes[example]
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        begin, length = np.zeros(len(distinct), dtype=np.int64), np.zeros(len(distinct), dtype=np.int64)
        begin[known], length[known] = self.begin[at[known]], self.length[at[known]]
        missing = np.flatnonzero(~known)
        if len(missing):
            raw = held.tobytes()
            spans = zip(starts[example[missing]].tolist(), ends[example[missing]].tolist())
            begin[missing], length[missing] = self._learn(distinct[missing], [raw[a:b] for a, b in spans], at[missing])
        counts = length[each]
        ids = self.flat[texts.ranges(begin[each], counts)].tobytes()
        edges = (4 * np.concatenate([[0], np.cumsum(counts)])[first]).tolist()
        raw = data.tobytes()
        special = [token for token in self.special if token in raw]
        for k, (low, high) in enumerate(zip(edges, edges[1:])):
            text = raw[offsets[k] : offsets[k + 1]] if special else b""
            yield self._whole(text) if any(token in text for token in special) else ids[low:high]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def cut(documents: DataFrame, path: str, capacity: int) -> DataFrame:
    """Pieces of the token sequence of every whole text: its ids, then id 0."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        width = 4 * capacity
        for batch in texts.runs(batches, size=ENCODED_BYTES):
            found: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.encode_all(batch.column("text"))):
                ids += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    found.append((doc_id, k, k * capacity, len(part) // 4, zlib.crc32(part)))
            yield texts.rows(_PIECES, **{name: list(values) for name, values in zip(_PIECES.names, zip(*found))})

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


class Packing:
    """Patterns of lengths that share a sequence, each with the number of such sequences."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in histogram.items():
            self.left[length] += n
        self.patterns: list[tuple[tuple[int, ...], int]] = []

    def _use(self, pattern: tuple[int, ...]) -> None:
        times = min(int(self.left[length]) // n for length, n in Counter(pattern).items())
        if times > 0:
            for length in pattern:
                self.left[length] -= times
            self.patterns.append((pattern, times))

    def _pairs(self, gap: int, most: int) -> np.ndarray:
        """First lengths of pairs that sum to the gap, the longer one first and at most `most`."""
        high = np.arange(min(gap - 1, most), (gap + 1) // 2 - 1, -1)
        return high[(self.left[high] > 0) & (self.left[gap - high] > 0)] if len(high) else high

    def fill_exactly(self) -> None:
        """From the longest length down, fill the gap beside it by one, two or three lengths."""
        self._use((self.capacity,))
        for length in range(self.capacity - 1, 0, -1):
            gap = self.capacity - length
            if self.left[length] and gap <= length and self.left[gap]:
                self._use((length, gap))
            for high in self._pairs(gap, length) if self.left[length] else ():
                if not self.left[length]:
                    break
                self._use((length, int(high), gap - int(high)))
            for first in range(min(gap - 2, length), (gap + 2) // 3 - 1, -1):
                if not self.left[length]:
                    break
                if self.left[first]:
                    for second in self._pairs(gap - first, first):
                        self._use((length, first, int(second), gap - first - int(second)))
                        if not self.left[length] or not self.left[first]:
                            break

    def fit_rest(self) -> None:
        """Put what is left, longest first, where the smallest gap that holds it remains."""
        open_bins: dict[int, list[list]] = defaultdict(list)
        gaps = np.zeros(self.capacity + 1, dtype=bool)
        for length in range(self.capacity, 0, -1):
            n = int(self.left[length])
            while n:
                fitting = np.flatnonzero(gaps[length:])
                if not len(fitting):
                    each = self.capacity // length
                    for bins, held in ((n // each, each), (1, n % each)):
                        if bins and held:
                            gap = self.capacity - held * length
                            open_bins[gap].append([(length,) * held, bins])
                            gaps[gap] = True
                    n = 0
                    break
                gap = length + int(fitting[0])
                pattern, bins = open_bins[gap].pop()
                moved = min(n, bins)
                if bins > moved:
                    open_bins[gap].append([pattern, bins - moved])
                gaps[gap] = bool(open_bins[gap])
                open_bins[gap - length].append([(*pattern, length), moved])
                gaps[gap - length] = True
                n -= moved
            self.left[length] = 0
        self.patterns += [(pattern, bins) for held in open_bins.values() for pattern, bins in held]

    def plan(self) -> dict[str, np.ndarray]:
        """For each length, stretches of ranks, and where the first of each stretch goes."""
        used = np.zeros(self.capacity + 1, dtype=np.int64)
        found, base = [], 0
        for pattern, times in self.patterns:
            offset = 0
            for length in pattern:
                found.append((length, used[length], base, offset))
                used[length] += times
                offset += length
            base += times
        columns = np.array(sorted(found), dtype=np.int64).reshape(-1, 4)
        return {"key": (columns[:, 0] << 44) | columns[:, 1], "rank": columns[:, 1], "base": columns[:, 2], "offset": columns[:, 3]}


def pack(documents: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Place every document's tokens in sequences of at most `capacity` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A
    document with null or empty text is one piece of the closing id 0. Repeated rows
    are packed each for itself; pieces alike in all columns may change places. Null ids
    are kept, extra columns ignored, and an empty table gives an empty result.
    """
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PARTS)).cast("int")
    pieces = texts.checkpointed(cut(documents, tokenizer, capacity).withColumn("part", part))
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {row["length"]: row["n"] for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    packing = Packing(histogram, capacity)
    packing.fill_exactly()
    packing.fit_rest()
    plan = packing.plan()
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "part").orderBy(F.col("doc_id").asc_nulls_last(), "piece", "ids_crc32")
    ranked = pieces.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.row_number().over(own) - 1)
    schema = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(plan["key"], (length << 44) | rank, side="right") - 1
            yield texts.rows(
                schema,
                **{name: batch.column(name) for name in _PIECES.names},
                sequence_id=plan["base"][at] + rank - plan["rank"][at],
                offset=plan["offset"][at],
            )

    return ranked.select(*_PIECES.names, "rank").mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
