"""Byte-level BPE without merging: tokens are tried longest first, and taken back where they fail.

A sequence of tokens is what merging would give exactly if every two neighbours are: then no
merge across their border comes before the merges that built them. So an encoder walks along a
piece, takes the longest token there that goes with the last one, and steps back from places
where none does. A prefix has one valid sequence only, hence a place that failed once fails for
good, and the work is linear in the piece.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from granary.llm import texts

# Pieces whose ids a worker remembers at most, and the longest of them in bytes.
REMEMBERED = 400_000
REMEMBERED_BYTES = 48
# Characters below are split by the pattern here, texts with others by the library's splitter.
PLAIN = 0x500
NEVER = 1 << 62


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if it prints, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(byte if byte in shown else next(rest)) for byte in range(256)]


class Pair:
    """Which tokens may stand next to each other; answers are kept."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        """merges: left, right and whole, in the order they apply."""
        self.rank = {(left, right): rank for rank, (left, right, _) in enumerate(merges)}
        self.made = {whole: (rank, left, right) for rank, (left, right, whole) in enumerate(merges)}
        self.known: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int, int]]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Tokens that stand at one end (1 left, 2 right) while `token` is built: each with the ranks of the merges it comes from and goes into."""
        found = self.edges.get((token, side))
        if found is None:
            found, at, until = [], token, NEVER
            while at in self.made:
                since = self.made[at][0]
                found.append((at, since, until))
                at, until = self.made[at][side], since
            found.append((at, -1, until))
            self.edges[token, side] = found
        return found

    def across(self, first: int, second: int) -> int:
        """Rank of the first merge across the border of two tokens, while both its tokens are there.

        Of equal merges the one further left comes first.
        """
        found = NEVER
        for a, since_a, until_a in self.edge(first, 2):
            for b, since_b, until_b in self.edge(second, 1):
                rank = self.rank.get((a, b), NEVER)
                if rank < found and since_a < rank < until_a and since_b < rank <= until_b:
                    found = rank
        return found

    def fits(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both gives both."""
        found = self.known.get((first, second))
        if found is None:
            if len(self.known) >= 2 * REMEMBERED:
                self.known.clear()
            found = self.known[first, second] = self.across(first, second) == NEVER
        return found


class Bpe(dict):
    """Encodes and decodes with the vocabulary of a byte-level BPE file of the tokenizers library.

    As a dict it remembers pieces (text between two cuts of the splitter) and their ids, as bytes
    of little-endian 32-bit numbers.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, cut = held["model"], held["pre_tokenizer"] or {}
        plain = model.get("type") in (None, "BPE") and not any(
            model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        if not plain or held["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE: {path}")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in held["added_tokens"]):
            raise ValueError(f"added tokens that take in their surroundings: {path}")
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        bytes_of = {token: bytes(byte_of[c] for c in word) for word, token in model["vocab"].items()}
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pair = Pair([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges])
        self.single = {data: token for token, data in bytes_of.items() if len(data) == 1}

        # Only tokens that their own bytes merge to can be in a result.
        sound = set(self.single.values())
        for token, (rank, left, right) in self.pair.made.items():
            if left in sound and right in sound and self.pair.across(left, right) == rank:
                sound.add(token)
        self.token = {data: token for token, data in bytes_of.items() if token in sound}
        self.size = {t: len(data) for data, t in self.token.items()}
        self.shorter = {}
        for data, token in self.token.items():
            self.shorter[token] = next((self.token[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.token), None)
        self.automaton = ahocorasick.Automaton()
        for data, token in self.token.items():
            self.automaton.add_word(data.decode("latin-1"), (len(data), token))
        self.automaton.make_automaton()

        self.added = {t["content"]: t["id"] for t in held["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self._splitter(path)

        # The offset table: bytes of all ids one after the other, and where each begins.
        everything = bytes_of | {token: content.encode() for content, token in self.added.items()}
        last = max(everything, default=-1) + 1
        self.offsets = np.zeros(last + 1, dtype=np.int64)
        np.cumsum([len(everything.get(token, b"")) for token in range(last)], out=self.offsets[1:])
        self.held = np.frombuffer(b"".join(everything.get(token, b"") for token in range(last)), dtype=np.uint8)

    def _splitter(self, path: str) -> None:
        """The library's splitter, and its pattern over the letters, digits and blanks that it knows below `PLAIN`.

        Kinds are asked of the library, whose Unicode tables differ from Python's: a letter sticks
        to a letter, a digit to a digit, a sign to a sign, a blank to nothing.
        """
        self.library = Tokenizer.from_file(path).pre_tokenizer
        whole = lambda text: len(self.library.pre_tokenize_str(text)) == 1
        kinds = {"letter": "", "digit": "", "blank": ""}
        for c in map(chr, range(PLAIN)):
            kind = next((k for k, known in (("letter", "a"), ("digit", "1"), ("sign", "!")) if whole(known + c)), "blank")
            if kind != "sign":
                kinds[kind] += re.escape(c)
        letter, digit, blank = kinds["letter"], kinds["digit"], kinds["blank"]
        # Fixed value: the pattern of the tokenizer, over these kinds.
        self.cut = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{blank}{letter}{digit}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
        ).findall
        self.beyond = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]").search

    def pieces(self, text: str) -> list[str]:
        if self.beyond(text) is None:
            return self.cut(text)
        return [text[low:high] for _, (low, high) in self.library.pre_tokenize_str(text)]

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        token = self.token.get(data)
        found = np.array([token] if token is not None else self.tokens(data), dtype="<i4").tobytes()
        if len(data) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = found
        return found

    def tokens(self, data: bytes) -> list[int]:
        """Tokens of a piece, by trying the longest match of each place first."""
        longest = [0] * len(data)
        width = [0] * len(data)
        for end, (size, token) in self.automaton.iter(data.decode("latin-1")):
            start = end - size + 1
            if size > width[start]:
                width[start], longest[start] = size, token
        fits, size_of, shorter = self.pair.fits, self.size, self.shorter
        failed = bytearray(len(data) + 1)
        found: list[int] = []
        place, token = 0, longest[0] if data else None
        while place < len(data):
            while token is not None:
                end = place + size_of[token]
                if not failed[end] and (not found or fits(found[-1], token)):
                    break
                token = shorter[token]
            if token is not None:
                found.append(token)
                place = end
                token = longest[place] if place < len(data) else None
            else:
                failed[place] = 1
                token = found.pop()
                place -= size_of[token]
                token = shorter[token]
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as bytes of little-endian 32-bit numbers."""
        if self.special is None or self.special.search(text) is None:
            return b"".join(map(self.__getitem__, self.pieces(text)))
        parts = self.special.split(text)  # text and added tokens in turn
        return b"".join(
            np.array([self.added[part]], dtype="<i4").tobytes() if k % 2 else b"".join(map(self.__getitem__, self.pieces(part)))
            for k, part in enumerate(parts)
        )

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, gathered by the offset table, and where those of each id begin."""
        ids = np.where((ids >= 0) & (ids < len(self.offsets) - 1), ids, -1)
        starts = np.where(ids < 0, 0, self.offsets[ids])
        sizes = np.where(ids < 0, 0, self.offsets[ids + 1] - self.offsets[ids])
        return self.held[texts.ranges(starts, sizes)], np.concatenate([[0], np.cumsum(sizes)])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Bpe:
    """The vocabulary of a file, read once by each worker."""
    return Bpe(path)


def _text(value: bytes | str | None) -> str:
    return "" if value is None else value if isinstance(value, str) else value.decode("utf-8", "replace")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, as the tokenizers library gives them.

    No special tokens are added; those that a text spells out are recognised. Null and empty
    texts have no ids. Rows keep their doc_id, null or repeated, and each is encoded by itself;
    an empty table gives no rows. A very long text is encoded by one task as a whole. Other
    columns are left behind, so their names cannot clash. `path` is read by every worker.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in texts.runs(batches):
            found = [bpe.encode(_text(text)) for text in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, found)]) // 4
            ids = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encoded, f"doc_id {kind}, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the text that ids stand for; bytes that are no UTF-8 show as U+FFFD.

    Ids that the vocabulary lacks, and nulls, stand for nothing; so do null and empty lists.
    Each row is decoded by itself; an empty table gives no rows, and other columns are left behind.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            # Runs of rows with about as many ids as a run of text may have bytes.
            sizes = np.array([0 if n is None else n for n in batch.column("ids").value_lengths().to_pylist()], dtype=np.int64)
            ends = np.cumsum(sizes)
            cuts = [0, *(np.flatnonzero(np.diff(ends // texts.RUN_BYTES)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if high == low:
                    continue
                part = batch.slice(low, high - low)
                ids = part.column("ids").flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                data, places = bpe.decode(ids)
                bounds = places[np.concatenate([[0], np.cumsum(sizes[low:high])])]
                data = data.tobytes()
                found = [data[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(found, pa.string())], names=["doc_id", "ids", "text"]
                )

    return rows.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(decoded, f"doc_id {kind}, ids array<int>, text string")
