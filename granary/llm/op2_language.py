"""Language identification: known words first, then ever shorter character n-grams.

A word seen in training scores by its log frequency in each language. An unseen word
takes the mean over its known n-grams of the longest order of which it has any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import texts

# Whole words are order 0; then character n-grams, longest first.
ORDERS = (5, 4, 3, 2, 1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), dtype=bool, count=0x110000)


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, and where each text begins; null counts as empty."""
    lowered = [(held or b"").decode("utf-8", "replace").lower() for held in column.cast(pa.binary()).to_pylist()]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(text) for text in lowered], dtype=np.int64)])


@dataclass
class Words:
    """The distinct words of some texts."""

    total: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    of_each: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Words:
        codes, offsets = code_points(column)
        starts, ends, bounds = texts.spans(_letters()[codes], offsets)
        total = texts.prefix_sums(codes)
        hashes, first, each = np.unique(
            texts.span_hashes(total, starts, ends), return_index=True, return_inverse=True
        )
        return Words(total, starts[first], ends[first], hashes, each, bounds)

    def grams(self, order: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams of the chosen words, and the place of each one's word in `chosen`."""
        counts = np.maximum(self.ends[chosen] - self.starts[chosen] - order + 1, 0)
        word = np.repeat(np.arange(len(chosen)), counts)
        start = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts) + self.starts[chosen][word]
        return texts.span_hashes(self.total, start, start + order), word


_COUNTED = pa.schema([("order", pa.int32()), ("gram", pa.int64()), ("lang", pa.string()), ("n", pa.int64())])


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and n-grams of labelled texts, counted by language."""
    for batch in texts.runs(batches):
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        for lang in np.unique(langs):
            found = Words.of(batch.column("text").filter(pa.array(langs == lang)))
            times = np.bincount(found.of_each, minlength=len(found.hashes))
            everything = np.arange(len(found.hashes))
            counted = [(0, found.hashes, times)]
            for order in ORDERS:
                grams, word = found.grams(order, everything)
                distinct, each = np.unique(grams, return_inverse=True)
                counted.append((order, distinct, np.bincount(each, weights=times[word], minlength=len(distinct)).astype(np.int64)))
            for order, grams, n in counted:
                yield texts.rows(
                    _COUNTED,
                    order=np.full(len(grams), order, dtype=np.int32),
                    gram=grams.view(np.int64),
                    lang=pa.array([lang] * len(grams), pa.string()),
                    n=n,
                )


@dataclass
class Model:
    """Log frequencies per language of words and n-grams, by order."""

    langs: list[str]
    grams: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]

    def known(self, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        grams = self.grams[order]
        place = np.minimum(np.searchsorted(grams, hashes), max(0, len(grams) - 1))
        return (grams[place] == hashes if len(grams) else np.zeros(len(hashes), bool)), place

    def score(self, words: Words) -> np.ndarray:
        """Log score of every distinct word in every language."""
        scores = np.zeros((len(words.hashes), len(self.langs)))
        known, place = self.known(0, words.hashes)
        scores[known] = self.logs[0][place[known]]
        unseen = np.flatnonzero(~known)
        for order in ORDERS:
            if not len(unseen):
                break
            grams, word = words.grams(order, unseen)
            known, place = self.known(order, grams)
            word, place = word[known], place[known]
            hits = np.bincount(word, minlength=len(unseen))
            for k in range(len(self.langs)):
                summed = np.bincount(word, weights=self.logs[order][place, k], minlength=len(unseen))
                scores[unseen, k] = summed / np.maximum(hits, 1)
            unseen = unseen[hits == 0]
        return scores


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a document is kept from learning; those without an id always are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def fit(labelled: DataFrame, sample_docs: int = 1500) -> Model | None:
    """Learn from doc_id, text and lang: about `sample_docs` documents of each language.

    The model holds every word and n-gram of these, so that no language loses any to another;
    the sample bounds its size, which does not grow with the corpus.
    """
    labelled = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    there = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not there:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in there.items() for x in (lang, min(1.0, sample_docs / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.where(draw < F.element_at(share, F.col("lang"))).select("lang", "text")
    counted = sample.mapInArrow(count_grams, "order int, gram long, lang string, n long").groupBy("order", "gram")
    summed = texts.checkpointed(
        counted.agg(
            *[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(sorted(there))],
        )
    )
    found = summed.toPandas()
    grams, logs = {}, {}
    for order in (0, *ORDERS):
        own = found[found["order"] == order]
        hashes = own["gram"].to_numpy(dtype=np.int64).view(np.uint64)
        counts = own[[f"n{k}" for k in range(len(there))]].to_numpy(dtype=np.float64)
        at = np.argsort(hashes)
        grams[order] = hashes[at]
        logs[order] = np.log((counts[at] + 0.5) / (counts.sum(axis=0) + 0.5 * (len(at) + 1)))
    return Model(sorted(there), grams, logs)


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """Language of every whole text: doc_id, lang_pred, score; one row per input row.

    The score is the language's share of the likelihood among all learned ones. Texts
    that are null or have no letter get `und` and 0, as do all if nothing was learned;
    among languages alike in score the first by name wins. Extra columns are ignored,
    null ids are kept, and an empty table gives an empty result.
    """

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.runs(batches):
            words = Words.of(batch.column("text"))
            n = batch.num_rows
            names = np.full(n, "und", dtype=object)
            share = np.zeros(n)
            if model is not None and len(words.of_each):
                doc = np.repeat(np.arange(n), np.diff(words.bounds))
                each = model.score(words)
                sums = np.stack([np.bincount(doc, weights=each[words.of_each, k], minlength=n) for k in range(len(model.langs))], axis=1)
                likely = np.exp(sums - sums.max(axis=1, keepdims=True))
                best = likely.argmax(axis=1)
                some = np.diff(words.bounds) > 0
                names[some] = np.array(model.langs, dtype=object)[best[some]]
                share[some] = (likely.max(axis=1) / likely.sum(axis=1))[some]
            yield texts.rows(_PREDICTED, doc_id=batch.column("doc_id"), lang_pred=pa.array(names, pa.string()), score=share)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        classify, "doc_id long, lang_pred string, score double"
    )


def identify(documents: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """Learn from the documents with a language outside one part of ids; predict all."""
    hidden = held_out(F.col("doc_id"), parts, part)
    model = fit(documents.where(~hidden).select("doc_id", "text", "lang"))
    return predict(documents, model).select("doc_id", hidden.alias("held_out"), "lang_pred", "score")
