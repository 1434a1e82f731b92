"""Toxicity by a classifier chain: each category's model sees the earlier categories' chances.

Features are the presence of tokens (runs of letters, and runs of signs), all of them that the
sampled documents hold. A token counts the more the clearer it goes with a category, so that rare
ones have their say and the many that go with nothing add little noise. Later models learn from
chances that models fitted without the row at hand gave for the earlier categories.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import texts
from granary.llm.op2_language import held_out

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SIGN = ~(_LETTER | texts.SPACE)
_SIGN[48:58] = False


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct token hashes of every text, and the text of each, in the order of texts."""
    data, offsets = texts.flat(column)
    total = texts.prefix_sums(texts.LOWER[data])
    owners, hashes = [], []
    for mask in (_LETTER, _SIGN):
        starts, ends, bounds = texts.spans(mask[data], offsets)
        hashes.append(texts.span_hashes(total, starts, ends))
        owners.append(np.repeat(np.arange(len(offsets) - 1), np.diff(bounds)))
    owner, held = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((held, owner))
    owner, held = owner[order], held[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (held[1:] != held[:-1])
    return held[new], owner[new]


@dataclass
class Rows:
    """Which tokens each row holds, by number, one row after the other."""

    column: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """The weights of each row's tokens added up."""
        return np.bincount(np.repeat(np.arange(len(self)), np.diff(self.bounds)), weights=weights[self.column], minlength=len(self))

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        """The values of the rows added up by token."""
        return np.bincount(self.column, weights=np.repeat(values, np.diff(self.bounds)), minlength=width)

    def some(self, chosen: np.ndarray) -> Rows:
        counts = np.diff(self.bounds)
        return Rows(self.column[np.repeat(chosen, counts)], np.concatenate([[0], np.cumsum(counts[chosen])]))


@dataclass
class Chain:
    """Tokens, and per category their weights, those of earlier chances and a last one for all."""

    categories: list[str]
    tokens: np.ndarray
    weights: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def rows(self, held: np.ndarray, owner: np.ndarray, count: int) -> Rows:
        """The known tokens of some texts."""
        place = np.minimum(np.searchsorted(self.tokens, held), max(0, len(self.tokens) - 1))
        known = self.tokens[place] == held if len(self.tokens) else np.zeros(len(held), dtype=bool)
        return Rows(place[known], np.concatenate([[0], np.cumsum(np.bincount(owner[known], minlength=count))]))

    def chances(self, rows: Rows) -> np.ndarray:
        earlier = np.zeros((len(rows), 0))
        for of_tokens, others in self.weights:
            earlier = np.hstack([earlier, chance(rows.sums(of_tokens), earlier, others)[:, None]])
        return earlier


def chance(sums: np.ndarray, earlier: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Chances of a category, without the last digits, which depend on the order of sums."""
    return np.round(1 / (1 + np.exp(-np.clip(sums + earlier @ others[:-1] + others[-1], -30, 30))), 9)


def clarity(rows: Rows, label: np.ndarray, width: int, least: float) -> np.ndarray:
    """How clearly each token goes with a label: its chi-square, as a share of `least`, 1 at most."""
    n, positive = len(label), float(label.sum())
    if not 0 < positive < n:
        return np.zeros(width)
    held, having = rows.back(np.ones(n), width), rows.back(label, width)
    gap = having * n - held * positive
    held = np.maximum(held, 1)  # a token that only rows left out hold has no gap
    return np.minimum(1.0, gap * gap * n / (held * (n - held + 0.5) * positive * (n - positive)) / least)


def logistic(
    rows: Rows, scale: np.ndarray, earlier: np.ndarray, label: np.ndarray, ridge: float = 1.0, steps: int = 80
) -> np.ndarray:
    """Weights of a logistic model on scaled tokens with a squared penalty: tokens, earlier chances, one for all.

    Steps are those of a quasi-Newton method that remembers the last eight.
    """
    width = len(scale)
    penalty = np.full(width + earlier.shape[1] + 1, ridge)
    penalty[-1] = 1e-6

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.clip(rows.sums(scale * w[:width]) + earlier @ w[width:-1] + w[-1], -30, 30)
        miss = 1 / (1 + np.exp(-z)) - label
        slope = np.concatenate([scale * rows.back(miss, width), earlier.T @ miss, [miss.sum()]]) + penalty * w
        return float(np.logaddexp(0, z).sum() - label @ z + 0.5 * (penalty * w) @ w), slope

    w = np.zeros(len(penalty))
    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, shares = slope.copy(), []
        for moved, turned, product in reversed(past):
            shares.append(moved @ way / product)
            way -= shares[-1] * turned
        way *= past[-1][2] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(slope).max())
        for (moved, turned, product), share in zip(past, reversed(shares)):
            way += moved * (share - turned @ way / product)
        length, fall = 1.0, slope @ way
        after, turned_slope = loss(w - way)
        while after > value - 1e-4 * length * fall and length > 1e-6:
            length /= 2
            after, turned_slope = loss(w - length * way)
        moved, turned = -length * way, turned_slope - slope
        if moved @ turned > 1e-12:
            past = [*past, (moved, turned, moved @ turned)][-8:]
        small = abs(value - after) < 1e-5 * max(1.0, abs(value))
        w, value, slope = w + moved, after, turned_slope
        if small:
            break
    return w


def fit_chain(chain: Chain, rows: Rows, labels: np.ndarray, least: float, folds: int = 5, seed: int = 4) -> Chain:
    """Fit the models in turn; later ones learn from out-of-fold chances of earlier ones."""
    fold = np.random.default_rng(seed).permutation(len(rows)) % folds
    earlier, width = np.zeros((len(rows), 0)), len(chain.tokens)
    for label in labels.T:
        scale = clarity(rows, label, width, least)
        whole = logistic(rows, scale, earlier, label)
        outside = np.zeros(len(rows))
        for k in range(folds):
            train, test = fold != k, fold == k
            if not (train.any() and test.any()):
                continue
            part = rows.some(train)
            # Nothing of the rows left out is known, not even how clear tokens are.
            own = clarity(part, label[train], width, least)
            w = logistic(part, own, earlier[train], label[train])
            outside[test] = chance(rows.some(test).sums(own * w[:width]), earlier[test], w[width:])
        chain.weights.append((scale * whole[:width], whole[width:]))
        earlier = np.hstack([earlier, outside[:, None]])
    return chain


_HELD = pa.schema([("doc_id", pa.int64()), ("kind", pa.int32()), ("tokens", pa.binary())])


def held_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct tokens of every text."""
    for batch in texts.runs(batches):
        held, owner = tokens(batch.column("text"))
        cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        packed = [held[low:high].tobytes() for low, high in zip(cuts, cuts[1:])]
        yield texts.rows(_HELD, doc_id=batch.column("doc_id"), kind=batch.column("kind"), tokens=pa.array(packed, pa.binary()))


def fit(
    documents: DataFrame, labels: DataFrame, categories: Sequence[str], sample_docs: int = 12_000, least: float = 30.0
) -> Chain | None:
    """Learn from doc_id and text, and doc_id and a 0/1 column per category, on about `sample_docs` labels.

    The sampled labels go to the documents, not the other way round: their number is bounded, and
    so is what is broadcast. Each teaches once, by the first of its texts if a doc_id repeats, so
    the driver gets the tokens of as many texts at most. No token is left out; one whose
    chi-square with a category is under `least` counts by its share of that.
    """
    n = labels.count()
    if not n:
        return None
    kind = sum((F.col(name).cast("int") * (1 << k) for k, name in enumerate(categories)), F.lit(0))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = labels.where(draw < min(1.0, sample_docs / n)).select("doc_id", kind.alias("kind"))
    sample = documents.select("doc_id", "text").join(F.broadcast(texts.checkpointed(sampled)), "doc_id")
    sample = sample.groupBy("doc_id", "kind").agg(F.min("text").alias("text"))
    seen = sample.mapInArrow(held_tokens, "doc_id long, kind int, tokens binary").toPandas().sort_values(["doc_id", "kind"])
    if seen.empty:
        return None
    held = np.frombuffer(b"".join(map(bytes, seen["tokens"])), dtype=np.uint64)
    counts = seen["tokens"].map(len).to_numpy() // 8
    kinds = seen["kind"].to_numpy()
    del seen
    known, column = np.unique(held, return_inverse=True)
    del held
    rows = Rows(column, np.concatenate([[0], np.cumsum(counts)]))
    label = np.stack([(kinds >> k & 1).astype(float) for k in range(len(categories))], axis=1)
    return fit_chain(Chain(list(categories), known), rows, label, least)


def predict(documents: DataFrame, chain: Chain | None, categories: Sequence[str]) -> DataFrame:
    """doc_id and one chance per category for every whole text, one row per input row.

    Null and empty texts hold no token. With nothing learned all chances are 0. Repeated
    rows score alike, null ids are kept, and extra columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), *[(f"p_{name}", pa.float64()) for name in categories]])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.runs(batches):
            if chain is None:
                found = np.zeros((batch.num_rows, len(categories)))
            else:
                found = chain.chances(chain.rows(*tokens(batch.column("text")), batch.num_rows))
            columns = {f"p_{name}": np.ascontiguousarray(found[:, k]) for k, name in enumerate(categories)}
            yield texts.rows(schema, doc_id=batch.column("doc_id"), **columns)

    ddl = ", ".join(["doc_id long", *[f"p_{name} double" for name in categories]])
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(apply, ddl)


def assess(documents: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, least: float = 0.1) -> DataFrame:
    """Chances of the categories of `labels`, junk first and toxic after it, for all documents.

    Learns from labelled documents outside one part of ids. The label table names two
    categories, low quality and toxic, so the chain has two links. Returns doc_id,
    held_out, p_junk, score (of toxic), predicted; null and empty texts hold no token, an empty
    table gives no rows, a very long text is judged by one task as a whole, and further columns
    do not matter. Labels repeated for a document count
    once, as the worst of them; rows with a null label do not teach. A document is
    predicted toxic from `least` on, which is about the share of toxic documents.
    """
    categories = ("junk", "toxic")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    worst = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(1 - F.col("quality")).alias("junk"), F.max("toxic").alias("toxic")
    )
    hidden = held_out(F.col("doc_id"), parts, part)
    chain = fit(documents.select(F.col("doc_id").cast("long"), "text"), worst.where(~hidden), categories)
    return predict(documents, chain, categories).select(
        "doc_id",
        hidden.alias("held_out"),
        "p_junk",
        F.col("p_toxic").alias("score"),
        (F.col("p_toxic") >= least).cast("int").alias("predicted"),
    )
