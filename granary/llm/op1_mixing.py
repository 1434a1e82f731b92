"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a word budget. Whole epochs of a source come first; what is left
of its budget goes to documents in the order of exponential keys, scaled by their
quality weights, until the running sum of sizes is nearest the budget.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import texts

# Ranges of keys per source. Documents of one source are ranked range by range, so
# that a source with a third of all rows is sorted by many tasks.
KEY_RANGES = 4096

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MEASURED = pa.schema(
    [("doc_id", pa.int64()), ("source", pa.string()), ("row", pa.int64()), ("size", pa.int64()), ("weight", pa.float64()), ("draw", pa.int64())]
)


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, quality weight and draw of each document.

    The weight is the share of letters among bytes that are not white space, at least
    0.1. The draw depends on doc_id and text alone, so reruns agree.
    """
    for batch in texts.runs(batches):
        data, offsets = texts.flat(batch.column("text"))
        solid = ~texts.SPACE[data]
        _, _, bounds = texts.spans(solid, offsets)
        total = texts.prefix_sums(data)
        count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
        letters, visible = count(_LETTER[data]), count(solid)
        ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        draw = texts.mix(texts.span_hashes(total, offsets[:-1], offsets[1:]) + texts.mix(ids.view(np.uint64)))
        yield texts.rows(
            _MEASURED,
            doc_id=batch.column("doc_id"),
            source=batch.column("source"),
            row=batch.column("row"),
            size=np.diff(bounds),
            weight=np.maximum(0.1, letters / np.maximum(visible, 1)),
            draw=draw.view(np.int64),
        )


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Budgets of sources: `share` of all words by weight, at most `most` times a source's words.

    What a capped source cannot take is shared again by weight until none is above its
    cap: sources are capped in the order of cap per weight, up to the first whose share
    of the rest fits. Sources by code point, null last, get the weights in turn.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ratio = F.col("cap") / F.col("weight")
    upward = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    ordered = (
        sizes.select("source", "source_size")
        .withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", ratio)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("before", F.coalesce(F.sum("cap").over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", (F.col("all_words") * F.lit(float(share)) - F.col("before")) / (F.col("all_weight") - F.col("weight_before")))
        .withColumn("fits", F.col("level") < F.col("ratio"))
    )
    level = F.min(F.when(F.col("fits"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(everything)["level"]
    return ordered.withColumn("line", level).select(
        "source",
        "source_size",
        F.when(F.col("ratio") <= F.coalesce("line", F.lit(float("inf"))), F.col("cap"))
        .otherwise(F.least("cap", F.col("line") * F.col("weight")))
        .alias("target"),
    )


def same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def row_key() -> Column:
    return F.xxhash64("doc_id", "source", "text")


def mix_sources(
    documents: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """What the mix takes of each document: one row per input row.

    Columns: doc_id, source, row (a hash of doc_id, source and text), size, weight,
    source_size, target, epochs, taken. `taken` is `epochs * size`, plus `size` if the document is among those that fill the rest
    of its source's budget. Null and empty texts have size 0 and take 0. A null source
    is a source of its own, the last. Repeated rows are documents of their own; among
    rows alike in all columns it does not matter which is taken. An empty table gives
    an empty result. Extra columns are ignored. Rows with null doc_id keep it.
    """
    schema = "doc_id long, source string, row long, size long, weight double, draw long"
    own = documents.select(F.col("doc_id").cast("long"), "source", "text", row_key().alias("row"))
    measured = own.mapInArrow(measure, schema)
    uniform = (F.shiftrightunsigned("draw", 11).cast("double") + 0.5) / F.lit(float(2**53))
    key = -F.log(uniform) / F.col("weight")
    keyed = texts.checkpointed(
        measured.withColumn("key", key).withColumn(
            "range", F.floor(F.col("key") / (F.col("key") + 1) * KEY_RANGES).cast("int")
        )
    )
    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("inside"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("inside").alias("source_size")), weights, share, most)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("before", F.coalesce(F.sum("inside").over(before), F.lit(0)))
    starts = (
        starts.alias("s")
        .join(targets.alias("t"), same_source("s", "t"))
        .select("s.source", "s.range", "s.before", "t.source_size", "t.target")
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    joined = keyed.alias("k").join(starts.alias("s"), same_source("k", "s") & (F.col("k.range") == F.col("s.range")))
    running = Window.partitionBy("k.source", "k.range").orderBy("key", F.col("doc_id").asc_nulls_last(), "draw", "size")
    after = F.col("before") + F.sum("size").over(running.rowsBetween(Window.unboundedPreceding, 0))
    fills = (after - F.col("size") < F.col("rest")) & (2 * after - F.col("size") <= 2 * F.col("rest"))
    return joined.select(
        "doc_id",
        "k.source",
        "row",
        "size",
        "weight",
        "source_size",
        "target",
        F.col("epochs").cast("int").alias("epochs"),
        (F.col("epochs") * F.col("size") + F.when(fills, F.col("size")).otherwise(0)).cast("long").alias("taken"),
    )


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The documents in all their columns, each as often as the mix takes it.

    Documents the mix does not take go, and with them those without words.
    """
    times = F.sum(F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0)).cast("int")
    taken = mix_sources(documents).groupBy("row").agg(times.alias("times")).where(F.col("times") > 0)
    whole = documents.select(row_key().alias("row"), F.struct("*").alias("document"))
    once = whole.join(taken, "row").dropDuplicates(["row"])
    copies = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return copies.select("document.*")
