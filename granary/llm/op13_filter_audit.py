"""How document filters interact: what each removes in every order they may be applied in.

A document fails a filter whatever the order, so each gets a set of failures once. Orders are
then played through over counts of the 32 sets, never over documents.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import texts

FILTERS = "ABCDE"
# Bit of each filter in a set of failures.
BITS = {letter: 1 << place for place, letter in enumerate(FILTERS)}
SETS = 1 << len(FILTERS)

WORD = r"[^\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """The failures that a text shows by itself, as bits; null counts as empty.

    A: under 200 words; B: fewer than half of them distinct; C: more than three of a hundred
    characters are capitals A-Z; D: holds any of #$%&*|.
    """
    whole = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(whole, "[^A-Z]+", ""))
    fails = {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals.cast("long") * 100 > F.length(whole).cast("long") * 3,
        "D": whole.rlike("[#$%&*|]"),
    }
    bits = F.lit(0)
    for letter, failing in fails.items():
        bits = bits + F.when(failing, BITS[letter]).otherwise(0)
    return bits


def _hashed(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def copies(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, hash) of documents whose text a smaller doc_id holds, each once.

    `rows` holds doc_id and hash of all documents: texts whose hash only one doc_id has are left
    out by it. Of the rest every row looks for a smaller doc_id among the first of each distinct
    text: a semi join on hash, text and smaller doc_id, whose left side adaptive execution may
    split where a text has very many copies. Equal hashes of different texts mark nothing.
    """
    known = rows.filter("doc_id IS NOT NULL")
    repeated = known.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    # A written side, merged at every size: Spark may then split the other where a hash is very common.
    repeated = texts.written(repeated.select("hash")).hint("merge")
    whole = docs.filter("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _hashed(F.col("text")).alias("hash"))
    shared = texts.written(whole.join(repeated, "hash", "left_semi"))
    first = texts.written(shared.groupBy("hash", "text").agg(F.min("doc_id").alias("first")))
    a, b = shared.alias("a"), first.alias("b")
    same = (F.col("a.hash") == F.col("b.hash")) & (F.col("a.text") == F.col("b.text")) & (F.col("b.first") < F.col("a.doc_id"))
    return a.join(b, same, "left_semi").select("doc_id", "hash").distinct()


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts by part and set of failures: part, failed (bits), good, toxic, n.

    Ids that fail by their text and ids of copies are united and their bits combined; rows are
    known by doc_id and hash, so that texts under one doc_id stay apart.
    """
    rows = texts.written(docs.select("doc_id", _hashed(F.col("text")).alias("hash"), "part", text_failures(F.col("text")).alias("bits")))
    copied = copies(docs, rows).withColumn("bits", F.lit(BITS["E"]))
    united = rows.filter("bits > 0").select("doc_id", "hash", "bits").unionByName(copied)
    failed = united.groupBy(F.col("doc_id").alias("id"), F.col("hash").alias("of")).agg(F.bit_or("bits").alias("failed"))
    holds = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("marked"))
    marks = marks.agg(holds("quality").alias("good"), holds("toxic").alias("toxic"))
    judged = rows.join(failed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("of")), "left")
    judged = judged.join(marks, F.col("doc_id") == F.col("marked"), "left")
    flag = lambda name: F.coalesce(name, F.lit(False)).alias(name)
    return judged.groupBy("part", F.coalesce("failed", F.lit(0)).alias("failed"), flag("good"), flag("toxic")).agg(F.count("*").alias("n"))


def _over_sets(counts: str, holds: str) -> Column:
    """Sum of the counts (one per set of failures) of the sets `s` for which a condition holds."""
    return F.expr(f"aggregate(transform(filter(sequence(0, {SETS - 1}), s -> {holds}), s -> {counts}[s]), 0L, (x, y) -> x + y)")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """What each filter removes at each step of each order, per value of a column.

    One row, zeros included, per part (null: empty string), filter_order (all 120 orders of
    ABCDE) and step (1 to 5): kept (after this step), removed (here), redundant (fail this
    filter, removed before), unique_fails (fail this filter alone), good_lost and toxic_lost
    (removed here, by label), shapley (what this filter removes, summed over all orders: a
    document failing k filters goes to each of them first in one k-th of the orders).

    Null texts count as empty. Very long texts are judged whole, by one task each. Rows without
    doc_id fail A to D but are no copies, have none, and no label; repeated rows count each; rows
    of one doc_id are no smaller than each other. Of several labels of a doc_id, one that holds
    is enough. An empty table gives no rows. Other columns do not matter, whatever their names.
    """
    named = F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    counted = failures(docs.select("doc_id", "text", named), labels.select("doc_id", "quality", "toxic"))
    # At most 32 sets of failures a part, so a row holds a part.
    by_set = counted.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    slots = by_set.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("failed", F.struct("n", "good", "toxic")))).alias("by"))
    lists = slots.select("part", *[
        F.expr(f"transform(sequence(0, {SETS - 1}), s -> coalesce(try_element_at(by, s).{name}, 0L))").alias(name) for name in ("n", "good", "toxic")
    ])
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = lists.withColumn("filter_order", F.explode(orders)).select("*", F.posexplode(F.split("filter_order", "")).alias("before", "letter"))
    bit_of = F.create_map(*[F.lit(x) for pair in BITS.items() for x in pair])
    steps = steps.withColumn("own", bit_of[F.col("letter")]).withColumn(
        "earlier",
        F.aggregate(F.split(F.substring("filter_order", F.lit(1), F.col("before")), ""), F.lit(0), lambda x, c: x + F.coalesce(bit_of[c], F.lit(0))),
    )
    here = "s & own != 0 AND s & earlier = 0"
    return steps.select(
        "part",
        "filter_order",
        (F.col("before") + 1).cast("int").alias("step"),
        _over_sets("n", "s & own = 0 AND s & earlier = 0").alias("kept"),
        _over_sets("n", here).alias("removed"),
        _over_sets("n", "s & own != 0 AND s & earlier != 0").alias("redundant"),
        F.get("n", F.col("own")).alias("unique_fails"),
        _over_sets("good", here).alias("good_lost"),
        _over_sets("toxic", here).alias("toxic_lost"),
        F.expr(
            f"aggregate(filter(sequence(0, {SETS - 1}), s -> s & own != 0), 0L, "
            "(x, s) -> x + n[s] * CAST(120 / bit_count(s) AS BIGINT))"
        ).alias("shapley"),
    )
