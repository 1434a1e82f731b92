"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from granary.llm import (
    op1_mixing,
    op2_language,
    op3_ngram_join,
    op4_toxicity,
    op5_suffix_dedup,
    op6_quality,
    op7_lines,
    op8_embeddings,
    op9_packing,
    op10_neighbours,
    vectors,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = [
    "row", "tag", "part", "n", "sig", "key", "size", "weight", "draw", "rep", "cluster", "gram", "at", "found", "kept", "drops",
    "line", "score", "held_out", "stats", "label", "kind", "blocks", "copies", "vector", "length", "range", "before", "doc",
    "_", "sig2", "group", "shard", "salt", "held", "i", "j", "near", "component", "drop_tag", "copy", "node", "code",
]

LONG = "word " * 120_000 + "idiot"
DOCS = [
    (1, "the same text twice over, the same text twice over", "en", "a", 1),
    (1, "the same text twice over, the same text twice over", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (4, " \n\t ", None, "b", 4),
    (None, "no id here but a line of its own", "de", "a", 3),
    (None, "no id here but a line of its own", "de", "a", 3),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG, "en", "b", len(LONG)),
    (8, "!", "en", "c", 1),
]


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def some_labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (6, 0, 1), (7, 0, 1), (8, None, None), (None, 1, 1), (4, 0, None), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


OPERATORS = {
    "mixing": lambda s, d: op1_mixing.mix_sources(d),
    "language": lambda s, d: op2_language.identify(d),
    "join": lambda s, d: op3_ngram_join.join(d),
    "toxicity": lambda s, d: op4_toxicity.assess(d, some_labels(s)),
    "toxicity unlabelled": lambda s, d: op4_toxicity.assess(d, no_labels(s)),
    "suffixes": lambda s, d: op5_suffix_dedup.remove_repeats(d),
    "quality": lambda s, d: op6_quality.assess(d, some_labels(s)),
    "quality unlabelled": lambda s, d: op6_quality.assess(d, no_labels(s)),
    "lines": lambda s, d: op7_lines.dedup_lines(d, keep=("lang", "source")),
    "packing": lambda s, d: op9_packing.pack(d, public_tokenizers.path("word_bpe_49k.json")),
}


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    return frame.withColumns({name: F.lit("x") for name in CLASHES}).cache()


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, name):
    found = OPERATORS[name](spark, odd).collect()
    ids = [r["doc_id"] for r in found if "piece" not in r or r["piece"] == 0]
    assert sorted(ids, key=str) == sorted([d[0] for d in DOCS], key=str)
    by_id = {}
    for r in found:
        by_id.setdefault((r["doc_id"], r["piece"] if "piece" in r else 0), []).append(r)
    first = by_id[1, 0]
    assert len(first) == 2
    if name in ("language", "join", "toxicity", "suffixes", "quality", "lines"):
        assert first[0] == first[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    empty = spark.createDataFrame([], SCHEMA)
    assert OPERATORS[name](spark, empty).collect() == []


def test_results_of_odd_rows(spark, odd):
    def by_id(frame):
        return {r["doc_id"]: r for r in frame.collect()}

    joined = by_id(op3_ngram_join.join(odd))
    assert (joined[2]["n_shingles"], joined[2]["component_id"]) == (0, 2)
    assert joined[4]["component_id"] == 4 and joined[7]["component_id"] == 6 and joined[None]["component_id"] is None
    assert by_id(op2_language.identify(odd))[8]["lang_pred"] == "und"
    removed = by_id(op5_suffix_dedup.remove_repeats(odd))
    assert removed[2]["n_bytes"] == 0 and removed[2]["kept"] == b"" and removed[6]["n_removed"] == len(LONG)
    lines = by_id(op7_lines.dedup_lines(odd))
    assert (lines[2]["text"], lines[2]["n_lines"], lines[2]["n_dropped"]) == ("", 1, 0)
    assert lines[1]["n_dropped"] == 0 and lines[6]["n_dropped"] == 0 and lines[7]["n_dropped"] == 1
    mixed = by_id(op1_mixing.mix_sources(odd))
    assert mixed[2]["taken"] == 0 and mixed[None]["size"] == 9


VECTORS = [
    (0, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]),
    (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 1.0, 0.0]), (7, [None, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]),
    (50, [1.0, 0.0]), (100, [0.0, 0.0, 1.0]), (8, [1e-30, 0.0, 0.0]),
]


def test_odd_vectors(spark):
    frame = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>").withColumns({n: F.lit("x") for n in CLASHES})
    rows = op8_embeddings.deduplicate(frame).collect()
    assert len(rows) == len(VECTORS)
    found = {r["vec_id"]: r for r in rows}
    for lonely in (2, 3, 4, 5, 6, 7, 100):
        assert (found[lonely]["n_links"], found[lonely]["component_id"], found[lonely]["kept"]) == (0, lonely, True)
    for linked in (0, 1, 8, 50, None):
        assert found[linked]["component_id"] == 0 and found[linked]["n_links"] == 5
    near = op10_neighbours.search(frame, F.col("vec_id") % 50 == 0).collect()
    assert {r["query_id"] for r in near} == {0, 50, 100}
    assert [r["vec_id"] for r in sorted(near, key=lambda r: r["rank"]) if r["query_id"] == 100] == [0, 1, 8, 50]


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op8_embeddings.deduplicate(frame).collect() == []
    assert op10_neighbours.search(frame, F.col("vec_id") % 50 == 0).collect() == []
    lone = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in op8_embeddings.deduplicate(lone).collect()] == [(1, 0, 1, True)]


SIZES = [(0, [1e-200, 0.0, 0.0]), (1, [1e200, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [5e-324, 0.0, 0.0]), (4, [1e-310, 1e-310, 0.0]),
         (5, [1e308, 1e308, 0.0]), (50, [0.0, 1e300, 1e-300]), (6, [1e200, 1e-200, 0.0])]


def test_vectors_of_any_length(spark):
    frame = spark.createDataFrame(SIZES, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op8_embeddings.deduplicate(frame).collect()}
    assert found == {**{k: (4, 0) for k in (0, 1, 2, 3, 6)}, 4: (1, 4), 5: (1, 4), 50: (0, 50)}
    near = [r for r in op10_neighbours.search(frame, F.col("vec_id") % 50 == 0, k=7).collect() if r["query_id"] == 0]
    near.sort(key=lambda r: r["rank"])
    assert [r["vec_id"] for r in near] == [1, 2, 3, 6, 4, 5, 50]
    assert [round(r["score"], 12) for r in near] == [1.0] * 4 + [round(0.5**0.5, 12)] * 2 + [0.0]


def test_a_copied_vector_is_sampled_once(spark):
    rows = [(k, [float(k % 7), 1.0, 2.0]) for k in range(300)] + [(1000 + k, [9.0, 9.0, 1.0]) for k in range(300)]
    read = vectors.read(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), 3)
    assert len(vectors.sample(read, 600, 600, 3)) == 8
