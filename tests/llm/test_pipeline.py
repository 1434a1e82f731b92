"""Each stage of the corpus pipeline against its plain version, and the whole run."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from granary.llm import op1_mixing, op6_quality, texts

from . import brute
from .test_edges import CLASHES, DOCS, SCHEMA

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and what the last one returns."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    near = documents.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 10_000)
    near = near.withColumn("text", F.concat(F.lit("Copied: "), F.regexp_replace("text", "\\n", " \n")))
    found = [documents.unionByName(near)]
    for _, stage in corpus_pipeline.STAGES:
        found.append(texts.written(stage(spark, found[-1], FOLDER)))
    return found


def plain(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_all_but_the_last_return_the_columns_of_documents(stages):
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_quality_keeps_what_it_does_not_reject(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = op6_quality.assess(stages[0], labels).where("predicted = 1").select("doc_id")
    assert sorted(map(tuple, stages[1].collect())) == sorted(map(tuple, stages[0].join(good, "doc_id", "left_semi").collect()))
    assert 0 < stages[1].count() < stages[0].count()


def test_lines(stages):
    wanted = brute.kept_lines(plain(stages[1]))
    found = {r["doc_id"]: r for r in stages[2].collect()}
    assert {i: hashlib.sha256(r["text"].encode()).hexdigest() for i, r in found.items()} == {i: w[2] for i, w in wanted.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_near_duplicates(stages):
    components = brute.jaccard_components(plain(stages[2]), 5, 80)
    kept = sorted(i for i, (_, component) in components.items() if component == i)
    assert sorted(r["doc_id"] for r in stages[3].collect()) == kept
    assert len(kept) < len(components)


def test_mixing(stages):
    sizes = {i: len(brute.words(t)) for i, t in plain(stages[3])}
    taken = {r["doc_id"]: r["taken"] for r in op1_mixing.mix_sources(stages[3]).collect()}
    times = Counter(r["doc_id"] for r in stages[4].collect())
    assert {i: n for i, n in times.items()} == {i: t // sizes[i] for i, t in taken.items() if t}
    by_source, reached, most = Counter(), Counter(), defaultdict(int)
    for r in stages[3].collect():
        by_source[r["source"]] += sizes[r["doc_id"]]
        reached[r["source"]] += times[r["doc_id"]] * sizes[r["doc_id"]]
        most[r["source"]] = max(most[r["source"]], sizes[r["doc_id"]])
    for source, target in brute.targets(by_source).items():
        assert abs(reached[source] - target) <= most[source] / 2 + 1e-6


def test_packing(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    times = Counter(r["doc_id"] for r in stages[4].collect())
    wanted = brute.pieces(set(plain(stages[4])), tokenizer, 2048)
    found = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in stages[5].collect())
    assert found == Counter({(i, k, *rest): times[i] for (i, k), rest in wanted.items()})


def test_run(spark, stages):
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        documents = texts.written(stage(spark, documents, FOLDER))
    found = corpus_pipeline.run(spark, FOLDER).select(*key).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, documents.select(*key).collect()))


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(DOCS if rows == "odd" else [], SCHEMA).withColumns({n: F.lit("x") for n in CLASHES})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = texts.written(stage(spark, docs, FOLDER))
        assert found.dtypes == docs.dtypes
        docs = found
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).where("piece = 0")
    assert pieces.count() == docs.count()
    assert docs.count() == 0 if rows == "empty" else docs.where("doc_id = 1").count() in (1, 2)
