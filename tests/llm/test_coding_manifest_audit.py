"""BPE coding, the Merkle manifest and the filter audit against plain versions."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from granary.llm import op11_bpe, op12_merkle, op13_filter_audit, queries
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = [
    "ids", "leaf", "root", "subroot", "proof", "folded_root", "verified", "position", "tree", "id", "value", "other", "digest", "block",
    "arrival", "at", "piece", "total", "path", "top", "forest", "name", "rest", "part", "hash", "bits", "failed", "of", "good", "toxic",
    "low", "high", "first", "marked", "n", "by", "step", "own", "earlier", "before", "letter", "filter_order", "quality", "_",
]
TEXT = st.text(alphabet=st.one_of(
    st.sampled_from(list(" \t\n\r\x0b\x1c\x85  ​aeiotsnr'lvdm019.!?-=<|>é՘日本한😀")), st.characters(blacklist_categories=["Cs"])
))


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def own_ids(text):
    return np.frombuffer(op11_bpe.tokenizer(PATH).encode(text), "<i4").tolist()


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(TEXT, st.sampled_from(["<|endoftext|>", "<|endoftext", " the", "aaaa", "'ll", "\r\n\n", "ing"])), max_size=8))
def test_ids_are_those_of_the_library(library, parts):
    text = "".join(parts)
    ids = own_ids(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    data, _ = op11_bpe.tokenizer(PATH).decode(np.array(ids, dtype=np.int64))
    assert data.tobytes().decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False) == text


def test_letters_below_the_plain_bound_are_split_as_by_the_library(library):
    for c in map(chr, range(op11_bpe.PLAIN)):
        text = f"a{c}1{c} !{c}{c} x{c}'s{c}"
        assert own_ids(text) == library.encode(text, add_special_tokens=False).ids, hex(ord(c))


@pytest.mark.parametrize("seed", range(4))
def test_long_pieces(library, seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(["a", "aa", "b", "ab", "the", "in", "g"][: seed + 3]) for _ in range(20_000))
    assert own_ids(text) == library.encode(text, add_special_tokens=False).ids


def test_every_token_encodes_to_itself_if_its_merges_do(library):
    bpe = op11_bpe.tokenizer(PATH)
    for data, token in list(bpe.token.items())[::7]:
        if len(data) > 1:
            assert bpe.tokens(data) == [token]


def test_ids_of_any_kind_decode(spark, library):
    rows = [(1, [50256, 0, 10**6, -1, None, 262]), (2, None), (3, []), (4, [220, 26486, 112]), (5, [47249])]
    found = {r["doc_id"]: r["text"] for r in op11_bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<long>"), PATH).collect()}
    assert found[1] == library.decode([50256, 0, 262], skip_special_tokens=False)
    assert (found[2], found[3]) == ("", "")
    for k in (4, 5):
        assert found[k] == library.decode(rows[k - 1][1], skip_special_tokens=False)


def test_coding_of_documents(spark, library, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    rows = [tuple(d) for d in docs] + [(-1, None, None, None, None), (-2, "", "", "", 0), (None, "no id", None, None, 1), (-3, "w " * 200_000, "en", "a", 1)]
    spark.createDataFrame(rows * 2, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_bpe_coding(spark, str(tmp_path)).collect()
    assert len(found) == 2 * len(rows)
    expected = {}
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[doc_id] = (len(ids), brute.digest(",".join(map(str, ids))), brute.digest(decoded))
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == expected


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        op11_bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))


def leaves(name="doc_id", more=0):
    fields = [F.col(c) for c in (name, "source", "lang", "n_chars", "text")]
    return op12_merkle.leaf_digest(*[(f + more).cast("long") if k == 3 else f for k, f in enumerate(fields)])


def documents(count, seed=0):
    rnd = random.Random(seed)
    langs = ["en"] * 6 + ["de", "é", "z", "", None]
    return [
        (k * 3 - 50, rnd.choice([None, "", "text é %d" % k, "x" * 50]), rnd.choice(langs), rnd.choice([None, "a", "-", "1:b"]), rnd.choice([None, 0, k]))
        for k in range(count)
    ]


@pytest.mark.parametrize(("count", "fanout", "block_nodes"), [(1, 2, 8), (2, 2, 8), (9, 2, 4), (200, 2, 4), (257, 3, 9), (300, 5, 5), (150, 2, 1024)])
def test_manifest_is_that_of_plain_trees(spark, count, fanout, block_nodes):
    docs = documents(count)
    changed = F.col("doc_id") % 2 == 0
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3).withColumns({name: F.lit("x") for name in CLASHES})
    replaced = F.when(changed, leaves(more=1)).otherwise(leaves())
    found = op12_merkle.manifest(frame, leaves(), replaced, fanout=fanout, block_nodes=block_nodes)
    found = found.select("doc_id", "leaf", "subroot", "root", op12_merkle.proof_digest(F.col("proof")), "folded_root", "verified").collect()
    expected = brute.manifest(docs, lambda doc_id: doc_id % 2 == 0, fanout)
    assert {r[0]: tuple(r)[1:6] for r in found} == expected and len(found) == count
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in found)
    by_id = {d[0]: d for d in docs}
    assert all(r["verified"] == (r["doc_id"] % 2 != 0 or by_id[r["doc_id"]][4] is None) for r in found)


def test_positions_and_proofs_of_equal_rows(spark):
    row = (7, "copy", "en", "a", 1)
    rows = [row] * 40 + [(None, None, None, None, None), (None, "x", "en", None, 2), (8, "long " * 300_000, "en", "b", 3)]
    found = op12_merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(4), leaves(), block_nodes=4).collect()
    assert len(found) == len(rows) and all(r["verified"] for r in found)
    places = sorted((r["position"], r["doc_id"]) for r in found if r["lang"] == "en")
    assert [p for p, _ in places] == list(range(42))
    assert places[0][1] is None and places[-1][1] == 8
    for r in found:
        assert brute.folded(r["leaf"], [(s["slot"], s["siblings"]) for s in r["proof"]]) == r["root"]


def test_manifest_of_nothing(spark):
    assert op12_merkle.manifest(spark.createDataFrame([], SCHEMA), leaves()).collect() == []


def test_the_query_tampers_where_seven_divides_the_checksum(spark, tmp_path):
    docs = [*documents(120, seed=3), (2**62, "t", "en", "a", 2**63 - 1)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: tuple(r)[1:6] for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect()}
    assert found == brute.manifest(docs, lambda doc_id: zlib.crc32(str(doc_id).encode()) % 7 == 0)


AUDITED = [
    *[(k, "word " * (150 + 20 * k), "en") for k in range(6)],
    *[(10 + k, " ".join(f"w{j}" for j in range(190 + 5 * k)), "de") for k in range(6)],
    *[(20 + k, " ".join(f"w{j}" for j in range(215)), None) for k in range(5)],
    *[(30 + k, "Loud ABC $ text", "en") for k in range(300)],
    (None, "Loud ABC $ text", "en"), (None, None, None), (40_000, None, "fr"), (40_001, "", "fr"), (31, "Loud ABC $ text", "en"),
    (31, "another text of an id", "en"), (50, "A" * 3 + "é" * 97, ""), (51, "A" * 4 + "é" * 97, ""), (52, "a\x1cb c\x0bd|", "xx"),
    (60, "big word " * 100_000, "en"), (61, "big word " * 100_000, "xx"),
]
LABELS = [(d, d % 2, int(d % 3 == 0)) for d in range(70)] + [(31, 1, None), (31, 0, 1), (None, 1, 1), (33, None, None), (99, 1, 1)]


def test_audit_is_that_of_playing_all_orders(spark):
    docs = spark.createDataFrame(AUDITED, "doc_id long, text string, lang string").repartition(3)
    docs = docs.withColumns({name: F.lit("x") for name in CLASHES})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumns({n: F.lit("x") for n in ("part", "text", "n")})
    found = op13_filter_audit.audit(docs, labels).collect()
    expected = brute.audit(AUDITED, LABELS)
    assert len(found) == len(expected)
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in found} == expected


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op13_filter_audit.audit(empty, labels).collect() == []


def test_equal_hashes_of_different_texts_are_no_copies(spark, monkeypatch):
    monkeypatch.setattr(op13_filter_audit, "_hashed", lambda text: F.lit("same"))
    docs = [(1, "a", "en"), (2, "b", "en"), (3, "a", "en"), (4, "c", "en")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = frame.select("doc_id", F.lit("same").alias("hash"))
    assert [r["doc_id"] for r in op13_filter_audit.copies(frame, rows).collect()] == [3]
