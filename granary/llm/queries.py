"""One query per operator over its whole table, with the parameters a production run takes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import (
    op1_mixing,
    op10_neighbours,
    op11_bpe,
    op12_merkle,
    op13_filter_audit,
    op2_language,
    op3_ngram_join,
    op4_toxicity,
    op5_suffix_dedup,
    op6_quality,
    op7_lines,
    op8_embeddings,
    op9_packing,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = op1_mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return op2_language.identify(table(spark, folder, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return op3_ngram_join.join(table(spark, folder, "documents"), size=3, per_cent=90)


def op4_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    return op4_toxicity.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = op5_suffix_dedup.remove_repeats(table(spark, folder, "documents"), size=200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return op6_quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = op7_lines.dedup_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return op8_embeddings.deduplicate(table(spark, folder, "embeddings"), least=0.95)


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return op9_packing.pack(table(spark, folder, "documents"), word_tokenizer())


def op10_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return op10_neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_bpe_coding(spark: SparkSession, folder: str) -> DataFrame:
    encoded = op11_bpe.encode(table(spark, folder, "documents"), byte_tokenizer())
    return op11_bpe.decode(encoded, byte_tokenizer()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    # Wide enough for one more than the largest integer.
    more = fields[3].cast("decimal(20,0)") + F.when(F.crc32(fields[0].cast("string")) % 7 == 0, 1).otherwise(0)
    tampered = [more.cast("decimal(20,0)") if k == 3 else field for k, field in enumerate(fields)]
    found = op12_merkle.manifest(
        table(spark, folder, "documents"), op12_merkle.leaf_digest(*fields), op12_merkle.leaf_digest(*tampered)
    )
    proof = op12_merkle.proof_digest(F.col("proof")).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op13_filter_audit_orders(spark: SparkSession, folder: str) -> DataFrame:
    return op13_filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing_sources": op1_mixing_sources,
    "op2_language_id": op2_language_id,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_toxicity_chain": op4_toxicity_chain,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_line_dedup": op7_line_dedup,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_learned_partitions": op10_learned_partitions,
    "op11_bpe_coding": op11_bpe_coding,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_filter_audit": op13_filter_audit_orders,
}

_OP7 = """
WITH cells AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM cells
), repeated AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT k.*, coalesce(r.first_doc <> k.doc_id, false) AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_OP3 = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
                 END AS grams
  FROM split
), sized AS (
  SELECT doc_id, CAST(len(grams) AS BIGINT) AS n, md5(array_to_string(list_sort(grams), ' | ')) AS class, grams FROM sets
), classes AS (
  SELECT class, min(doc_id) AS rep, any_value(n) AS n, any_value(grams) AS grams FROM sized WHERE n > 0 GROUP BY class
), cells AS (SELECT rep, n, unnest(grams) AS gram FROM classes),
frequent AS (SELECT gram, count(*) AS c FROM cells GROUP BY gram HAVING count(*) > 1),
shared AS (
  SELECT a.rep AS x, b.rep AS y, a.n AS nx, b.n AS ny, count(*) AS o
  FROM cells a JOIN frequent USING (gram) JOIN cells b USING (gram)
  WHERE a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL
), links AS (
  SELECT x, y FROM shared WHERE 100 * o >= 90 * (nx + ny - o)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT rep AS node, rep AS seen FROM classes
  UNION
  SELECT r.node, e.y FROM reach r JOIN edges e ON r.seen = e.x
), roots AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT s.doc_id, s.n AS n_shingles, coalesce(r.component, s.doc_id) AS component_id
FROM sized s LEFT JOIN classes c ON s.class = c.class AND s.n > 0 LEFT JOIN roots r ON c.rep = r.node
"""

_OP5 = """
WITH raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS w
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM raw)
), repeated AS (SELECT w FROM strings GROUP BY w HAVING count(*) > 1),
starts AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, true) AS new
  FROM strings SEMI JOIN repeated USING (w)
), numbered AS (
  SELECT doc_id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM starts
), spans AS (
  SELECT doc_id, min(i) AS low, max(i) + 200 AS high FROM numbered GROUP BY doc_id, span
), edges AS (
  SELECT doc_id, low, high FROM spans
  UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM raw
), gaps AS (
  SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low, high), 0) AS since FROM edges
), kept AS (
  SELECT g.doc_id, string_agg(substr(r.h, 2 * g.since + 1, 2 * (g.low - g.since)), '' ORDER BY g.low, g.high) AS h,
         sum(g.high - g.low) AS n_removed, count(*) - 1 AS n_spans
  FROM gaps g JOIN raw r ON g.doc_id = r.doc_id GROUP BY g.doc_id
)
SELECT r.doc_id, CAST(len(r.h) // 2 AS BIGINT) AS n_bytes, CAST(k.n_removed AS BIGINT) AS n_removed,
       CAST(k.n_spans AS BIGINT) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM raw r JOIN kept k ON r.doc_id = k.doc_id
"""

_OP8 = """
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.y FROM reach r JOIN links l ON r.seen = l.x
), roots AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON e.vec_id = r.node LEFT JOIN counts c ON c.x = e.vec_id
"""

_OP12 = """
WITH RECURSIVE cells AS (
  SELECT doc_id, lang, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS plain,
         [CAST(doc_id AS VARCHAR), source, lang,
          CAST(CAST(n_chars AS HUGEINT) + CASE WHEN xor(4294967295, list_reduce(
            list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
            lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 7 = 0
          THEN 1 ELSE 0 END AS VARCHAR), text] AS changed
  FROM documents
), leaves AS (
  SELECT doc_id, lang,
         sha256(array_to_string([CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END FOR v IN plain], '')) AS leaf,
         sha256(array_to_string([CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END FOR v IN changed], '')) AS changed
  FROM cells
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS total,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaves
), nodes AS (
  SELECT 0 AS level, tree, pos, total, leaf AS digest FROM placed
  UNION ALL
  SELECT any_value(level) + 1, tree, pos // 2, (any_value(total) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE total > 1 GROUP BY tree, pos // 2
), subroots AS (
  SELECT tree, digest, count(*) OVER () AS total FROM nodes WHERE total = 1
), upper_nodes AS (
  SELECT 0 AS level, tree AS pos, total, digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, (any_value(total) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_nodes WHERE total > 1 GROUP BY pos // 2
), depth AS (
  SELECT tree, max(level) AS depth FROM nodes GROUP BY tree
), steps AS (
  SELECT p.tree, p.pos, n.level, (p.pos >> n.level) % 2 AS slot, s.digest AS other
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.pos = p.pos >> n.level AND n.total > 1
  LEFT JOIN nodes s ON s.level = n.level AND s.tree = n.tree AND s.pos = xor(n.pos, 1)
  UNION ALL
  SELECT p.tree, p.pos, d.depth + n.level, (p.tree >> n.level) % 2, s.digest
  FROM placed p JOIN depth d ON d.tree = p.tree JOIN upper_nodes n ON n.pos = p.tree >> n.level AND n.total > 1
  LEFT JOIN upper_nodes s ON s.level = n.level AND s.pos = xor(n.pos, 1)
), proofs AS (
  SELECT tree, pos, sha256(string_agg(other, '' ORDER BY level)) AS proof FROM steps GROUP BY tree, pos
), folded AS (
  SELECT tree, pos, 0 AS level, changed AS digest FROM placed
  UNION ALL
  SELECT f.tree, f.pos, f.level + 1,
         sha256(CASE WHEN s.slot = 0 THEN f.digest || coalesce(s.other, '') ELSE s.other || f.digest END)
  FROM folded f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level
), roots AS (
  SELECT tree, pos, arg_max(digest, level) AS folded_root FROM folded GROUP BY tree, pos
)
SELECT p.doc_id, p.leaf, u.digest AS subroot, r.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       f.folded_root, f.folded_root = r.digest AS verified
FROM placed p JOIN subroots u ON u.tree = p.tree CROSS JOIN (SELECT digest FROM upper_nodes WHERE total = 1) r
JOIN roots f ON f.tree = p.tree AND f.pos = p.pos LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos
"""

_OP13 = """
WITH cells AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT doc_id, part, [
      len(words) < 200,
      100 * len(list_distinct(words)) < 50 * len(words),
      100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
      regexp_matches(text, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM cells
), marked AS (
  SELECT j.*, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM judged j LEFT JOIN (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id) l ON j.doc_id = l.doc_id
), counted AS (
  SELECT part, fails, good, toxic, count(*) AS n FROM marked GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest(range(1, 6)) AS i),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS seq
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), played AS (
  SELECT part, filter_order, unnest(range(1, 6)) AS step, seq, fails, good, toxic, n FROM counted CROSS JOIN orders
), seen AS (
  SELECT *, seq[step] AS own, fails[seq[step]] AS here, list_bool_or([fails[k] FOR k IN seq[1:step - 1]]) AS before,
         len([k FOR k IN seq IF fails[k]]) AS many FROM played
), told AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
         CAST(coalesce(sum(n) FILTER (NOT here AND NOT coalesce(before, false)), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (here AND NOT coalesce(before, false)), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (here AND before), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (here AND many = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (here AND NOT coalesce(before, false) AND good), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (here AND NOT coalesce(before, false) AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, own
)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM told
"""

ORACLE: dict[str, str] = {
    "op3_ngram_jaccard_join": _OP3,
    "op5_suffix_array_dedup": _OP5,
    "op7_line_dedup": _OP7,
    "op8_embedding_near_dedup": _OP8,
    "op12_merkle_manifest": _OP12,
    "op13_filter_audit": _OP13,
}
