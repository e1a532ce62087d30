"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from crashlake.llm import (chaining, decontaminate, languages, licenses, merkle, minhash, mixing, negatives, quality, ring, suffixes,
                           token_files, toxicity)
from crashlake.llm.common import documents
from crashlake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(configure(spark), folder)
        if oracle:
            ORACLES[name] = oracle
        return fn
    return register


@query("op6_ring_shards")
def op6(spark, folder):
    """All documents on a ring of 24 shards; no shard above the mean bytes by more than its slack."""
    return (ring.shard_ring(documents(spark, folder), shards=24)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
    source_size * CAST(2 AS DOUBLE) AS most, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS budget,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
l AS (SELECT *, most <= weight * ((budget - coalesce(sum(most) OVER (ORDER BY most / weight, place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY most / weight, place
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS is_full FROM w),
t AS (SELECT source, source_size, CASE WHEN is_full THEN most ELSE weight * (budget
        - coalesce(sum(CASE WHEN is_full THEN most END) OVER (), 0)) / sum(CASE WHEN NOT is_full THEN weight END) OVER () END
        AS target FROM l),
p AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size
        ROWS UNBOUNDED PRECEDING) AS sent FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CAST(turn * source_size + sent AS DOUBLE) / target AS finish FROM p, (VALUES (0), (1)) AS v(turn) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, key, doc_id NULLS FIRST, source NULLS FIRST, size, sent, turn
        ROWS UNBOUNDED PRECEDING) <= (SELECT sum(target) FROM t) AS is_in FROM e)
SELECT doc_id, source, size, source_size, target, CAST(sum(CASE WHEN is_in THEN size ELSE 0 END) AS BIGINT) AS taken,
    min(finish) AS finish FROM r GROUP BY doc_id, source, size, source_size, target, sent
UNION ALL SELECT doc_id, source, size, source_size, target, 0, NULL FROM p WHERE size = 0
"""


@query("op9_fair_mix", MIX_SQL)
def op9(spark, folder):
    """Words the mix takes of every document, with its source's target."""
    return mixing.mix(documents(spark, folder)).select("doc_id", "source", "size", "source_size", "target", "taken", "finish")


@query("op5_license_scan")
def op5(spark, folder):
    """Licenses of every document: exact phrases, labels by voting, and covered share."""
    return licenses.scan_licenses(documents(spark, folder))


@query("op7_quality_outliers")
def op7(spark, folder):
    """Statistics, base rules and robust verdict of every document."""
    return quality.quality_report(documents(spark, folder)).drop("lang", "source", "text_key")


@query("op8_minhash_near_duplicates")
def op8(spark, folder):
    """Components of documents whose two-word shingles agree by 80 in 100."""
    return minhash.near_duplicates(documents(spark, folder), words=2, percent=80)


@query("op3_spaced_seed_leaks")
def op3(spark, folder):
    """Overlaps of documents with benchmark items."""
    return (decontaminate.find_leaks(documents(spark, folder), documents(spark, folder, "benchmark"))
            .select("doc_id", "item_id", "first_word", "n_words", "n_matched"))


@query("op1_huffman_token_files")
def op1(spark, folder):
    """Token files of all documents, written and read back."""
    return token_files.token_digest(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_nb_char_toxicity")
def op2(spark, folder):
    """Toxicity of every document, learned from labels outside the held-out fold."""
    return toxicity.score_toxicity(documents(spark, folder), documents(spark, folder, "labels"))


@query("op4_chained_passages")
def op4(spark, folder):
    """Fuzzy passages that documents share with earlier ones."""
    return chaining.fuzzy_passages(documents(spark, folder))


@query("op10_repeated_bytes")
def op10(spark, folder):
    """What every document keeps without the 50-byte strings of earlier documents."""
    return suffixes.remove_repeats(documents(spark, folder))


@query("op11_output_code_language")
def op11(spark, folder):
    """Language of every document by output codes, learned outside the held-out fold."""
    return languages.identify_languages(documents(spark, folder))


MERKLE_SQL = r"""
WITH RECURSIVE f AS (SELECT doc_id, lang, CAST(doc_id AS VARCHAR) AS d, n_chars, h.*
  FROM documents, LATERAL (SELECT
    CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id) END
    || CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END
    || CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END AS tail) AS h),
c AS (SELECT *, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(d, '')]),
    lambda r, b: list_reduce(list_prepend(xor(r, b), [CAST(1 AS BIGINT) FOR k IN range(8)]),
      lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)) AS crc FROM f),
leaves AS (SELECT doc_id, lang,
  sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars) END || tail) AS leaf,
  CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL
    THEN sha256(head || concat(strlen(CAST(n_chars + 1 AS VARCHAR)), ':', n_chars + 1) || tail) END AS changed FROM c),
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS i,
  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
tree AS (SELECT lang, 0 AS h, i, n, leaf AS node FROM p
  UNION ALL SELECT lang, h + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM tree WHERE n > 1
  GROUP BY lang, h, i // 2, n),
subs AS (SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (SELECT 0 AS h, i, n, node FROM subs
  UNION ALL SELECT h + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY h, i // 2, n),
way AS (SELECT doc_id, p.lang, leaf, coalesce(changed, leaf) AS folded, '' AS proof, p.i, p.n, 0 AS h, false AS above, s.i AS si, s.n AS sn, s.node AS subroot
    FROM p JOIN subs AS s ON p.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT doc_id, w.lang, leaf,
    CASE WHEN w.n = 1 THEN folded WHEN o.node IS NULL THEN sha256(folded) WHEN w.i % 2 = 1 THEN sha256(o.node || folded) ELSE sha256(folded || o.node) END,
    CASE WHEN w.n = 1 THEN proof ELSE proof || coalesce(o.node, '') END,
    CASE WHEN w.n = 1 THEN si ELSE w.i // 2 END, CASE WHEN w.n = 1 THEN sn ELSE (w.n + 1) // 2 END,
    CASE WHEN w.n = 1 THEN 0 ELSE w.h + 1 END, above OR w.n = 1, si, sn, subroot
  FROM way AS w LEFT JOIN (SELECT lang, false AS on_top, h, i, node FROM tree UNION ALL SELECT NULL, true, h, i, node FROM top) AS o
    ON o.on_top = w.above AND o.h = w.h AND o.i = xor(w.i, 1) AND (w.above OR o.lang IS NOT DISTINCT FROM w.lang)
  WHERE NOT (w.above AND w.n = 1))
SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.node AS verified,
  CAST(strlen(proof) // 64 AS INT) AS n_siblings
FROM way, (SELECT node FROM top WHERE n = 1) AS r WHERE above AND way.n = 1
"""


@query("op12_postorder_manifest", MERKLE_SQL)
def op12(spark, folder):
    """Leaf, roots, proof and check of every document, read from a postorder log."""
    return merkle.prove_documents(documents(spark, folder))


NEGATIVES_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e AS a, e AS b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 3
"""


@query("op13_pruned_negatives", NEGATIVES_SQL)
def op13(spark, folder):
    """Hard negatives of every fiftieth vector against all others."""
    return negatives.hard_negatives(documents(spark, folder, "embeddings"))
