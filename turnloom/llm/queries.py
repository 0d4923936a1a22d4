"""The operators' queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_trie, fingerprint, jaccard, language, lexical_search, line_dedup, mixing, nearest, quality, secret_scan, substring_dedup, warc
from .common import shared_dir, table


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, repeats=2)
    same = ("doc_id", "size", "source_size", "target")
    return mix.groupBy("key").agg(*(F.first(c).alias(c) for c in same), F.sum("taken").alias("taken")).select(*same, "taken")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=4, threshold=(85, 100)).withColumnRenamed("id", "doc_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def vocabulary_path() -> str:
    """The public vocabulary that op6 is asked to use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings carry the candidate's length and hash, not the secret."""
    documents = table(spark, sf_dir, "documents")
    found = secret_scan.scan(documents, secret_scan.learn(documents.where(~held_out(3, 1))))
    return found.select("doc_id", "start", F.length("candidate").cast("long").alias("n_chars"), F.sha2("candidate", 256).alias("candidate_sha256"), "score")


def held_out(modulus: int, remainder: int) -> Column:
    """Rows that nothing is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.train(documents, table(spark, sf_dir, "labels").where(~held_out(3, 1)))
    return quality.scored(documents, machine).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.learn(documents.where(~held_out(4, 2)))
    return language.identified(documents.select("doc_id", "text"), model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    nodes = conversation_trie.prefix_trie(conversation_trie.with_shared_heads(turns, every=20, most=4))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives are read back with their payloads, whose lengths and digests are made anew."""
    folder = warc.write_archives(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_nearest_neighbours, op2_source_mixing, op3_ngram_jaccard_join, op4_line_dedup, op5_substring_dedup, op6_bpe_encode_decode, op7_secret_scan, op8_quality_classifier, op9_language_id, op10_document_fingerprints, op11_conversation_trie, op12_ranked_search, op13_warc)
    }


_SPACES = r"\x20\x09-\x0D"

_OP2 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS key, doc_id, source, coalesce(len(regexp_extract_all(text, '[^{_SPACES}]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || '/0') AS shuffle FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, (2 * source_size)::DOUBLE AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM w),
n AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS filled,
             sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM r),
l AS (SELECT *, (budget - filled) / open AS own FROM n),
t AS (SELECT source, source_size, least(cap, coalesce(weight * (SELECT max(own) FROM l WHERE own < ratio), cap)) AS target FROM l),
q AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY shuffle, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d),
c AS (SELECT q.*, source_size, target, copy, before + copy * source_size AS start, greatest(0, least(size, floor(target)::BIGINT - (before + copy * source_size)))::BIGINT AS early
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source CROSS JOIN range(0, 2) r(copy)),
p AS (SELECT *, 0 AS piece, early AS words, start + early AS ends FROM c WHERE early > 0 OR size = 0 UNION ALL SELECT *, 1, size - early, start + size FROM c WHERE size > early),
f AS (SELECT *, CASE WHEN target > 0 AND size > 0 THEN ends::DOUBLE / target ELSE 0 END AS finish FROM p),
o AS (SELECT *, coalesce(sum(words) OVER (ORDER BY finish, piece, shuffle, doc_id, copy, size, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS position FROM f)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(greatest(0, least(words, (SELECT sum(floor(target)::BIGINT) FROM t) - position)))::BIGINT AS taken
FROM o GROUP BY key
"""

_OP4 = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[{_SPACES}]+', ''), '[{_SPACES}]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, g.first IS NOT NULL AND k.doc_id <> g.first AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_OP11 = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS p FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n, c - c % 20 AS b, xor(list_reduce([ord(x) FOR x IN string_split(c::VARCHAR, '')], lambda a, b: list_reduce(range(0, 8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(a, b)), 4294967295), 4294967295) % 4 AS h FROM t GROUP BY c),
i AS (SELECT n.*, least(n.h, coalesce(m.n, 0)) AS m FROM n LEFT JOIN n m ON m.c = n.b),
r AS (SELECT i.c, t.p AS d, t.k, t.text FROM i JOIN t ON t.c = i.b AND t.p <= i.m UNION ALL SELECT i.c, i.m + t.p - i.h, t.k, t.text FROM i JOIN t ON t.c = i.c AND t.p > i.h),
p AS (SELECT c, d, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS k, coalesce(len(regexp_extract_all(text, '[^{_SPACES}]+')), 0) AS words FROM r UNION ALL SELECT c, 0, '', 0 FROM i),
e AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS last FROM p),
g AS (SELECT d, k, min(c) AS c, count(*) AS n, count(*) FILTER (last) AS ends, max(words) AS words, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM e GROUP BY d, k),
q AS (SELECT p.c, p.d, g.c AS node FROM p JOIN g USING (d, k)),
s AS (SELECT q.node AS c, q.d, count(*) FILTER (g.n = g.ends) AS leaves, sum((g.n - 1) * g.words) AS saved, count(*) FILTER (g.d = q.d + 1) AS children FROM g JOIN q ON q.c = g.c AND q.d <= g.d GROUP BY q.node, q.d)
SELECT g.c::BIGINT AS conv_id, g.d::BIGINT AS depth, q.node::BIGINT AS parent_conv_id, g.n::BIGINT AS n_convs, s.children::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, ends_sha256
FROM g JOIN s ON s.c = g.c AND s.d = g.d LEFT JOIN q ON q.c = g.c AND q.d = g.d - 1
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS key, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS terms FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
a AS (SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms))::BIGINT AS total FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term FROM benchmark WHERE item_id IS NOT NULL),
u AS (SELECT key, doc_id, len(terms) AS size, unnest(terms) AS term FROM d),
p AS (SELECT key, any_value(doc_id) AS doc_id, any_value(size) AS size, term, count(*) AS tf FROM u WHERE term IN (SELECT term FROM q) GROUP BY key, term),
f AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p CROSS JOIN a GROUP BY term),
s AS (SELECT item_id, key, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * n) // total))))::BIGINT AS score FROM q JOIN p USING (term) JOIN f USING (term) CROSS JOIN a GROUP BY item_id, key),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""

_OP13 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST, url) AS nth, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1(body) || '0', 1 + (5 * i) // 4, 3))::INT >> (7 - (5 * i) % 4)) & 31) + 1, 1) FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN first END AS refers_to FROM p
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express at the driver's scale; the others are tested by brute force."""
    return {"op2_source_mixing": _OP2, "op4_line_dedup": _OP4, "op11_conversation_trie": _OP11, "op12_ranked_search": _OP12, "op13_warc": _OP13}
