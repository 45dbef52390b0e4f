"""Registered queries of the text operators, with their DuckDB twins.

Each query applies its operator, with production parameters, to its whole
table and returns its full result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.llm import hard_negatives, linededup, mixing, neardup, pii, prefix_trie, quality, secret_scan, simhash, token_counts, toxicity, unigram, warc

#: Folder of the public tokenizer files; a parameter of the deployment.
TOKENIZERS = "/opt/tokenizers"


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """A tokenizer file's place: the installed package's, else below :data:`TOKENIZERS`."""
    try:
        from public_tokenizers import path
    except ImportError:
        return os.path.join(TOKENIZERS, name)
    return path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every text and its edited text, their likenesses, and near fingerprints of the query rows."""
    return simhash.fingerprint_table(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text under the 32k byte-pair model."""
    out = token_counts.token_counts(table(spark, sf_dir, "documents"), model_path())
    return out.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 4096 AS over_limit")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base findings, and spans the boosted trees add."""
    rows = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id", *map(count, pii.BASE), F.sha2(pii.spans_text("base").cast("binary"), 256).alias("base_sha256"),
        pii.spans_text("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures of every text, and the verdict of the combined rules."""
    return quality.quality_table(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "votes", "posterior")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram pieces of every text, and whether they decode to it again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unigram.encoded_and_decoded(docs, model_path())


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC, deduplicated by revisit records and read back."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


#: SHA-1 in base32: ten hexadecimal digits hold eight groups of five bits.
OP6_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
e AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31), 1)), '')
      AS payload_digest FROM d),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM e)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM f"""


def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies: 4-word shingle sets with a similarity of 0.8 or more, connected."""
    return neardup.near_groups(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 150% mix with weights 5, 2, 1 takes of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken")


#: Words of a text in DuckDB, as an array.
SQL_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

OP8_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len({SQL_WORDS}) AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)]::DOUBLE AS w
  FROM sized GROUP BY source),
leveled AS (
  SELECT *, row_number() OVER by_cap AS pos, 2.0::DOUBLE * source_size AS most,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(2.0::DOUBLE * source_size) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW by_cap AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST)),
aims AS (
  SELECT source, source_size,
         least(most, w * (SELECT arg_min(level, pos) FROM leveled WHERE level * w <= most)) AS target
  FROM leveled),
placed AS (
  SELECT doc_id, size, source_size, coalesce(target, 2.0 * source_size) AS target,
         floor(coalesce(target, 2.0 * source_size) + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 4) AS target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size
              + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM placed"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by its nearest labelled examples."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: base findings, and credential parts that co-occur."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, secret_scan.BASE_KINDS),
        F.sha2(secret_scan.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_text(secret_scan.in_order(F.concat("base", "linked"))).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


#: CRC-32 of a number's decimal text, bit by bit.
SQL_CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT),
  lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT)"""

OP11_SQL = f"""
WITH turns AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''),
              md5('0:' || length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT conv_id, own, ({SQL_CRC32} % 4)::INT AS h FROM turns),
rebuilt AS (
  SELECT c.conv_id, coalesce(list_slice(b.own, 1, c.h), []) || coalesce(list_slice(c.own, c.h + 1, len(c.own)), []) AS seq
  FROM cut c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(seq) AS n, d AS depth, list_slice(seq, 1, d) AS p
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256,
         CASE WHEN any_value(depth) = 0 THEN 0
              ELSE len(regexp_extract_all(any_value(p)[-1].t, '[^\x20\x09-\x0D]+')) END AS w
  FROM prefixes GROUP BY p),
linked AS (
  SELECT c.*, x.conv_id AS parent_conv_id FROM nodes c
  LEFT JOIN nodes x ON x.depth = c.depth - 1 AND x.p = list_slice(c.p, 1, c.depth - 1)),
childless AS (
  SELECT n.*, (SELECT count(*) FROM linked k WHERE k.depth = n.depth + 1 AND k.parent_conv_id = n.conv_id) AS n_children
  FROM linked n)
SELECT v.conv_id, v.depth::BIGINT AS depth, v.parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children,
       count(*) FILTER (WHERE u.n_children = 0)::BIGINT AS n_leaves, sum((u.n_convs - 1) * u.w)::BIGINT AS saved_tokens, v.ends_sha256
FROM childless v JOIN childless u ON u.depth >= v.depth AND list_slice(u.p, 1, v.depth) = v.p
GROUP BY ALL"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, after moving the label of every seventh."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", label)


OP12_SQL = """
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
rows AS (SELECT vec_id, label, v::DOUBLE[] AS v FROM taken QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the long lines that five or more of them share, except in the largest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.kept_texts(docs, linededup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = """
WITH split AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, coalesce(max(doc_id)::VARCHAR, 'none') AS last FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'null')) >= 5),
marked AS (
  SELECT r, doc_id, pos, line, s.k IS NOT NULL AND coalesce(doc_id::VARCHAR, 'null') <> s.last AS gone
  FROM keyed LEFT JOIN shared s ON keyed.k = s.k)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r"""


QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_token_counts, op3_personal_data, op4_quality_rules, op5_sentencepiece, op6_warc_revisits,
    op7_minhash_neardup, op8_mixing, op9_toxicity, op10_secret_scan, op11_prefix_trie,
    op12_hard_negatives, op13_line_dedup)}

ORACLE_SQL: dict[str, str] = {"op6_warc_revisits": OP6_SQL, "op8_mixing": OP8_SQL, "op11_prefix_trie": OP11_SQL, "op12_hard_negatives": OP12_SQL,
                              "op13_line_dedup": OP13_SQL}
