"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import (
    alignment,
    block_anchors,
    dart_minhash,
    filter_audit,
    line_dedup,
    mixing,
    pairwise_quality,
    pieces,
    pii,
    quality_rules,
    secrets,
    url_filter,
    vafile,
)
from weir.llm.common import read

#: Folder of public tokenizer files, and the model used.
TOKENIZERS = os.environ.get("WEIR_TOKENIZERS", "/opt/tokenizers")
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
BYTES = f"{TOKENIZERS}/byte_bpe_50k.json"

URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``position`` is the first time a document is trained on, in 0..1."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.cycling_schedules(docs))
    first = F.round(F.get("positions", F.lit(0)), 6).alias("position")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", first)


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    seen = labels.where(~pairwise_quality.held_out(F.col("doc_id")))
    return pairwise_quality.rank(docs, pairwise_quality.learn(docs, seen))


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = dart_minhash.near_duplicate_classes(read(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "lines_removed")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(read(spark, sf_dir, "embeddings"), k=5, every=50)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_rules.judge(docs, quality_rules.learn(docs, labels))


def op9_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_anchors.remove_repeats(read(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(read(spark, sf_dir, "documents"), PIECES)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), BYTES, PIECES)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find(read(spark, sf_dir, "documents")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = filter_audit.text_filters(F.col("text"))
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), filters)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_pairwise_quality": op2_pairwise_quality,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_url_filter": op4_url_filter,
    "op5_line_dedup": op5_line_dedup,
    "op6_secrets": op6_secrets,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_quality_rules": op8_quality_rules,
    "op9_block_anchors": op9_block_anchors,
    "op10_pieces": op10_pieces,
    "op11_alignment": op11_alignment,
    "op12_pii": op12_pii,
    "op13_filter_audit": op13_filter_audit,
}

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source
),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0) AS DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM s
  WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
t AS (
  SELECT source, source_size, weight,
         least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target,
         CASE weight WHEN 5 THEN weight * 1.5 WHEN 1 THEN weight * 0.5 ELSE weight END AS w0,
         CASE weight WHEN 5 THEN -weight WHEN 1 THEN weight ELSE 0 END AS slope
  FROM l
),
p AS (
  SELECT d.doc_id, d.size, t.*,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS DOUBLE) AS x
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * ((size > 0 AND x + size / 2 < target)::INT
            + (size > 0 AND x + source_size + size / 2 < target)::INT
            + (size > 0 AND x + 2 * source_size + size / 2 < target)::INT) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND x + size / 2 < target THEN
         round(least(1.0, 2 * x * (weight / target)
           / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * (x * (weight / target)), 0.0)))), 6)
       END AS position
FROM p
"""

OP5_SQL = r"""
WITH l AS (
  SELECT DISTINCT doc_id, source, trim(line, E' \t\n\x0b\x0c\r') AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, E'\n')) AS line FROM documents)
  WHERE trim(line, E' \t\n\x0b\x0c\r') <> ''
),
b AS (
  SELECT line, min(doc_id) AS first FROM l GROUP BY line HAVING count(DISTINCT source) >= 10
),
c AS (
  SELECT l.doc_id, list(line) AS cut FROM l JOIN b USING (line)
  WHERE l.doc_id <> b.first GROUP BY l.doc_id
),
r AS (
  SELECT d.doc_id, string_split(d.text, E'\n') AS lines, c.cut
  FROM documents d LEFT JOIN c USING (doc_id)
),
k AS (
  SELECT doc_id, lines, CASE WHEN cut IS NULL THEN lines
    ELSE list_filter(lines, lambda x: NOT list_contains(cut, trim(x, E' \t\n\x0b\x0c\r'))) END AS kept
  FROM r
)
SELECT doc_id, coalesce(array_to_string(kept, E'\n'), '') AS text,
       CAST(len(lines) - len(kept) AS BIGINT) AS lines_removed
FROM k
"""

OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
),
s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM t WHERE len(words) >= 50
),
h AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM s
),
f AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM h
),
c AS (
  SELECT DISTINCT doc_id, i + k AS i FROM f, unnest(range(0, 50)) AS u(k) WHERE first < doc_id
),
w AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM t
),
k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM w ANTI JOIN c USING (doc_id, i) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)
"""

OP13_SQL = r"""
WITH l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
),
t AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY t) AS first
  FROM t
),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(words) < 100)::INT
         + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(w.doc_id > first, false)::INT AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
),
r AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL
),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
s AS (
  SELECT filter_order, CAST(step AS INT) AS step, bits[step] AS bit,
         coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, unnest([1, 2, 3, 4, 5]) u(step)
),
x AS (
  SELECT part, filter_order, step, bit,
         CAST(sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM r, s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM x
"""

ORACLES: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op5_line_dedup": OP5_SQL,
    "op7_exact_top_k": OP7_SQL,
    "op9_block_anchors": OP9_SQL,
    "op13_filter_audit": OP13_SQL,
}
