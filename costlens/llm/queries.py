"""One query per corpus operator over the shared tables, with oracle SQL where SQL can say it.

Each callable takes ``(spark, sf_dir)`` and applies its operator, with production
parameters, to the whole intended table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from costlens.llm import (
    bpe,
    chat,
    decontaminate,
    html_text,
    near_dedup,
    periodic_runs,
    quality,
    secret_scan,
    sharding,
    spelling,
    token_counts,
    topk,
    toxicity,
)
from costlens.llm.common import table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(RANK_FILE),
        public_tokenizers.PATTERN,
        with_ids=False,
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(table(spark, sf_dir, "conversations"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_FILE)
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), drop_every=199)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.repeated_runs(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_html_text": op3_html_text,
    "op4_secret_scan": op4_secret_scan,
    "op5_topk": op5_topk,
    "op6_sharding": op6_sharding,
    "op7_decontaminate": op7_decontaminate,
    "op8_near_dedup": op8_near_dedup,
    "op9_chat": op9_chat,
    "op10_quality": op10_quality,
    "op11_token_counts": op11_token_counts,
    "op12_spelling": op12_spelling,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    # every component quantized, every pair scored, ranked with ties to smaller ids
    "op5_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    # every run of words looked up among the benchmark's windows
    "op7_decontaminate": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS words
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS words
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, words)),
spots AS (
  SELECT doc_id, count(DISTINCT s) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(s) GROUP BY 1
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         sha256(string_agg(DISTINCT item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM hits GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    # all pairs that share a shingle, their exact similarity, and the closure of the links
    "op8_near_dedup": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, w[i:i + 3] AS s
  FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
), m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
""",
    # turns and texts from the table itself; only the length follows the template
    "op9_chat": """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), l AS (
  SELECT *, role || chr(10) || text || chr(10) AS said,
         CASE WHEN role = 'assistant' THEN text ELSE '' END AS learnt,
         length(role) + length(text) + length(regexp_replace(role || text, '[^&<\\[]', '', 'g')) + 8
           AS written
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(learnt)) AS BIGINT) AS loss_chars,
       sha256(string_agg(learnt, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(written) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
""",
}
