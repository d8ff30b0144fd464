"""The registered queries of the training-data operators.

Each reads whole tables and gets its rows through its operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, chatwindows, decontaminate, packing, pairrank, parityjoin, pii, quality, substrings,
    treap, urlratio, whitening, wordpieces,
)
from .common import table
from .registry import ORACLES, QUERIES, query

URL_RULES = {
    "net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow",
}


@query()
def op1_url_language_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page by rule, or by the ratio of two character models."""
    return urlratio.judge(table(spark, sf_dir, "pages"), URL_RULES)


CONTROL_TEXT = "</s>[INST] ok [/INST]"
# Escaped length and prefix sums restated from their definition: the text with
# every "&" and every control string four (or three) characters longer.
OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tok,
    length(role) + length(text) + length('<|start|><|says|><|end|>')
      + 4 * (length(role || text) - length(replace(role || text, '&', '')))
      + 3 * len(regexp_extract_all(role || chr(10) || text, '<\||<</?SYS>>|</?s>'))
      + 4 * len(regexp_extract_all(role || chr(10) || text, '\[/?INST\]')) AS chars
  FROM t
), s AS (
  SELECT *, place = 1 AND role = 'system' AS sys FROM n
), p AS (
  SELECT *, greatest(768 - coalesce(max(CASE WHEN sys THEN tok END) OVER (PARTITION BY conv_id), 0), 1) AS room,
    max(CASE WHEN sys THEN chars ELSE 0 END) OVER (PARTITION BY conv_id) AS sys_chars,
    sum(CASE WHEN sys THEN 0 ELSE tok END) OVER (PARTITION BY conv_id ORDER BY place) AS e
  FROM s
), q AS (
  SELECT *, CASE WHEN sys THEN 0 ELSE e - tok END AS b, greatest((e - 1) // room, 0) AS g FROM p
), r AS (
  SELECT *, 2 * g + CASE WHEN NOT sys AND b // room < g THEN 0 ELSE 1 END AS span FROM q
), o AS (
  SELECT *, lag(span) OVER (PARTITION BY conv_id ORDER BY place) IS DISTINCT FROM span AS opens FROM r
), again AS (
  SELECT o.conv_id, sum(h.chars) AS chars FROM o JOIN o h ON h.conv_id = o.conv_id
    AND h.place BETWEEN o.place - 8 AND o.place - 1 AND NOT h.sys AND o.b - h.b <= 256
  WHERE o.opens GROUP BY 1
), f AS (
  SELECT conv_id, sum(CASE WHEN opens AND NOT sys THEN sys_chars ELSE 0 END) AS chars,
    count(*) FILTER (opens) AS n_windows FROM o GROUP BY 1
)
SELECT o.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(o.chars) + any_value(f.chars) + coalesce(any_value(again.chars), 0) AS BIGINT) AS formatted_chars,
  CAST(any_value(n_windows) AS BIGINT) AS n_windows
FROM o JOIN f USING (conv_id) LEFT JOIN again USING (conv_id) GROUP BY o.conv_id
"""


@query(OP2_SQL)
def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every conversation, read back from its budgeted windows."""
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chatwindows.digests(chatwindows.windows(given.unionByName(own)))


@query()
def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether rules and distance keep it."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query()
def op4_word_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return wordpieces.count_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


@query()
def op5_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from preference pairs."""
    return pairrank.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to."""
    return bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query()
def op7_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of a benchmark item, with the item."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_difference_cover_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that earlier text repeats, and what remains."""
    return substrings.deduplicate(table(spark, sf_dir, "documents"))


@query()
def op9_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, by shingle similarity."""
    return parityjoin.link(table(spark, sf_dir, "documents"))


@query()
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, disguised writing included."""
    return pii.detect(table(spark, sf_dir, "documents"))


@query()
def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable embedding, fitted on the distinct ones."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), u AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
s AS (SELECT count(*) AS docs, sum(n) :: BIGINT AS len FROM u),
q AS (
  SELECT i, item_id, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS again
  FROM (
    SELECT row_number() OVER () AS i, item_id,
      unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY ALL
), t AS (
  SELECT r, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS tf
  FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2.0 :: DOUBLE * docs + 2) / (2 * count(*) + 1))) :: BIGINT AS w
  FROM t, s WHERE term IN (SELECT term FROM q) GROUP BY term, docs
), g AS (
  SELECT i, item_id, r, doc_id,
    sum(again * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len)))) :: BIGINT AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN u USING (r), s GROUP BY ALL
), p AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM g WHERE score > 0
)
SELECT item_id, rank :: INT AS rank, doc_id, score FROM p WHERE rank <= 20
"""


@query(OP12_SQL)
def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    index = treap.build(table(spark, sf_dir, "documents"))
    return treap.search(index, table(spark, sf_dir, "benchmark"), 20)


@query()
def op13_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False
    )
