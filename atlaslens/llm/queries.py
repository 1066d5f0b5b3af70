"""The queries of this package and, where SQL can express them, the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from atlaslens.llm import (
    chat, collocations, hardneg, html_blocks, langid, mixing, ngram_join, packing, pii, quality, rpforest, rules, sharding,
)
from atlaslens.llm.common import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op3_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed_counts(mixing.plan_mix(docs))


# Seats one by one from the quotients, which the operator does not do.
ORACLES["op3_sainte_lague_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix-1:' || doc_id), 1, 8) AS BIGINT) AS number, md5('mix-1:order:' || doc_id) AS place
  FROM documents
), s AS (
  SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL
), w AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS most FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW o AS (ORDER BY most / weight, key)
), t AS (
  SELECT key, source_size, least(weight * max(level) OVER (), most) AS target FROM l
), n AS (
  SELECT CAST(round(sum(target) / 64) AS BIGINT) AS seats FROM t
), q AS (
  SELECT key, target / (2 * k - 1) AS quotient FROM t, n, range(1, CAST(seats AS BIGINT) + 1) r(k) WHERE target > 0
), b AS (
  SELECT key, count(*) AS blocks FROM (SELECT key FROM q ORDER BY quotient DESC, key LIMIT (SELECT seats FROM n)) GROUP BY key
), p AS (
  SELECT d.*, source_size, target, coalesce(blocks, 0) AS blocks, number % greatest(1, least(4096, CAST(ceil(source_size / 65536) AS BIGINT))) AS shard
  FROM d JOIN t USING (key) LEFT JOIN b USING (key)
), h AS (
  SELECT key, shard, blocks, CAST(sum(size) AS BIGINT) AS shard_size FROM p GROUP BY ALL
), hq AS (
  SELECT key, shard, shard_size, blocks, shard_size / (2 * k - 1) AS quotient FROM h, range(1, CAST(blocks AS BIGINT) + 1) r(k) WHERE shard_size > 0
), hr AS (
  SELECT key, shard, CASE WHEN row_number() OVER (PARTITION BY key ORDER BY quotient DESC, shard) <= blocks THEN 1 ELSE 0 END AS won FROM hq
), g AS (
  SELECT key, shard, CAST(sum(won) AS BIGINT) AS quota FROM hr GROUP BY ALL
), f AS (
  SELECT p.*, shard_size, least(64 * coalesce(quota, 0), 2 * shard_size) AS takes,
    sum(size) OVER (PARTITION BY p.key, p.shard ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
  FROM p JOIN h ON p.key = h.key AND p.shard = h.shard LEFT JOIN g ON p.key = g.key AND p.shard = g.shard
)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, takes - start)) + greatest(0, least(size, takes - shard_size - start)) AS BIGINT) AS taken
FROM f
"""


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents")).drop("mark")


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    awkward = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", awkward), (-1, 1, "assistant", awkward)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.read_back(chat.format_conversations(turns)))


ORACLES["op6_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?s>|/?ROLE\]|/?INST\])', '\1\2\\\3', 'g') AS r,
    regexp_replace(text, '([<\[])(\\*)(/?s>|/?ROLE\]|/?INST\])', '\1\2\\\3', 'g') AS x FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<s>[ROLE]' || r || '[/ROLE]' || x || '</s>')) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"]
    return rules.score(table(spark, sf_dir, "documents")).select(*names)


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


@query
def op1_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.train(pages))


@query
def op2_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


# Bucket sums at every depth, one after another; the given tables repeat no doc_id, so 60 bits are enough.
ORACLES["op2_extendible_shards"] = """
WITH d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents
), e AS (
  SELECT d.*, CAST(k AS INTEGER) AS depth, h >> (60 - k) AS above FROM d, range(0, 41) r(k)
), s AS (
  SELECT depth, above, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_documents FROM e GROUP BY ALL
), f AS (
  SELECT doc_id, n_bytes, depth, above, shard_bytes, shard_documents,
    row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS r
  FROM e JOIN s USING (depth, above) WHERE shard_bytes <= 1048576 OR shard_documents = 1
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(above), depth, '0') END AS shard, depth, shard_bytes, shard_documents
FROM f WHERE r = 1
"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings")
    return hardneg.mine(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))


# Every anchor against every row.
ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""


@query
def op12_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


@query
def op13_phrase_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


# Phrases as lists of words, looked up by equality.
ORACLES["op13_phrase_streams"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), s AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS words FROM s
), t AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang
), f AS (
  SELECT lang, phrase, count(*) AS f FROM (
    SELECT lang, words[i : i + m - 1] AS phrase FROM w, range(1, 6) r(m), unnest(range(1, CAST(greatest(1, len(words) - m + 2) AS BIGINT))) u(i)
  ) GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT lang, phrase, f AS a FROM f WHERE len(phrase) > 1
), gone AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN (
    SELECT lang, a, phrase[i : i + m - 1] AS part FROM c, range(2, 5) r(m), unnest(range(1, CAST(greatest(1, len(phrase) - m + 2) AS BIGINT))) u(i) WHERE m < len(phrase)
  ) x ON c.lang = x.lang AND c.phrase = x.part AND 100 * x.a >= 100 * c.a
), k AS (
  SELECT lang, phrase, a, k FROM c ANTI JOIN gone USING (lang, phrase), unnest(range(1, CAST(len(phrase) AS BIGINT))) u(k)
), v AS (
  SELECT k.lang, k.phrase, a, x.f AS l, y.f AS r, n, (1000 * a::HUGEINT * n) // (x.f::HUGEINT * y.f) AS score, k
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.phrase[1 : k] JOIN f y ON y.lang = k.lang AND y.phrase = k.phrase[k + 1 :] JOIN t ON t.lang = k.lang
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER o AS rank, array_to_string(phrase, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM v WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) QUALIFY row_number() OVER o <= 2000
"""
