"""The operators as queries over the test tables, and the SQL that their results are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    embedding_dedup,
    mixing,
    packing,
    periodic_runs,
    pii,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    token_counts,
    url_filter,
    warc,
    whitening,
)
from ledgerline.llm.common import WORD, read

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_documents(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN, with_ids)


def op1_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("n_spans")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"))


def op8_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.with_shard(read(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; by a hash of its id, a tenth of the documents repeats a stretch of its words to the end."""
    words, n = F.col("words"), F.size("words")
    share = (F.col("hash") / 10).cast("bigint")
    cut = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("hash")).select(
        "doc_id", "text", share.alias("g"),
        F.when(F.col("hash") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))).alias("words")).select(
        "*", F.when(n > 0, F.col("g") % n).cast("int").alias("a")).select(
        "*", F.expr("1 + (size(words) - a) div (3 + g % 8)").cast("int").alias("p"))
    rest = n - F.col("a")
    stretch = F.slice(words, F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(stretch, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("a")), repeated), " ")
    return cut.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse(with_planted_runs(read(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Query]:
    return {
        "op1_embedding_groups": op1_embedding_groups,
        "op2_repeated_passages": op2_repeated_passages,
        "op3_packing": op3_packing,
        "op4_token_counts": op4_token_counts,
        "op5_url_filter": op5_url_filter,
        "op6_simhash_groups": op6_simhash_groups,
        "op7_personal_data": op7_personal_data,
        "op8_shard_lookup": op8_shard_lookup,
        "op9_quality_rules": op9_quality_rules,
        "op10_source_mixing": op10_source_mixing,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_warc_archives": op13_warc_archives,
    }


OP1_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(vec_id = coalesce(component_id, vec_id), false) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN counted ON counted.a = vec_id
"""

OP2_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs WHERE len(words) >= 13)),
firsts AS (SELECT content, min(doc_id) AS first FROM windows GROUP BY content),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM windows JOIN firsts USING (content) WHERE first < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS rest, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM docs)
  ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP5_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
places AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT p.page_id, p.host, p.path,
       (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
         WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS rule,
       coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
         WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)), 'allow') AS verdict
FROM places p
"""


OP10_SQL = r"""
WITH counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols FROM documents),
drawn AS (
  SELECT *, floor((1 - pow((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE,
                           1 / greatest(0.1::DOUBLE, 1 - symbols / greatest(size, 1)::DOUBLE))) * 17592186044416.0::DOUBLE)::BIGINT AS at
  FROM counted),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM counted GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS rank, (3 * source_size)::DOUBLE AS cap,
         ([1.0, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT])::DOUBLE AS weight FROM sources),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
targets AS (
  SELECT source, source_size, CASE WHEN cap / weight < level THEN cap
         ELSE weight * max(CASE WHEN cap / weight >= level THEN level END) OVER () END AS target FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets),
summed AS (
  SELECT d.doc_id, d.source, d.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.at, coalesce(d.doc_id, -9223372036854775808), d.size) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.at, d.doc_id, d.size) AS words
  FROM drawn d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source),
chosen AS (SELECT *, least(3, epochs + CASE WHEN rest > 0 AND upto - words / 2 <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM summed)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * copies)::BIGINT AS taken, source, copies FROM chosen
"""

OP13_SQL = """
WITH payloads AS (SELECT page_id, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, ''))::BIGINT AS bytes FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM payloads WHERE bytes >= 100 GROUP BY digest)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (digest)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_embedding_groups": OP1_SQL, "op2_repeated_passages": OP2_SQL, "op5_url_filter": OP5_SQL,
            "op10_source_mixing": OP10_SQL, "op13_warc_archives": OP13_SQL}
