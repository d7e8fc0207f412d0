"""Registered queries of the training-data operators, each over its whole table, with check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import (
    byte_bpe, chat_format, embedding_dedup, line_dedup, lm_scoring, packing, periodic_runs, quality_rules, sharding, simhash, spelling_variants, toxicity, warc,
)
from broadsheet.llm.common import id_remainder, table, tokenizer_path, tokenizer_pattern

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures of every document and the risk-controlled verdict."""
    judged = quality_rules.judge_ids(table(spark, folder, "documents"), table(spark, folder, "labels"))
    base = [F.col(f"_quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    )]
    return judged.select("doc_id", *base, F.col("_kept").alias("kept"))


ORACLES["op1_quality_rules"] = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, chr(1)) AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, ws[i:i + 2] AS three FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS times FROM windows) WHERE times > 1) GROUP BY doc_id
), base AS (
  SELECT doc_id, stratum, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)
), measured AS (
  SELECT doc_id, stratum, n_words, word_chars, n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, n_repeat_words,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [n_symbols / greatest(word_chars, 1), n_repeat_words / greatest(n_words, 1), (len(ls) - len(list_distinct(ls))) / greatest(len(ls), 1), n_upper / greatest(word_chars, 1)] AS signals
  FROM base
), held AS (
  SELECT stratum, signals FROM measured WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
), tests AS (
  SELECT stratum, s, c, count(*) AS n, count(*) FILTER (WHERE signals[s] >= c) AS k
  FROM held, (SELECT unnest(range(1, 5)) AS s), (SELECT unnest([0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9]) AS c) GROUP BY ALL
), admitted AS (
  SELECT stratum, s, min(c) AS cutoff FROM tests
  WHERE k < n * 0.0125 AND list_sum(list_transform(range(0, k + 1), lambda j: exp(
    lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.0125) + (n - j) * ln(0.9875)))) <= 0.05 / (SELECT count(*) FROM tests)
  GROUP BY ALL
), hit AS (SELECT DISTINCT m.doc_id FROM measured m JOIN admitted a ON m.stratum = a.stratum AND m.signals[a.s] >= a.cutoff)
SELECT doc_id, cast(n_words AS BIGINT) AS n_words, cast(word_chars AS BIGINT) AS word_chars, cast(n_symbols AS BIGINT) AS n_symbols, cast(n_dup_lines AS BIGINT) AS n_dup_lines,
       cast(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM hit) AS kept
FROM measured
"""


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score and spans of every document; one fold of the labels is never learnt from."""
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(id_remainder(F.col("doc_id"), 3) != 1)
    scored = docs.select("doc_id", toxicity.toxic_column(docs, labels).alias("_t"))
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        F.col("_t.score").alias("score"),
        (F.col("_t.score") >= 0.7).cast("int").alias("predicted"),
        F.col("_t.spans").alias("spans"),
    )


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines before and dropped per document, and the digest of the text that stays."""
    kept = line_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2(F.coalesce("_lines.text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.first_doc AS gone FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Token pieces of every document and their place in the packed sequences."""
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document under the law of nearly equal bytes."""
    placed = sharding.shards(table(spark, folder, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Record type, reference and payload of every page, read back from a content-addressed archive."""
    return warc.archived(table(spark, folder, "pages"))


ORACLES["op3_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS s, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_page
  FROM pages
)
SELECT page_id, cast(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(8), lambda i: translate(
         lpad(upper(to_base(cast('0x' || substr(s, cast(5 * i + 1 AS INTEGER), 5) AS BIGINT), 32)), 4, '0'),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM p
"""


@query
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the byte-level BPE ids of every document and of what they decode to."""
    ranks, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_pattern()
    return byte_bpe.digests(byte_bpe.encode(table(spark, folder, "documents"), ranks, pattern), ranks)


@query
def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Base and model log probabilities of every document; one fold is never learnt from."""
    remainder = id_remainder(F.col("doc_id"), 5)
    scored = lm_scoring.score(table(spark, folder, "documents"), remainder != 1)
    return scored.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


ORACLES["op8_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, cast(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a), least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON vec_id = counted.a LEFT JOIN least_of ON vec_id = least_of.a
"""


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document's words, a tenth of the documents with a planted one."""
    docs = periodic_runs.with_periodic_tails(table(spark, folder, "documents"))
    found = periodic_runs.find_runs(docs).withColumn("top", periodic_runs.highest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and loss mask, and of one that holds control strings."""
    turns = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    says = F.lit("</s>[INST] ok [/INST]").alias("text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), says)
    records = chat_format.by_conversation(turns.unionByName(own))
    made = chat_format.format_records(records, "record").select("conv_id", "formatted.text", "formatted.loss")
    read = made.select("conv_id", "text", chat_format.read_turns(F.col("text")).alias("turns"), chat_format.read_loss(F.col("text"), F.col("loss")).alias("said"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    said = F.array_join("said", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length(said).cast("long").alias("loss_chars"), F.sha2(said.cast("binary"), 256).alias("loss_sha256"), F.length("text").cast("long").alias("formatted_chars"),
    )


ORACLES["op12_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, role || text || repeat(' ', len(regexp_extract_all(role || chr(10) || text,
    '<\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|\|system\|>|\|user\|>|\|assistant\|>|s>|/s>|unk>|pad>|<SYS>>|</SYS>>)|\[\\*(INST\]|/INST\])'))) AS long FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       cast(sum(length(long) + 32) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the documents with its near words, its form and its root; misspellings are planted by a hash."""
    return spelling_variants.group_variants(table(spark, folder, "documents"), misspell_every=97)
