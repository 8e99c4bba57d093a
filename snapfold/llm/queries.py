"""The queries of this package, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.llm import (
    chat, convnet, jaccard, language, linededup, merkle, mixing, neighbours, packing, phrases, quality, substrings, tokenfiles,
)
from snapfold.llm.oracles import ORACLES as LATER_ORACLES
from snapfold.llm.textcols import lower_ascii


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_amounts(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hostile = f"{chat.CLOSE}{chat.ROLE} ok {chat.SAID}"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hostile).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(turns.unionByName(extra)))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = tokenfiles.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return tokenfiles.read_tokens(written)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    net = convnet.fit(docs, _table(spark, sf_dir, "labels"))
    return convnet.scored(docs, net).select(
        "doc_id", convnet.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    docs = _table(spark, sf_dir, "documents")
    return merkle.prove(merkle.build(docs, {"text": F.when(tampered, lower_ascii(F.col("text")))}))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_projection_forest": op4_projection_forest,
    "op5_sequence_packing": op5_sequence_packing,
    "op6_source_mixing": op6_source_mixing,
    "op7_weak_supervision": op7_weak_supervision,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_files": op10_token_files,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    **LATER_ORACLES,
    "op6_source_mixing": rf"""
WITH sizes AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
named AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS cap FROM totals),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM totals)::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER f, 0))
      / sum(weight) OVER r AS level
  FROM named WINDOW
    f AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    r AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
targets AS (
  SELECT source, source_size,
    CASE WHEN level * weight >= cap THEN cap
         ELSE (SELECT max(level) FROM levels WHERE level * weight < cap) * weight END AS target
  FROM levels),
offered AS (
  SELECT row, doc_id, s.source, size, source_size, target,
    sum(size) OVER (PARTITION BY s.source ORDER BY copy, md5('7:' || copy || ':' || doc_id), doc_id, size, row
                    ROWS UNBOUNDED PRECEDING) AS upto
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) c(copy))
SELECT doc_id, size, source_size, target,
  sum(greatest(0, least(size, round(target)::BIGINT - (upto - size))))::BIGINT AS taken
FROM offered GROUP BY row, doc_id, source, size, source_size, target
""",
    "op8_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
    length(role) + length(coalesce(text, ''))
    + len(regexp_extract_all(role || chr(10) || coalesce(text, ''),
        '\\|<s>|</s>|\[INST\]|\[/INST\]|<image |<audio |<document ')) AS size
  FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size + length('<s>[INST][/INST]</s>'))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
""",
    "op9_line_dedup": r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, i, parts[i] AS line,
    translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM texts, unnest(range(1, len(parts) + 1)) AS u(i)),
first AS (SELECT key, min(doc_id) AS holder FROM lines WHERE length(key) >= 10 GROUP BY key)
SELECT doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (holder < doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (holder IS NULL OR holder >= doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN first USING (key) GROUP BY doc_id
""",
}
