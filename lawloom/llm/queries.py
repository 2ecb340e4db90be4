"""The thin queries over whole tables, one for each operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm import filter_audit, grammar_files, hard_negatives, langid, main_text, media, minhash, mixing, oracles, packing, suffix, token_counts, urls, vectors

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
BYTE_BPE_SIZE = 50257
PASSAGE_BYTES = 250
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), 2048, 1, cached_words=1_200_000)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_lengths(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE)))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar_files.token_files(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), BYTE_BPE_SIZE, 0)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"), 0.95)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), RULES)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes go; n_passage_bytes also reports passages of fifty words of four letters and a blank, as the pipeline's stage removes them."""
    return suffix.digests(_table(spark, sf_dir, "documents"), 400, passage=PASSAGE_BYTES)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.image_features(media.media_table(_table(spark, sf_dir, "documents")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return langid.predict_languages(docs, langid.fit_language_model(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_text(_table(spark, sf_dir, "pages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_token_counts, op3_token_files, op4_near_vectors, op5_url_filter, op6_suffix_dedup, op7_minhash, op8_media, op9_mixing, op10_language, op11_filter_audit, op12_html_text, op13_hard_negatives)}


#: The others depend on a tokenizer, a model, a hash or a free layout; they are tested against brute force.
ORACLES: dict[str, str] = {"op4_near_vectors": oracles.near_vectors(0.95), "op6_suffix_dedup": oracles.repeated_strings(400, PASSAGE_BYTES), "op7_minhash": oracles.near_documents(4, 80), "op11_filter_audit": oracles.filter_orders("ABCDE"), "op13_hard_negatives": oracles.hard_negatives()}
