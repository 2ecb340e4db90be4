"""A training-data pipeline over ``documents``: each stage reads what the one before it kept.

The stages, each one call of an operator of lawloom.llm: language ID (rows whose
language is unknown or uncertain go), MinHash near-dedup (one document of each
group stays), suffix-array dedup (repeated passages go), mixing of sources to
target weights (rows come as often as the mix takes them), packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm import langid, minhash, mixing, packing, suffix
from lawloom.llm.queries import PASSAGE_BYTES, WORD_BPE, tokenizer_path
from lawloom.llm.scratch import new_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a probability of one half at least.

    Null texts and those without a letter go; repeated rows stay or go together; nothing of an empty table stays.
    """
    return langid.accepted(docs, langid.fit_language_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near duplicates (sets of five-word shingles, 0.8 or more).

    Null and empty texts are near to nothing and stay, as do rows without a doc_id. Rows that share the doc_id
    of a group's first document are one document to this stage: all of them stay, so ids should be unique.
    """
    kept = minhash.near_duplicates(docs, words=5, percent=80).where("kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns).unionByName(docs.where("doc_id is null"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of ``PASSAGE_BYTES`` or more (fifty words of four letters and a blank) that occur elsewhere too.

    Every occurrence goes, the first one too, so that no document keeps boilerplate. Null and empty texts and
    repeated rows stay as rows; the text of a row that repeats as a whole becomes empty.
    """
    return suffix.clean_texts(docs, PASSAGE_BYTES)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it, up to three times; documents without words (null and empty texts) go."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids; a null or empty text is its end id alone."""
    return packing.pack_documents(docs, tokenizer_path(WORD_BPE), 2048, 1, cached_words=200_000, keep_words=False)


STAGES = [
    ("language_id", keep_known_languages),
    ("minhash_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("mixing", mix_to_weights),
    ("packing", pack),
]

#: No stage but the mixing of given sizes has a form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.select([F.col(c) for c in docs.columns])
