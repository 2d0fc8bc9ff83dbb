"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmill.llm import bpe, langid, minhash, mixing, pii, simhash
from deskmill.llm.common import WORD, free_name, table, word_count
from deskmill.llm.queries import RANKS, language_model, ready
from deskmill.session import cuts_dropped, delete_folder, shared_dir

LEAST_SCORE = 0.5
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: not ``und``, and with a posterior of at least one half."""
    ready(spark)
    lang, score = (free_name(docs, c) for c in ("found_lang", "found_score"))
    found = langid.with_language(docs, language_model(docs), columns=(lang, score))
    return found.filter((F.col(lang) != langid.UND) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (Jaccard similarity of 5-word shingles of 0.8 or more), that with the smallest ``doc_id`` (then by text hash and columns).

    Candidates are the groups of the SimHash trie join over 5-word shingles, and min-max bands for copies that are further apart than its few
    bits; the whole sets decide. Rows without a ``doc_id`` or a word are not compared and stay; rows with the same ``doc_id`` and text are one.
    """
    ready(spark)
    compared = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    keyed = docs.filter(compared)
    prints = simhash.near_duplicates(keyed.select(F.xxhash64("text").alias("text_hash"), "text"), "text_hash", words_per_shingle=NEAR_WORDS)
    groups = prints.select("text_hash", F.col("component_id").alias("group")).distinct()
    # A row is told by doc_id and text, as rows may share a doc_id without being copies.
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    found = minhash.near_duplicates(keyed, percent=NEAR_PERCENT, words_per_shingle=NEAR_WORDS, also=groups).groupBy("component").agg(first)
    name = free_name(docs, "kept")
    kept = found.select(F.col("first.doc_id").alias(f"{name}_id"), F.col("first.text_hash").alias(f"{name}_hash"))
    same = (keyed["doc_id"] == F.col(f"{name}_id")) & (F.xxhash64(keyed["text"]) == F.col(f"{name}_hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = keyed.join(kept, same).groupBy(f"{name}_id", f"{name}_hash").agg(F.min_by(row, F.to_json(row)).alias(name))
    return rows.select(f"{name}.*").unionByName(docs.filter(~compared))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced; ``n_chars`` follows the text."""
    ready(spark)
    replaced = pii.pseudonymise(docs)
    return replaced.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else replaced


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ready(spark)
    prefix = free_name(docs, "mix")
    times = F.col(f"{prefix}_times")
    found = mixing.mix(docs, "doc_id", word_count(F.col("text")), "source", prefix=prefix).filter(times > 0)
    return found.withColumn(f"{prefix}_copy", F.explode(F.sequence(F.lit(1), times.cast("int")))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of the bytes they decode to."""
    ready(spark)
    return bpe.encode(docs, "doc_id", "text", public_tokenizers.path(RANKS), public_tokenizers.PATTERN, columns=("ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("pii", pseudonyms),
    ("mixing", mixed),
    ("byte_bpe", tokens),
]

# The models, fingerprints and tokens are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
        with cuts_dropped(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
