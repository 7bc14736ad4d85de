"""From raw documents to tokens: the stages, in order, each on all that the last one kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velometry.llm import bpe, decontaminate, pii, repetition, simhash
from velometry.llm.common import ensure_checkpoint_dir

#: Bits in which fingerprints of 3-word shingles may differ.
SIMHASH_WORDS, SIMHASH_BITS = 3, 2
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: SimHash, edit distance and BPE have no SQL; the tests chain brute-force versions.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of the smallest doc_id."""
    return simhash.keep_one(docs, SIMHASH_WORDS, SIMHASH_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the number of tokens, their ids, and the digest of the decoded bytes."""
    pattern = public_tokenizers.PATTERN
    encoded = bpe.encode_documents(docs, RANKS, pattern, offsets=False, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  Each stage is written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{number}")
    return docs
