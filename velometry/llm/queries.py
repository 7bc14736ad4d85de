"""Named queries of this folder: each operator over its whole table.

The operators give texts, spans, records and files; a query only digests them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velometry.llm import (
    bpe,
    chat,
    decontaminate,
    langid,
    merkle,
    negatives,
    pii,
    repetition,
    simhash,
    sketches,
    substrings,
    url_filter,
    warc,
)
from velometry.llm.common import ensure_checkpoint_dir, stored

Query = Callable[..., DataFrame]

_QUERIES: dict[str, Query] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
RULES = (
    url_filter.rule("allow", "com/"),
    url_filter.rule("block", "example.com/en/"),
    url_filter.rule("allow", "www.example.com/en/"),
    url_filter.rule("block", "net/es/"),
    url_filter.rule("block", "net/fr/"),
)
#: A conversation whose texts hold the template's control strings.
TRICKY_ID, TRICKY_TEXT = -7, "\\### Assistant: </turn> ok"


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query
def op1_chat_format(spark, sf):
    tricky = spark.range(2).select(
        F.lit(TRICKY_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY_TEXT).alias("text"),
    )
    own = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat.format_chats(own.unionByName(tricky))
    read = chats.select(
        "conv_id",
        "valid",
        "formatted",
        chat.parse_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha256(F.concat_ws("", lines)).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        _sha256(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


@query
def op2_url_filter(spark, sf):
    return url_filter.judge_urls(_table(spark, sf, "pages"), RULES, url_filter.wide_vocabulary())


@query
def op3_warc(spark, sf):
    marked = warc.mark_revisits(_table(spark, sf, "pages"))
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    archives = warc.store_archives(warc.write_archives(marked), folder)
    return warc.read_archives(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"
    )


@query
def op4_pii(spark, sf):
    found = pii.find_pii(_table(spark, sf, "documents"))

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s.kind == kind)
        if kind == "card":  # a part of a longer run of digits is the method's own
            own = F.filter("spans", lambda s: (s.kind == kind) & s.base)
        return F.size(own).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", s.kind, s.start.cast("string"), s.end.cast("string")
                ),
            ),
            ",",
        )

    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.BASE),
        _sha256(joined(F.filter("spans", lambda s: s.base))).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op5_byte_bpe(spark, sf):
    documents = _table(spark, sf, "documents")
    encoded = bpe.encode_documents(documents, RANKS, PATTERN, offsets=False, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_substring_dedup(spark, sf):
    digest = F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    kept, extended = substrings.drop_and_extend(_table(spark, sf, "documents"), 13, digest)
    longest = F.coalesce("longest", F.lit(0).cast("long")).alias("longest_repeat")
    return kept.join(extended, "doc_id", "left").select(*kept.columns, longest)


@query
def op7_decontamination(spark, sf):
    return decontaminate.find_benchmark(
        _table(spark, sf, "documents"), _table(spark, sf, "benchmark")
    )


@query
def op8_quality_rules(spark, sf):
    return repetition.judge_documents(_table(spark, sf, "documents"))


@query
def op9_simhash(spark, sf):
    found = simhash.near_duplicates(_table(spark, sf, "documents"), words=3, distance=2)
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op10_language_id(spark, sf):
    documents = _table(spark, sf, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.learn(documents.filter(~out & F.col("doc_id").isNotNull()))
    return langid.predict(documents, model).withColumn("held_out", out)


@query
def op11_fingerprints(spark, sf):
    found = sketches.edit_documents(_table(spark, sf, "documents"))
    own, edited = F.col("sketch"), F.col("edited_sketch")
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        _sha256(F.col("edited")).alias("edited_sha256"),
        sketches.as_text(own).alias("fingerprint"),
        sketches.as_text(edited).alias("edited_fingerprint"),
        sketches.resemblance(own, edited).alias("near_edited"),
        sketches.resemblance(own, F.col("next_sketch")).alias("near_next"),
        sketches.containment(own, edited).alias("in_edited"),
        sketches.distinct_shingles(own).alias("n_shingles"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    )


@query
def op12_hard_negatives(spark, sf):
    rows = negatives.clean_vectors(_table(spark, sf, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = stored(rows.withColumn("label", label))
    return negatives.mine(rows, rows.filter("vec_id % 100 = 0"))


@query
def op13_merkle(spark, sf):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    shown = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    leaves = merkle.leaves(_table(spark, sf, "documents"), {"text": shown})
    return merkle.manifest(leaves).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
