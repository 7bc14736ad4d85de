import plain
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from velometry.llm import bpe, decontaminate, pii, repetition
from velometry.llm.queries import PATTERN, RANKS

SF = "/root/testdata/sf0.01"
RULES = repetition.RepetitionRules()


def passes(text):
    n, repeated, covered, longest = plain.repetition(text, RULES.window_words, RULES.least_words)
    return (
        n >= RULES.fewest_words
        and 100 * repeated <= RULES.window_percent * n
        and 100 * covered <= RULES.covered_percent * n
        and longest <= RULES.longest_words
    )


def brute_force(docs, items):
    """The rows that the stages should give, and the ids after each filter."""
    good = [(i, t) for i, t in docs if passes(t)]
    one = {c for _, _, c in plain.simhash_groups(good)}
    single = [(i, t) for i, t in good if i in one]
    lowered = [(t.lower(), int(len(t) * decontaminate.EDIT_RATE)) for t in items]
    clean = []
    for i, t in single:
        low = t.lower()
        # Of n + 1 pieces one is untouched; only then is the full table worth filling.
        near = [
            (x, k) for x, k in lowered
            if any(x[round(len(x) * j / (k + 1)) : round(len(x) * (j + 1) / (k + 1))] in low for j in range(k + 1))
        ]
        if not any(x in low or plain.infix_distance(x, low) <= k for x, k in near):
            clean.append((i, t))
    return [len(good), len(single), len(clean)], clean


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    counts, clean = brute_force([(r.doc_id, r.text) for r in docs.collect()], items)
    assert docs.count() > counts[0] > counts[1] > counts[2] > 0
    coder = tiktoken.Encoding("o", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = {}
    for i, text in clean:
        base = sorted((a, b) for _, a, b in plain.base_spans(text))
        redacted = pii.redact(text, pii.find_spans(text))
        assert not any(text[a:b] in redacted for a, b in base)
        want[i] = (redacted, coder.encode_ordinary(redacted))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(want)
    for i, (text, ids) in want.items():
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded_sha256 == plain.sha(text)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "benchmark decontamination", "PII", "byte-level BPE",
    ]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stage_on_odd_rows(spark, stage):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, text, "en", "s", len(text)), (1, text, "en", "s", len(text)), (2, None, None, None, None),
        (None, text + " mail a@b.cd", "en", "s", None), (None, None, None, None, None), (3, "", "en", "s", 0),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    wide = docs.select("*", F.lit(1).alias("fingerprint"), F.lit("x").alias("block"), F.lit(2).alias("__id"))
    last = stage is corpus_pipeline.tokens
    for df in (docs, wide):
        out = stage(spark, df, SF)
        assert out.count() > 0
        assert last or out.columns == df.columns
        assert last or out.dtypes == df.dtypes
    assert stage(spark, docs.limit(0), SF).count() == 0
