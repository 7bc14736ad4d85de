import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from velometry.llm import substrings as s


def check(spark, rows, size=13):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = s.drop_repeated(df, size).collect()
    want = [
        (doc, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
        for (doc, _), (words, gone) in zip(rows, plain.removed(rows, size))
    ]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    return want


def random_rows(rng, n, words, most):
    shared = [" ".join(rng.choices(words, k=rng.randint(5, 30))) for _ in range(4)]
    rows = []
    for doc in rng.sample(range(1000), n):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, most))) for _ in range(2)]
        parts.insert(rng.randint(0, 2), rng.choice(shared) if rng.random() < 0.6 else "")
        rows.append((doc, rng.choice(["\n", " ", "\t \x0b"]).join(parts)))
    return rows


@pytest.mark.parametrize("size", [2, 3, 4, 5, 13])
@pytest.mark.parametrize("block", [200, 1 << 22])
def test_equals_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(s, "BLOCK_BYTES", block)
    monkeypatch.setattr(s, "PART_BYTES", 2 * block)
    rng = random.Random(size)
    words = [f"w{i}" for i in range(6 if size < 6 else 3)]
    want = check(spark, random_rows(rng, 60, words, 25), size)
    assert any(r[2] for r in want)


def test_documents_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(s, "PART_BYTES", 100_000)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = check(spark, [(r.doc_id, r.text) for r in df.collect()])
    assert any(r[2] for r in want)


def test_long_passage_and_copies(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_BYTES", 2_000)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} {passage} c{i}") for i in range(40)]
    rows += [(100 + i, passage) for i in range(30)]
    want = check(spark, rows)
    assert [r[2] for r in want] == [0] + [60] * 69


def test_nulls_ties_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(14))
    rows = [(3, text), (3, text), (None, text), (5, text), (5, text + " é"), (7, None), (8, ""), (9, "w1 w2")]
    check(spark, rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("block", F.lit("x"))
    df = df.withColumn("hashes", F.lit(1))
    assert s.drop_repeated(df).count() == len(rows)
    assert s.drop_repeated(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="two words"):
        s.drop_repeated(df, 1)


def test_a_repeat_inside_one_document_stays(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    want = check(spark, [(1, passage + " x " + passage), (0, "other")])
    assert want[0][2] == 0


def test_very_long_text(spark):
    long = " ".join(str(i) for i in range(400_000))
    rows = [(1, long), (2, " ".join(str(i) for i in range(1000, 3000)))]
    want = check(spark, rows)
    assert [r[2] for r in want] == [0, 2000]


def test_least_of():
    values = np.random.default_rng(1).integers(0, 1 << 60, 50).astype(np.uint64)
    for size in range(1, 12):
        want = [values[i : i + size].min() for i in range(len(values) - size + 1)]
        assert s.least_of(values, size).tolist() == want


def test_exchange_of_texts_is_reused(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = s.drop_repeated(df)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


@pytest.mark.parametrize("block", [400, 1 << 22])
def test_longest_repeats_doubles_until_none_is_left(spark, monkeypatch, block):
    monkeypatch.setattr(s, "BLOCK_BYTES", block)
    monkeypatch.setattr(s, "PART_BYTES", 2 * block)
    rng = random.Random(6)
    rows = random_rows(rng, 40, [f"w{i}" for i in range(9)], 25)
    rows += [(2000, " ".join(f"p{i}" for i in range(70))), (2001, "x " + " ".join(f"p{i}" for i in range(50)))]
    rows += [(None, rows[0][1]), (2002, None), (2003, "")]

    def held(size):
        seen = {}
        for n, (doc, text) in enumerate(rows):
            own = (text or "").split() if doc is not None else []
            for i in range(len(own) - size + 1):
                seen.setdefault(tuple(own[i : i + size]), set()).add(n)
        return {rows[n][0] for v in seen.values() if len(v) > 1 for n in v}

    want, size = {}, 3
    while here := held(size):
        want |= dict.fromkeys(here, size)
        size *= 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.longest for r in s.longest_repeats(df, 3).collect()}
    assert got == want and want[2000] == want[2001] == 48
    assert s.longest_repeats(df.limit(0)).count() == 0


def longest_before(rows, size):
    """For each doc_id the longest doubled length at which a smaller doc_id has a window of it."""
    want = {}
    while True:
        least = {}
        for doc, text in rows:
            own = (text or "").split() if doc is not None else []
            for i in range(len(own) - size + 1):
                key = tuple(own[i : i + size])
                least[key] = min(doc, least.get(key, doc))
        here = {
            doc
            for doc, text in rows
            if doc is not None
            for own in [(text or "").split()]
            if any(least[tuple(own[i : i + size])] < doc for i in range(len(own) - size + 1))
        }
        if not here:
            return want
        want |= dict.fromkeys(here, size)
        size *= 2


@pytest.mark.parametrize("size", [2, 3, 5])
@pytest.mark.parametrize("block", [250, 1 << 22])
def test_extension_equals_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(s, "BLOCK_BYTES", block)
    monkeypatch.setattr(s, "PART_BYTES", 2 * block)
    rng = random.Random(size)
    rows = random_rows(rng, 50, [f"w{i}" for i in range(4)], 30)
    passage = [f"p{i}" for i in range(90)]
    inner = " ".join(passage[30:60])
    rows += [
        (-5, "y " + inner),  # a smaller document has the middle of the passage
        (2000, " ".join(passage)),
        (2001, "x " + " ".join(passage[:70])),
        (2002, " ".join(passage[20:]) + " z"),
        (2003, " ".join(["a", "b"] * 40)),  # periodic
        (2004, "c " + " ".join(["a", "b"] * 30)),
        (2005, " ".join(["b", "a"] * 25)),
        (2006, inner),  # rows with one doc_id
        (2006, " ".join(passage[:40])),
        (2006, inner),
        (2007, "q0 q1 q2 q3 q4 q5 q6 q7"),
        (2007, "q0 q1 q2 q3 q4 q5 q6 q7 r"),
        (2008, "s q0 q1 q2 q3 q4 q5 q6 q7"),
        (None, " ".join(passage)),
        (2009, None),
        (2010, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept, longest = s.drop_and_extend(df.withColumn("runs", F.lit(1)), size)
    want = longest_before(rows, size)
    assert {r.doc_id: r.longest for r in longest.collect()} == want
    assert want[2002] >= 32 and want[2004] >= 32 and 2000 in want
    plainly = s.drop_repeated(df, size)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, plainly.collect()), key=str)


def test_extension_of_copies_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_BYTES", 100_000)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    kept, longest = s.drop_and_extend(df)
    want = longest_before(rows, 13)
    assert {r.doc_id: r.longest for r in longest.collect()} == want and max(want.values()) > 26
    kept, longest = s.drop_and_extend(df.limit(0))
    assert kept.count() == longest.count() == 0
    kept, longest = s.drop_and_extend(spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id bigint, text string"))
    assert kept.count() == 2 and longest.count() == 0
    digest = F.sha2("kept_text", 256).alias("digest")
    kept, _ = s.drop_and_extend(df, 13, digest)
    plainly = s.drop_repeated(df).select("doc_id", "n_words", "n_removed", digest)
    assert sorted(kept.collect()) == sorted(plainly.collect())
