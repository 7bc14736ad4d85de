import random

import plain
import pytest
from pyspark.sql import functions as F

from velometry.llm import simhash
from velometry.llm.common import null_safe_join, stored
from velometry.llm.components import connected


def unsigned(x):
    return x % (1 << 64)


def clusters(rng, centres, size, flips):
    prints = set()
    for _ in range(centres):
        base = rng.getrandbits(64)
        for _ in range(size):
            x = base
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    return sorted(prints)


def test_fingerprint():
    for text in ("", " \t", "One", "one two", "A b C d", "a b c a b c a b c", "É é", "x " * 50, " a b"):
        assert simhash.fingerprint(text, 3) == plain.fingerprint(text), text
    assert simhash.fingerprint("A B c", 3) == simhash.fingerprint("a b C", 3)
    assert simhash.fingerprint("a b", 1) == plain.fingerprint("a b", 1)


def test_long_text_in_parts():
    text = " ".join(str(i % 997) for i in range(40_000))
    assert simhash.fingerprint(text, 3) == plain.fingerprint(text)


@pytest.mark.parametrize(("distance", "crowded"), [(1, 64), (2, 64), (1, 2), (2, 2), (3, 3)])
def test_links_connect_what_all_pairs_do(spark, monkeypatch, distance, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    prints = clusters(random.Random(distance), 4, 60, 5)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint bigint")
    edges = simhash.links(df, distance)
    assert all((unsigned(e.a) ^ unsigned(e.b)).bit_count() <= 2 * ((distance + 1) // 2) for e in edges.collect())
    got = {}
    for r in connected(edges).collect():
        got.setdefault(r.component, set()).add(unsigned(r.node))
    want = {}
    for p, root in plain.components(prints, distance).items():
        want.setdefault(root, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_all_pairs_of_uncrowded_keys_are_links(spark):
    prints = clusters(random.Random(9), 5, 12, 4)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint bigint")
    got = {frozenset((unsigned(e.a), unsigned(e.b))) for e in simhash.links(df, 2).collect()}
    assert got == {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}


def test_distance_must_fit():
    with pytest.raises(ValueError, match="distance"):
        simhash.links(None, 7, 7)


def test_chain_of_components(spark):
    n = 50
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in connected(edges).collect()} == {0}
    shuffled = list(range(60))
    random.Random(1).shuffle(shuffled)
    rows = list(zip(shuffled, shuffled[1:])) + [(1000, 1001), (7, 7)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == dict.fromkeys(range(60), 0) | {1000: 1000, 1001: 1000}
    assert connected(edges.limit(0)).count() == 0


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    want = plain.simhash_groups(docs)
    got = simhash.near_duplicates(df).collect()
    assert sorted((r.doc_id, unsigned(r.fingerprint), r.component_id) for r in got) == sorted(want)
    assert any(d != c for d, _, c in want)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == sorted(
        tuple(r) for r in df.collect() if r.doc_id in {c for _, _, c in want}
    )


def test_nulls_ties_and_clashing_columns(spark):
    a, b = "some words that are here", "other words that are not there at all"
    rows = [(5, a), (3, a), (3, a), (None, a), (None, b), (7, None), (6, ""), (8, " ")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit(1).alias("fingerprint"), F.lit(2).alias("component_id"), F.lit(3).alias("first")
    )
    got = [(r.doc_id, unsigned(r.fingerprint), r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted(plain.simhash_groups(rows), key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str((r.doc_id, r.text)) for r in kept.collect())) == sorted(
        [str((3, a)), str((None, a)), str((None, b)), str((6, ""))]
    )
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_each_group_keeps_one_row_where_doc_ids_repeat(spark):
    a, b, c = ("some words that are here", "other words that are not there at all", "a third text about something else")
    schema = "doc_id bigint, text string, lang string"
    # 1 is the smallest of two groups; 2 is the smallest of one group and not of the other.
    rows = [(1, a, "x"), (1, a, "y"), (1, b, "x"), (4, a, "x"), (2, b, "x"), (2, c, "x"), (3, c, "x"), (1, b, None)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept = simhash.keep_one(spark.createDataFrame(rows, schema).repartition(3)).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, a), (1, b), (2, c)])
        seen.add(tuple(sorted(map(str, kept))))
    assert len(seen) == 1


def test_a_copied_side_is_not_broadcast_under_its_size(spark):
    """The plan of each join knows the size of what it would send to every task."""
    left = spark.range(10).withColumn("k", F.lit(1))
    path_side = stored(spark.range(50_000).select(F.col("id").alias("k"), F.rand(1).alias("v")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        plan = null_safe_join(left, path_side, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Generate" not in plan and "BroadcastHashJoin" not in plan


def test_null_safe_join_splits_a_hot_key(spark):
    rows = [(None,)] * 40 + [(i % 3,) for i in range(9)]
    left = spark.createDataFrame(rows, "k int")
    right = spark.createDataFrame([(None, "n"), (0, "a"), (7, "z")], "k int, v string")
    found = null_safe_join(left, right, ["k"])
    assert found.filter("v = 'n'").count() == 40 and found.filter("v = 'a'").count() == 3
    assert found.count() == 49 and found.columns == ["k", "v"]
