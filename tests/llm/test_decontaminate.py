import random

import plain
import pytest
from pyspark.sql import functions as F

from velometry.llm import decontaminate as d

ITEMS = [
    "The quick brown fox jumps over the lazy dog and then it sleeps for a very long while.",
    "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich, und zwar am Abend.",
    "short item",
]


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        new = rng.choice("abcxyz ") if kind else ""
        text = text[:at] + new + text[at + (kind != 2) :]
    return text


def test_distance_equals_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        p = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 30)))
        best = plain.infix_distance(p, t)
        assert d.myers_ends(p, t, len(p))[0] == best
        if best < len(p):
            edits, start, end = d.nearest_substring(p, t, len(p) - 1)
            assert edits == best == plain.infix_distance(p, t[start:end])
            assert plain.infix_distance(t[start:end], p) <= best
        assert best == 0 or d.myers_ends(p, t, best - 1) is None


def test_finds_exactly_what_is_within_the_budget():
    rng = random.Random(7)
    matcher = d.Matcher(ITEMS, d.EDIT_RATE)
    for _ in range(300):
        number = rng.randrange(3)
        text = edited(rng, ITEMS[number], rng.randint(0, 12))
        text = " ".join(["before"] * rng.randint(0, 4)) + text + " after" * rng.randint(0, 4)
        got = {m.item: m.edits for m in matcher.find(text)}
        for i, item in enumerate(ITEMS):
            best = plain.infix_distance(plain.squeezed(item), plain.squeezed(text))
            assert got.get(i) == (best if best <= int(len(item) * d.EDIT_RATE) else None)


def test_random_alphabet_and_rates():
    rng = random.Random(5)
    for _ in range(200):
        items = ["".join(rng.choices("ab c", k=rng.randint(1, 25))) for _ in range(4)]
        rate = rng.choice([0, 0.1, 0.2])
        text = "".join(rng.choices("ab c", k=rng.randint(0, 80)))
        got = {m.item: m.edits for m in d.Matcher(items, rate).find(text)}
        for i, item in enumerate(map(plain.squeezed, items)):
            best = plain.infix_distance(item, plain.squeezed(text))
            fits = item and best <= int(len(item) * rate)
            assert got.get(i) == (best if fits else None), (item, text)


def test_place_is_the_nearest_passage():
    matcher = d.Matcher(ITEMS[:1], d.EDIT_RATE)
    near = ITEMS[0].replace("brown", "brawn")
    text = f"x {near} y {ITEMS[0].upper()} z"
    (match,) = matcher.find(text)
    assert text[match.start : match.end] == ITEMS[0].upper() and match.edits == 0


def test_letters_that_grow_in_lower_case():
    text = "İ" * 5 + ITEMS[0]
    (match,) = d.Matcher(ITEMS[:1], d.EDIT_RATE).find(text)
    assert (match.start, match.end) == (5, len(text))


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("block", [50, 1 << 20])
def test_rows(spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_CHARS", block)
    bench = items(spark, [*enumerate(ITEMS[:2]), (None, None), (5, ""), (0, ITEMS[0])])
    bench = bench.withColumn("doc_id", F.lit("x"))
    docs = spark.createDataFrame(
        [(1, "aa " + ITEMS[0]), (1, "aa " + ITEMS[0]), (2, ITEMS[1] + ITEMS[0]), (3, "clean text"),
         (4, None), (5, ""), (None, ITEMS[1])],
        "doc_id bigint, text string",
    ).withColumn("item_id", F.lit(-1)).withColumn("edits", F.lit("x"))
    got = sorted(str(tuple(r)) for r in d.find_benchmark(docs, bench).collect())
    n, m = len(ITEMS[0]), len(ITEMS[1])
    want = [(1, 0, 3, 3 + n, 0)] * 2 + [(2, 0, m, m + n, 0), (2, 1, 0, m, 0), (None, 1, 0, m, 0)]
    assert got == sorted(map(str, want))
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert d.find_benchmark(docs.limit(0), bench).count() == 0
    assert d.find_benchmark(docs, bench.limit(0)).count() == 0
    assert d.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in d.find_benchmark(docs, bench).collect()}
    listed = [(r.item_id, r.text) for r in bench.collect()]
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in listed if t in (r.text or "")}
    assert exact and exact <= found


def test_long_text():
    text = "the quick brown " * 20_000 + ITEMS[0]
    assert [m.edits for m in d.Matcher(ITEMS, d.EDIT_RATE).find(text)] == [0]


SPACED = {
    "line breaks": lambda t: t.replace(" ", "\n"),
    "doubled spaces": lambda t: t.replace(" ", "  "),
    "no-break spaces": lambda t: t.replace(" ", "\xa0"),
    "wrapped lines": lambda t: t.replace(" ", " \r\n\t", 4),
    "quotes and dashes": lambda t: t.replace("'", "\u2019").replace('"', "\u201d").replace("-", "\u2013"),
    "capitals": lambda t: "".join(c.upper() if len(c.upper()) == 1 else c for c in t),
}


@pytest.mark.parametrize("change", SPACED)
def test_a_passage_set_anew_is_found_where_it_stands(spark, change):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    listed = [r.text for r in bench.collect()] + ["it's a \"well-known\" passage - isn't it, they said"]
    matcher = d.Matcher(listed, d.EDIT_RATE)
    for number, item in enumerate(listed):
        passage = SPACED[change](item)
        text = f"  before\n\n{passage}\u2003 and after"
        (match,) = [m for m in matcher.find(text) if m.item == number]
        assert match.edits == 0
        assert plain.squeezed(text[match.start : match.end]) == plain.squeezed(item)
        assert text[match.start : match.end] == passage.strip()


def test_items_of_white_space_match_nothing():
    assert d.Matcher([" \n", ""], 0.5).find("a  b") == []
