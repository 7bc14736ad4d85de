import math
import random

import pytest

from velometry.llm import negatives, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, positives=5, negs=10, low=30, high=90):
    """Every score by itself."""
    clean = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, [math.floor(256 * x) for x in vector])
        clean[vec_id] = min(clean.get(vec_id, row), row)
    labels = {i: (l + 1) % 10 if i % 7 == 0 else l for i, (l, _) in clean.items()}
    out = []
    for a in clean:
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(clean[a][1], v)) for i, (_, v) in clean.items()}
        order = sorted((i for i in clean if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if labels[i] == labels[a]][:positives]:
            fit = [i for i in order if labels[i] != labels[a] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit[:negs], 1)]
    return sorted(out)


def got(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(tuple(r) for r in queries.op12_hard_negatives(spark, str(tmp_path)).collect())


def vectors(n, dims, seed, labels=4, step=25):
    rng = random.Random(seed)
    return [
        (i * step, [rng.choice([rng.gauss(0, 0.2), 0.25, -0.25]) for _ in range(dims)], rng.randrange(labels))
        for i in range(n)
    ]


@pytest.mark.parametrize("dims", [1, 7, 24])
def test_all_scores_by_brute_force(spark, tmp_path, dims):
    rows = vectors(120, dims, dims)
    assert got(spark, tmp_path, rows) == brute(rows)


def test_many_parts_give_the_same(spark):
    rows = vectors(90, 20, 5)
    df = negatives.clean_vectors(spark.createDataFrame(rows, SCHEMA))
    found = [
        sorted(map(tuple, negatives.mine(df, df.filter("vec_id % 100 = 0"), part_bytes=size).collect()))
        for size in (1 << 30, 2000)
    ]
    assert found[0] == found[1] and len(found[0]) > 100


def test_nulls_ties_repeated_rows_and_other_columns(spark, tmp_path):
    rows = [
        (0, [0.5, 0.5], 1), (100, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1),
        (3, [0.2, 0.2], 2), (4, [0.2, 0.2], 2), (4, [0.2, 0.2], 2), (4, [0.1, 0.1], 3),
        (5, None, 2), (6, [0.2, 0.2], None), (8, [None, 0.2], 2), (9, [math.nan, 0.2], 2),
        (10, [math.inf, 0.2], 2), (None, [0.2, 0.2], 2), (11, [], 2), (12, [0.3], 2), (14, [0.2, 0.2], 0),
        (200, [0.0, 0.0], 1), (300, [-0.4, -0.4], 1),
    ]
    wide = [(*r, 1, "x") for r in rows]
    assert got(spark, tmp_path, wide, SCHEMA + ", part int, anchor string") == brute(rows)


def test_empty_table_and_few_rows(spark, tmp_path):
    assert got(spark, tmp_path, []) == []
    assert got(spark, tmp_path, [(100, [1.0], 1)]) == []
    rows = [(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]
    assert got(spark, tmp_path, rows) == brute(rows) == [(100, 1, 1, 2, 65536, 32768)]


def test_scores_beyond_doubles(spark, tmp_path):
    rows = [(100, [1e5, 2e5, 1.0], 1), (1, [3e5, 1e5, 0.3], 1), (2, [1e5, 1e5, 0.1], 2), (3, [1e5, 1e5, 0.9], 2)]
    big = [(i, [x * 20 for x in v], l) for i, v, l in rows]
    schema = "vec_id bigint, embedding array<double>, label int"
    assert got(spark, tmp_path, big, schema) == brute(big) != []


def test_bitmap_drops_rows_before_all_columns_are_read(monkeypatch):
    rng = random.Random(1)
    n, dims = 400, 64
    scales = [100 // (d + 1) for d in range(dims)]  # few columns decide
    data = [[rng.randrange(-s, s + 1) if s else 0 for s in scales] for _ in range(n)]
    part = negatives.Part(list(range(n)), [i % 2 for i in range(n)], data)
    left = []
    scan = part._scan
    def spy(query, rows, dropped):
        def watched(low, high):
            gone = dropped(low, high)
            left.append(int((~gone).sum()))
            return gone
        return scan(query, rows, watched)
    monkeypatch.setattr(part, "_scan", spy)
    best = part.nearest(data[0], 0, 0, 5)
    score = lambda i: sum(x * y for x, y in zip(data[0], data[i]))
    assert best == [(i, score(i)) for i in sorted(range(2, n, 2), key=lambda i: (-score(i), i))[:5]]
    assert left[0] < 150 and left[-1] < 20


def test_windows_of_integers():
    for score in (-7, 0, 1, 10, 33, 101):
        low, high = negatives.window(score, 30, 90)
        fits = [s for s in range(-200, 200) if 30 * score <= 100 * s <= 90 * score]
        assert [s for s in range(-200, 200) if low <= s <= high] == fits
