import random

import pytest
from frames import taxi
from pyspark.sql import functions as F

from velometry.functions.sketch import merged, quantile_from, rank_error, sketches
from velometry.operators.taxi import slow_trips, velocity_sketches
from velometry.sources import replace_partitions


def _one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0][0]


@pytest.mark.parametrize("q", [0.0, 0.2, 0.5, 0.99, 1.0])
def test_quantile_is_within_the_error(spark, q):
    # A third of all rows hold one value; the rest are spread unevenly.
    n = 300_000
    df = spark.range(n, numPartitions=13).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pow(F.col("id") * 7919 % n, F.lit(1.5))).alias("v"),
        (F.col("id") % 4).alias("year"),
    )
    found = _one(quantile_from(sketches(df, "v", ["year"]), q))
    below, upto = df.agg(F.count_if(F.col("v") < found), F.count_if(F.col("v") <= found)).first()
    slack = 2 * rank_error() * n
    assert below - slack <= q * n <= upto + slack


def test_few_values_are_exact(spark):
    values = [random.Random(1).randrange(100) / 4 for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert _one(quantile_from(sketches(df, "v"), 0.5)) == sorted(values)[499]


def test_nulls_nan_and_empty_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", float("nan")), ("b", None), (None, 2.0), (None, 3.0)],
        "key string, v double",
    )
    parts = sketches(df, "v", ["key"])
    assert {(r.key, r.n) for r in parts.collect()} == {("a", 1), (None, 2)}
    assert _one(quantile_from(parts, 1.0)) == 3.0
    assert quantile_from(parts.limit(0), 0.5).collect() == []
    assert sketches(df.limit(0), "v").collect() == []
    assert merged(parts).first().n == 3


def test_a_later_year_costs_only_its_own_scan(spark, tmp_path):
    path = str(tmp_path / "sketches")

    def year(y, *seconds):
        at = f"{y}-03-01 10:00:00"
        return taxi(spark, *({"pickup_datetime": at, "travel_time": s} for s in seconds))

    def stored():
        return spark.read.schema("year int, n bigint, sketch binary").parquet(path)

    first, second = year(2015, 100, 200, 400), year(2016, 500, 800, 0)
    replace_partitions(velocity_sketches(first), path, ["year"], [2015])
    assert _one(quantile_from(stored(), 0.5)) == 1 / 200
    for _ in range(2):  # a repeated run counts once
        replace_partitions(velocity_sketches(second), path, ["year"], [2016])
    assert sorted(r.n for r in stored().collect()) == [2, 3]
    assert _one(quantile_from(stored(), 0.5)) == 1 / 400
    slow = slow_trips(first.union(second), 0.5, stored=stored())
    assert sorted(r.travel_time for r in slow.collect()) == [400, 500, 800]
    plan = quantile_from(stored(), 0.5)._jdf.queryExecution().toString()
    assert "pickup_datetime" not in plan
