import pytest
from pyspark.sql import functions as F

from velometry.functions import numbering
from velometry.functions.numbering import numbered
from velometry.functions.quantile import exact_quantile
from velometry.operators.taxi import od_pairs
from velometry.sources import cut_lineage


def _expected(rows):
    """Places by sorting, nulls first, for (group, value) rows."""
    key = [(g is not None, g, v is not None, v) for g, v in rows]
    places, seen = [], {}
    for g, v in (rows[i] for i in sorted(range(len(rows)), key=lambda i: key[i])):
        seen[g] = seen.get(g, 0) + 1
        places.append((g, v, seen[g]))
    return places, seen


@pytest.mark.parametrize("partitions", [1, 5])
def test_places_in_groups_with_nulls_and_ties(spark, partitions):
    rows = [(g, v) for g in ("a", None, "b") for v in (3, None, 1, 1, 7, None)] + [("c", 0)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(partitions)
    found = numbered(df, ["v"], cut_lineage, ["g"], total="n").collect()
    places, sizes = _expected(rows)
    key = lambda r: (r[0] or "", r[2])
    assert sorted([(r.g, r.v, r.position) for r in found], key=key) == sorted(places, key=key)
    assert all(r.n == sizes[r.g] for r in found)


def test_places_over_the_whole_table(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("v", F.hash("id"))
    found = numbered(df, ["v"], cut_lineage, name="at").orderBy("v").collect()
    assert [r["at"] for r in found] == list(range(1, 5001))
    assert numbered(df.limit(0), ["v"], cut_lineage).count() == 0


def test_equal_rows_are_dealt_over_the_ranges(spark):
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        kept = []
        df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("v"))
        found = numbered(df, ["v"], lambda held: kept.append(cut_lineage(held)) or kept[0])
        assert found.agg(F.max("position"), F.countDistinct("position")).first()[:] == (40_000,) * 2
        sizes = kept[0].groupBy(F.shiftright("__at", 33)).count()
        # Bounds are sampled, so ranges differ in size, but none holds the table.
        assert sizes.agg(F.max("count")).first()[0] < 15_000
    finally:
        spark.conf.unset(merge)


def test_a_quantile_of_groups_leaves_the_value_above_the_grouping(spark):
    """Distances are computed for pairs, not for each trip."""
    names = [f"{end}_station_{c}" for end in ("start", "end") for c in ("latitude", "longitude")]
    ends = [F.lit("x").alias(f"{end}_station_name") for end in ("start", "end")]
    rides = spark.range(9).select(
        F.current_timestamp().cast("timestamp_ntz").alias("starttime"),
        *ends,
        *(F.col("id").cast("double").alias(n) for n in names),
    )
    median = exact_quantile(od_pairs(rides), "dist", 0.5, few_values=True)
    plan = median._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate [") :].partition("\n")[2]
    assert "ACOS" in plan and "ACOS" not in below


@pytest.mark.parametrize("bits", [31, 2, 0])
def test_each_value_has_a_number_of_its_own(spark, monkeypatch, bits):
    monkeypatch.setattr(numbering, "_HASH_BITS", bits)
    texts = [*(f"v{i % 40}" for i in range(100)), None, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "at int, text string")
    changed, numbers = numbering.by_number(df, "text")
    value = {r.number: r.value for r in numbers.collect()}
    assert len(value) == 41 and set(value.values()) == set(texts)
    assert changed.dtypes == [("at", "int"), ("text", "bigint")]
    assert [value[r.text] for r in changed.orderBy("at").collect()] == texts
