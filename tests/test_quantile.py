import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velometry.functions.quantile import exact_quantile, nth_place, nth_smallest, quantile


def _expected(values, q):
    values = sorted(values, key=lambda v: (math.isnan(v), v))
    rank = max(1, len(values) - math.floor(len(values) - q * len(values)))
    return values[rank - 1]


_VALUES = st.lists(
    st.one_of(
        st.sampled_from([0.0, 1.0, -1.0, 5.0]),
        st.floats(-1e12, 1e12, allow_nan=False),
        st.floats(1.0, 1.0000001),
        st.sampled_from([math.nan, math.inf, -math.inf]),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=_VALUES, q=st.sampled_from([0.0, 0.2, 0.5, 0.9, 1.0]))
def test_quantile_is_a_rank_of_the_sorted_values(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    expected = _expected(values, q)
    for few in (False, True):
        found = exact_quantile(df, "x", q, few_values=few).first()[0]
        assert found == expected or (math.isnan(found) and math.isnan(expected))


def test_one_value_holding_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7.25).otherwise(F.sqrt(F.col("id") + 1.0)).alias("x")
    )
    values = [r.x for r in df.collect()]
    for q in (0.05, 0.2, 0.5):
        assert exact_quantile(df, "x", q).first()[0] == _expected(values, q)


def test_weight_counts_a_row_several_times(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 10), (3.0, 2)], "x double, w int")
    assert quantile(df, "x", 0.5, "w").first()[0] == 2.0
    assert quantile(df, "x", 0.95, "w").first()[0] == 3.0
    with pytest.raises(ValueError):
        quantile(df, "x", 0.5, "w", accuracy=100)


def test_no_value_gives_no_row(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantile(df, "x", 0.5).collect() == []
    assert quantile(df, "x", 0.5, accuracy=100).collect() == []


def test_sketch_is_near_the_exact_value(spark):
    df = spark.range(10_000).select((F.col("id") * 1.0).alias("x"))
    assert abs(quantile(df, "x", 0.2, accuracy=1000).first()[0] - 1999.0) <= 10


def test_nth_smallest(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (1.0,), (None,), (2.0,)], "x double")
    found = [nth_smallest(df, "x", n).first()[0] for n in (1, 2, 3, 4, 9)]
    assert found == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_no_number_is_above_every_number(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0] + [math.nan] * 4], "x double")
    assert exact_quantile(df, "x", 0.2).first()[0] == 2.0
    assert exact_quantile(df, "x", 0.5).first()[0] == 4.0
    assert math.isnan(exact_quantile(df, "x", 0.9).first()[0])


def test_place_tells_how_many_equal_ones_are_needed(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 2.0, 5.0]], "x double")
    found = [tuple(nth_place(df, "x", n).first()) for n in (1, 2, 4, 5, 99)]
    assert found == [(1.0, 1), (2.0, 1), (2.0, 3), (5.0, 1), (5.0, 1)]
