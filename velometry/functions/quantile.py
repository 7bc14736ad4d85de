"""Exact quantile of one column, with bounded state at any table size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Classes per unit of the natural logarithm.  A coarse class spans 0.1 % of a
# value, so a task counts a few thousand of them; it holds a million fine ones.
# A fine class spans 1e-9 of a value and so at most a few million doubles.
_COARSE, _FINE = 1_000, 1_000_000_000


def _class(v: Column, per_unit: int) -> Column:
    """An integer that never falls as ``v`` grows; NaN is above every number."""
    # 800 exceeds |ln(x)| for every double x, so the sizes stay positive.
    size = F.floor((F.ln(F.abs(v)) + 800.0) * per_unit)
    signed = (
        F.when(F.isnan(v), F.lit((1 << 63) - 1))
        .when(v == 0.0, F.lit(0).cast("bigint"))
        .when(v > 0.0, size)
        .otherwise(-size)
    )
    # Known not to be null, the class draws no null check into either use of
    # a shared shuffle, so that Spark sees both are equal and runs it once.
    return F.coalesce(signed, F.lit(0).cast("bigint"))


def _reaching(groups: DataFrame, key: str, rank: Column) -> DataFrame:
    """The one group in which the running ``n`` reaches ``rank``.

    Returns its key and the rank that remains inside it.  ``rank`` may use the
    whole weight, ``total``.  All groups pass through one task; callers hand in
    a bounded number of them.
    """
    whole = Window.partitionBy(F.lit(0))
    upto = whole.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        groups.withColumns({"running": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
        .withColumn("left", rank - F.col("running") + F.col("n"))
        .filter((F.col("left") > 0) & (F.col("left") <= F.col("n")))
        .select(key, "left")
    )


def _value_at(
    df: DataFrame,
    value: str | Column,
    rank: Column,
    weight: str | Column | None = None,
    few_values: bool = False,
) -> DataFrame:
    """The value ``v`` at ``rank`` in ascending order; at most one row.

    Nulls are left out; ``weight`` counts a row several times; ``rank`` may use
    the whole weight, ``total``.

    Three counts narrow the search: coarse classes of similar size, then fine
    classes inside the coarse one that holds the answer, then the values of
    one fine class.  Each count is combined before its shuffle, equal values
    collapse into one row, and no task holds more than a bounded number of
    groups.  (A sketch would be merged whole, from every task, in one task.)
    ``few_values`` is for values that are few by nature, such as whole
    kilometres on Earth: then one count is enough.

    NaN is above every number.  Returned with it is ``left``, the rank of the
    row among those equal to it.
    """
    value = F.col(value) if isinstance(value, str) else value
    weight = F.lit(1) if weight is None else weight
    weight = F.col(weight) if isinstance(weight, str) else weight
    value = value.cast("double")
    # A filter on nulls would be pushed below a grouping that ``value`` is computed
    # from, and there compute it for each raw row; a weight of zero is not.
    rows = df.select(value.alias("v"), F.when(value.isNull(), 0).otherwise(weight).alias("w"))
    rows = rows.withColumn("w", F.col("w").cast("bigint"))
    n = F.sum("w").alias("n")
    if few_values:
        return _reaching(rows.groupBy("v").agg(n), "v", rank)

    rows = rows.withColumn("coarse", _class(F.col("v"), _COARSE))
    # One row each: broadcasting them filters the other side in place.
    coarse = F.broadcast(_reaching(rows.groupBy("coarse").agg(n), "coarse", rank))
    values = (
        rows.join(coarse, "coarse")
        .groupBy("v", "left")
        .agg(n)
        .withColumn("fine", _class(F.col("v"), _FINE))
    )
    slices = values.groupBy("fine", F.col("left").alias("want")).agg(F.sum("n").alias("n"))
    fine = F.broadcast(_reaching(slices, "fine", F.col("want")))
    last = values.drop("left").join(fine, "fine").withColumnRenamed("left", "want")
    return _reaching(last, "v", F.col("want"))


def exact_quantile(
    df: DataFrame,
    value: str | Column,
    q: float,
    weight: str | Column | None = None,
    few_values: bool = False,
) -> DataFrame:
    """The smallest value with at least the share ``q`` of all rows at or below it.

    One column, ``quantile``, and one row, or none when there is no value.
    """
    total = F.col("total")
    rank = F.greatest(F.lit(1).cast("bigint"), total - F.floor(total - total * F.lit(q)))
    return _value_at(df, value, rank, weight, few_values).select(F.col("v").alias("quantile"))


def nth_smallest(df: DataFrame, value: str | Column, n: int) -> DataFrame:
    """The ``n``-th smallest value, or the largest if there are fewer: ``value``."""
    return nth_place(df, value, n).select("value")


def nth_place(df: DataFrame, value: str | Column, n: int) -> DataFrame:
    """``nth_smallest`` with ``left``: how many rows of that value are among the ``n``."""
    rank = F.least(F.lit(n).cast("bigint"), F.col("total"))
    return _value_at(df, value, rank).withColumnRenamed("v", "value")


def quantile(
    df: DataFrame,
    value: str | Column,
    q: float,
    weight: str | Column | None = None,
    few_values: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """One-row quantile: exact, or a ``percentile_approx`` of given ``accuracy``."""
    if accuracy is None:
        return exact_quantile(df, value, q, weight, few_values)
    if weight is not None:
        raise ValueError("a weighted quantile is exact; leave accuracy unset")
    value = F.col(value) if isinstance(value, str) else value
    sketch = F.percentile_approx(value.cast("double"), F.lit(q), F.lit(accuracy))
    return df.agg(sketch.alias("quantile")).filter(F.col("quantile").isNotNull())
