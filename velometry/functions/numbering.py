"""Row numbers over tables and groups of any size, without a task that sees them all."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` holds the partition above the index in it.
_INDEX_BITS = 33
#: Bits of a value's hash in its number, which holds them above its place among equal ones.
_HASH_BITS = 31


def numbered(
    df: DataFrame,
    order: Sequence[str],
    keep: Callable[[DataFrame], DataFrame],
    within: Sequence[str] = (),
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """``df`` with each row's place from 1 in the order of ``order``, nulls first.

    Places start anew in each group of ``within``; nulls are a group of their own.
    ``total`` names a column for the group's number of rows.  Rows are dealt out by
    ranges and sorted in each; a row's place is its index in the range plus the rows that
    its group has in the ranges before.  So neither a group nor a value of
    ``order`` that holds much of the table meets in one task, and rows that are equal
    in all of ``order`` are split by the partition they come from, in any order.

    ``keep`` must hold on to its argument, as ``cut_lineage`` does: ranges that are
    computed twice may differ.
    """
    keys = [*within, *(c for c in order if c not in within)]
    held = keep(
        df.withColumn("__from", F.spark_partition_id())
        .repartitionByRange(*keys, "__from")
        .sortWithinPartitions(*keys, "__from")
        .withColumn("__at", F.monotonically_increasing_id())
        .drop("__from")
    ).withColumn("__range", F.shiftright("__at", _INDEX_BITS))
    ranges = held.groupBy("__range", *within).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    # One row for each range and group: a window here holds no more than the ranges.
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    if total is not None:
        ranges = ranges.withColumn(total, F.sum("__n").over(group))
    names = {c: f"__g{i}" for i, c in enumerate(["__range", *within])}
    ranges = ranges.withColumnsRenamed(names).drop("__n")
    same = F.lit(True)
    for column, other in names.items():
        same = same & F.col(f"`{column}`").eqNullSafe(F.col(other))
    place = F.col("__at") - F.col("__first") + F.col("__before") + 1
    return (
        held.join(ranges, same)
        .withColumn(name, place)
        .drop("__at", "__range", "__first", "__before", *names.values())
    )


def by_number(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with a bigint in place of each value of ``column``, and a table of ``value``
    and ``number`` that has each value once, null as well.

    Grouping many rows by a number costs a third of what it does by a text.  A number is the
    value's hash and its place among the values of that hash, so no two values share one and it
    is the same whenever it is computed.
    """
    values = df.select(F.col(column).alias("value")).distinct()
    values = values.withColumn("hash", F.xxhash64("value").bitwiseAND((1 << _HASH_BITS) - 1))
    place = F.row_number().over(Window.partitionBy("hash").orderBy("value"))
    numbers = values.select("value", (F.shiftleft("hash", 32) + place).alias("number"))
    same = F.col(f"`{column}`").eqNullSafe(F.col("__value"))
    changed = df.join(numbers.withColumnsRenamed({"value": "__value", "number": "__number"}), same)
    kept = [F.col("__number").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
    return changed.select(*kept), numbers
