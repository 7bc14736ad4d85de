"""What several of the operators share: Arrow slices, lineage, joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one Python step holds in its own form at a time.
SLICE_BYTES = 4 << 20

WHITE = " \t\n\x0b\x0c\r"


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``size`` bytes of ``column`` each.

    A single longer value makes a run of its own.  Nothing is copied.
    """
    values = batch.column(column)
    if not len(values):
        return
    ends = pc.cumulative_sum(
        pc.fill_null(pc.binary_length(values).cast(pa.int64()), 0)
    ).to_numpy()
    first, used = 0, 0
    for row in range(1, len(ends) + 1):
        if row == len(ends) or ends[row] - used > size:
            yield batch.slice(first, row - first)
            first, used = row, ends[row - 1]


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The strings of a column; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ensure_checkpoint_dir(spark) -> str:
    """The folder for checkpoints and stored steps, which all executors share.

    It is the one named in ``spark.checkpoint.dir``; where that is unset, one in the
    warehouse.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back as a table in the shared folder.

    A lost executor repeats nothing that is stored, and later plans see the true size
    (a checkpoint keeps the estimate, which a loop multiplies in every round).
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left"
) -> DataFrame:
    """Join on ``keys``, where null equals null; ``right`` has each key at most once.

    A key may hold much of ``left``: adaptive execution splits the rows of a large
    partition over several tasks and gives each the one partition of ``right``, by
    sizes that it has measured.  ``right`` is never copied before the join, so
    Spark broadcasts it only where its own size is known to be small.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    right = right.withColumnsRenamed(dict(zip(keys, names)))
    on = F.lit(True)
    for key, name in zip(keys, names):
        on = on & F.col(key).eqNullSafe(F.col(name))
    return left.join(right, on, how).drop(*names)
