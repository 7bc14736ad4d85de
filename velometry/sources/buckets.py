"""Stored tables whose rows lie in buckets by key, so that joins on it move none of them."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _name(path: str) -> str:
    return f"buckets_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def write_buckets(df: DataFrame, path: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` in ``path`` as ``buckets`` files by a hash of ``by``, and open it.

    Later joins and groups on ``by``, or on it and more, need no shuffle of this side, and a
    filter on its values reads one bucket.  A task writes a whole bucket, so ``by`` is for
    tables in which a key has a bounded number of rows, such as the hours of a station.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    dealt = df.repartition(buckets, *by)  # the hash of the buckets, so one file for each
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
    writer.format("parquet").option("path", path).saveAsTable(_name(path))
    return spark.table(_name(path))


def open_buckets(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], buckets: int
) -> DataFrame:
    """A table of ``write_buckets`` in a session that has not written it.

    ``schema``, ``by`` and ``buckets`` are those it was written with; files do not tell.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{c}`" for c in by)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    spark.sql(
        f"CREATE TABLE {_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(_name(path))
