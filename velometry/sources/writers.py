"""Sinks, and the one place where a long lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    single_file: bool = False,
    replace_all: bool = False,
    rebalance: bool = True,
    **options: str,
) -> None:
    """Write ``df`` from the executors.

    With ``partition_by`` the rows are first rebalanced on those columns, so
    that each directory gets few files while a hot one is still split over
    several tasks; an overwrite replaces only the partitions that ``df`` has,
    so that runs over other years stay, unless ``replace_all``.  Without ``rebalance``
    rows are written where they are, which suits few partitions.  ``single_file`` is
    meant for small reports.  CSV cannot hold arrays, so there they become JSON text.
    """
    if fmt == "csv":
        options = {"header": "true", **options}
        df = df.withColumns(
            {
                f.name: F.to_json(f.name)
                for f in df.schema.fields
                if isinstance(f.dataType, T.ArrayType)
            }
        )
    if single_file:
        df = df.repartition(1)  # only the file itself is written by one task
    elif partition_by and rebalance:
        df = df.hint("rebalance", *map(F.col, partition_by))
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    writer.save(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], owned: Sequence | None = None
) -> None:
    """Write ``df`` in place of all that an earlier run left for what this run owns.

    ``owned`` lists values of the first partition column, None for null; without it the run owns the
    whole table.  The rows are first written aside, in a folder that readers skip, and
    then swapped in: a run that fails leaves the old rows, and partitions that it no
    longer yields go.  Rows outside ``owned`` are an error.  While folders are swapped a
    reader may miss some.
    """
    spark, column = df.sparkSession, partition_by[0]
    if owned is not None:
        named = [value for value in owned if value is not None]
        inside = F.col(column).isin(*named) if named else F.lit(False)
        if None in owned:
            inside = inside | F.col(column).isNull()
        refused = F.raise_error(F.lit(f"{column} is not owned by this run"))
        df = df.withColumn(
            column, F.when(inside, F.col(column)).otherwise(refused.cast(df.schema[column].dataType))
        )
    aside = f"{path}/_staged-{uuid.uuid4().hex}"
    write_table(df, aside, partition_by=partition_by, mode="errorifexists")
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    files = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def parts(folder: str) -> dict[str, object]:
        found = (s.getPath() for s in files.listStatus(to_path(folder)))
        return {p.getName(): p for p in found if p.getName().startswith(f"{column}=")}

    missing = "__HIVE_DEFAULT_PARTITION__"
    names = None
    if owned is not None:
        names = {f"{column}={missing if value is None else value}" for value in owned}
    for name, old in parts(path).items():
        if names is None or name in names:
            files.delete(old, True)
    for name, new in parts(aside).items():
        files.rename(new, to_path(f"{path}/{name}"))
    files.delete(to_path(aside), True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` for input that is read many times.

    Model fits pass over their input dozens of times.  The rows are kept by
    the executors, and a lost part is computed again: every operator gives
    the same rows each time.  Where ``spark.checkpoint.dir`` names a shared
    folder, they are checkpointed there instead, and nothing is repeated.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        sc.setCheckpointDir(folder)
    return df.checkpoint()
