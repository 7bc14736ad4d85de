"""Shares of a table that are exact and that any engine can draw again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velometry.functions.numbering import numbered
from velometry.sources.writers import cut_lineage


def _text(df: DataFrame, name: str) -> Column:
    """The cell in a form that does not depend on how an engine prints numbers."""
    cell = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.NumericType):
        cell = F.floor(cell.cast("double") * 1_000_000 + 0.5).cast("bigint")
    return F.coalesce(cell.cast("string"), F.lit(""))


def row_hash(df: DataFrame, seed: int, columns: Sequence[str] | None = None) -> Column:
    """MD5 of ``seed`` and the cells, joined by ``|``: numbers in whole millionths, null empty."""
    cells = [_text(df, name) for name in columns or df.columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *cells).cast("binary"))


def drawn(
    df: DataFrame, share: float, seed: int, columns: Sequence[str] | None = None, out: str = "drawn"
) -> DataFrame:
    """``df`` with ``out``: whether the row is among ``share`` of all, those of least hash.

    Their number is exact, rounded half up.  Of equal rows some may be drawn and
    others not.  The rows are kept, so that both sides read the same ones.
    """
    placed = numbered(
        df.withColumn("__hash", row_hash(df, seed, columns)),
        ["__hash"],
        cut_lineage,
        name="__place",
        total="__total",
    )
    most = F.floor(F.col("__total") * F.lit(float(share)) + 0.5)
    return placed.withColumn(out, F.col("__place") <= most).drop("__hash", "__place", "__total")
