"""Lists that older result files hold as printed text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_name_list(text: Column | str) -> Column:
    """``['A & B', "C's"]`` as an array of strings."""
    return F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})


def parse_centres(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per centre of a printed ``[[[lat, lon], ...]]``, after ``keep``."""
    nested = F.from_json(text, "array<array<array<double>>>")
    points = df.select(*keep, F.posexplode(F.flatten(nested)).alias("cluster_id", "point"))
    return points.select(
        *keep,
        "cluster_id",
        F.col("point")[0].alias("latitude"),
        F.col("point")[1].alias("longitude"),
    )
