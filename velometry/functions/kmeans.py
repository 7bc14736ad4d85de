"""k-means of points on a map, the same however the points are partitioned.

Points are counted by place, seeds are drawn by a hash of the place, and centres come from
sums of integers, so no order of rows or tasks can be felt.  Every step is an
aggregate over the places; the driver holds the centres and, while seeding, a few
times as many candidates.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places are whole billionths of a degree, about a tenth of a millimetre.
SCALE = 1_000_000_000
#: Rounds of seeding; each draws twice as many candidates as there are to be centres.
ROUNDS = 2

Centre = tuple[float, float]


def places(points: DataFrame, lat: str, lon: str) -> DataFrame:
    """``a, b, n``: the points' places as integers, and how many points lie there.

    Points without two finite numbers are left out.
    """
    fit = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != math.inf) for c in (lat, lon)]
    whole = [F.round(F.col(c) * SCALE).cast("bigint") for c in (lat, lon)]
    return (
        points.filter(fit[0] & fit[1])
        .groupBy(whole[0].alias("a"), whole[1].alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _nearest(lat: Column, lon: Column, centres: Sequence[Centre]) -> Column:
    """The least ``(square of the distance, number of the centre)``.

    The centres are one constant beside the generated code, not part of it, so that
    Spark need not compile each step anew.
    """
    rows = [{"x": x, "y": y, "i": i} for i, (x, y) in enumerate(centres)]
    known = F.from_json(F.lit(json.dumps(rows)), "array<struct<x double, y double, i int>>")

    def reach(c: Column) -> Column:
        return F.struct(
            ((lat - c.x) * (lat - c.x) + (lon - c.y) * (lon - c.y)).alias("far"), c.i.alias("i")
        )

    return F.array_min(F.transform(known, reach))


def nearest(lat: Column, lon: Column, centres: Sequence[Centre]) -> Column:
    """The number of the nearest centre, from 0; the first of several as near."""
    return _nearest(lat, lon, centres)["i"]


def _degrees(name: str) -> Column:
    return F.col(name) / SCALE


def _to(centres: Sequence[Centre]) -> Column:
    return _nearest(_degrees("a"), _degrees("b"), centres)["far"]


def cost(found: DataFrame, centres: Sequence[Centre]) -> float:
    """The sum of squared distances from ``places`` to their centres, in square degrees."""
    return found.agg(F.sum(F.col("n") * _to(centres))).first()[0]


def _draw(found: DataFrame, weight: Column, seed: int, step: int, size: int) -> list[Centre]:
    """``size`` places, each with a chance by its ``weight``: the least exponential clocks."""
    text = F.concat_ws("|", F.lit(f"{seed}|{step}"), "a", "b")
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    clock = -F.ln((digits + 0.5) / 2.0**52) / weight
    drawn = found.withColumn("w", weight).filter("w > 0").withColumn("clock", clock)
    rows = drawn.orderBy("clock", "a", "b").limit(size).select("a", "b").collect()
    return [(r.a / SCALE, r.b / SCALE) for r in rows]


def _reduced(candidates: list[Centre], weights: list[int], k: int, seed: int) -> list[Centre]:
    """``k`` of the weighted candidates, each drawn by its distance to those before."""
    chosen: list[Centre] = []
    far = [1.0] * len(candidates)
    for step in range(k):
        clocks = []
        for (x, y), w, d in zip(candidates, weights, far):
            text = f"{seed}|reduce|{step}|{x!r}|{y!r}"
            u = (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52
            clocks.append((-math.log(u) / (w * d) if w * d > 0 else math.inf, x, y))
        x, y = min(clocks)[1:]
        chosen.append((x, y))
        near = [(x - a) ** 2 + (y - b) ** 2 for a, b in candidates]
        far = near if step == 0 else [min(f, n) for f, n in zip(far, near)]
    return chosen


def _seeds(found: DataFrame, k: int, seed: int) -> list[Centre]:
    centres = _draw(found, F.col("n").cast("double"), seed, 0, 1)
    step = 0
    while centres and (step < ROUNDS or len(centres) < k):
        step += 1
        more = _draw(found, F.col("n") * _to(centres), seed, step, 2 * k)
        if not more:  # every place is a candidate
            break
        centres += more
    if len(centres) <= k:
        return centres
    number = nearest(_degrees("a"), _degrees("b"), centres).alias("c")
    held = {r.c: r.n for r in found.groupBy(number).agg(F.sum("n").alias("n")).collect()}
    return _reduced(centres, [held.get(i, 0) for i in range(len(centres))], k, seed)


def fit(
    found: DataFrame, k: int, seed: int = 1, max_iter: int = 20, tolerance: float = 1e-4
) -> list[Centre]:
    """The centres of ``places``, in order of latitude and longitude.

    Steps end when no centre moves further than ``tolerance`` degrees, or after
    ``max_iter``.  A centre without points stays where it is.  With fewer places
    than ``k`` there is a centre at each; without any, there is none.
    """
    centres = _seeds(found, k, seed)
    for _ in range(max_iter if centres else 0):
        number = nearest(_degrees("a"), _degrees("b"), centres).alias("c")
        sums = [F.sum(F.col(c).cast("decimal(19,0)") * F.col("n")).alias(c) for c in "ab"]
        moved = 0.0
        for r in found.groupBy(number).agg(*sums, F.sum("n").alias("n")).collect():
            centre = (float(r.a / r.n) / SCALE, float(r.b / r.n) / SCALE)
            moved = max(moved, math.dist(centre, centres[r.c]))
            centres[r.c] = centre
        if moved <= tolerance:
            break
    return sorted(centres)
