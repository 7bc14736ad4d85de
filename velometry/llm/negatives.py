"""Hard negatives by a vertical scan of vectors, dimension by dimension (BOND).

A part of the rows lies in memory by columns.  An anchor reads the columns in descending
order of its own magnitude there and adds up partial scores.  What the columns not
yet read can still add lies between sums of their least and largest products, which the
columns' minima and maxima bound.  Rows whose bounds leave every window of scores, or
fall behind enough others, leave the bitmap of candidates; the rest get exact scores.

Rows are dealt into parts of bounded size, and every part receives all anchors in turn,
as a stated query set against all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velometry.llm.common import stored

#: Bytes of vectors, as doubles, that a part holds, and the rows worth a part of their own.
PART_BYTES, PART_ROWS = 64 << 20, 2048
#: Columns read between two looks at the bounds.
STEP = 8
#: Sums of products below this are exact in doubles.
_EXACT = float(1 << 53)


def clean_vectors(embeddings: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, label, vector``: the rows that take part, their components as integers.

    A component becomes ``floor(scale * x)``.  Rows with a null vec_id, label or vector, or
    with a null or non-finite component, take no part.  A vec_id names one row: of
    several the one with the least label, then the least vector, is taken.
    """
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    unfit = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == math.inf))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.when(~unfit, F.transform(x, lambda c: F.floor(c * scale))).alias("vector"),
    ).dropna()
    least = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return least.select("vec_id", "row.*")


class Part:
    """Rows by columns, ordered by label, then vec_id."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list[list[int]]):
        order = np.lexsort((ids, labels))
        self.ids = np.array(ids, np.int64)[order]
        self.labels = np.array(labels, np.int64)[order]
        width = max(map(len, vectors))
        rows = np.zeros((len(vectors), width), np.int64)  # missing components count as zero
        for i, vector in enumerate(vectors):
            rows[i, : len(vector)] = vector
        self.columns = np.ascontiguousarray(rows[order].T.astype(np.float64))
        self.whole = rows[order]
        self.least = self.columns.min(axis=1) if len(rows) else np.zeros(width)
        self.most = self.columns.max(axis=1) if len(rows) else np.zeros(width)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, (label, label + 1)))

    def _query(self, vector: list[int]) -> np.ndarray:
        query = np.zeros(len(self.columns), np.int64)
        shared = min(len(vector), len(query))
        query[:shared] = vector[:shared]
        return query

    def _scan(self, query: np.ndarray, rows: np.ndarray, dropped) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the ``rows`` that ``dropped(low, high)`` leaves."""
        q = query.astype(np.float64)
        a, b = q * self.least, q * self.most
        if np.maximum(np.abs(a), np.abs(b)).sum() >= _EXACT:  # beyond doubles: all in integers
            return rows, self.whole[rows] @ query
        order = np.argsort(-np.abs(q), kind="stable")
        # What the columns from each place of the order on add at least and at most.
        low = np.append(np.minimum(a, b)[order][::-1].cumsum()[::-1], 0.0)
        high = np.append(np.maximum(a, b)[order][::-1].cumsum()[::-1], 0.0)
        partial = np.zeros(len(rows))
        for at in range(0, len(order), STEP):
            read = order[at : at + STEP]
            columns = self.columns[read]
            partial += q[read] @ (columns if len(rows) == columns.shape[1] else columns[:, rows])
            end = min(at + STEP, len(order))
            if end < len(order):
                alive = ~dropped(partial + low[end], partial + high[end])
                if not alive.all():
                    rows, partial = rows[alive], partial[alive]
                if not len(rows):
                    break
        return rows, partial.astype(np.int64)

    def nearest(self, vector: list[int], label: int, own: int, n: int) -> list[tuple[int, int]]:
        """The ``n`` best (vec_id, score) of the label, without the row ``own``."""
        span = self.of_label(label)
        rows = np.arange(span.start, span.stop)
        rows = rows[self.ids[rows] != own]

        def dropped(low, high):
            if len(low) <= n:
                return np.zeros(len(low), bool)
            return high < np.partition(low, len(low) - n)[len(low) - n]

        return self._best(*self._scan(self._query(vector), rows, dropped), n)

    def in_windows(
        self, vector: list[int], label: int, windows: list[tuple[int, int]], n: int
    ) -> list[list[tuple[int, int]]]:
        """For each window of scores, the ``n`` best (vec_id, score) of other labels in it."""
        span = self.of_label(label)
        rows = np.concatenate([np.arange(span.start), np.arange(span.stop, len(self.ids))])

        def dropped(low, high):
            gone = np.ones(len(low), bool)
            for first, last in windows:
                floor = first
                certain = low[(low >= first) & (high <= last)]
                if len(certain) >= n:
                    floor = max(floor, np.partition(certain, len(certain) - n)[len(certain) - n])
                gone &= (high < floor) | (low > last)
            return gone

        rows, scores = self._scan(self._query(vector), rows, dropped)
        fits = [(scores >= first) & (scores <= last) for first, last in windows]
        return [self._best(rows[fit], scores[fit], n) for fit in fits]

    def _best(self, rows: np.ndarray, scores: np.ndarray, n: int) -> list[tuple[int, int]]:
        ids = self.ids[rows]
        if len(scores) > n:
            near = scores >= np.partition(scores, len(scores) - n)[len(scores) - n]
            ids, scores = ids[near], scores[near]
        order = np.lexsort((ids, -scores))[:n]
        return list(zip(ids[order].tolist(), scores[order].tolist()))


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores ``s`` with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


def _parts(rows: DataFrame, part_bytes: int) -> int:
    """Parts for all ``rows``: by size, or as many as small tables fill."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    n, width = found["n"], found["width"] or 1
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n * width * 8 // part_bytes), min(2 * cores, -(-n // PART_ROWS)))


def _meet(rows: DataFrame, anchors: DataFrame, parts: int, found, schema: str) -> DataFrame:
    """``found(part, anchor)`` for every part of ``rows`` and every anchor.

    A part's rows and then the anchors reach a task in one sorted stream, so that it
    holds the part and a batch of anchors.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    arrow = {"bigint": pa.int64(), "int": pa.int32()}
    fields = pa.schema([(f.split()[0], arrow[f.split()[1]]) for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, number = ([], [], []), None, None
        for batch in batches:
            out: list[tuple] = []
            for first in range(0, batch.num_rows, 1024):
                for row in batch.slice(first, 1024).to_pylist():
                    if row["part"] != number:
                        held, part, number = ([], [], []), None, row["part"]
                    if not row["anchor"]:
                        for values, name in zip(held, ("id", "label", "vector")):
                            values.append(row[name])
                        continue
                    if held[0] and part is None:
                        part = Part(*held)
                        held[2].clear()
                    if part is not None:
                        out += found(part, row)
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields
            )

    dealt = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"),
        F.lit(False).alias("anchor"),
        F.col("vec_id").alias("id"),
        "label",
        "vector",
    )
    sent = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(True).alias("anchor"),
        F.col("vec_id").alias("id"),
        "label",
        "vector",
        *(["scores"] if "scores" in anchors.columns else []),
    )
    stream = dealt.unionByName(sent, allowMissingColumns=True)
    stream = stream.repartition(parts, "part").sortWithinPartitions("part", "anchor")
    return stream.mapInArrow(run, schema)


def _top(found: DataFrame, group: list[str], n: int) -> DataFrame:
    """The best ``n`` of each group with their ``rank``; Spark cuts each task's rows first."""
    best = Window.partitionBy(*group).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` and ``anchors`` are ``vec_id, label, vector`` (see ``clean_vectors``) with each
    vec_id once; a score is the inner product, where a shorter vector counts as filled up
    with zeros, and higher scores come first, equal ones by vec_id.  For each of an anchor's best
    ``positives`` rows of its label (without itself), the best ``negatives`` rows of other
    labels are returned whose score is between ``low`` and ``high`` percent of that
    positive's.  Scores must fit a long.  No anchors or no rows give no result.
    """
    parts = _parts(rows, part_bytes)

    def near(part: Part, anchor: dict) -> list[tuple]:
        best = part.nearest(anchor["vector"], anchor["label"], anchor["id"], positives)
        return [(anchor["id"], *pair) for pair in best]

    found = _meet(rows, anchors, parts, near, "anchor_id bigint, id bigint, score bigint")
    near_rows = stored(
        _top(found, ["anchor_id"], positives).select(
            "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    scores = near_rows.groupBy("anchor_id").agg(
        F.sort_array(F.collect_set("positive_score")).alias("scores")
    )
    asking = anchors.join(scores, anchors.vec_id == scores.anchor_id).drop("anchor_id")

    def apart(part: Part, anchor: dict) -> list[tuple]:
        windows = [window(s, low, high) for s in anchor["scores"]]
        best = part.in_windows(anchor["vector"], anchor["label"], windows, negatives)
        return [
            (anchor["id"], score, *pair)
            for score, pairs in zip(anchor["scores"], best)
            for pair in pairs
        ]

    schema = "anchor_id bigint, positive_score bigint, id bigint, score bigint"
    within = _top(
        _meet(rows, asking, parts, apart, schema), ["anchor_id", "positive_score"], negatives
    )
    return near_rows.join(within, ["anchor_id", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
