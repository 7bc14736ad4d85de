"""SimHash near-duplicates: fingerprints, and links found by pigeonring filtering.

A 64-bit fingerprint is cut into boxes on a ring.  If two differ in at most ``t``
bits over ``m`` boxes, some box starts a chain in which, for every length ``l``, the
first ``l`` boxes differ in at most ``l * t / m`` bits.  The longest chain prefix whose
budget is below one bit must be equal, so it is the key of an equi-join; the
budgets of the longer chains prune the pairs before the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velometry.llm.common import null_safe_join, slices, stored
from velometry.llm.components import connected

SEED = 42
BITS = 64
#: Fingerprints with one key that are still compared pair by pair.
CROWDED = 64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | bytes, words: int) -> int:
    """The unsigned fingerprint: each bit as in over half the hashes of the shingles."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    tokens = raw.translate(_LOWER).split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles, n = iter([b" ".join(tokens)]), 1
    else:
        n = len(tokens) - words + 1
        shingles = map(b" ".join, zip(*(islice(tokens, i, None) for i in range(words))))
    ones = np.zeros(BITS, np.int64)
    for first in range(0, n, 1 << 15):
        size = min(n - first, 1 << 15)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(s, SEED) for s in islice(shingles, size)), "<u8", size
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (as a signed long) of each row; a text without words has 0."""

    return _fingerprints(documents, words, F.lit(0)).drop("row_hash")


def _fingerprints(documents: DataFrame, words: int, row_hash: Column) -> DataFrame:
    """``fingerprints`` with the ``row_hash`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw = part.column("text").cast(pa.binary()).to_pylist()
                own = [fingerprint(t or b"", words) for t in raw]
                signed = np.array(own, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(signed), part.column("row_hash")],
                    ["doc_id", "fingerprint", "row_hash"],
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        row_hash.cast("long").alias("row_hash"),
    ).mapInArrow(run, "doc_id bigint, fingerprint bigint, row_hash bigint")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _chains(distance: int, boxes: int) -> tuple[int, list[list[int]]]:
    """The length of the equal prefix, and for each start the mask of each chain length."""
    cuts = [round(BITS * i / boxes) for i in range(boxes + 1)]
    widths = [b - a for a, b in zip(cuts, cuts[1:])]
    equal = max(n for n in range(boxes + 1) if n * distance < boxes)
    masks = [
        [
            _signed((1 << sum(widths[(start + i) % boxes] for i in range(n))) - 1)
            for n in range(1, boxes + 1)
        ]
        for start in range(boxes)
    ]
    return equal, masks


def links(prints: DataFrame, distance: int, boxes: int = 7) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints within ``distance`` bits of each other.

    ``prints`` holds each ``fingerprint`` once.  A key with up to ``CROWDED`` of them is
    compared pair by pair.  The fingerprints of a larger one are linked without
    pairs, exactly: two are within the distance if and only if the balls of half
    the distance around them meet, so all that meet in a point are linked to one.
    """
    if not 0 < distance < boxes or distance > 4:
        raise ValueError("distance must be 1 to 4 and below the number of boxes")
    equal, masks = _chains(distance, boxes)
    cuts = [round(BITS * i / boxes) for i in range(boxes)]

    def ring(start: int) -> Column:
        c, f = cuts[start], F.col("fingerprint")
        if not c:
            return f
        return F.shiftrightunsigned(f, c).bitwiseOR(F.shiftleft(f, BITS - c))

    rows = prints.select(
        "fingerprint",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("box"),
                        ring(i).bitwiseAND(F.lit(masks[i][equal - 1])).alias("key"),
                        ring(i).alias("turned"),
                    )
                    for i in range(boxes)
                )
            )
        ).alias("r"),
    ).select("fingerprint", "r.*")
    shared = rows.groupBy("box", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(null_safe_join(rows, shared, ["box", "key"], "inner"))
    few = members.filter(F.col("n") <= CROWDED).drop("n")
    table = F.array(*(F.lit(m) for own in masks for m in own))

    def within(n: int) -> Column:
        mask = F.get(table, F.col("box") * boxes + (n - 1))
        apart = F.col("turned").bitwiseXOR(F.col("turned2")).bitwiseAND(mask)
        return F.bit_count(apart) <= n * distance // boxes

    other = few.select(
        F.col("fingerprint").alias("fingerprint2"),
        F.col("box").alias("box2"),
        F.col("key").alias("key2"),
        F.col("turned").alias("turned2"),
    )
    chained = F.lit(True)
    for n in range(equal + 1, boxes):
        chained = chained & within(n)
    pairs = (
        few.join(other, (F.col("box") == F.col("box2")) & (F.col("key") == F.col("key2")))
        .filter(F.col("fingerprint") < F.col("fingerprint2"))
        .filter(chained)
        .filter(
            F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("fingerprint2"))) <= distance
        )
        .select(F.col("fingerprint").alias("a"), F.col("fingerprint2").alias("b"))
    )
    crowd = members.filter(F.col("n") > CROWDED).select("fingerprint").distinct()
    return pairs.union(_meeting(crowd, distance)).distinct()


def _meeting(prints: DataFrame, distance: int) -> DataFrame:
    near, far = distance // 2, (distance + 1) // 2
    ball = [
        (_signed(sum(1 << b for b in bits)), n)
        for n in range(far + 1)
        for bits in combinations(range(BITS), n)
    ]
    points = prints.select(
        "fingerprint",
        F.explode(
            F.array(*(F.struct(F.lit(m).alias("flip"), F.lit(n).alias("n")) for m, n in ball))
        ).alias("p"),
    ).select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("p.flip")).alias("point"), "p.n")
    # A point has at most as many members as the ball has points.
    groups = points.groupBy("point").agg(
        F.min(F.when(F.col("n") <= near, F.col("fingerprint"))).alias("a"),
        F.collect_set("fingerprint").alias("members"),
    )
    return (
        groups.filter(F.col("a").isNotNull() & (F.size("members") > 1))
        .select("a", F.explode("members").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def near_duplicates(
    documents: DataFrame, words: int = 3, distance: int = 2, boxes: int = 7
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``documents``.

    ``component_id`` is the smallest doc_id among all rows reachable over links of at
    most ``distance`` differing bits.  Texts without words share fingerprint 0 and are
    linked like others.  Rows with a null doc_id take part, but never name a component; it is
    null if no row of it has a doc_id.  Repeated rows are kept, other columns are
    not read, an empty table gives no rows.
    """
    return _grouped(stored(fingerprints(documents, words)), distance, boxes).drop("component")


def _grouped(own: DataFrame, distance: int, boxes: int) -> DataFrame:
    """Stored ``own`` with the ``component_id`` of each row and its ``component``.

    Two components may have one component_id, if a doc_id is repeated; ``component``, a
    fingerprint, tells them apart.
    """
    classes = stored(own.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    found = connected(links(classes.select("fingerprint"), distance, boxes))
    labelled = classes.join(found, classes.fingerprint == found.node, "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component")
    )
    # Only linked classes need a component's minimum; others have their own.
    least = (
        labelled.filter("component is not null")
        .groupBy("component")
        .agg(F.min("first").alias("component_id"))
    )
    by_print = null_safe_join(labelled, least, ["component"]).select(
        "fingerprint", "component_id", "component"
    )
    return null_safe_join(own, by_print, ["fingerprint"])


def keep_one(documents: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest doc_id.

    If a group has that doc_id several times, the row of the least hash stays; a doc_id
    that is in several groups stays once for each group of which it is the smallest.
    Rows with a null doc_id cannot be told apart and stay.
    """
    names = documents.columns
    # A null adds nothing to a hash, so its place is hashed as well.  Maps have no hash.
    hashed = ["text", *(n for n, kind in documents.dtypes if n != "text" and "map<" not in kind)]
    cells = [F.col(f"`{n}`") for n in hashed]
    row_hash = F.xxhash64(*cells, *(c.isNull() for c in cells))
    own = stored(_fingerprints(documents, words, row_hash))
    kept = (
        _grouped(own, distance, 7)
        .filter("doc_id = component_id")
        .groupBy("component")
        .agg(F.min("doc_id").alias("__kept_id"), F.min("row_hash").alias("__kept_hash"))
        .drop("component")
    )
    one = documents.withColumn("__row_hash", row_hash)
    same = (one["doc_id"].cast("long") == kept["__kept_id"]) & (
        one["__row_hash"] == kept["__kept_hash"]
    )
    one = one.join(kept, same, "left_semi").dropDuplicates(["doc_id", "__row_hash"])
    return (
        one.drop("__row_hash")
        .unionByName(documents.filter(F.col("doc_id").isNull()))
        .select(*(F.col(f"`{n}`") for n in names))
    )
