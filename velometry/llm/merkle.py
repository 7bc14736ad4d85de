"""Merkle manifest of a dataset: digests swept up to a root, proofs swept back down.

Time-forward processing: a node's digest is a message to its parent, held in a priority
queue ordered by the parent's label, so that a node is made when its label comes up
and all messages to it lie at the front.  The queue is external: across tasks it is
Spark's sorted shuffle, which brings a task its messages in order of label, and within a
task a heap over the consecutive nodes whose top it makes, of ``DEPTH`` levels at a time.  The reversed sweep goes through the same labels downward: each
node sends its children the proof suffix that they share, and adds their siblings.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velometry.functions.numbering import numbered
from velometry.llm.common import stored

FANOUT = 16
#: Levels that one round climbs: a task holds ``FANOUT ** DEPTH`` nodes for it at a time.
DEPTH = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_DOWN = "source string, pos bigint, path array<string>, subroot string, root string"
_PROOF = (
    "doc_id bigint, leaf string, subroot string, root string, path array<string>, "
    "proof_sha256 string, folded_root string"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 over the fields as text, each behind its length in bytes; null is ``-``."""
    texts = [f.cast("string") for f in fields]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(documents: DataFrame, presented: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, source, leaf, presented`` of each row.

    ``presented`` is the leaf with some fields replaced, as a reader might show it for
    verification; without replacements it is the leaf itself.
    """
    own = {name: F.col(f"`{name}`") for name in FIELDS}
    shown = own | (presented or {})
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_digest(list(own.values())).alias("leaf"),
        leaf_digest(list(shown.values())).alias("presented"),
    )


def _height(n: int, depth: int) -> int:
    """The levels that a round climbs in a group of ``n`` nodes, ``depth`` at most."""
    if n > FANOUT**depth:
        return depth
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _sweep(digests: list[str], height: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The top over ``digests``, and the children of each node by its label."""
    runs: dict[tuple[int, int], list[str]] = {}
    if not height:
        return digests[0], runs
    # In order of label already, so a heap as it is.
    queue = [(1, i // FANOUT, i % FANOUT, d) for i, d in enumerate(digests)]
    while True:
        label = queue[0][:2]
        children = []
        while queue and queue[0][:2] == label:
            children.append(heapq.heappop(queue)[3])
        runs[label] = children
        made = digest("".join(children))
        level, index = label
        if level == height:
            return made, runs
        heapq.heappush(queue, (level + 1, index // FANOUT, index % FANOUT, made))


def _paths(digests: list[str], height: int, above: list[str]) -> Iterator[list[str]]:
    """The path of each node: what stands before and after it, level by level, to the root."""
    if not height:
        yield above
        return
    runs = _sweep(digests, height)[1]
    suffixes = {(height, 0): above}
    for level, index in sorted(runs, reverse=True):
        if level == 1:
            break
        children, suffix = runs[level, index], suffixes.pop((level, index))
        for slot in range(len(children)):
            around = ["".join(children[:slot]), "".join(children[slot + 1 :])]
            suffixes[level - 1, FANOUT * index + slot] = around + suffix
    for index in range(len(suffixes)):
        children, suffix = runs[1, index], suffixes[1, index]
        for slot in range(len(children)):
            yield ["".join(children[:slot]), "".join(children[slot + 1 :]), *suffix]


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its path lead to."""
    for before, after in zip(path[::2], path[1::2]):
        leaf = digest(before + leaf + after)
    return leaf


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        # A row may carry a path of some kilobytes.
        for first in range(0, batch.num_rows, 1024):
            yield from batch.slice(first, 1024).to_pylist()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of rows with one source and chunk; sorted input brings them together."""
    held: list[dict] = []
    for row in _rows(batches):
        if held and (held[0]["source"], held[0]["chunk"]) != (row["source"], row["chunk"]):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 1024:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _queued(df: DataFrame, *order: str) -> DataFrame:
    """Messages and nodes where their chunk is made, in order of label."""
    return df.repartition("source", "chunk").sortWithinPartitions("source", "chunk", *order)


def _rise(nodes: DataFrame, depth: int) -> DataFrame:
    """One round up: the top of each chunk of the groups that have several nodes."""
    size, text, number = FANOUT**depth, pa.string(), pa.int64()
    schema = pa.schema([("source", text), ("pos", number), ("n", number), ("digest", text)])

    def run(batches):
        def tops():
            for rows in _chunks(batches):
                n, chunk = rows[0]["n"], rows[0]["chunk"]
                top = _sweep([r["digest"] for r in rows], _height(n, depth))[0]
                yield rows[0]["source"], chunk, -(-n // size), top

        yield from _batches(tops(), schema)

    own = nodes.filter("n > 1").select(
        "source", F.expr(f"pos div {size}").alias("chunk"), "pos", "n", "digest"
    )
    return _queued(own, "pos").mapInArrow(run, "source string, pos bigint, n bigint, digest string")


def _fall(
    nodes: DataFrame, messages: DataFrame, depth: int, proofs: bool, paths: bool
) -> DataFrame:
    """One round down: ``messages`` to the chunks' tops become those of their nodes.

    With ``proofs`` the nodes are leaves, and their proofs are made.
    """
    text = pa.string()
    if proofs:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("leaf", text), ("subroot", text), ("root", text)]
            + [("path", pa.list_(text)), ("proof_sha256", text), ("folded_root", text)]
        )
    else:
        schema = pa.schema(
            [("source", text), ("pos", pa.int64()), ("path", pa.list_(text))]
            + [("subroot", text), ("root", text)]
        )

    def made(rows: list[dict]) -> Iterator[tuple]:
        message, own = rows[0], rows[1:]
        ends = message["subroot"], message["root"]
        found = _paths([r["digest"] for r in own], _height(own[0]["n"], depth), message["path"])
        for row, path in zip(own, found):
            if proofs:
                yield (
                    row["doc_id"], row["digest"], *ends, path if paths else None,
                    digest("".join(path)), fold(row["presented"], path),
                )
            else:
                yield row["source"], row["pos"], path, *ends

    def run(batches):
        yield from _batches((r for rows in _chunks(batches) for r in made(rows)), schema)

    leaf = ["doc_id", "presented"] if proofs else []
    kinds = dict(nodes.dtypes)
    own = nodes.select(
        "source", F.expr(f"pos div {FANOUT**depth}").alias("chunk"), "pos", "n", "digest", *leaf
    ).withColumn("kind", F.lit(1))
    sent = messages.select(
        "source", F.col("pos").alias("chunk"), "path", "subroot", "root",
        *(F.lit(None).cast(kinds[c]).alias(c) for c in leaf), F.lit(0).alias("kind"),
    )
    queue = _queued(own.unionByName(sent, allowMissingColumns=True), "kind", "pos")
    return queue.mapInArrow(run, _PROOF if proofs else _DOWN)


def _climb(nodes: DataFrame, most: int, depth: int) -> list[DataFrame]:
    """The nodes of each round, up to that in which every group has one."""
    rounds = [nodes]
    while most > 1:
        rounds.append(stored(_rise(rounds[-1], depth)))
        most = -(-most // FANOUT**depth)
    return rounds


def _descend(
    rounds: list[DataFrame],
    messages: DataFrame,
    depth: int,
    proofs: bool,
    paths: bool = False,
) -> DataFrame:
    """``messages``, with the ``round`` in which they name a group's only node, sent down."""
    sent = messages.filter(F.col("round") == len(rounds) - 1).drop("round")
    for number in range(len(rounds) - 2, 0, -1):
        down = _fall(rounds[number].filter("n > 1"), sent, depth, False, False)
        sent = stored(down).unionByName(
            messages.filter(F.col("round") == number).drop("round")
        )
    if len(rounds) > 1:  # groups of one leaf are told directly
        sent = sent.unionByName(messages.filter("round = 0").drop("round"))
    return _fall(rounds[0], sent, depth, proofs, paths)


def manifest(leaves: DataFrame, paths: bool = False, depth: int = DEPTH) -> DataFrame:
    """``doc_id, leaf, subroot, root, path, proof_sha256, folded_root`` of each leaf.

    ``leaves`` are those of ``leaves()``.  Per source they ascend by doc_id (null first,
    equal ones by leaf), ``FANOUT`` to a parent up to one subroot; the subroots ascend by
    source (null first, bytewise) up to the root.  A lone node is not hashed again.
    ``path`` (null unless asked for) lists what stands before and after the node at each
    level, ``proof_sha256`` is the digest of all of it, and ``folded_root`` is where
    the path leads from ``presented``.  Repeated rows are leaves of their own; an
    empty table gives no rows.

    A source may hold any share of the leaves: places are counted over ranges, and a
    task holds ``FANOUT ** depth`` leaves at a time.
    """
    # Ranges are sampled first, which must not hash the texts once more.
    placed = numbered(stored(leaves), ["doc_id", "leaf"], stored, ["source"], "place", "n")
    nodes = stored(
        placed.select(
            "source", (F.col("place") - 1).alias("pos"), "n",
            F.col("leaf").alias("digest"), "doc_id", "presented",
        )
    )
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = _climb(nodes, most, depth)
    tops = [
        r.filter("n = 1").select("source", "digest", F.lit(i).alias("round"))
        for i, r in enumerate(rounds)
    ]
    subroots = tops[0]
    for top in tops[1:]:
        subroots = subroots.unionByName(top)
    # The tree over the subroots has one group, and its own leaves are the subroots.
    ranked = stored(numbered(subroots, ["source"], stored, name="place", total="n"))
    above = ranked.select(
        F.lit("").alias("source"), (F.col("place") - 1).alias("pos"), "n", "digest"
    )
    sources = ranked.agg(F.max("n")).first()[0] or 0
    levels = _climb(above, sources, depth)
    text = "cast(null as string)"
    top = levels[-1].selectExpr(
        "source", "pos", "cast(array() as array<string>) as path", f"{text} as subroot",
        "digest as root", f"{len(levels) - 1} as round",
    )
    down = _descend(levels, top, depth, proofs=False).select("pos", "path", "root")
    messages = stored(
        ranked.select("source", "round", "digest", (F.col("place") - 1).alias("pos"))
        .join(down, "pos")
        .select(
            "source", F.lit(0).cast("long").alias("pos"), "path",
            F.col("digest").alias("subroot"), "root", "round",
        )
    )
    return _descend(rounds, messages, depth, proofs=True, paths=paths)
