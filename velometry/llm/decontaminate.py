"""Benchmark decontamination: pigeonhole edit matching.

A test item of ``n`` characters may differ by ``k`` edits.  It is cut into ``k + 1`` pieces;
at most ``k`` of them are touched by edits, so a passage within the budget holds a piece
exactly.  Piece hits give places, and Myers' bit-parallel distance verifies each.
Letters are compared in lower case, runs of white space as one space, and typographic
quotes and dashes as their ASCII forms, so that a page set anew spends none of the budget.

Items are a stated query set.  They are dealt into blocks of bounded size, and each
block passes over all documents.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velometry.llm.common import slices, texts

#: Edits allowed for each character of an item.
EDIT_RATE = 0.08
# Typographic characters and what they are compared as.
_ASCII = {
    "'": "\u2018\u2019\u201a\u201b\u2032",
    '"': "\u201c\u201d\u201e\u201f\u2033\u00ab\u00bb",
    "-": "\u2010\u2011\u2012\u2013\u2014\u2015\u2212",
}
_INK = re.compile(r"\S+")
#: Characters of items that are broadcast together.
BLOCK_CHARS = 1 << 20


class Match(NamedTuple):
    item: int
    start: int
    end: int
    edits: int


def myers_ends(pattern: str, text: str, limit: int) -> tuple[int, int] | None:
    """The least distance of ``pattern`` to a substring of ``text`` and its first end.

    None if it is above ``limit``.  One step per character of ``text``, on integers with
    a bit for each character of ``pattern``.
    """
    n = len(pattern)
    if not n:
        return (0, 0) if limit >= 0 else None
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = (n, 0) if n <= limit else (limit + 1, -1)
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        vertical = eq | minus
        eq = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(eq | plus) & full
        down = plus & eq
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        # A match may begin anywhere, so nothing is carried in from above.
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, at
            if not best:
                break
    return (best, end) if end >= 0 else None


def nearest_substring(pattern: str, text: str, limit: int) -> tuple[int, int, int] | None:
    """Edits, start and end of the substring of ``text`` nearest to ``pattern``.

    Of equally near ones it is the one that ends first, and of those the shortest.
    """
    forward = myers_ends(pattern, text, limit)
    if forward is None:
        return None
    edits, end = forward
    back = myers_ends(pattern[::-1], text[:end][::-1], edits)
    return edits, end - back[1], end


def lower(text: str) -> str:
    """Lower case, character by character where a letter would become longer."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def compared(text: str) -> str:
    """``text`` as it is compared; white space at the ends goes."""
    if not text.isascii():
        for plain, fancy in _ASCII.items():
            for c in fancy:
                if c in text:
                    text = text.replace(c, plain)
    return lower(" ".join(text.split()))


def raw_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where ``compared(text)[start:end]`` stands in ``text``."""
    raw, own, length = [], [], 0
    for ink in _INK.finditer(text):
        raw.append(ink.start())
        own.append(length)
        length += ink.end() - ink.start() + 1

    def place(at: int) -> int:
        word = bisect_right(own, at) - 1
        return raw[word] + at - own[word]

    return place(start), place(end - 1) + 1


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[str], rate: float):
        self.items = [compared(t) for t in items]
        self.limits = [int(len(t) * rate) for t in self.items]
        self.automaton = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for number, (item, limit) in enumerate(zip(self.items, self.limits)):
            if not item:
                continue
            cuts = [round(len(item) * i / (limit + 1)) for i in range(limit + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(item[a:b], []).append((number, a))
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[Match]:
        """The nearest passage of each item that is within its budget, by item."""
        if not len(self.automaton):
            return []
        low = compared(text)
        windows: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(low):
            for number, offset in places:
                limit = self.limits[number]
                begin = last + 1 - size - offset
                first = max(0, begin - limit)
                end = begin + len(self.items[number]) + limit
                own = windows.setdefault(number, [])
                # Hits come by their last character; windows that touch are one.
                if own and first <= own[-1][1]:
                    own[-1][0] = min(own[-1][0], first)
                    own[-1][1] = max(own[-1][1], end)
                else:
                    own.append([first, end])
        found = []
        for number, own in sorted(windows.items()):
            best = None
            for first, end in own:
                limit = self.limits[number] if best is None else best[0] - 1
                near = nearest_substring(self.items[number], low[first:end], limit)
                if near is not None:
                    best = (near[0], first + near[1], first + near[2])
                    if not best[0]:
                        break
            if best is not None:
                found.append(Match(number, *raw_span(text, *best[1:]), best[0]))
        return found


def _blocks(items: DataFrame) -> int:
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return 1 + size // BLOCK_CHARS


def _block_items(items: DataFrame, block: int, blocks: int) -> list[tuple[int | None, str]]:
    """One block, dealt by hash; its size is about ``BLOCK_CHARS`` whatever the table's."""
    own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
    rows = own.select("item_id", "text").distinct().orderBy("item_id", "text").collect()
    return [(r.item_id, r.text) for r in rows]


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("text <> ''")


#: The matcher that this Python worker used last.
_MATCHERS: dict[str, Matcher] = {}


def _shared_matcher(
    spark, items: list[tuple[int | None, str]], rate: float
) -> Callable[[], Matcher]:
    """A function that gives a task its matcher; a Python worker builds it once."""
    sent = spark.sparkContext.broadcast([t for _, t in items])
    key = uuid.uuid4().hex

    def matcher() -> Matcher:
        if key not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[key] = Matcher(sent.value, rate)
        return _MATCHERS[key]

    return matcher


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE
) -> DataFrame:
    """``doc_id, item_id, start, end, edits`` for each document and each item it holds.

    The passage is the nearest, of equal ones the first; offsets are code points of the
    text as it is, edits count in the compared form.  Items that are null, empty or white
    space match nothing, null or empty texts hold nothing.  Repeated
    documents give repeated rows, repeated items one.  A null doc_id or item_id stays
    null.  Other columns are not read; an empty table on either side gives no rows.
    """
    spark = documents.sparkSession
    items = _items(benchmark)
    own = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    blocks = _blocks(items)
    parts = []
    for block in range(blocks):
        listed = _block_items(items, block, blocks)
        parts.append(own.mapInArrow(_finder(spark, listed, rate), _FOUND))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


_FOUND = "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint"


def _finder(spark, items: list[tuple[int | None, str]], rate: float):
    matcher, ids = _shared_matcher(spark, items, rate), [i for i, _ in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [
                    (doc, ids[m.item], m.start, m.end, m.edits)
                    for doc, text in zip(part.column("doc_id").to_pylist(), texts(part, "text"))
                    for m in matcher().find(text)
                ]
                columns = zip(*rows) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["doc_id", "item_id", "start", "end", "edits"],
                )

    return run


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE
) -> DataFrame:
    """The rows of ``documents`` that hold no item, unchanged, with all their columns.

    A null doc_id makes no difference; repeated rows stay or go together; a null or empty
    text is kept; an empty table on either side leaves the documents as they are.
    """
    spark = documents.sparkSession
    items = _items(benchmark)
    blocks = _blocks(items)
    kept = documents
    for block in range(blocks):
        matcher = _shared_matcher(spark, _block_items(items, block, blocks), rate)

        def keep(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    clean = [not matcher().find(t) for t in texts(part, "text")]
                    yield part.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(keep, documents.schema)
    return kept
