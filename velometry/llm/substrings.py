"""Substring dedup over words: level-wise doubling of repeated windows.

The first level looks at windows of half the wanted length.  A window of the next
length, twice as long (its halves overlap by a word where the length is odd), is only a
candidate where the half windows in it are repeated, and survives if it is itself.
``drop_repeated`` stops at the wanted length, as longer windows cover no other words;
``drop_and_extend`` and ``longest_repeats`` go on until no candidates survive.

``drop_and_extend`` reads no text again for that.  A repeated window is named by the place of
its first occurrence (least doc_id), so a repeated passage is a run of consecutive
names.  Two halves with names that follow each other are a window at that very place;
only where they do not, the pair of names is sent and gets a name of its own.

Documents are dealt into blocks by a hash, and block and window hash into
parts, both in numbers that follow the size of the input.  A block sends each part its different
window hashes, packed; a part answers each block with those that count.  A passage
that every document shares is thus one entry per block, not one per document.

Windows are compared by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velometry.llm.common import stored

#: Bytes of text in a block, and those whose windows one part gathers.
BLOCK_BYTES = 2 << 20
PART_BYTES = 8 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_EMPTY = np.empty(0, np.uint64)
_NO_IDS = np.empty(0, np.int64)
#: Who has a window first: a smaller doc_id, an equal one in another block, or the block itself.
_SMALLER, _EQUAL, _OWN = 0, 1, 2


def words_of(text: bytes | None) -> list[bytes]:
    """Words are runs without ASCII white space."""
    return (text or b"").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each window of ``size`` word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return _EMPTY
    total = words[:n].copy()
    for i in range(1, size):
        total = total * _MULTIPLIER + words[i : i + n]
    return _mixed(total)


def least_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` hashes in a row."""
    step, least = 1, hashes
    while step * 2 <= size:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = size - step
    return np.minimum(least[:-rest], least[rest:]) if rest else least


class _Block:
    """A block of documents in the order of doc_id (null first), with their word hashes.

    Each has a base, a hash of doc_id and text; base plus position names a place.
    """

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        raw = table.column("text").cast(pa.binary())
        bases = [
            xxhash.xxh64_intdigest(t.as_py() or b"", (d or 0) % (1 << 64))
            for d, t in zip(ids, raw)
        ]
        order = sorted(
            range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, bases[i])
        )
        self.number = table.column("block")[0].as_py() if len(ids) else 0
        self.ids = [ids[i] for i in order]
        self.bases = np.array([bases[i] for i in order], np.uint64)
        self.texts = [raw[i] for i in order]
        self.hashes = [self._hashed(t) for t in self.texts]

    @staticmethod
    def _hashed(text: pa.Scalar) -> np.ndarray:
        words = words_of(text.as_py())
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))

    def compared(self, size: int) -> Iterator[tuple[int, np.uint64, np.ndarray]]:
        """doc_id, base and word hashes of those documents that have a window."""
        for doc, base, hashes in zip(self.ids, self.bases, self.hashes):
            if doc is not None and len(hashes) >= size:
                yield doc, base, hashes


def _unpack(column: pa.ChunkedArray, kind=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """All numbers that the cells of a column hold, and how many each cell has.

    They are read where Arrow has them, without an object for each cell.
    """
    values, sizes = [np.empty(0, kind)], [np.empty(0, np.int64)]
    for cells in column.chunks:
        if len(cells):
            _, ends, data = cells.buffers()
            width = np.int64 if pa.types.is_large_binary(cells.type) else np.int32
            ends = np.frombuffer(ends, width)[cells.offset : cells.offset + len(cells) + 1]
            size = ends[-1] - ends[0]
            if size:
                values.append(np.frombuffer(data, np.uint8, size, ends[0]).view(kind))
            sizes.append(np.diff(ends).astype(np.int64) // 8)
    return np.concatenate(values), np.concatenate(sizes)


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def _first_level(docs: _Block, half: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The half windows that stand for the windows of a block, and which two documents have.

    A window is represented by the smallest hash among its half windows, so equal
    windows have equal representatives, and a few of the hashes represent all.
    """
    chosen = [
        np.unique(least_of(window_hashes(h, half), size - half + 1))
        for _, _, h in docs.compared(size)
    ]
    if not chosen:
        return _EMPTY, _EMPTY
    values, counts = np.unique(np.concatenate(chosen), return_counts=True)
    return values, values[counts > 1]


def _parted(
    block: int,
    values: np.ndarray,
    parts: int,
    ids: np.ndarray | None = None,
    names: np.ndarray | None = None,
) -> pa.Table:
    """Values (and the doc_ids and names that belong to them) packed for each part."""
    part = (values >> np.uint64(1)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    part = part[order]
    numbers, first = np.unique(part, return_index=True)
    ends = [*first[1:], len(part)]

    def cells(column: np.ndarray | None) -> pa.Array:
        if column is None:
            return pa.nulls(len(ends) if len(numbers) else 0, pa.binary())
        column = column[order]
        return pa.array([column[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())

    return pa.table(
        {
            "part": pa.array(numbers.astype(np.int64)),
            "block": pa.array(np.full(len(numbers), block, np.int64)),
            "hashes": cells(values),
            "ids": cells(ids),
            "names": cells(names),
        }
    )


def _first_parted(
    block: int, values: np.ndarray, ids: np.ndarray, names: np.ndarray, parts: int
) -> pa.Table:
    """Each value once, with its first entry.  Documents come by doc_id, so that is the least."""
    values, first = np.unique(values, return_index=True)
    by_id = np.argsort(first, kind="stable")
    first = first[by_id]
    return _parted(block, values[by_id], parts, ids[first], names[first])


_SENT = "part bigint, block bigint, hashes binary, ids binary, names binary"
_ANSWER = "block bigint, hashes binary"
_NAMED = "block bigint, kind int, hashes binary, names binary"


def _by_row(blocks: np.ndarray, values: np.ndarray, rows: np.ndarray) -> pa.Table:
    """An answer to each block that has one; ``rows`` ascend."""
    found, first = np.unique(rows, return_index=True)
    cells = np.split(values, first[1:]) if len(found) else []
    return pa.table(
        {
            "block": pa.array(blocks[found]),
            "hashes": pa.array([v.tobytes() for v in cells], pa.binary()),
        }
    )


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks, all hashes, and for each hash the row that sent it."""
    values, sizes = _unpack(table.column("hashes"))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return table.column("block").to_numpy(), values, rows


def _shared(table: pa.Table) -> pa.Table:
    """To each block those of its hashes that another block has too."""
    blocks, values, rows = _entries(table)
    _, back, counts = np.unique(values, return_inverse=True, return_counts=True)
    common = counts[back] > 1
    return _by_row(blocks, values[common], rows[common])


def _owned(table: pa.Table) -> pa.Table:
    """To each block those of its hashes that another block has, and who has them first.

    First is the smallest doc_id, then the smallest name, which the block gets unless it
    is its own.
    """
    blocks, values, rows = _entries(table)
    ids, _ = _unpack(table.column("ids"), np.int64)
    names, _ = _unpack(table.column("names"))
    order = np.lexsort((names, ids, values))
    values, rows, ids, names = values[order], rows[order], ids[order], names[order]
    fresh = np.ones(len(values) + 1, bool)
    fresh[1:-1] = values[1:] != values[:-1]
    first = np.maximum.accumulate(np.where(fresh[:-1], np.arange(len(values)), 0))
    common = ~(fresh[:-1] & fresh[1:])
    kind = np.where(ids > ids[first], _SMALLER, np.where(fresh[:-1], _OWN, _EQUAL))
    found = []
    for wanted in (_SMALLER, _EQUAL, _OWN):
        at = np.flatnonzero(common & (kind == wanted))
        at = at[np.argsort(rows[at], kind="stable")]
        answer = _by_row(blocks, values[at], rows[at])
        if wanted == _OWN:
            owners = pa.nulls(len(answer), pa.binary())
        else:
            owners = _by_row(blocks, names[first[at]], rows[at]).column("hashes")
        kinds = pa.array(np.full(len(answer), wanted, np.int32))
        columns = [answer.column("block"), kinds, answer.column("hashes"), owners]
        found.append(pa.table(dict(zip(("block", "kind", "hashes", "names"), columns))))
    return pa.concat_tables(found)


def _named(
    keys: np.ndarray, ids: np.ndarray, bases: np.ndarray, names: np.ndarray, answer: pa.Table
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of a block its name, and whether a smaller doc_id, another row has it.

    ``ids``, ``bases`` and ``names`` (its own place) are those of the window's document;
    the windows come in the order of the documents.
    """
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(fresh)
    first, last = order[starts], order[np.append(starts[1:], len(keys)) - 1] if len(keys) else order
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(fresh) - 1
    values, owner, least = ordered[starts], names[first], ids[first]
    shared = bases[first] != bases[last]
    smaller = np.zeros(len(values), bool)
    for kind in (_SMALLER, _EQUAL, _OWN):
        cells = answer.filter(pc.equal(answer.column("kind"), kind))
        at = np.searchsorted(values, _unpack(cells.column("hashes"))[0])
        shared[at] = True
        if kind != _OWN:
            owner[at] = _unpack(cells.column("names"))[0]
        if kind == _SMALLER:
            smaller[at] = True
    return owner[group], smaller[group] | (least[group] < ids), shared[group]


def _runs(
    rows: np.ndarray, at: np.ndarray, names: np.ndarray, earlier: np.ndarray
) -> dict[int, np.ndarray]:
    """For each row its repeated windows as runs: position, length, name, held by a smaller one."""
    if not len(rows):
        return {}
    follows = (rows[1:] == rows[:-1]) & (at[1:] == at[:-1] + 1) & (earlier[1:] == earlier[:-1])
    follows &= names[1:] == names[:-1] + np.uint64(1)
    starts = np.flatnonzero(np.append(True, ~follows))
    sizes = np.diff(np.append(starts, len(rows)))
    runs = np.stack([at[starts], sizes, names[starts].view(np.int64), earlier[starts]], axis=1)
    found, first = np.unique(rows[starts], return_index=True)
    return dict(zip(found.tolist(), np.split(runs.astype(np.int64), first[1:])))


def _dealt(documents: DataFrame) -> tuple[DataFrame, int]:
    """Documents with their block, and the number of parts."""
    own = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = F.lit(1 + size // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), blocks)
    return own.withColumn("block", block), 1 + size // PART_BYTES


def _answered(docs: DataFrame, answers: DataFrame, step, schema: str) -> DataFrame:
    """``step`` on each block together with the answers to it."""
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(step, schema)


def _half_windows(docs: DataFrame, words: int, parts: int) -> DataFrame:
    """The answers to the first level: representatives that other blocks have, too."""
    half = (words + 1) // 2

    def send(table: pa.Table) -> pa.Table:
        own = _Block(table)
        return _parted(own.number, _first_level(own, half, words)[0], parts)

    sent = docs.groupBy("block").applyInArrow(send, _SENT)
    return sent.groupBy("part").applyInArrow(_shared, _ANSWER)


def _candidates(
    docs: _Block, answer: pa.Table, words: int
) -> Iterator[tuple[int, np.uint64, np.ndarray, np.ndarray]]:
    """doc_id, base, word hashes, and which windows have a repeated half window."""
    half = (words + 1) // 2
    repeated = np.union1d(
        _first_level(docs, half, words)[1], _unpack(answer.column("hashes"))[0]
    )
    for doc, base, h in docs.compared(words):
        least = least_of(window_hashes(h, half), words - half + 1)
        yield doc, base, h, _member(least, repeated)


def drop_repeated(documents: DataFrame, words: int = 13) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for each row of ``documents``.

    A word goes if a window of ``words`` words covers it that also starts in a document
    with a smaller doc_id.  What is left is joined by single spaces.  A null text has
    no words.  A row with a null doc_id is compared with none and keeps its words; rows
    with the same doc_id do not count as smaller than each other.  Other columns are
    not read, an empty table gives no rows.
    """
    decided, _ = _decided(documents, words)
    return decided.select("doc_id", "n_words", "n_removed", "kept_text")


def drop_and_extend(
    documents: DataFrame, words: int = 13, keep: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``drop_repeated``, and ``doc_id, longest`` for those that lose words.

    ``longest`` is the longest of the lengths ``words``, twice that, and so on, at which a
    window of the document also starts in a document with a smaller doc_id.  Windows
    repeated at one length alone are extended to twice that length, until none of a
    smaller document survives.  Of rows with the same doc_id the longest counts.
    The first result is a stored table, in which ``keep``, an expression of ``kept_text``,
    takes its place if given (a digest needs far less room).  Null doc_ids and empty
    tables have no row in the second result.
    """
    decided, parts = _decided(documents, words)
    rows = ["doc_id", "n_words", "n_removed", "kept_text" if keep is None else keep]
    decided = stored(decided.select(*rows, "block", "base", "runs"))
    state = decided.where(F.length("runs") > 0).select("block", "doc_id", "base", "runs")
    size = words
    levels = [decided.where("n_removed > 0").select("doc_id", F.lit(size).alias("longest"))]
    more = not levels[0].isEmpty()
    while more:
        sent = state.groupBy("block").applyInArrow(_ask_for(size, parts), _SENT)
        answers = sent.groupBy("part").applyInArrow(_owned, _NAMED)
        state = stored(_answered(state, answers, _doubled(size), f"{_STATE}, earlier boolean"))
        size *= 2
        held = state.where("earlier")
        more = not held.isEmpty()
        levels.append(held.select("doc_id", F.lit(size).alias("longest")))
    found = levels[0]
    for level in levels[1:]:
        found = found.union(level)
    longest = F.max("longest").cast("long").alias("longest")
    return decided.drop("block", "base", "runs"), found.groupBy("doc_id").agg(longest)


_STATE = "block bigint, doc_id bigint, base bigint, runs binary"


def _decided(documents: DataFrame, words: int) -> tuple[DataFrame, int]:
    """Each row with what is kept of it and the runs of its repeated windows; the number of parts."""
    if words < 2:
        raise ValueError("a window has two words at least")
    docs, parts = _dealt(documents)

    def send(table: pa.Table, answer: pa.Table) -> pa.Table:
        block = _Block(table)
        found, ids, names = [_EMPTY], [_NO_IDS], [_EMPTY]
        for doc, base, h, candidates in _candidates(block, answer, words):
            at = np.flatnonzero(candidates)
            if len(at):
                values, first = np.unique(window_hashes(h, words)[at], return_index=True)
                found.append(values)
                ids.append(np.full(len(values), doc, np.int64))
                names.append(base + at[first].astype(np.uint64))
        return _first_parted(block.number, *map(np.concatenate, (found, ids, names)), parts)

    def decide(table: pa.Table, answer: pa.Table) -> pa.Table:
        block = _Block(table)
        windows = [
            _EMPTY if doc is None else window_hashes(h, words)
            for doc, h in zip(block.ids, block.hashes)
        ]
        sizes = np.array([len(w) for w in windows], np.int64)
        first = np.cumsum(sizes) - sizes
        rows = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(rows)) - first[rows]
        ids = np.array([d or 0 for d in block.ids], np.int64)[rows]
        bases = block.bases[rows]
        names, gone, shared = _named(
            np.concatenate([_EMPTY, *windows]), ids, bases, bases + at.astype(np.uint64), answer
        )
        runs = _runs(rows[shared], at[shared], names[shared], gone[shared])
        counts, texts = [], []
        for row, text in enumerate(block.texts):
            tokens = words_of(text.as_py())
            own = gone[first[row] : first[row] + sizes[row]]
            kept = tokens
            if own.any():
                change = np.zeros(len(tokens) + 1, np.int64)
                ends = np.flatnonzero(own)
                np.add.at(change, ends, 1)
                np.add.at(change, ends + words, -1)
                kept = [w for w, c in zip(tokens, np.cumsum(change[:-1]).tolist()) if not c]
            counts.append((len(tokens), len(tokens) - len(kept)))
            texts.append(b" ".join(kept))
        n_words, n_removed = zip(*counts) if counts else ((), ())
        return pa.table(
            {
                "doc_id": pa.array(block.ids, pa.int64()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
                "block": pa.array(np.full(len(texts), block.number, np.int64)),
                "base": pa.array(block.bases.view(np.int64)),
                "runs": pa.array(
                    [runs[r].tobytes() if r in runs else b"" for r in range(len(texts))],
                    pa.binary(),
                ),
            }
        )

    sent = _answered(docs, _half_windows(docs, words, parts), send, _SENT)
    owners = sent.groupBy("part").applyInArrow(_owned, _NAMED)
    kept = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    state = "block bigint, base bigint, runs binary"
    return _answered(docs, owners, decide, f"{kept}, {state}"), parts


class _Halves:
    """The windows of a block, twice as long as those of its state, both halves of which are in it."""

    def __init__(self, state: pa.Table, size: int):
        self.number = state.column("block")[0].as_py() if len(state) else 0
        ids = state.column("doc_id").to_numpy()
        bases = state.column("base").to_numpy().view(np.uint64)
        order = np.lexsort((bases, ids))
        self.ids, self.bases = ids[order], bases[order]
        packed = state.column("runs").take(pa.array(order))
        runs, counts = _unpack(packed.cast(pa.binary()), np.int64)
        start, length, name, earlier = runs.reshape(-1, 4).T
        run = np.repeat(np.arange(len(length)), length)
        step = np.arange(len(run)) - (np.cumsum(length) - length)[run]
        rows = np.repeat(np.arange(len(counts)), counts // 4)[run]
        at = start[run] + step
        names = name.view(np.uint64)[run] + step.astype(np.uint64)
        place = (rows << 40) + at
        right = np.searchsorted(place, place + size)
        right[right == len(place)] = 0
        left = np.flatnonzero(place[right] == place + size) if len(place) else _NO_IDS
        self.rows, self.at, self.names = rows[left], at[left], names[left]
        self.earlier = earlier[run[left]] > 0
        follower = names[right[left]]
        self.asked = np.flatnonzero(follower != self.names + np.uint64(size))
        self.keys = _mixed(self.names[self.asked] * _MULTIPLIER + _mixed(follower[self.asked]))
        row = self.rows[self.asked]
        self.owners, self.origins = self.ids[row], self.bases[row]
        self.places = self.origins + self.at[self.asked].astype(np.uint64)


def _ask_for(size: int, parts: int):
    """Sends the pairs of names that do not follow each other."""

    def send(state: pa.Table) -> pa.Table:
        own = _Halves(state, size)
        return _first_parted(own.number, own.keys, own.owners, own.places, parts)

    return send


def _doubled(size: int):
    """The state at twice the size: windows whose halves follow each other, or that are repeated."""

    def extend(state: pa.Table, answer: pa.Table) -> pa.Table:
        own = _Halves(state, size)
        names, earlier, kept = own.names.copy(), own.earlier.copy(), np.ones(len(own.names), bool)
        names[own.asked], earlier[own.asked], kept[own.asked] = _named(
            own.keys, own.owners, own.origins, own.places, answer
        )
        runs = _runs(own.rows[kept], own.at[kept], names[kept], earlier[kept])
        found = np.array(list(runs), np.int64)
        return pa.table(
            {
                "block": pa.array(np.full(len(found), own.number, np.int64)),
                "doc_id": pa.array(own.ids[found]),
                "base": pa.array(own.bases[found].view(np.int64)),
                "runs": pa.array([r.tobytes() for r in runs.values()], pa.binary()),
                "earlier": pa.array([bool(r[:, 3].any()) for r in runs.values()], pa.bool_()),
            }
        )

    return extend


def longest_repeats(documents: DataFrame, words: int = 13) -> DataFrame:
    """``doc_id, longest``: of the lengths ``words``, twice that, and so on, the longest
    at which a window of the document is also in another row.

    Rows without such a window, or without a doc_id, are left out; of repeated
    doc_ids the longest counts.  One pass per length, and the last finds nothing.
    """
    docs, parts = _dealt(documents)

    def packed(block: _Block, found: list[np.ndarray]) -> pa.Table:
        # What two documents of a block have is sent twice, so that it counts as shared.
        values, counts = np.unique(np.concatenate([_EMPTY, *found]), return_counts=True)
        both = np.concatenate([values, values[counts > 1]])
        return _parted(block.number, both, parts)

    def send_first(table: pa.Table, answer: pa.Table) -> pa.Table:
        block = _Block(table)
        found = [
            np.unique(window_hashes(h, words)[candidates])
            for _, _, h, candidates in _candidates(block, answer, words)
        ]
        return packed(block, found)

    def repeated(block: _Block, answer: pa.Table, size: int):
        known = np.unique(_unpack(answer.column("hashes"))[0])
        for doc, _, h in block.compared(size):
            yield doc, h, _member(window_hashes(h, size), known)

    def extended(size: int):
        def send(table: pa.Table, answer: pa.Table) -> pa.Table:
            block, found = _Block(table), []
            for _, h, held in repeated(block, answer, size):
                if len(h) >= 2 * size:
                    halves = held[:-size] & held[size:]
                    found.append(np.unique(window_hashes(h, 2 * size)[halves]))
            return packed(block, found)

        return send

    def holders(size: int):
        def run(table: pa.Table, answer: pa.Table) -> pa.Table:
            ids = [doc for doc, _, held in repeated(_Block(table), answer, size) if held.any()]
            sizes = pa.array([size] * len(ids), pa.int64())
            return pa.table({"doc_id": pa.array(ids, pa.int64()), "longest": sizes})

        return run

    def shared(sent: DataFrame) -> DataFrame:
        return stored(sent.groupBy("part").applyInArrow(_shared, _ANSWER))

    size, found = words, []
    answers = shared(_answered(docs, _half_windows(docs, words, parts), send_first, _SENT))
    while not answers.isEmpty():
        found.append(_answered(docs, answers, holders(size), "doc_id bigint, longest bigint"))
        answers = shared(_answered(docs, answers, extended(size), _SENT))
        size *= 2
    none = documents.sparkSession.createDataFrame([], "doc_id bigint, longest bigint")
    for level in found:
        none = none.union(level)
    return none.groupBy("doc_id").agg(F.max("longest").alias("longest"))
