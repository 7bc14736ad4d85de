"""Byte-level BPE with the tokenizers library, over Arrow batches.

A rank file is turned into the library's form: bytes are written as the
characters of the byte table, and every split of a token into two tokens is a
merge, in the order of the merged token's rank.  Texts are split by the pattern
first.  Each different piece is encoded once while it stays in a bounded cache.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from velometry.llm.common import slices, texts

#: Pieces that a worker remembers.
CACHE_PIECES = 250_000


def byte_table() -> dict[int, str]:
    """The character for each byte: itself where it prints, else one from 256 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in printing else next(others)) for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


class ByteBpe:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.chars = byte_table()
        self.pattern = regex.compile(pattern)
        # Ids of the pieces met so far, four bytes each.
        self.cache: dict[str, bytes] = {}
        # Decoding reverses the byte table on the tokens as the library writes them.
        back = {c: b for b, c in self.chars.items()}
        written = {i: self.written(t) for t, i in self.ranks.items()}
        self.tokens = [
            bytes(map(back.__getitem__, written.get(i, ""))) for i in range(max(written) + 1)
        ]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def written(self, raw: bytes) -> str:
        """Bytes as the characters of the byte table."""
        return raw.decode("latin-1").translate(self.chars)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        ranks = self.ranks
        merges = [
            (self.written(token[:i]), self.written(token[i:]))
            for token in sorted(ranks, key=ranks.get)
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        vocab = {self.written(t): r for t, r in ranks.items()}
        return Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces into the cache, all of a call in one pass of the library."""
        mapped = [self.written(p.encode("utf-8", "surrogatepass")) for p in pieces]
        found = self.tokenizer.encode(mapped, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, np.int32).tobytes()
        owner = np.array(found.word_ids, np.int64)
        cuts = (4 * np.searchsorted(owner, np.arange(len(pieces) + 1))).tolist()
        self.cache.update(zip(pieces, (ids[a:b] for a, b in zip(cuts, cuts[1:]))))

    def encode_batch(self, batch: list[str]) -> list[np.ndarray]:
        pieces = [self.pattern.findall(t) for t in batch]
        here = set().union(*pieces)
        new = list(here.difference(self.cache))
        if len(self.cache) + len(new) > CACHE_PIECES:
            # What is frequent is in this batch too.
            self.cache = {p: self.cache[p] for p in here.difference(new)}
        for first in range(0, len(new), 20_000):
            self._learn(new[first : first + 20_000])
        ids = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(ids, own)), np.int32) for own in pieces]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end code point of each token; parts of one character share it."""
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        if not len(ids):
            return starts, ends
        return char[starts], char[ends - 1] + 1

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_tokens(self, ids) -> Iterator[str]:
        """The text that each token completes; a split character comes with its last part."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield decoder.decode(self.tokens[i])
        if rest := decoder.decode(b"", True):
            yield rest


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode_documents(
    documents: DataFrame, path: str, pattern: str, offsets: bool = True, decoded: bool = False
) -> DataFrame:
    """``doc_id, ids`` and, if asked for, ``starts``, ``ends`` and ``decoded``.

    ``starts`` and ``ends`` are code points of tokens in the text, ``decoded`` the bytes
    that the ids give back (as ``decode_documents`` does for stored ids, without sending
    them to another Python worker).  ``path`` is a rank file that every executor can
    open.  Null and empty texts have no tokens.  Null and repeated doc_ids stay as they
    are, other columns are not read, an empty table gives no rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                own = texts(part, "text")
                ids = coder.encode_batch(own)
                columns = [part.column("doc_id"), _lists(ids)]
                if offsets:
                    places = [coder.offsets(t, i) for t, i in zip(own, ids)]
                    columns += [_lists([p[0] for p in places]), _lists([p[1] for p in places])]
                if decoded:
                    columns.append(pa.array([coder.decode(i.tolist()) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, list(fields))

    fields = {"doc_id": "bigint", "ids": "array<int>"}
    if offsets:
        fields |= {"starts": "array<int>", "ends": "array<int>"}
    if decoded:
        fields["decoded"] = "binary"
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(encode, ", ".join(f"{n} {kind}" for n, kind in fields.items()))


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes of each id list; a null list has none."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                out = [
                    coder.decode(ids.values.to_pylist() if ids.is_valid else ())
                    for ids in part.column("ids")
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(out, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(
        decode, "doc_id bigint, ids array<int>, decoded binary"
    )
