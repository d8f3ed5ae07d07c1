"""Byte-level byte-pair encoding and decoding from a rank file.

A text is split by the vocabulary's pattern.  The bytes of each piece become
Latin-1 characters, in which an Aho-Corasick automaton finds every token.  The
encoder takes the longest token at each place that may follow the token
before, and steps back where none may.  Two tokens may follow each other when
merging their joined bytes by rank gives just these two: no merge across their border comes before the merges that
make the two.  The parts that a token is merged from are known once for the vocabulary, so a pair is decided by a walk down the inner
edges of its two trees.  As a sequence whose neighbours all may follow each other is
the one that the merges lead to, the result equals that of the merges, and as
a place that led nowhere is not tried again, the work grows with the length.
"""

from __future__ import annotations

import base64
import functools
import io
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pieces and pairs remembered by each Python worker.
MEMORY = 3 << 17
_NOTHING: dict[bytes, bool] = {}


def read_ranks(spark, path: str) -> bytes:
    """The rank file, read by Spark so that it may lie in any store.  Its size is that of a vocabulary."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


class Encoder:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, rank_file: bytes, pattern: str):
        lines = (line.split() for line in io.BytesIO(rank_file) if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.digits = {rank: str(rank) for rank in self.bytes_of}
        self.split = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token in self.ranks:
            self.automaton.add_word(token.decode("latin-1"), len(token))
        self.automaton.make_automaton()
        # Ids as 32-bit numbers in bytes: small, and nothing for Python's collector to look through.
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.follows: dict[bytes, dict[bytes, bool]] = {}
        self.n_follows = 0
        self.shorter: dict[bytes, bytes] = {}

    def merged(self, data: bytes, below: int) -> list[bytes]:
        """Merge by rank, lowest first, with ranks under a limit; used on the bytes of one token."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge is the token; None for a byte, and for a token that no merge leads to."""
        if token not in self.parts:
            found = self.merged(token, self.ranks[token]) if len(token) > 1 else [token]
            self.parts[token] = (found[0], found[1]) if len(found) == 2 else None
        return self.parts[token]

    def may_follow(self, before: bytes, token: bytes) -> bool:
        """Whether the merges keep ``token`` whole and apart from ``before`` (empty at the start).

        The border between two tokens is crossed by the tokens that stood there earlier: the right parts of the left tree and the
        left parts of the right one.  The walk goes from the whole tokens back in time, the later merge first; a pair that stood
        there together would have merged if its rank is lower than that of the merge that ended it.
        """
        if len(token) > 1 and self.halves(token) is None:
            return False
        if not before:
            return True
        ranks = self.ranks
        left, right = before, token
        # Ranks of the merges that take the place of the pair at hand; the whole tokens are never merged on.
        last = len(ranks)
        while True:
            rank = ranks.get(left + right)
            if rank is not None and rank < last:
                return False
            a = ranks[left] if len(left) > 1 else -1
            b = ranks[right] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            # Of equal merges the left one comes first, so the right one is undone first.
            if b >= a:
                right, last = self.halves(right)[0], b
                # A merge across the border of the same rank, further left, would come before it.
                last += 1
            else:
                left, last = self.halves(left)[1], a

    def _decided(self, before: bytes, token: bytes) -> bool:
        """`may_follow`, remembered."""
        if self.n_follows >= MEMORY:
            self.follows.clear()
            self.n_follows = 0
        self.n_follows += 1
        answer = self.may_follow(before, token)
        self.follows.setdefault(before, {})[token] = answer
        return answer

    def next_shorter(self, token: bytes) -> bytes:
        """The longest token that the given one begins with, or nothing."""
        known = self.shorter.get(token)
        if known is None:
            known = b""
            for end in range(len(token) - 1, 0, -1):
                if token[:end] in self.ranks:
                    known = token[:end]
                    break
            self.shorter[token] = known
        return known

    def longest_tokens(self, data: bytes) -> list[int]:
        """Length of the longest token that begins at each byte."""
        longest = [1] * len(data)
        for last, length in self.automaton.iter(data.decode("latin-1")):
            start = last - length + 1
            if length > longest[start]:
                longest[start] = length
        return longest

    def encode_piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        if data in self.ranks:
            return array("i", (self.ranks[data],)).tobytes()
        longest, n, follows = self.longest_tokens(data), len(data), self.follows
        dead = bytearray(n + 1)  # places from which no sequence leads to the end
        tokens: list[bytes] = []
        place, before = 0, b""
        token = data[:longest[0]]
        while place < n:
            known = follows.get(before, _NOTHING)
            while token:
                if not dead[place + len(token)]:
                    fits = known.get(token)
                    if fits or fits is None and self._decided(before, token):
                        break
                token = self.shorter.get(token) if token in self.shorter else self.next_shorter(token)
            if token:
                tokens.append(token)
                before = token
                place += len(token)
                if place < n:
                    token = data[place:place + longest[place]]
            else:
                if not tokens:
                    raise ValueError("the vocabulary lacks single bytes")
                dead[place] = 1
                token = tokens.pop()
                place -= len(token)
                before = tokens[-1] if tokens else b""
                token = self.next_shorter(token)
        return array("i", map(self.ranks.__getitem__, tokens)).tobytes()

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        parts = self.split(text)
        out = list(map(self.pieces.get, parts))
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    out[i] = self._remembered(parts[i])
        return b"".join(out)

    def _remembered(self, piece: str) -> bytes:
        found = self.pieces.get(piece)  # met earlier in the same text
        if found is None:
            found = self.older_pieces.get(piece) or self.encode_piece(piece)
            if len(piece) <= 64:
                if len(self.pieces) >= MEMORY:  # what was used of late stays at hand
                    self.older_pieces, self.pieces = self.pieces, {}
                self.pieces[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_packed(text)).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _encoder(rank_file: bytes, pattern: str) -> Encoder:
    """One per Python worker; workers live on from task to task."""
    return Encoder(rank_file, pattern)


def _with(df: DataFrame, column: str, kind: T.DataType, of: str, function) -> DataFrame:
    """``df`` with a column worked out from another in Python, in place of one of the same name."""
    kept = [c for c in df.columns if c.lower() != column.lower() or c == of]
    kept = [c for c in kept if c.lower() != column.lower()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(column, kind)])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            at = batch.schema.get_field_index(of)
            yield from function(batch, batch.column(at), [batch.schema.get_field_index(c) for c in kept])

    return df.mapInArrow(batches, schema)


#: Rows are sent on in lots of about so many bytes.
LOT = 4 << 20


def _lots(batch, kept, values, column, pack):
    """Record batches of bounded size from byte strings that are made one by one."""
    start, lot, weight = 0, [], 0
    for i, value in enumerate(values):
        lot.append(value)
        weight += len(value)
        if weight >= LOT or i == batch.num_rows - 1:
            rows = batch.slice(start, len(lot))
            yield pa.RecordBatch.from_arrays(
                [rows.column(k) for k in kept] + [pack(lot)], names=[batch.schema.names[k] for k in kept] + [column])
            start, lot, weight = i + 1, [], 0


def _id_lists(packed: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed], dtype=np.int64)))
    values = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def encode(docs: DataFrame, rank_file: bytes, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids``, the token ids of each text, without special tokens.

    A null or empty text has no ids.  Repeated rows stay.  A column of ``docs``
    named like the result is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def run(batch, texts, kept):
        encoder = _encoder(shared.value, pattern)
        ids = (encoder.encode_packed(t.as_py() or "") for t in texts)
        return _lots(batch, kept, ids, ids_col, _id_lists)

    return _with(docs, ids_col, T.ArrayType(T.IntegerType()), text_col, run)


def decode(docs: DataFrame, rank_file: bytes, pattern: str, ids_col: str = "ids", data_col: str = "decoded") -> DataFrame:
    """``docs`` with ``decoded``, the bytes that the ids stand for (null ids: no bytes)."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def run(batch, ids, kept):
        encoder = _encoder(shared.value, pattern)
        data = (encoder.decode(i.values.to_pylist() if i.is_valid else []) for i in ids)
        return _lots(batch, kept, data, data_col, lambda lot: pa.array(lot, type=pa.binary()))

    return _with(docs, data_col, T.BinaryType(), ids_col, run)


def round_trip(docs: DataFrame, rank_file: bytes, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and the ``decoded`` bytes of these ids, in one pass; see `encode` and `decode`."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)
    taken = ("ids", "decoded")
    kept = [c for c in docs.columns if c.lower() not in taken and c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for batch in source:
            texts = batch.column(batch.schema.get_field_index(text_col))
            first, packed, data, weight = 0, [], [], 0
            for i, text in enumerate(texts):
                ids = encoder.encode_packed(text.as_py() or "")
                packed.append(ids)
                data.append(encoder.decode(array("i", ids)))
                weight += len(ids) + len(data[-1])
                if weight >= LOT or i == batch.num_rows - 1:
                    rows = batch.slice(first, len(packed))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(c) for c in kept] + [_id_lists(packed), pa.array(data, type=pa.binary())], names=[*kept, *taken])
                    first, packed, data, weight = i + 1, [], [], 0

    return docs.mapInArrow(run, schema)


def digests() -> list:
    """Columns ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoded and decoded rows."""
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>"))
    return [F.size(ids).cast("long").alias("n_tokens"),
            F.sha2(F.array_join(ids.cast("array<string>"), " "), 256).alias("ids_sha256"),
            F.sha2(F.coalesce(F.col("decoded"), F.lit(b"")), 256).alias("decoded_sha256")]
