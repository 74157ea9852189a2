"""Byte-level BPE encoding and decoding in padded numpy matrices.

Texts are cut by the vocabulary's pattern. The distinct pieces of a batch that are not whole tokens
go into matrices by length, one row a piece, one column a byte. In each round every row merges its
leftmost pair of minimum rank; pairs are looked up in a hash table, the row closes up, and rows
without a pair left leave the matrix. Ranks come from a file in the ``tiktoken`` format.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.llm.common import fresh, text_batches

NONE = np.iinfo(np.int32).max
#: Widths of the matrices. Longer pieces, of which a matrix would be mostly width, use a heap.
WIDTHS = (4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64, 96, 128)
WIDTH_OF = [min(w for w in WIDTHS if n <= w) for n in range(WIDTHS[-1] + 1)]
#: Rows of one matrix, and pieces that a worker remembers.
ROWS, REMEMBERED = 1 << 12, 200_000


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, to travel with the tasks: some hundred KB by the size of a vocabulary."""
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Tokens by id, and the pairs that merge, in an open-addressing hash table."""

    def __init__(self, rank_file: bytes) -> None:
        ranks = {}
        for line in rank_file.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.ranks = ranks
        self.token = np.full(max(ranks.values()) + 1, None, object)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        made = array("q")
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    made.extend((a << 32 | b, rank))
        keys, value = np.array(made, np.int64).reshape(-1, 2).T
        keys, value = keys.copy(), value.astype(np.int32)
        self._pairs = keys, value
        self._bits = max(4, int(np.ceil(np.log2(4 * len(value) + 1))))
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._values = np.full(1 << self._bits, NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] < 0
            self._keys[slot[free]] = keys[free]  # of several at one slot the last stays
            put = self._keys[slot] == keys
            self._values[slot[put]] = value[put]
            keys, value = keys[~put], value[~put]
            slot = (slot[~put] + 1) & ((1 << self._bits) - 1)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """What the heap needs, so only workers that meet a long piece hold it: the rank by both ids."""
        keys, value = self._pairs
        return dict(zip(keys.tolist(), value.tolist()))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, ``NONE`` where it makes none or has a pad (-1)."""
        keys = left.astype(np.int64) << 32 | right  # negative with a pad, like a free slot
        slot = self._slot(keys)
        there = self._keys[slot]
        out = self._values[slot]
        wrong = there != keys
        out[wrong | (keys < 0)] = NONE
        at = np.flatnonzero(wrong & (there >= 0) & (keys >= 0))
        keys, slot = keys[at], slot[at]
        while len(at):
            slot = (slot + 1) & ((1 << self._bits) - 1)
            there = self._keys[slot]
            hit = there == keys
            out[at[hit]] = self._values[slot[hit]]
            on = ~hit & (there >= 0)
            at, keys, slot = at[on], keys[on], slot[on]
        return out

    def encode_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids, as the bytes of 32-bit numbers, of pieces of at most ``width`` bytes, all in one matrix."""
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = self.of_byte[raw.reshape(n, width)]
        length = np.fromiter(map(len, pieces), np.int64, n)
        ids[np.arange(width) >= length[:, None]] = -1
        rank = self.merged(ids[:, :-1].reshape(-1), ids[:, 1:].reshape(-1)).reshape(n, -1)
        row, out = np.arange(n), [b""] * n
        while len(row):
            width = ids.shape[1]
            each = np.arange(len(row))
            at = rank.argmin(axis=1)  # the first, so the leftmost, of the least
            best = rank[each, at]
            over = best == NONE
            if over.any():
                rest = ids[over]
                ends = (4 * (rest >= 0).sum(axis=1) + 4 * width * np.arange(len(rest))).tolist()
                rest = rest.tobytes()
                for r, start, end in zip(row[over].tolist(), range(0, len(rest), 4 * width), ends):
                    out[r] = rest[start:end]
                on = ~over
                ids, rank, row, at, best = ids[on], rank[on], row[on], at[on], best[on]
                each = each[: len(row)]
            # Merge, and close up: the column right of the merged one goes.
            ids.reshape(-1)[each * width + at] = best
            gone = np.ones((len(row), width), bool)
            gone.reshape(-1)[each * width + at + 1] = False
            ids = ids[gone].reshape(-1, width - 1)
            if width == 2:
                for r, got in zip(row.tolist(), best):
                    out[r] = got.tobytes()
                break
            rank = rank[gone[:, 1:]].reshape(-1, width - 2)
            # New neighbours: of the merged token and what stands before it, and after it.
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.merged(ids[has, at[has] - 1], best[has])
            has = np.flatnonzero(at < width - 2)
            rank[has, at[has]] = self.merged(best[has], ids[has, at[has] + 1])
        return out

    def encode_long(self, piece: bytes) -> bytes:
        """The same merges for a long piece, by a heap of (rank, place) over a linked list."""
        start = self.of_byte[np.frombuffer(piece, np.uint8)]
        n, pairs = len(start), self.pairs
        ids = array("q", start.astype(np.int64).tobytes())
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        first = self.merged(start[:-1], start[1:]).astype(np.int64)
        at = np.flatnonzero(first != NONE)
        heap = (first[at] << 40 | at).tolist()  # one number an entry: rank, then place
        heapq.heapify(heap)
        places = (1 << 40) - 1
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 40, entry & places
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := rank << 32 | ids[k]) in pairs:
                    heapq.heappush(heap, pairs[p] << 40 | i)
            if (h := before[i]) >= 0 and (p := ids[h] << 32 | rank) in pairs:
                heapq.heappush(heap, pairs[p] << 40 | h)
        left = np.frombuffer(ids, np.int64)
        return left[left >= 0].astype(np.int32).tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that token ids stand for."""
        return b"".join(self.token[ids]) if len(ids) else b""

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as the bytes of 32-bit numbers."""
        out = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            else:
                buckets.setdefault(WIDTH_OF[len(piece)] if len(piece) <= WIDTHS[-1] else 0, []).append(i)
        for width, at in buckets.items():
            if not width:
                for i in at:
                    out[i] = self.encode_long(pieces[i])
                continue
            for k in range(0, len(at), ROWS):
                part = at[k : k + ROWS]
                for i, got in zip(part, self.encode_rows([pieces[i] for i in part], width)):
                    out[i] = got
        return out


@lru_cache(maxsize=4)
def vocabulary(rank_file: bytes) -> Vocabulary:
    return Vocabulary(rank_file)


class Encoder:
    """Cuts texts by a pattern and remembers the pieces met, up to a bound."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.vocabulary = vocabulary(rank_file)
        self.pieces = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text."""
        cut = [self.pieces.findall(t) if t else [] for t in texts]
        wanted = set().union(*cut)
        new = list(wanted - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(wanted)
        ids = self.vocabulary.encode_pieces([p.encode() for p in new])
        self.known.update(zip(new, ids))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, pieces)), np.int32) for pieces in cut]


@lru_cache(maxsize=4)
def encoder(rank_file: bytes, pattern: str) -> Encoder:
    return Encoder(rank_file, pattern)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    cuts = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
    return pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(ids)))


def encode(
    docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``docs`` with the token ids of each whole text in ``ids`` (``array<int>``).

    Special tokens are ordinary text. A null or empty text has no ids; repeated rows stay; an empty
    table stays empty; a column that already has the name ``ids`` is replaced.
    """
    kept = [c for c in docs.columns if c != ids]

    def run(batches):
        own = encoder(rank_file, pattern)
        for batch in batches:
            for part in text_batches([batch], 0):
                made = own.encode(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], _lists(made)], names=[*kept, ids])

    df = docs.select(F.col(f"`{text}`").alias(fresh("text", docs.columns)), *[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*df.schema.fields[1:], T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_file: bytes, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for in ``decoded``; null ids give no bytes.

    A column that already has the name ``decoded`` is replaced. An id outside the vocabulary is an error.
    """
    kept = [c for c in df.columns if c != decoded]

    def run(batches):
        own = vocabulary(rank_file)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                lists = part.column(0)
                made = [own.decode(lists[k].values.to_numpy() if lists[k].is_valid else []) for k in range(len(lists))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(made, pa.binary())], names=[*kept, decoded]
                )

    df = df.select(F.col(f"`{ids}`").alias(fresh("ids", df.columns)), *[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*df.schema.fields[1:], T.StructField(decoded, T.BinaryType())])
    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, rank_file: bytes, pattern: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of each row: ``encode`` and ``decode`` in one pass.

    ``with_ids`` adds the ids themselves in ``ids``.

    The digests are those of the decimal ids joined by spaces and of the bytes decoded from the ids.
    Null texts count as empty, see ``encode``.
    """

    def run(batches):
        own = encoder(rank_file, pattern)
        decimal = np.array([b"%d" % i for i in range(len(own.vocabulary.token))], object)
        for batch in batches:
            for part in text_batches([batch], "text", 1 << 20):
                counts, ids_sha, decoded_sha = [], [], []
                encoded = own.encode(part.column("text").to_pylist())
                for ids in encoded:
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(b" ".join(decimal[ids])).hexdigest())
                    decoded_sha.append(hashlib.sha256(own.vocabulary.decode(ids)).hexdigest())
                made = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]
                yield pa.RecordBatch.from_arrays([*made, *[_lists(encoded)] * with_ids], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
