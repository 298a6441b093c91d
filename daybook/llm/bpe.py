"""Byte-level BPE by rank files: encoding through a rank queue over hierarchical bitmaps, and decoding."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import slices, texts_of

#: Chunks kept per worker; beyond it the cache starts anew.
CACHED = 700_000


class RankQueue:
    """Positions in buckets per merge rank. Two levels of 256-bit words say which buckets hold any.

    The lowest rank is found by one find-first-set per level. A bucket gives its positions from left to right.
    """

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.low = [0] * ((ranks >> 8) + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
            return
        bucket.append(position)
        word = rank >> 8
        if not self.low[word]:
            self.top |= 1 << word
        self.low[word] |= 1 << (rank & 255)

    def pop(self) -> tuple[int, int]:
        """Lowest rank and its leftmost position; (-1, -1) once empty."""
        top = self.top
        if not top:
            return -1, -1
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        lowest = bits & -bits
        rank = (word << 8) + lowest.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        bits ^= lowest
        self.low[word] = bits
        if not bits:
            self.top = top & (top - 1)
        return rank, bucket.pop()


class Chunks(dict):
    """Ids of chunks that follow ``lead``, encoded when first asked for; bounded.

    A chunk of several pre-tokens is put together from theirs, so a word with a mark costs no merges of its own.
    """

    def __init__(self, lead: str, pairs: BytePairs, most: int, others: Chunks | None = None):
        self.lead, self.pairs, self.most = lead, pairs, most
        self.others = self if others is None else others

    def __missing__(self, chunk: str) -> bytes:
        pieces = self.pairs.split(self.lead + chunk)
        if len(pieces) > 1:
            first, *rest = pieces
            return self[first.removeprefix(self.lead)] + b"".join([self.others[piece] for piece in rest])
        ids = self.pairs.pre_token(pieces[0]) if pieces else b""
        if len(chunk) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = ids
        return ids


class BytePairs:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.decimals = {rank: str(rank) for rank in self.tokens}
        # White space as in the rank files' own library: the Unicode property, without the separators \x1c to \x1f.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        # White space other than space and line feed.
        self.odd_space = re.compile("[\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
        self.queue = RankQueue(max(self.tokens) + 1)
        self.line_start = Chunks("", self, CACHED // 2)
        self.after_space = Chunks(" ", self, CACHED, self.line_start)

    @staticmethod
    @cache
    def of(path: str, pattern: str) -> BytePairs:
        return BytePairs(path, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank is merged first, of equal ones the leftmost.

        The steps of ``RankQueue`` are written out here on its buckets and words, as a call per step costs as much as the step.
        """
        rank_of, buckets, low, n = self.ranks.get, self.queue.buckets, self.queue.low, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # rank of the pair that begins at each position
        current = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]
        current.append(-1)
        top = 0
        for at, rank in enumerate(current):
            if rank >= 0:
                bucket = buckets[rank]
                if not bucket:
                    word = rank >> 8
                    low[word] |= 1 << (rank & 255)
                    top |= 1 << word
                bucket.append(at)  # rising positions are a heap
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            lowest = bits & -bits
            rank = (word << 8) + lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket.pop()
                low[word] = bits = bits ^ lowest
                if not bits:
                    top &= top - 1
            if current[at] != rank:
                continue  # stale: one of the pair has been merged since
            gone = after[at]
            end = after[at] = after[gone]
            current[gone] = current[at] = -1
            left = before[at]
            if end < n:
                before[end] = at
                changed = ((at, piece[at : after[end]]), (left, piece[left:end])) if left >= 0 else ((at, piece[at : after[end]]),)
            else:
                changed = ((left, piece[left:end]),) if left >= 0 else ()
            for at, pair in changed:
                rank = current[at] = rank_of(pair, -1)
                if rank >= 0:
                    bucket = buckets[rank]
                    if bucket:
                        heappush(bucket, at)
                    else:
                        bucket.append(at)
                        word = rank >> 8
                        if not low[word]:
                            top |= 1 << word
                        low[word] |= 1 << (rank & 255)
        ranks, ids, at = self.ranks, [], 0
        while at < n:
            ids.append(ranks[piece[at : after[at]]])
            at = after[at]
        return ids

    def pre_token(self, text: str) -> bytes:
        """Ids of one pre-token as little-endian unsigned 32-bit numbers."""
        piece = text.encode()
        whole = self.ranks.get(piece)
        ids = self.merge(piece) if whole is None else [whole]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers.

        A single space or line feed between other characters always begins a pre-token, so such texts are cut there
        first and the chunks' ids are looked up. Texts with other white space are split in one go.
        """
        if not text:
            return b""
        if self.odd_space(text) or text[0] in " \n" or text[-1] in " \n" or any(two in text for two in ("  ", " \n", "\n ", "\n\n")):
            return b"".join(map(self.line_start.__getitem__, self.split(text)))
        parts, after_space, line_end = [], self.after_space.__getitem__, self.line_start["\n"]
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            parts.append(self.line_start[first])
            parts += map(after_space, rest)
            parts.append(line_end)
        return b"".join(parts[:-1])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ``ids``."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def encoded(
    docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
    view: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None = None,
) -> DataFrame:
    """(id, ids array<int>): the ids of every whole text; none for a null or empty one. Other columns are not read.

    Every row gives one row, also where ids or whole rows repeat; an empty table gives none. ``view`` (a function of
    such batches, the schema of what it returns) says what leaves the task instead.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    shape, schema = view or (lambda batch: batch, f"id {kind}, ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs.of(ranks, pattern)
        for part in slices(batches, "text"):
            found = [np.frombuffer(pairs.encode(t), "<u4").view(np.int32) for t in texts_of(part)]
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            yield shape(pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))], ["id", "ids"]))

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, schema)


def decoded(ids: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(id, ids, bytes binary): the bytes that ``ids`` (id, ids array<int>) stand for; none for null or no ids."""
    kind = ids.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs.of(ranks, pattern)
        for part in slices(batches, "ids"):
            bounds, flat = part.column(1).offsets.to_numpy(), part.column(1).values.to_numpy()
            data = [pairs.decode(flat[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], ["id", "ids", "bytes"])

    return ids.select("id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, f"id {kind}, ids array<int>, bytes binary")


def digest_view(id_type: str, ranks: str, pattern: str) -> tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str]:
    """``view`` of ``encoded``: (id, n_tokens, ids_sha256, decoded_sha256), digests of the decimal ids joined by commas and
    of the bytes that the ids decode to."""

    def digested(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = BytePairs.of(ranks, pattern)
        bounds, flat = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy()
        rows = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        listed = [hashlib.sha256(",".join(map(pairs.decimals.__getitem__, row)).encode()).hexdigest() for row in rows]
        back = [hashlib.sha256(b"".join(map(pairs.tokens.__getitem__, row))).hexdigest() for row in rows]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(len, rows), pa.int64()), pa.array(listed, pa.string()), pa.array(back, pa.string())],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digested, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(ids: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``digest_view`` of rows (id, ids array<int>) that were encoded before; null ids count as none."""
    shape, schema = digest_view(ids.schema["id"].dataType.simpleString(), ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "ids"):
            yield shape(part)

    return ids.select("id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, schema)
