"""Removal of word windows that repeat anywhere in the corpus, found by level-wise doubling."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.tables import partitions, slices

#: Two seeds for words and two sets of odd multipliers: two independent 64-bit hashes of a window.
_WORD_SEEDS = (0, 0x2545F4914F6CDD1D)
_FAMILY = (
    (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB),
    (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93),
)
#: Texts that are settled among themselves before they ask the rest of the corpus.
SLICE_BYTES, SLICE_DOCUMENTS = 5 << 20, 2048


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(data: bytes, family: int = 0) -> np.ndarray:
    """XXH3 of each word of ``data``, with the family's seed; words are runs without space, tab, line feed, VT, FF or CR."""
    words = data.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(_WORD_SEEDS[family])), np.uint64, len(words))


def _join(left: np.ndarray, right: np.ndarray, odd: tuple[int, int, int]) -> np.ndarray:
    return _mix(left * np.uint64(odd[0]) + (right ^ (right >> np.uint64(31))) * np.uint64(odd[1]) + np.uint64(odd[2]))


def window_hashes(words: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """Hash of each window of ``length`` words, built from windows of half the length."""
    if len(words) < length:
        return np.empty(0, np.uint64)
    odd = _FAMILY[family]
    if length == 1:
        return _mix(words * np.uint64(odd[2]))
    half = window_hashes(words, length // 2, family)
    n = len(words) - length + 1
    both = _join(half[:n], half[length // 2 : length // 2 + n], odd)
    return both if length % 2 == 0 else _join(both, words[length - 1 :], odd)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """min or max of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = best(values[:-step], values[step:])
        have += step
    return values


class _Slice:
    """The words of some documents in a row; windows that would cross a document are left out."""

    def __init__(self, texts: list[bytes]):
        words = [word_hashes(text) for text in texts]
        self.texts = texts
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.words = np.concatenate(words) if words else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(words)), self.lengths)

    def second_words(self, docs: np.ndarray) -> np.ndarray:
        """Words by the other family's hash; only those of ``docs`` are set."""
        words = np.zeros(len(self.words), np.uint64)
        for doc in docs.tolist():
            start = self.starts[doc]
            words[start : start + self.lengths[doc]] = word_hashes(self.texts[doc], 1)
        return words

    def whole(self, length: int) -> np.ndarray:
        """Which windows of ``length`` words lie in one document."""
        n = max(0, len(self.words) - length + 1)
        return self.doc[:n] == self.doc[length - 1 : length - 1 + n]

    def samples(self, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, smallest hash within each window, sampled?): of the windows of ``length`` words inside a window the
        one of smallest hash stands for it. Equal windows choose equal ones, so none that repeats is lost."""
        hashes = window_hashes(self.words, length)
        width = window - length + 1
        if len(hashes) < width:
            return hashes, np.empty(0, np.uint64), np.zeros(len(hashes), bool)
        least = _sliding(hashes, width, np.minimum)
        # Windows across documents choose nothing: 0 is below any other choice.
        chosen = np.where(self.whole(window), least, np.uint64(0))
        padded = np.concatenate([np.zeros(width - 1, np.uint64), chosen, np.zeros(width - 1, np.uint64)])
        return hashes, least, _sliding(padded, width, np.maximum) == hashes


def _packed(texts: pa.Array) -> pa.Array:
    squeeze = zstandard.ZstdCompressor(level=3)
    return pa.array([squeeze.compress((t or "").encode()) for t in texts.to_pylist()], pa.binary())


def _unpacked(blobs: pa.Array) -> list[bytes]:
    widen = zstandard.ZstdDecompressor()
    return [widen.decompress(b) for b in blobs.to_pylist()]


def packed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the text compressed row by row in ``__blob``, and ``__tie``, a text hash that tells repeated ids apart."""
    keyed = docs.withColumn("__tie", F.expr(f"cast(xxhash64(`{text_column}`) & 2147483647 AS int)"))
    schema = T.StructType([f for f in keyed.schema if f.name != text_column] + [T.StructField("__blob", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column):
            texts = part.column(part.schema.get_field_index(text_column))
            columns = [part.column(i) for i, name in enumerate(part.schema.names) if name != text_column]
            yield pa.RecordBatch.from_arrays([*columns, _packed(texts)], schema.names)

    return keyed.mapInArrow(run, schema)


def repeated_samples(docs: DataFrame, length: int, window: int, id_column: str, text_column: str) -> DataFrame:
    """(doc, tie, alive array<long>): per document, the sampled windows of ``length`` words that occur more than once.

    Copies within a slice are settled there: the slice asks about each hash once, and what repeats inside it is alive
    already. So no hash has more rows than there are slices, however many documents share it.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES, SLICE_DOCUMENTS):
            piece = _Slice([(t or "").encode() for t in part.column(2).to_pylist()])
            hashes, _, sampled = piece.samples(length, window)
            at = np.flatnonzero(sampled)
            if not len(at):
                continue
            found, owner = hashes[at], piece.doc[at]
            order = np.lexsort((owner, found))
            found, owner = found[order], owner[order]
            head = np.r_[True, found[1:] != found[:-1]]
            count = np.diff(np.r_[np.flatnonzero(head), len(found)])
            many = np.repeat(count, count) > 1
            # each hash asks once: for its document, or for nobody where it repeats here and is alive already
            # in the order of documents, whose repeated ids then compress well
            rows = np.flatnonzero(head)[np.argsort(owner[head], kind="stable")]
            asks, ask_owner = found[rows], pa.array(owner[rows], mask=many[rows])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(asks.view(np.int64)), part.column(0).take(ask_owner), part.column(1).take(ask_owner),
                    pa.array(np.where(many[rows], 2, 1).astype(np.int8)), pa.nulls(len(asks), pa.list_(pa.int64())),
                ],
                names,
            )
            pair = many & (head | np.r_[True, owner[1:] != owner[:-1]])
            docs_here, lists = _per_owner(owner[pair], found[pair].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    _spread(part, docs_here), part.column(0).take(docs_here), part.column(1).take(docs_here),
                    pa.array(np.zeros(len(docs_here), np.int8)), lists,
                ],
                names,
            )

    names = ["h", "doc", "tie", "n", "known"]
    rows = _keyed(docs, id_column, text_column).mapInArrow(run, f"h long, doc {kind}, tie int, n byte, known array<long>")
    return (
        rows.withColumn("total", F.sum("n").over(Window.partitionBy("h")))
        .where("tie IS NOT NULL AND (known IS NOT NULL OR total > 1)")
        .groupBy("doc", "tie")
        .agg(F.collect_list(F.expr("IF(known IS NULL, h, NULL)")).alias("asked"), F.flatten(F.collect_list("known")).alias("known"))
        .select("doc", "tie", F.concat("asked", "known").alias("alive"))
    )


def _per_owner(owner: np.ndarray, values: np.ndarray) -> tuple[pa.Array, pa.ListArray]:
    """(owners, their values as lists)."""
    order = np.argsort(owner, kind="stable")
    owners, starts = np.unique(owner[order], return_index=True)
    return pa.array(owners), pa.ListArray.from_arrays(pa.array(np.r_[starts, len(owner)], pa.int32()), pa.array(values[order]))


def _spread(part: pa.RecordBatch, owners: pa.Array) -> pa.Array:
    """Keys of rows that ask nothing, so that they don't meet anywhere."""
    tie = part.column(1).take(owners).to_numpy(zero_copy_only=False).astype(np.uint64)
    return pa.array(_mix(tie << np.uint64(32) | owners.to_numpy().astype(np.uint64)).view(np.int64))


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id, tie and text of each document; identical rows count as one document."""
    tie = F.expr(f"cast(xxhash64(`{text_column}`) & 2147483647 AS int)")
    return docs.select(F.col(id_column).alias("doc"), tie.alias("tie"), F.col(text_column).alias("text"))


def _with_lists(packed: DataFrame, lists: DataFrame, id_column: str, how: str) -> DataFrame:
    """Join what is known of each document; its columns get a leading ``__``."""
    side = lists.select(F.col("doc").alias("__doc"), F.col("tie").alias("__its"), *[F.col(c).alias(f"__{c}") for c in lists.columns[2:]])
    return packed.join(side, packed[id_column].eqNullSafe(side["__doc"]) & (packed["__tie"] == side["__its"]), how)


def extended_samples(packed: DataFrame, alive: DataFrame, shorter: int, window: int, id_column: str) -> DataFrame:
    """The next level: of windows whose sample of ``shorter`` words is alive, those whose sample of twice that length is."""
    kind = packed.schema[id_column].dataType.simpleString()
    joined = _with_lists(packed, alive, id_column, "inner").select(F.col(id_column).alias("doc"), F.col("__tie").alias("tie"), "__blob", "__alive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__blob", SLICE_BYTES // 2, SLICE_DOCUMENTS):
            piece, candidate = _candidates(part, shorter, window)
            hashes, least, _ = piece.samples(2 * shorter, window)
            wanted = np.unique(least[candidate])
            at = np.flatnonzero(np.isin(hashes, wanted) & piece.whole(2 * shorter))
            if len(at):
                pairs = np.unique(np.rec.fromarrays([hashes[at], piece.doc[at]], names="h,d"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs.h.view(np.int64)), part.column(0).take(pa.array(pairs.d)), part.column(1).take(pa.array(pairs.d)),
                     pa.array(_counts(hashes[at], piece.doc[at], pairs))],
                    ["h", "doc", "tie", "n"],
                )

    rows = joined.mapInArrow(run, f"h long, doc {kind}, tie int, n long")
    many = rows.groupBy("h").agg(F.sum("n").alias("total")).where("total > 1").select("h")
    return rows.join(many, "h", "left_semi").groupBy("doc", "tie").agg(F.collect_list("h").alias("alive"))


def _counts(hashes: np.ndarray, docs: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    all_pairs = np.sort(np.rec.fromarrays([hashes, docs], names="h,d"))
    starts = np.searchsorted(all_pairs, pairs)
    return np.diff(np.r_[starts, len(all_pairs)])


def _candidates(part: pa.RecordBatch, length: int, window: int) -> tuple[_Slice, np.ndarray]:
    piece = _Slice(_unpacked(part.column(2)))
    _, least, _ = piece.samples(length, window)
    alive = part.column(3).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return piece, np.flatnonzero(np.isin(least, alive) & piece.whole(window)[: len(least)])


def later_windows(packed: DataFrame, alive: DataFrame, length: int, window: int, id_column: str) -> DataFrame:
    """(doc, tie, starts array<int>, spans array<int>): windows of full length whose words also start earlier.

    Order: id (none: last), tie, start. Windows are compared by two 64-bit hashes that start from differently seeded
    XXH3 of their words. Of equal windows in a slice all but the first
    are known to be later and come as spans of words (begin, end, begin, end, ...); only the first asks the rest of the
    corpus, so a passage that many documents share has a row per slice.
    """
    kind = packed.schema[id_column].dataType.simpleString()
    joined = _with_lists(packed, alive, id_column, "inner").select(F.col(id_column).alias("doc"), F.col("__tie").alias("tie"), "__blob", "__alive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__blob", SLICE_BYTES // 2, SLICE_DOCUMENTS):
            piece, at = _candidates(part, length, window)
            if not len(at):
                continue
            owner = piece.doc[at]
            one = window_hashes(piece.words, window)[at]
            two = window_hashes(piece.second_words(np.unique(owner)), window, 1)[at]
            start = at - piece.starts[owner]
            rank = _order_of(part)[owner]
            order = np.lexsort((start, rank, two, one))
            one, two, owner, start, rank = one[order], two[order], owner[order], start[order], rank[order]
            head = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
            first = np.flatnonzero(head)[np.cumsum(head) - 1]
            rows = np.flatnonzero(head)[np.lexsort((start[head], owner[head]))]  # in the order of documents
            mine = pa.array(owner[rows])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one[rows].view(np.int64)), pa.array(two[rows].view(np.int64)), part.column(0).take(mine),
                    part.column(1).take(mine), pa.array(start[rows].astype(np.int32)), pa.nulls(len(rows), pa.list_(pa.int32())),
                ],
                names,
            )
            # the same window of an identical row isn't a later one
            later = ~head & ((rank != rank[first]) | (start != start[first]))
            docs_here, spans = _spans(owner[later], start[later], window)
            yield pa.RecordBatch.from_arrays(
                [
                    _spread(part, docs_here), pa.array(np.zeros(len(docs_here), np.int64)), part.column(0).take(docs_here),
                    part.column(1).take(docs_here), pa.nulls(len(docs_here), pa.int32()), spans,
                ],
                names,
            )

    names = ["h", "g", "doc", "tie", "start", "spans"]
    rows = joined.mapInArrow(run, f"h long, g long, doc {kind}, tie int, start int, spans array<int>")
    asks = Window.partitionBy("h", "g").orderBy(F.col("doc").asc_nulls_last(), "tie", "start")
    ranked = rows.withColumn("nth", F.rank().over(asks))
    return (
        ranked.where("spans IS NOT NULL OR nth > 1")
        .groupBy("doc", "tie")
        .agg(F.collect_list("start").alias("starts"), F.flatten(F.collect_list("spans")).alias("spans"))
    )


def _spans(owner: np.ndarray, start: np.ndarray, window: int) -> tuple[pa.Array, pa.ListArray]:
    """Per owner the spans of words (begin, end, ...) that windows at ``start`` cover."""
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    opens = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + 1)]) if len(owner) else np.empty(0, np.int64)
    closes = np.r_[opens[1:], len(owner)] - 1 if len(opens) else opens
    pairs = np.stack([start[opens], start[closes] + window], axis=1).astype(np.int32).ravel()
    return _per_owner(np.repeat(owner[opens], 2), pairs)


def _order_of(part: pa.RecordBatch) -> np.ndarray:
    """Rank of each row of a slice by id (none: last) and tie; identical rows are one document."""
    keys = [(i is None, i if i is not None else 0, t) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
    place = {key: n for n, key in enumerate(sorted(set(keys)))}
    return np.array([place[key] for key in keys], np.int64)


def covered(n_words: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words lie in one of the spans."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, np.minimum(ends, n_words), -1)
    return np.cumsum(edge[:-1]) > 0


def without_repeats(
    docs: DataFrame, window: int = 20, doublings: int = 2, keep_layout: bool = False, id_column: str = "doc_id", text_column: str = "text",
    counts: tuple[str, str] = ("n_words", "n_removed"),
) -> DataFrame:
    """``docs`` plus ``counts`` and the text that is left: its words joined by one space. Columns named so are replaced.

    A word goes if a window of ``window`` words that covers it also starts earlier in the corpus: in a document of
    smaller id, or earlier in its own. Windows are judged on the input. Levels: windows of ``window / 2**doublings`` words
    are sampled and counted; those that repeat alone are extended to twice the length, until ``window`` is reached.

    ``keep_layout`` leaves texts that lose nothing as they are. Null and empty texts have no words. Documents without an
    id come after all others; rows that repeat an id are told apart by a text hash, identical rows count as one document
    and get equal results. Other columns are kept.
    """
    if doublings < 1 or window % (1 << doublings):
        raise ValueError("window must be divisible by 2**doublings, with one doubling at least")
    length = window >> doublings
    docs = docs.drop(*counts)
    packed = packed_documents(docs, id_column, text_column)
    alive = repeated_samples(docs, length, window, id_column, text_column)
    while 2 * length < window:
        alive = extended_samples(packed, alive, length, window, id_column)
        length *= 2
    joined = _with_lists(packed, later_windows(packed, alive, length, window, id_column), id_column, "left")
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == text_column else f.dataType) for f in docs.schema]
        + [T.StructField(name, T.LongType()) for name in counts]
    )
    names = [f.name for f in docs.schema]
    ready = joined.select(*[F.col(f"`{n}`") if n != text_column else F.col("__blob") for n in names], "__starts", "__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob = names.index(text_column)
        for part in slices(batches, "__blob"):
            texts, n_words, n_removed = [], [], []
            later, spans = part.column(len(names)).to_pylist(), part.column(len(names) + 1).to_pylist()
            for data, starts, pairs in zip(_unpacked(part.column(blob)), later, spans):
                words = data.split()
                if starts or pairs:
                    starts, pairs = np.array(starts, np.int64), np.array(pairs, np.int64)
                    gone = covered(len(words), np.r_[starts, pairs[::2]], np.r_[starts + window, pairs[1::2]])
                    left = [word for word, out in zip(words, gone.tolist()) if not out]
                else:
                    left = words
                texts.append((data if keep_layout and len(left) == len(words) else b" ".join(left)).decode())
                n_words.append(len(words)), n_removed.append(len(words) - len(left))
            columns = [part.column(i) if i != blob else pa.array(texts, pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], schema.names)

    return ready.mapInArrow(run, schema)
