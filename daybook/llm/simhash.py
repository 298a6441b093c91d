"""SimHash fingerprints and their links by deletion variants of segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.tables import partitions, slices, texts_of, written

BITS = 64
#: Odd multipliers that turn one 64-bit shingle hash into further ones.
STIRS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Members up to which a run's pairs are compared offset by offset.
_WIDE_RUN = 1024


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of ``words`` words, repeats included; a shorter text is one shingle."""
    tokens = text.encode().translate(_LOWER).split()
    if not tokens:
        return np.empty(0, np.uint64)
    line = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([digest(line, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = [0, *(ends[: len(tokens) - words] + 1).tolist()]
    return np.array([digest(line[s:e], 42) for s, e in zip(starts, ends[words - 1 :].tolist())], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bit is 1 where over half of ``hashes`` have it."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _stirred(hashes: np.ndarray, odd: int) -> np.ndarray:
    x = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(odd)
    return x ^ (x >> np.uint64(29))


def fingerprints(docs: DataFrame, words: int = 4, check_words: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp long, check array<long>): the 64-bit fingerprint of each whole text, and ``check_words`` further ones.

    Null and empty texts, and texts of white space, have fingerprint zero. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            prints, checks = [], []
            for text in texts_of(part):
                hashes = shingle_hashes(text, words)
                prints.append(majority(hashes))
                checks.append([majority(_stirred(hashes, odd)) for odd in STIRS[:check_words]])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                    pa.array([np.array(c, np.uint64).view(np.int64) for c in checks], pa.list_(pa.int64())),
                ],
                ["id", "fp", "check"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, fp long, check array<long>"
    )


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of the fewest segments of which one differs by at most one bit."""
    n = max_bits // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(max_bits: int) -> list[tuple[int, int]]:
    """(number, mask): each segment with one of its bits left out. Two segments that differ by one bit at most share one."""
    masks = [(((1 << width) - 1) << at) & ~(1 << (at + i)) for at, width in segments(max_bits) for i in range(width)]
    return list(enumerate(masks))


def links(nodes: DataFrame, max_bits: int = 4, check_bits: int | None = None) -> DataFrame:
    """Links (a, b) that connect exactly what pairs at ``max_bits`` or fewer differing bits connect.

    ``nodes`` (node long, fp long, check array<long>): distinct fingerprints. Each node is indexed under every one-bit
    deletion variant of every segment; rows that share a variant meet in one run and are verified there. Not every pair
    is returned: of the pairs verified in a task, those that join its parts of a component are enough, so a large group
    of near copies gives links in proportion to its size. With ``check_bits``, all bits of fingerprint and check numbers
    together must also differ by that much at most. Runs up to 1,024 are compared offset by offset, longer ones from one
    node to the next; nothing is capped.
    """
    wide = check_bits is not None

    def signed(mask: int) -> int:
        return mask - (1 << 64) if mask >> 63 else mask

    table = ", ".join(f"struct({number} AS v, {signed(mask)}L AS m)" for number, mask in variants(max_bits))
    keyed = nodes.select("node", "fp", "check", F.expr(f"explode(array({table})) AS slot")).select(
        F.expr("xxhash64(slot.v, fp & slot.m) AS key"), F.expr("cast(slot.v AS short) AS v"), "fp", "node", *(["check"] if wide else [])
    )
    masks = np.array([mask for _, mask in variants(max_bits)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            key, v = batch.column(0), batch.column(1)
            if key[0] == key[-1] and v[0] == v[-1]:
                continue  # a run may go on for many batches
            table = pa.Table.from_batches(held)
            keys = table.column(0).to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            yield from _forest(table.slice(0, last), masks, max_bits, check_bits)
            held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield from _forest(pa.Table.from_batches(held), masks, max_bits, check_bits)

    spread = keyed.repartition(partitions(nodes.sparkSession), "key").sortWithinPartitions("key", "v", "fp")
    return spread.mapInArrow(run, "a long, b long").distinct()


def _forest(rows: pa.Table, masks: np.ndarray, max_bits: int, check_bits: int | None) -> Iterator[pa.RecordBatch]:
    """Links of a forest over the verified pairs of whole runs."""
    if rows.num_rows < 2:
        return
    number = rows.column(1).to_numpy().astype(np.int64)
    fp = rows.column(2).to_numpy().view(np.uint64)
    ids = rows.column(3).to_numpy()
    part = fp & masks[number]
    words = [fp]
    if check_bits is not None:
        flat = rows.column(4).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(fp), -1)
        words += [np.ascontiguousarray(flat[:, i]) for i in range(flat.shape[1])]
    # Sorted by a hash of (variant, bits left); order by the pair itself, so that hash collisions keep apart.
    order = np.lexsort((part, number))
    number, part, ids, words = number[order], part[order], ids[order], [w[order] for w in words]
    new = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (part[1:] != part[:-1])])
    lengths = np.diff(np.r_[new, len(part)])
    nodes, at = np.unique(ids, return_inverse=True)
    label = np.arange(len(nodes))
    end = np.repeat(new + lengths, lengths)
    size = np.repeat(lengths, lengths)

    def near(i, j):
        first = np.bitwise_count(words[0][i] ^ words[0][j])
        ok = first <= max_bits
        if check_bits is not None:
            total = first.astype(np.int64)
            for w in words[1:]:
                total = total + np.bitwise_count(w[i] ^ w[j])
            ok &= total <= check_bits
        return ok

    left = np.flatnonzero((size > 1) & (size <= _WIDE_RUN))
    offset, found_i, found_j, waiting = 1, [], [], 0
    while len(left):
        left = left[left + offset < end[left]]
        ok = near(left, left + offset)
        a, b = at[left[ok]], at[left[ok] + offset]
        found_i.append(a), found_j.append(b)
        waiting += len(a)
        if waiting > 2_000_000:
            label, found_i, found_j, waiting = _merged(label, found_i, found_j), [], [], 0
        offset += 1
    if found_i:
        label = _merged(label, found_i, found_j)
    for start, length in zip(new[lengths > _WIDE_RUN], lengths[lengths > _WIDE_RUN]):
        label = _merged(label, *_walk(start, length, near, at))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    if len(moved):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[label[moved]]), pa.array(nodes[moved])], ["a", "b"])


def _walk(start: int, length: int, near, at: np.ndarray) -> tuple[list, list]:
    """Forest links of one long run: from each node reached to those not reached yet."""
    rest = np.arange(start, start + length)
    found_i, found_j, queue = [], [], []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        node = queue.pop()
        ok = near(np.full(len(rest), node), rest)
        hit, rest = rest[ok], rest[~ok]
        if len(hit):
            found_i.append(np.full(len(hit), at[node])), found_j.append(at[hit])
            queue.extend(hit.tolist())
    return found_i, found_j


def _merged(label: np.ndarray, found_i: list, found_j: list) -> np.ndarray:
    """Smallest label of each component once the links (i, j) are added."""
    if not found_i:
        return label
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    label = label.copy()
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label[label] != label).any():
            label = label[label]
    while (label[label] != label).any():
        label = label[label]
    return label


def near_duplicates(
    docs: DataFrame, words: int = 4, max_bits: int = 4, check_words: int = 0, check_bits: int | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(id, fp, component): every document with the smallest id that links of ``max_bits`` or fewer bits reach.

    Copies share a fingerprint and are one node of the search. A row without an id takes no part and has no component;
    rows that repeat an id are equal members. Empty texts share fingerprint zero and are linked like any others.
    """
    prints = written(fingerprints(docs, words, check_words, id_column, text_column), "simhash")
    nodes = prints.where("id IS NOT NULL").groupBy("fp", "check").agg(F.min("id").cast("long").alias("node"))
    roots = components(links(nodes, max_bits, check_bits))
    placed = nodes.join(roots, "node", "left").select("fp", "check", F.expr("coalesce(root, node) AS root"))
    # Nodes of different fingerprints may name one id when rows repeat it: then they are one component as well.
    joined = prints.join(placed, ["fp", "check"], "left")
    return joined.select("id", "fp", F.expr("CASE WHEN id IS NOT NULL THEN root END AS component"))
