"""Jaccard join of word n-gram sets by prefix filtering with the rarest n-grams first."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.tables import partitions, slices, texts_of, written

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: N-grams of smaller hash come first, by the number of sets that hold them; a quarter of all, as a prefix is a sixth.
_COUNTED = np.uint64(1 << 62)
#: Linked sets share an n-gram more in their prefixes for each so many that they have.
_PER_SHARED = 50
#: Words of 64 bits in a set's bitmap; bit ``i`` says whether an odd number of n-grams have ``i`` as their hash's last bits.
_MAP = tuple(f"map{i}" for i in range(4))
#: N-grams of a set's prefix that say in which run a pair is given.
_MEETS = tuple(f"meets{i}" for i in range(4))
#: Halvings of the suffix filter.
_DEPTH = 3


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def gram_hashes(text: str, words: int) -> np.ndarray:
    """64-bit hashes of the distinct n-grams of ``words`` words, rising; fewer words are one n-gram, none have none.

    A hash is mixed from the XXH3 hashes of the words, in order.
    """
    tokens = text.encode().translate(_LOWER).split()
    if not tokens:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens, repeat(13)), np.uint64, len(tokens))
    width = min(words, len(tokens))
    n = len(tokens) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = _mix(total * _ODD[0] + own[i : i + n])
    return np.unique(total)


def shared_at_least(size):
    """N-grams that a set of ``size`` must have in common with a linked one of this size or more, within the prefixes."""
    return 1 + size // _PER_SHARED


def prefix_length(size: int, threshold: int) -> int:
    """N-grams of a set, the first in order, among which are ``shared_at_least`` of those that it shares with a linked set."""
    return min(size, size - -(-threshold * size // 100) + shared_at_least(size)) if size else 0


def least_overlap(a, b, threshold: int):
    """N-grams that sets of sizes ``a`` and ``b`` must share to be linked."""
    return -(-threshold * (a + b) // (100 + threshold))


def bitmap(grams: np.ndarray) -> np.ndarray:
    """The ``_MAP`` words of a set. Where two of them differ, an n-gram is in one set only."""
    bits = 64 * len(_MAP)
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def _sets(docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """(id, n, key_a, key_b, counted, ``_MAP``, grams array<long>): size and digest of each set, its n-grams below ``_COUNTED`` and how
    many they are; more, in the order of their hash, where a prefix needs them."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = [gram_hashes(text, words) for text in texts_of(part)]
            counted = [int(np.searchsorted(s, _COUNTED)) for s in sets]
            digests = [(xxhash.xxh3_64_intdigest(s.data, 1), xxhash.xxh3_64_intdigest(s.data, 2)) for s in sets]
            shown = [s[: max(c, prefix_length(len(s), threshold))] for s, c in zip(sets, counted)]
            ends = pa.array(np.cumsum([0, *map(len, shown)]), pa.int32())
            flat = pa.array(np.concatenate(shown).view(np.int64))
            keys = np.array(digests, np.uint64).view(np.int64)
            maps = np.stack([bitmap(s) for s in sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                 pa.array(counted, pa.int32()), *[pa.array(maps[:, i]) for i in range(len(_MAP))], pa.ListArray.from_arrays(ends, flat)],
                ["id", "n", "key_a", "key_b", "counted", *_MAP, "grams"],
            )

    return docs.mapInArrow(run, f"id {kind}, n long, key_a long, key_b long, counted int, {', '.join(f'{m} long' for m in _MAP)}, grams array<long>")


def _prefixes(nodes: DataFrame, threshold: int) -> DataFrame:
    """(rank, node, n, most, left): the prefix n-grams of each node that other nodes hold, too.

    Order: first the counted n-grams, those of fewest nodes first, then the others. N-grams of one node alone are never
    sent on: how many come first follows from the rest. ``most`` of a node's n-grams up to this one can be shared, ``left``
    come after it.
    """
    entries = nodes.select("node", F.col("n").cast("int").alias("n"), "counted", F.posexplode("grams").alias("pos", "rank"))
    often = entries.withColumn("holders", F.count("*").over(Window.partitionBy("rank"))).where("holders > 1")
    own = Window.partitionBy("node", "n", "counted")
    first = own.orderBy("outside", F.when(F.col("outside"), 0).otherwise(F.col("holders")), F.when(F.col("outside"), F.col("pos")), "rank")
    placed = often.withColumn("outside", F.expr("pos >= counted")).withColumns(
        {"most": F.row_number().over(first), "inside": F.sum(F.expr("IF(outside, 0, 1)")).over(own)}
    )
    placed = placed.withColumn("place", F.expr("IF(outside, pos, counted - inside + most - 1)"))
    at_least = f"1 + (({threshold} * n + 99) div 100) div {_PER_SHARED}"
    length = f"n - ({threshold} * n + 99) div 100 + 1 + n div {_PER_SHARED}"
    kept = placed.where(f"place < {length} AND most >= {at_least}")
    return kept.select("rank", "node", F.col("n").cast("long").alias("n"), "most", F.expr("cast(n - place - 1 AS int)").alias("left"))


def _runs(entries: DataFrame, emit, schema: str, order: list[str]) -> DataFrame:
    """``emit`` of each run of rows with one ``rank``, given as arrays; tasks hold one run at a time beyond a batch."""
    names = entries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if batch.column(0)[0] == batch.column(0)[-1]:
                continue  # a run may go on for many batches
            table = pa.Table.from_batches(held)
            ranks = table.column(0).to_numpy()
            last = int(np.searchsorted(ranks, ranks[-1]))
            yield from whole(table.slice(0, last))
            held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield from whole(pa.Table.from_batches(held))

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {name: table.column(i).to_numpy() for i, name in enumerate(names)}
        new = np.flatnonzero(np.r_[True, np.diff(columns["rank"]) != 0, True])
        long = np.diff(new) > 1
        yield from emit(columns, new[:-1][long], new[1:][long])

    spread = entries.repartition(partitions(entries.sparkSession), "rank").sortWithinPartitions("rank", *order)
    return spread.mapInArrow(run, schema)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Distinct pairs, the smaller node first."""
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.empty((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _possible(run: dict[str, np.ndarray], a, b, threshold: int) -> np.ndarray:
    """Which pairs of rows pass the filters. Length and position: ``most`` n-grams of each side up to the shared one can be shared, ``left`` come
    after it; a linked pair has a shared one at which ``most`` is what prefixes must share.
    Bitmaps: every bit that differs stands for an n-gram of one side only."""
    n_a, n_b = run["n"][a], run["n"][b]
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    most = np.minimum(run["most"][a], run["most"][b])
    overlap = least_overlap(n_a, n_b, threshold)
    ok = (100 * low >= threshold * high) & (most >= shared_at_least(low)) & (most + np.minimum(run["left"][a], run["left"][b]) >= overlap)
    apart = sum(np.bitwise_count((run[m][a] ^ run[m][b]).view(np.uint64)).astype(np.int64) for m in _MAP)
    return ok & (apart <= n_a + n_b - 2 * overlap)


def _leaders(threshold: int):
    """Pairs of each run with two of its members: the one with fewest n-grams of its own, and one by hash."""

    def emit(run: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(starts):
            return
        node, n, most, left = (run[c] for c in ("node", "n", "most", "left"))
        drawn = _mix(node.view(np.uint64) ^ _mix(run["rank"].view(np.uint64)))
        lengths = ends - starts
        before = np.cumsum(lengths) - lengths
        member = np.repeat(starts - before, lengths) + np.arange(lengths.sum())
        group = np.repeat(np.arange(len(starts)), lengths)
        found_a, found_b = [], []
        for keys in ((node, n - most - left), (node, drawn)):
            ordered = member[np.lexsort((*[k[member] for k in keys], group))]
            leader = ordered[before][group]
            ok = (leader != member) & _possible(run, leader, member, threshold)
            found_a.append(node[leader[ok]]), found_b.append(node[member[ok]])
        yield _pairs(np.concatenate(found_a), np.concatenate(found_b))

    return emit


def _meetings(prefixes: DataFrame) -> DataFrame:
    """(node, n, ``_MEETS``): the first n-grams, by hash, of each set's prefix at which any linked pair of it passes the filters; 0 for none.

    Sets of equal size that share a node, as its id is repeated, have none: they can't be told apart.
    """
    own = F.expr("array_sort(collect_list(struct(rank < 0 AS high, rank, most)))").alias("own")
    sets = prefixes.groupBy("node", "n").agg(own).withColumn("alone", F.expr("size(own) = size(array_distinct(own.rank))"))
    sure = sets.withColumn("sure", F.expr(f"filter(own, x -> alone AND x.most >= 1 + n div {_PER_SHARED}).rank"))
    return sure.select("node", "n", *[F.expr(f"coalesce(get(sure, {i}), 0L)").alias(m) for i, m in enumerate(_MEETS)])


def _given_here(run: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of rows of one run are given by it: by the smallest that both have among their ``_MEETS``, by all without such a one.

    A linked pair passes the filters in that run, so one run is enough.
    """
    at = np.zeros(len(a), np.int64)
    for x in (run[m][a] for m in _MEETS):
        for y in (run[m][b] for m in _MEETS):
            at = np.where((x == y) & (x != 0) & ((at == 0) | (x < at)), x, at)
    return (at == 0) | (at == run["rank"][a])


def _others(threshold: int):
    """Pairs of each run that are in different components, pass the filters and are given by this run.

    The members of the largest component of a run are not compared with one another; every other member is compared with
    the members whose size and remaining n-grams make a link possible.
    """

    def given(run: dict[str, np.ndarray], found_a: list[np.ndarray], found_b: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        here = _given_here(run, a, b)
        return _pairs(run["node"][a[here]], run["node"][b[here]])

    def emit(run: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        found_a, found_b, waiting = [], [], 0
        mixed = _mixed(run["root"], starts, ends)
        for s, e in zip(starts[mixed].tolist(), ends[mixed].tolist()):
            root = run["root"][s:e]
            n, most, left = (run[c][s:e] for c in ("n", "most", "left"))  # n rises
            names, group, sizes = np.unique(root, return_inverse=True, return_counts=True)
            large = int(sizes.argmax())
            for i in np.flatnonzero(group != large).tolist():
                reach = (most[i] + left[i]) * (100 + threshold) // threshold - n[i]
                low = np.searchsorted(n, -(-threshold * n[i] // 100))
                high = np.searchsorted(n, min(100 * n[i] // threshold, reach), side="right")
                if low >= high:
                    continue
                at = np.arange(low, high)
                ok = (group[at] != group[i]) & ((group[at] == large) | (at > i))
                ok &= _possible(run, s + i, s + at, threshold)
                at = at[ok]
                found_a.append(np.full(len(at), s + i)), found_b.append(s + at)
                waiting += len(at)
            if waiting > 500_000:
                yield given(run, found_a, found_b)
                found_a, found_b, waiting = [], [], 0
        if found_a:
            yield given(run, found_a, found_b)

    return emit


def _mixed(root: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which runs have more than one root."""
    changes = np.r_[0, np.cumsum(root[1:] != root[:-1])] if len(root) else np.empty(0, np.int64)
    return changes[ends - 1] != changes[starts]


def apart(a: np.ndarray, b: np.ndarray, depth: int = _DEPTH) -> int:
    """At least so many elements are in one of two rising arrays only: both are cut at the middle of ``b``, then each half."""
    if not depth or not len(a) or not len(b):
        return abs(len(a) - len(b))
    middle = len(b) // 2
    at = int(np.searchsorted(a, b[middle]))
    has = at < len(a) and a[at] == b[middle]
    return apart(a[:at], b[:middle], depth - 1) + apart(a[at + has :], b[middle + 1 :], depth - 1) + (not has)


def alike(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Whether 100 * intersection >= threshold * union for two rising arrays without repeats."""
    total, need = len(a) + len(b), least_overlap(len(a), len(b), threshold)
    if min(len(a), len(b)) < need or apart(a, b) > total - 2 * need:
        return False
    at = np.searchsorted(a, b)
    return int((a[np.minimum(at, len(a) - 1)] == b).sum()) >= need


def _packed(docs: DataFrame) -> DataFrame:
    """(id, blob): texts compressed, which are a third of the size of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in slices(batches, "text"):
            blobs = [squeeze.compress(text.encode()) for text in texts_of(part)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(blobs, pa.binary())], ["id", "blob"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, blob binary")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: int) -> DataFrame:
    """The linked ones of distinct ``pairs`` (a, b), each judged once on its whole sets."""
    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("blob").alias("blob_b")), "b")
    both = with_b.join(texts.select(F.col("node").alias("a"), F.col("blob").alias("blob_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widen = zstandard.ZstdDecompressor()

        def grams(blob: bytes) -> np.ndarray:
            return gram_hashes(widen.decompress(blob).decode(), words)

        last, own = None, None
        for part in slices(batches, "blob_b", 1 << 20, 4096):
            linked = []
            for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                if a != last:  # pairs of one node come in a row
                    last, own = a, grams(a)
                other = grams(b)
                linked.append(len(own) > 0 and len(other) > 0 and alike(own, other, threshold))
            yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "blob_a", "blob_b").mapInArrow(run, "a long, b long")


def linked(docs: DataFrame, words: int = 4, threshold: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n, component): size of each document's set of ``words``-word n-grams, and the smallest id that links reach.

    Words are lower-cased in A to Z; fewer than ``words`` are one n-gram, null and empty texts have none and are linked with
    nothing. Two documents link when 100 * intersection >= ``threshold`` * union.

    Equal sets are one node. Nodes meet in runs by the n-grams of their prefixes, rarest first: linked sets share some there.
    First each run's members are compared with two of them; then all pairs of a run that are still in different
    components and pass the filters, each from one of the runs that it is in. So a group of near copies gives pairs in
    proportion to its size, and no link between different components is left out. A row without an id takes no part and has no component; rows that repeat an id are
    one document that links what any of its texts links. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = written(_sets(rows, words, threshold), "sets")
    named = found.where("id IS NOT NULL AND n > 0")
    nodes = named.groupBy("key_a", "key_b").agg(
        F.min("id").cast("long").alias("node"), *[F.first(c).alias(c) for c in ("n", "counted", *_MAP, "grams")]
    )
    maps = nodes.select("node", "n", *_MAP)
    prefixes = written(_prefixes(nodes, threshold).join(maps, ["node", "n"]).select("rank", "node", "n", "most", "left", *_MAP), "prefixes")
    # A few rows may repeat an id: each of their texts speaks for the node, equal ones once.
    wanted = prefixes.select(F.col("node").alias("id")).distinct()
    asked = _packed(rows.where("id IS NOT NULL")).join(wanted, "id", "left_semi")
    texts = written(asked.groupBy("id", F.xxhash64("blob")).agg(F.first("blob").alias("blob")).select(F.col("id").cast("long").alias("node"), "blob"), "texts")

    shape = "a long, b long"
    first = written(_runs(prefixes, _leaders(threshold), shape, ["n"]).distinct(), "pairs")
    links = written(_verified(first, texts, words, threshold).distinct(), "links")
    reached = components(links)
    own = _meetings(prefixes).join(reached, "node", "left").select("node", "n", *_MEETS, F.coalesce("root", "node").alias("root"))
    placed = prefixes.join(own, ["node", "n"]).select(*prefixes.columns, *_MEETS, "root")
    second = _runs(placed, _others(threshold), shape, ["n"]).distinct().join(first, ["a", "b"], "left_anti")
    more = _verified(second, texts, words, threshold).distinct()

    classes = nodes.select("key_a", "key_b", "node")
    # A row that repeats the id of another set's node joins the two.
    members = named.join(classes, ["key_a", "key_b"]).where("id <> node")
    twice = members.join(classes.select(F.col("node").alias("id")).distinct(), "id", "left_semi").select(F.col("id").cast("long").alias("a"), F.col("node").alias("b"))
    roots = components(links.union(more).union(twice))
    labelled = classes.join(roots, "node", "left").select("key_a", "key_b", F.coalesce("root", "node").alias("root"))
    joined = found.join(labelled, ["key_a", "key_b"], "left")
    component = F.expr("CASE WHEN id IS NOT NULL THEN coalesce(root, id) END")
    return joined.select("id", "n", component.alias("component"))
