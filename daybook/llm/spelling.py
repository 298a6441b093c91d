"""Spelling variants: words at one inserted, deleted or replaced letter, found in a trie of letter-group counts."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import compress, count
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import partitions, slices, texts_of, written

#: Bytes of a text in Latin-1: A to Z become small, what is no letter of a run becomes a space. Other characters are "?".
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))
#: Letters are dealt to groups by code point; a word is arranged by its counts of the groups in turn.
GROUPS, _STEP = 13, 5
#: Groups whose counts say which part of the trie a word is in.
_HEAD = 8
#: Different words that a task counts before it hands them on.
_COUNTED = 200_000


def runs_of(text: str, doc: str, least_letters: int, every: int) -> dict[bytes, int]:
    """How often each run of ``least_letters`` or more occurs, in Latin-1 with A to Z lower-cased; where ``every`` divides the
    CRC-32 of ``<doc>:<run>`` in UTF-8 the run lacks one letter."""
    found = Counter([run for run in text.encode("latin-1", "replace").translate(_FOLD).split() if len(run) >= least_letters])
    if not every:
        return found
    start = zlib.crc32(f"{doc}:".encode())
    lacking = []
    for run in found:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % every == 0:
            lacking.append((run, h % len(run)))
    for less, n in [(run[:at] + run[at + 1 :], found.pop(run)) for run, at in lacking]:
        if len(less) >= least_letters:
            found[less] = found.get(less, 0) + n
    return found


def word_counts(docs: DataFrame, least_letters: int, least_count: int, every: int, id_column: str, text_column: str) -> DataFrame:
    """(word, n): words of ``least_letters`` and more that occur ``least_count`` times and more in all texts.

    Tasks count what they read before anything is shuffled, so a word that all documents share is a row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            names = pa.array([word.decode("latin-1") for word in total], pa.string())
            batch = pa.RecordBatch.from_arrays([names, pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        total: dict[bytes, int] = {}
        known = total.get
        for part in slices(batches, "text"):
            for doc, text in zip(part.column(0).to_pylist(), texts_of(part)):
                for word, n in runs_of(text, doc or "", least_letters, every).items():
                    total[word] = known(word, 0) + n
            if len(total) >= _COUNTED:
                yield rows()
        yield rows()

    named = docs.select(F.col(id_column).cast("string").alias("doc"), F.col(text_column).alias("text"))
    counted = named.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def group_counts(words: list[str]) -> np.ndarray:
    """A row of letter-group counts per word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.bincount(owner * GROUPS + points * _STEP % GROUPS, minlength=len(words) * GROUPS)
    return np.minimum(flat, 255).astype(np.uint8).reshape(len(words), GROUPS)


def one_apart(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next(compress(count(), map(ne, a, b)), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _heads() -> list[tuple[tuple[int, ...], int, int]]:
    """(change of the head's counts, surplus left, deficit left) of the parts in which a near word can be.

    Of the two parts of a pair only one asks the other: the change must be zero, or its first entry that isn't must be
    positive.
    """
    found = [((0,) * _HEAD, 1, 1)]
    for i in range(_HEAD):
        change = [0] * _HEAD
        change[i] = 1
        found.append((tuple(change), 0, 1))
        for j in range(i + 1, _HEAD):
            change[j] = -1
            found.append((tuple(change), 0, 0))
            change[j] = 0
    return found


class _Trie:
    """Words of one part by their remaining group counts, level by level; a leaf holds the words of equal counts."""

    def __init__(self):
        self.root: dict = {}
        self.words: list[str] = []

    def insert(self, word: str, counts: bytes) -> None:
        node = self.root
        for count in counts[:-1]:
            node = node.setdefault(count, {})
        node.setdefault(counts[-1], []).append(len(self.words))
        self.words.append(word)

    def near(self, word: str, counts: bytes, surplus: int, deficit: int) -> list[int]:
        """Numbers of the words one apart from ``word``; a count may be one higher and another one lower on the way."""
        words, last, found = self.words, len(counts) - 1, []
        stack = [(self.root, 0, surplus, deficit)]
        while stack:
            node, level, more, less = stack.pop()
            count = counts[level]
            for held, child in node.items():
                change = held - count
                if change == 0:
                    left = (more, less)
                elif change == 1 and more:
                    left = (0, less)
                elif change == -1 and less:
                    left = (more, 0)
                else:
                    continue
                if level < last:
                    stack.append((child, level + 1, *left))
                else:
                    found += [number for number in child if one_apart(word, words[number])]
        return found


def near_words(words: DataFrame) -> DataFrame:
    """(word, near long, best struct<down, form>): for every word with near words how many, and the one of largest n
    (ties: first in code-point order), as far as the rows of a part of the trie tell: several rows per word.

    The trie's first levels are dealt out to tasks; each word rests in one part and asks the parts in which a near word
    can be, in one of both directions. A task holds the words of one part and what each of them has found, no pairs.
    """
    changes = _heads()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "word", 1 << 20, 1 << 14):
            found = part.column(0).to_pylist()
            counts = group_counts(found)
            heads, tails = counts[:, :_HEAD].astype(np.int64), counts[:, _HEAD:]
            rows = [row.tobytes() for row in tails]
            for number, (change, surplus, deficit) in enumerate(changes):
                there = heads + np.array(change)
                at = np.flatnonzero((there >= 0).all(axis=1))
                keys = there[at] @ (257 ** np.arange(_HEAD))
                budget = np.full(len(at), surplus * 2 + deficit, np.int8)
                mine = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(len(at), number == 0)), pa.array(budget), part.column(0).take(mine), part.column(1).take(mine),
                     pa.array([rows[i] for i in at.tolist()], pa.binary())],
                    ["key", "rests", "budget", "word", "n", "tail"],
                )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(names: list[str], totals: list[int], found: list[tuple | None]) -> pa.RecordBatch:
            at = [i for i, total in enumerate(totals) if total]
            return pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in at], pa.string()), pa.array([totals[i] for i in at], pa.int64()),
                 pa.array([found[i][0] for i in at], pa.int64()), pa.array([found[i][1] for i in at], pa.string())],
                ["word", "near", "down", "form"],
            )

        key, trie = None, _Trie()
        ns, totals, best = [], [], []  # of the words at rest in the part
        for batch in batches:
            if not batch.num_rows:
                continue
            asking, asked, found = [], [], []
            batch = batch.filter(pa.array(_met(batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), key)))
            for k, rests, budget, word, n, tail in zip(*(column.to_pylist() for column in batch.columns)):
                if k != key:
                    yield rows(trie.words, totals, best)
                    key, trie, ns, totals, best = k, _Trie(), [], [], []
                if not rests and not ns:
                    continue
                hits = trie.near(word, tail, budget >> 1, budget & 1)
                for hit in hits:
                    totals[hit] += 1
                    if best[hit] is None or (-n, word) < best[hit]:
                        best[hit] = (-n, word)
                first = min(((-ns[hit], trie.words[hit]) for hit in hits), default=None)
                if rests:
                    trie.insert(word, tail)
                    ns.append(n), totals.append(len(hits)), best.append(first)
                elif hits:
                    asking.append(word), asked.append(len(hits)), found.append(first)
            yield rows(asking, asked, found)
        yield rows(trie.words, totals, best)

    spread = words.select("word", "n").mapInArrow(placed, "key long, rests boolean, budget byte, word string, n long, tail binary")
    parts = spread.repartition(partitions(words.sparkSession), "key").sortWithinPartitions("key", F.col("rests").desc())
    return parts.mapInArrow(met, "word string, near long, down long, form string")


def _met(keys: np.ndarray, rests: np.ndarray, open_key: int | None) -> np.ndarray:
    """Which rows are in a part where a word rests and another row is; the parts at both ends of a batch may go on."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    kept = rests[starts] & (sizes > 1)
    kept[-1] = kept[-1] or rests[starts[-1]]
    kept[0] = kept[0] or keys[0] == open_key
    return np.repeat(kept, sizes)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): follows (word, form: not null) to the last; a form's n is larger, so there are no rings.

    Each round doubles the steps: a word whose target has a target of its own takes that one.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = state.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        joined = state.join(after, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved"))
        moved = written(joined, "forms")
        state = moved.select("word", "root")
        if moved.where("__moved").isEmpty():
            return state


def variants(
    docs: DataFrame, least_letters: int = 6, least_count: int = 5, share: int = 5, every: int = 199, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with its spelling form.

    Words are maximal runs of A to Z, a to z and U+00C0 to U+00FF with A to Z lower-cased, of ``least_letters`` code points
    and ``least_count`` occurrences at least. Where ``every`` divides the CRC-32 ``h`` of ``<doc_id>:<run>`` the run first
    loses the code point ``h`` mod its length (``every`` = 0: never). Near words differ by exactly one inserted, deleted or
    replaced code point. ``form`` is the near word of largest n (ties: smallest in code-point order) if its n is
    ``share`` times the word's or more, else null; ``root`` is the last word that forms lead to.

    Null and empty texts have no words; a null id is written as an empty one. Rows that repeat an id or a whole row count
    each time. An empty table has no words. Other columns are not read.
    """
    if share < 2:
        raise ValueError("share must be 2 or more, so that forms rise in n")
    words = written(word_counts(docs, least_letters, least_count, every, id_column, text_column), "words")
    near = near_words(words).groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("down", "form")).alias("best"))
    rows = words.join(near, "word", "left")
    taken = F.col("best.down") * -1 >= F.col("n") * share
    rows = rows.select(
        "word", F.when(taken, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, -F.col("best.down")).alias("form_n"),
    )
    rows = written(rows, "near-words")
    last = roots(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
