"""Ranked lexical search that scores each class of documents with equal bags of query terms once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from daybook.llm.tables import slices, texts_of, written

#: Bytes of item texts that are searched in one go; more are dealt out over several passes.
ITEM_BYTES = 4 << 20
#: Scores held at once by a task: classes in a slice times items.
_SCORES = 1 << 20
#: Every byte that ends a term becomes a space, A to Z become small; bytes of other alphabets stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Terms in order, repeats included: runs of ASCII letters and digits and of anything beyond ASCII."""
    return (text or "").encode().translate(_FOLD).split()


@dataclass(frozen=True)
class Postings:
    """Terms of some items and which items hold them: for term ``t``, ``items[t]`` and how often, ``repeats[t]``."""

    numbers: dict[bytes, int]
    items: list[np.ndarray]
    repeats: list[np.ndarray]
    n_items: int

    @staticmethod
    def of(texts: list[str | None]) -> Postings:
        bags = [Counter(terms_of(text)) for text in texts]
        numbers = {term: i for i, term in enumerate(sorted(set().union(*bags)))}
        held: list[list[tuple[int, int]]] = [[] for _ in numbers]
        for item, bag in enumerate(bags):
            for term, n in bag.items():
                held[numbers[term]].append((item, n))
        items = [np.array([i for i, _ in x], np.int64) for x in held]
        return Postings(numbers, items, [np.array([n for _, n in x], np.int64) for x in held], len(texts))


def bags(docs: DataFrame, postings: Postings, id_column: str, text_column: str) -> DataFrame:
    """(id, n, terms array<int>, tfs array<int>): a document's number of terms, and its bag of the items' terms in order."""
    numbers = postings.numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.keys()
        for part in slices(batches, "text"):
            totals, sizes, held, tfs = [], [], [], []
            for text in texts_of(part):
                found = terms_of(text)
                bag = Counter(found)
                mine = sorted([(numbers[term], bag[term]) for term in known & bag.keys()])
                totals.append(len(found)), sizes.append(len(mine))
                held += [term for term, _ in mine]
                tfs += [tf for _, tf in mine]
            ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in (held, tfs)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(totals, pa.int64()), *lists], ["id", "n", "terms", "tfs"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n long, terms array<int>, tfs array<int>")


def classes(found: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(terms, tfs, m, ids array): documents with equal bags and equal ``m``, by the ``k`` smallest of their ids.

    Rows meet by a hash of bag and m and are told apart by bag and m themselves. Only the ``k`` smallest ids of a class
    leave a map task, so a class that a third of all documents belong to is as small as any other.
    """
    m = F.expr(f"25 + (75L * n * {n_docs}L) div {max(1, n_terms)}L")
    key = ["h", "m", "terms", "tfs"]
    rows = found.where("id IS NOT NULL AND size(terms) > 0").withColumn("m", m).withColumn("h", F.xxhash64("terms", "tfs", "m"))
    first = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
    kept = rows.select(*key, "id").withColumn("__nth", first).where(F.col("__nth") <= k)
    return kept.groupBy(*key).agg(F.sort_array(F.collect_list("id")).alias("ids")).select("terms", "tfs", "m", "ids")


def _scores(part: pa.RecordBatch, postings: Postings, weights: np.ndarray) -> np.ndarray:
    """Scores of the classes of a slice (rows) for all items (columns)."""
    terms, tfs = part.column(0), part.column(1)
    row = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
    term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
    m = part.column(2).to_numpy()
    value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
    total = np.zeros((part.num_rows, postings.n_items), np.int64)
    order = np.argsort(term, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(term[order]) > 0, True]) if len(order) else np.zeros(1, np.int64)
    for low, high in zip(cuts, cuts[1:]):
        at = order[low:high]
        t = term[at[0]]
        total[np.ix_(row[at], postings.items[t])] += value[at, None] * postings.repeats[t][None, :]
    return total


class _Best:
    """For each item the ``k`` best classes so far: by falling score, then by rising first id."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.floor = np.ones(n_items, np.int64)
        self.item = self.score = np.empty(0, np.int64)
        self.ids = pa.array([], pa.list_(pa.int64()))

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        if len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]
        else:
            least = np.zeros_like(self.floor)
        row, item = np.nonzero(scores >= np.maximum(least, self.floor))
        if not len(row):
            return
        self.ids = pa.concat_arrays([self.ids, ids.take(pa.array(row))])
        self.item, self.score = np.r_[self.item, item], np.r_[self.score, scores[row, item]]
        first = self.ids.flatten().to_numpy()[self.ids.offsets.to_numpy()[:-1]]
        order = np.lexsort((first, -self.score, self.item))
        start = np.searchsorted(self.item[order], self.item[order])
        nth = np.arange(len(order)) - start
        kept = order[nth < self.k]
        full = order[nth == self.k - 1]
        self.floor[self.item[full]] = np.maximum(self.floor[self.item[full]], self.score[full])
        self.item, self.score, self.ids = self.item[kept], self.score[kept], self.ids.take(pa.array(kept))


def _ranked(docs: DataFrame, items: list[Row], k: int, id_column: str, text_column: str) -> DataFrame:
    """(item, doc, score, rank) for some items, named by their place in ``items``."""
    postings = Postings.of([row[1] for row in items])
    found = written(bags(docs, postings, id_column, text_column), "bags")
    n_docs, n_terms = found.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = dict(found.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(postings.numbers))], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(postings.n_items, k)
        for part in slices(batches, "terms", 4 << 20, max(1, _SCORES // postings.n_items)):
            best.add(_scores(part, postings, weights), part.column(3).cast(pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.score), best.ids], ["item", "score", "ids"])

    kept = classes(found, n_docs, n_terms, k).mapInArrow(run, "item long, score long, ids array<long>")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc")
    members = kept.select("item", "score", F.explode("ids").alias("doc"))
    return members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """(item, rank int, doc, score long): the ``k`` documents of highest score above 0 for each item.

    Terms are maximal runs without ASCII characters other than letters and digits; only A to Z are lower-cased. With N
    documents that have a term, L terms in all and df documents that hold a term, its weight is floor(1000 ln((2N + 2) /
    (2 df + 1))); a document of n terms has m = 25 + 75 n N div L, and scores weight * (10^9 tf div (1000 tf + 8 m)) for
    each of the item's terms, repeats included, in 64-bit whole numbers. Equal scores: smaller id first.

    Every row of ``docs`` counts for N, L and df. Rows without an id are not ranked, rows that repeat an id are ranked one
    by one. A null text, of a document or an item, has no terms; such items, and all items where no document has a term,
    have no rows. Rows of ``items`` that repeat an id each get their rows. Other columns are not read.

    Items go to the driver and the tasks in blocks of about ``ITEM_BYTES``, a whole number of items each; every block is
    one pass over the documents. Ids must be whole numbers.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_column).alias("item"), F.col(item_text_column).alias("text"))
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = total // ITEM_BYTES + 1
    kind, doc_kind = items.schema[item_column].dataType, docs.schema[id_column].dataType
    result = None
    for block in range(blocks):
        mine = named.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect() if blocks > 1 else named.collect()
        mine = [row for row in mine if terms_of(row[1])]
        if not mine:
            continue
        names = F.broadcast(spark.createDataFrame([(i, row[0]) for i, row in enumerate(mine)], f"item long, name {kind.simpleString()}"))
        rows = _ranked(docs, mine, k, id_column, text_column).join(names, "item")
        rows = rows.select(F.col("name").alias("item"), F.col("rank").cast("int").alias("rank"), F.col("doc").cast(doc_kind).alias("doc"), "score")
        result = rows if result is None else result.union(rows)
    if result is None:
        return spark.createDataFrame([], f"item {kind.simpleString()}, rank int, doc {doc_kind.simpleString()}, score long")
    return result
