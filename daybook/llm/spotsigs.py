"""SpotSigs fingerprints: chains of content words that follow common words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import partitions, slices

# The common words that anchor a chain, by language.
ANCHORS = frozenset(
    """
    the a an of and or in on at to for with by is was are were be been it this that from as not
    le la les un une des du de et ou dans sur pour avec est était sont ce cette qui que en au aux ne pas
    der die das ein eine und oder im auf zu für mit ist war sind den dem von nicht sich
    el los las una unos y o para con es era son por del al se no
    """.split()
)
_WORDS = re.compile(r"\w+").findall
#: Stretches of the id order per task, so that tasks get even shares.
_STRETCHES = 4


def signatures(text: str, chain: int = 2, anchors: frozenset[str] = ANCHORS) -> frozenset[int]:
    """Hashes of (anchor, the next ``chain`` content words) for each anchor of a text.

    A text without any whole chain has one signature, the hash of its words; so equal texts always have equal sets.
    """
    words = _WORDS(text.lower())
    content, spots = [], []
    for word in words:
        if word in anchors:
            spots.append((word, len(content)))
        else:
            content.append(word)
    last, digest = len(content) - chain, xxhash.xxh3_64_intdigest
    found = {digest(" ".join((word, *content[at : at + chain]))) for word, at in spots if at <= last}
    return frozenset(found or {digest("\n".join(words))})


def fingerprint(found: frozenset[int]) -> str:
    """The signatures in order, 16 hex digits each."""
    return np.sort(np.fromiter(found, np.uint64, len(found))).astype(">u8").tobytes().hex()


def likeness(left: frozenset[int], right: frozenset[int], floor: float = 0.0) -> float:
    """Jaccard likeness; 0 without a look at the members if the sizes alone keep it below ``floor``."""
    less, more = sorted((left, right), key=len)
    if len(less) < floor * len(more):
        return 0.0
    both = len(less & more)
    found = both / (len(left) + len(right) - both)
    return found if found >= floor else 0.0


def signature_sets(docs: DataFrame, chain: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, signatures array<long>, sorted) of every whole text; null counts as empty."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = [np.sort(np.fromiter(s, np.uint64).view(np.int64)) for s in (signatures(t or "", chain) for t in part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "signatures"])

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, f"id {kind}, signatures array<long>")


def similar_sets(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(left, right, likeness): pairs of distinct sets of ``sets`` (id, signatures) that are alike to ``threshold`` or more.

    Equal sets are one member, named by their smallest id. Sets are partitioned by size, geometrically, so that partners
    share a class or neighbour it. Within a class, only the rarest ``size - ceil(threshold * size) + 1`` signatures are
    joined on, and pairs whose sizes rule the threshold out are dropped in the join, before likeness is computed.
    """
    step = -float(np.log(threshold))
    members = sets.where("id IS NOT NULL").groupBy("signatures").agg(F.min("id").alias("id"))
    members = members.withColumn("size", F.size("signatures")).withColumn("class", F.floor(F.log("size") / step + 1e-9).cast("int"))
    single = members.select("id", "size", "class", F.explode("signatures").alias("signature"))
    often = single.groupBy("signature").agg(F.count("*").alias("often"))
    ranked = (
        single.join(often, "signature")
        .groupBy("id", "size", "class")
        .agg(F.sort_array(F.collect_list(F.struct("often", "signature"))).alias("order"))
    )
    rarest = F.expr(f"slice(`order`.signature, 1, size - cast(ceil({threshold} * size - 1e-9) AS int) + 1)")
    prefix = ranked.select("id", "size", "class", F.explode(rarest).alias("signature"))
    other = prefix.select(F.col("id").alias("right"), F.col("size").alias("size2"), F.expr("explode(array(class, class + 1)) AS class"), "signature")
    pairs = (
        prefix.withColumnRenamed("id", "left").join(other, ["signature", "class"])
        .where(f"`left` <> `right` AND (size > size2 OR (size = size2 AND `left` < `right`)) AND size2 >= {threshold} * size")
        .select("left", "right").distinct()
    )
    texts = members.select("id", "signatures")
    both = pairs.join(texts.withColumnsRenamed({"id": "left", "signatures": "a"}), "left").join(
        texts.withColumnsRenamed({"id": "right", "signatures": "b"}), "right"
    )
    shared = F.size(F.array_intersect("a", "b"))
    alike = shared / (F.size("a") + F.size("b") - shared)
    return both.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), alike.alias("likeness")).where(
        F.col("likeness") >= threshold
    )


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def against_next(docs: DataFrame, chain: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and its likeness to that and to the next document.

    The next document is that of the next smaller id; after the last comes the first. Rows without an id come last,
    equal ids are ordered by text. A null text is empty. The rows are dealt out in stretches of the id order; each
    stretch also gets the first document of the stretch that follows, so nothing is ordered in one task.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    n = partitions(spark)
    stretches = _STRETCHES * n
    marks = rows.select(F.percentile_approx("id", [i / stretches for i in range(1, stretches)], 20 * stretches)).first()[0]
    bounds = np.unique(np.array(marks or [], np.int64))

    def stretch_of(ids: pa.Array) -> np.ndarray:
        # stretch 0 has the largest ids; rows without an id are a stretch after all others
        at = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds) + 1, at)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stretch_of(batch.column(0)))], ["id", "stretch"])

    first_ids = rows.select("id").mapInArrow(heads, "id long, stretch long").groupBy("stretch").agg(F.max("id")).collect()
    firsts = sorted((r[0], r[1]) for r in first_ids)
    # first id of a stretch -> the stretch before it: one entry per stretch
    carried = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    carried_ids = pa.array(list(carried), pa.int64())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "text", "stretch", "carried"]
        for batch in batches:
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(stretch_of(ids)), pa.array(np.zeros(len(ids), bool))], names)
            twice = batch.filter(pc.is_in(ids, value_set=carried_ids))
            if twice.num_rows:
                target = pa.array([carried[i] for i in twice.column(0).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([*twice.columns, target, pa.array(np.ones(len(target), bool))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for part in slices(batches, "text"):
            out = []
            for doc, text, stretch, is_carried in zip(*(c.to_pylist() for c in part.columns)):
                if is_carried and waiting is None:
                    continue  # a repeated id: only the first row of the next stretch counts
                own = signatures(text, chain)
                if waiting is not None:
                    out.append(_compared(*waiting, text, own, chain))
                waiting = None if is_carried else (doc, text, own)
            if out:
                yield _result(out)

    dealt = rows.mapInArrow(deal, "id long, text string, stretch long, carried boolean")
    ordered = dealt.repartition(n, "stretch").sortWithinPartitions("stretch", "carried", F.col("id").desc_nulls_last(), "text")
    names = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures long"
    return ordered.mapInArrow(run, names).withColumn("id", F.col("id").cast(kind))


def _compared(doc, text, own, following, next_own, chain) -> tuple:
    changed = edited(text, following)
    other = own if changed == text else signatures(changed, chain)
    return (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(own), fingerprint(other), likeness(own, other), likeness(own, next_own), len(own))


def _result(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_signatures"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
