"""Four stages from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import language, simhash, substring
from daybook.llm.queries import packed_pieces
from daybook.llm.tables import read_table, written

#: A text of so many characters and more whose cosine is lower is in no learned language; shorter ones can't be judged.
JUDGED_CHARS, LEAST_SCORE = 200, 0.2
#: Near copies: words of a shingle, and the bits by which fingerprints of linked documents differ at most.
SHINGLE, NEAR_BITS = 4, 4


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and long ones far from every language learned from the labelled ones.

    Where no language can be learned, no text is far from one: every text with a letter stays.
    """
    profiles = language.learn(docs)
    if not profiles.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.with_language(docs, profiles, lang_column="__lang", score_column="__score")
    near = (F.col("__score") >= LEAST_SCORE) | (F.length("text") < JUDGED_CHARS)
    return found.where((F.col("__lang") != language.UNKNOWN) & near).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group that SimHash fingerprints link.

    Documents without an id stay, as do rows that repeat a kept id. Texts without words share one fingerprint.
    """
    groups = simhash.near_duplicates(docs, SHINGLE, NEAR_BITS)
    gone = groups.where("id <> component").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 20 words and more that an earlier document, or an earlier place, has. What is left empty goes.

    Null and empty texts lose nothing and stay. Rows that repeat a whole row count as one document and all keep what it
    keeps; rows without an id come last. Texts that lose nothing keep their white space, ``n_chars`` follows the others.
    """
    left = substring.without_repeats(docs, keep_layout=True, counts=("__words", "__removed"))
    changed = F.col("__removed") > 0
    rows = left.where("__removed = 0 OR __words > __removed")
    return rows.select(*[F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2,048.

    A null or empty text is one piece of its end id alone; rows that repeat an id, or whole rows, all get their places.
    """
    return packed_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

#: Fingerprints, language profiles and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each on the written result of the one before."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
