"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import slices, texts_of

UNKNOWN = "und"
#: Letters share 63 slots (a to z have one each); slot 0 is any run of other characters.
SLOTS = 64
_GRAMS = SLOTS**3
#: Columns of n-gram vectors held at once.
_BLOCK = 1024
#: Weight of one document in a language's bundle, dealt out over its n-grams in whole numbers.
_UNIT = 1 << 20


@cache
def _slots() -> np.ndarray:
    table = np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        table[point] = _slot(chr(point))
    return table


def _slot(char: str) -> int:
    if not char.isalpha():
        return 0
    low = ord(char.lower()[0])
    return low - 96 if 97 <= low <= 122 else 27 + low % 37


@cache
def _letters(dimensions: int) -> np.ndarray:
    """A random +1/-1 vector per slot, fixed by a seed."""
    return (np.random.default_rng(6).integers(0, 2, (SLOTS, dimensions), dtype=np.int8) * 2 - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors of letter trigrams: the first letter's vector rotated twice, the second's once, the third's not."""
    letters = _letters(dimensions)
    once, twice = np.roll(letters, 1, axis=1), np.roll(letters, 2, axis=1)
    return twice[grams // (SLOTS * SLOTS)] * once[grams // SLOTS % SLOTS] * letters[grams % SLOTS]


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, trigram) of every trigram whose middle is a letter."""
    points = np.frombuffer("".join(f"\n{t}\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    slot = _slots()[np.minimum(points, 0xFFFF)]
    for high in np.unique(points[points > 0xFFFF]):
        slot[points == high] = _slot(chr(int(high)))
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 2 for t in texts])
    at = np.flatnonzero(slot[1:-1]) + 1
    wide = slot.astype(np.int32)
    return doc[at], (wide[at - 1] * SLOTS + wide[at]) * SLOTS + wide[at + 1]


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams that occur, matrix of their counts per document)."""
    doc, gram = grams_of(texts)
    grams = np.flatnonzero(np.bincount(gram, minlength=_GRAMS))
    place = np.zeros(_GRAMS, np.int64)
    place[grams] = np.arange(len(grams))
    counts = np.bincount(doc * np.int64(len(grams)) + place[gram], minlength=len(texts) * len(grams))
    return grams, counts.reshape(len(texts), len(grams))


def bundles(texts: list[str], dimensions: int) -> np.ndarray:
    """The bundle (sum of its n-gram vectors) of each text; zero if it has no letter."""
    grams, counts = _counted(texts)
    total = np.zeros((len(texts), dimensions), np.float64)
    for start in range(0, len(grams), _BLOCK):
        vectors = gram_vectors(grams[start : start + _BLOCK], dimensions).astype(np.float32)
        total += counts[:, start : start + _BLOCK].astype(np.float32) @ vectors
    return total


class Profiles:
    """Language names and their prototype vectors, scaled to length one."""

    def __init__(self, names: list[str], prototypes: np.ndarray):
        self.names = names
        length = np.linalg.norm(prototypes, axis=1, keepdims=True)
        self.prototypes = prototypes / np.where(length > 0, length, 1)
        self.dimensions = prototypes.shape[1]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language of the nearest prototype and the cosine, 0 at least; equal cosines: first name in order."""
        found = bundles(texts, self.dimensions)
        length = np.linalg.norm(found, axis=1)
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        cosines = np.round(found @ self.prototypes.T / np.where(length > 0, length, 1)[:, None], 9)
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(texts)), best], 0.0, 1.0)
        known = length > 0
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0).tolist()


def learn(labelled: DataFrame, dimensions: int = 1024, rows_per_language: int = 4000, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id") -> Profiles:
    """Prototypes from rows with a language and a text.

    At most about ``rows_per_language`` rows of each language are read, chosen by a hash of id, language and text, which holds
    a language that makes up a third of all rows to the same bound. Every row weighs the same, however long. What comes
    back is a sum per (language, trigram). Rows without language, text or letter are left out; with no rows left there
    are no languages.
    """
    rows = labelled.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    draw = F.pmod(F.xxhash64(F.col(id_column), F.col(lang_column), F.col(text_column)), F.lit(1_000_000))
    sizes = rows.groupBy(lang_column).agg(F.count("*"), F.min(draw)).collect()
    # the smallest draw of a language always counts, so that equal rows can't leave it without any
    bounds = {lang: max(int(1e6 * min(1.0, rows_per_language / n)), least) + 1 for lang, n, least in sizes}
    share = F.create_map(*[x for lang, bound in bounds.items() for x in (F.lit(lang), F.lit(bound))]) if bounds else None
    if share is None:
        return Profiles([], np.zeros((0, dimensions)))
    chosen = rows.where(draw < share[F.col(lang_column)]).select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20, 256):
            grams, counts = _counted(texts_of(part))
            total = counts.sum(axis=1)
            langs = np.array(part.column(0).to_pylist(), object)
            for lang in sorted(set(langs[total > 0])):
                mine = (langs == lang) & (total > 0)
                weight = (counts[mine] * _UNIT // total[mine, None]).sum(axis=0)
                at = np.flatnonzero(weight)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array(grams[at]), pa.array(weight[at])], ["lang", "gram", "weight"]
                )

    sums = chosen.mapInArrow(run, "lang string, gram long, weight long").groupBy("lang", "gram").agg(F.sum("weight").alias("weight"))
    table = sums.toArrow()
    langs, grams, weights = (np.array(table.column(i).to_pylist()) for i in range(3))
    names = sorted(set(langs.tolist()))
    prototypes = np.zeros((len(names), dimensions))
    for i, name in enumerate(names):
        mine = np.flatnonzero(langs == name)
        for start in range(0, len(mine), _BLOCK):
            at = mine[start : start + _BLOCK]
            prototypes[i] += weights[at].astype(np.float64) @ gram_vectors(grams[at], dimensions).astype(np.float64)
    return Profiles(names, prototypes)


def with_language(docs: DataFrame, profiles: Profiles, text_column: str = "text", lang_column: str = "lang_pred", score_column: str = "score") -> DataFrame:
    """``docs`` plus the predicted language and its score (0 to 1); ``und`` and 0 for texts that are null or have no letter.

    Only the text is read for a prediction. Other columns are kept; columns named like the two new ones are replaced.
    """
    base = docs.drop(lang_column, score_column)
    schema = f"{_ddl(base)}, `{lang_column}` string, `{score_column}` double"
    names = [*base.columns, lang_column, score_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column, 1 << 20, 256):
            langs, scores = profiles.predict(texts_of(part, text_column))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs), pa.array(scores)], names)

    return base.mapInArrow(run, schema)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
