"""Token ids by a public tokenizer file, found once for each distinct white-space separated chunk of a slice."""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A word of Latin-1 letters, in which lower case and canonical composition change letter by letter, and the ASCII marks
#: after it. An apostrophe would begin a token of another rule.
_WORD = r"^(?P<word>[A-Za-z\x{aa}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


class Pieces:
    """Encodes texts chunk by chunk; nothing is kept from one call to the next.

    The tokenizer drops white space, lowers case and never lets a token cross white space or join a letter to a mark, so
    a text's ids are those of its chunks in a row. Only spaces and line feeds cut here; any other white space stays
    inside a chunk, where the tokenizer sees it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The same model for words in lower case with a space between them.
        self.of_words = Tokenizer(self.tokenizer.model)
        self.of_words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # the tokens that end a word
        self.closes[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True

    @staticmethod
    @cache
    def of(path: str) -> Pieces:
        return Pieces(path)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids int32 of all texts in a row, bounds): text ``i`` has ``ids[bounds[i]:bounds[i + 1]]``; a null one has none."""
        chunks = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = chunks.flatten().dictionary_encode()
        flat, ends, first, second = self._units(coded.dictionary)
        place = coded.indices.to_numpy()
        units = np.stack([first[place], second[place]], axis=1).ravel()
        lengths = (ends[1:] - ends[:-1])[units]
        bounds = np.r_[0, np.cumsum(lengths)]
        at = np.repeat(ends[units] - bounds[:-1], lengths) + np.arange(bounds[-1])
        offsets = chunks.offsets.to_numpy()
        return flat[at], bounds[2 * (offsets - offsets[0])]

    def _units(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all units, bounds, first unit of each chunk, its second unit); unit 0 has no ids.

        A plain word and the marks after it are two units, any other chunk is one.
        """
        found = pc.extract_regex(chunks, _WORD)
        plain = found.is_valid()
        parts = found.filter(plain)
        words = pa.concat_arrays([pa.array([""]), pc.utf8_lower(parts.field(0)), parts.field(1)]).dictionary_encode()
        named = words.dictionary.slice(1)
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named), " ")[0].as_py()
        ids = np.array(self.of_words.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(named):
            raise ValueError("each word must end with a closing token")
        others = self.tokenizer.encode_batch_fast(chunks.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)
        rest = [np.array(other.ids, np.int32) for other in others]
        bounds = np.r_[0, 0, ends, len(ids) + np.cumsum([len(x) for x in rest], dtype=np.int64)]
        first, second = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        first[~is_plain] = 1 + len(ends) + np.arange(len(rest))
        first[is_plain], second[is_plain] = np.split(words.indices.to_numpy()[1:], 2)
        return np.concatenate([ids, *rest]), bounds, first, second

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        ids, bounds = self.ids(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
