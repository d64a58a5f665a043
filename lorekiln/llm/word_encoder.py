"""Token ids of whole texts, with each distinct word of a batch encoded once.

Both tokenizers split texts into pieces that never cross certain spaces, and encode each
piece alone. So a text's ids are its words' ids in a row, where words are cut at these
spaces: the library sees every distinct word once, NumPy puts the ids in place.
"""

from __future__ import annotations

import os
from functools import cache
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

#: Words that a process keeps with their ids, and words that the library sees in one text.
KNOWN_WORDS = 250_000
JOINED = 500
#: White space that has to be seen with its neighbours, and the mark that cuts words.
TOGETHER = "[ \t\n\v\f\r][ \t\n\v\f\r]|^[ \t\n\v\f\r]|[ \t\n\v\f\r]$|\x00"
#: Points and commas that may belong to what is before them, and marks that case may compose with.
BOUND = r"[^\p{L}\p{N}][.,]"
MARKS = r"\p{M}|[^ \t\n\v\f\r\p{L}\p{N}][.,]"


class WordEncoder:
    """``spaced``: a space belongs to the word after it; otherwise white space has no ids."""

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaced = spaced
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.sizes = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64))

    def _texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(texts), 10_000):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False)]
            lists = pa.array(ids, pa.list_(pa.uint32()))
            flat.append(lists.flatten().to_numpy())
            sizes.append(np.diff(lists.offsets.to_numpy()))
        return np.concatenate(flat), np.concatenate(sizes)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that may stand in one text; offsets tell whose an id is."""
        gap = 0 if self.spaced else 1
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        groups = [words[at : at + JOINED] for at in range(0, len(words), JOINED)]
        for at in range(0, len(groups), 20):
            some = groups[at : at + 20]
            for group, e in zip(some, self.tokenizer.encode_batch([(" " * gap).join(g) for g in some], add_special_tokens=False), strict=True):
                lengths = np.fromiter(map(len, group), np.int64, len(group)) + gap
                begin = np.fromiter(map(itemgetter(0), e.offsets), np.int64, len(e))
                whose = np.searchsorted(np.cumsum(lengths) - lengths, begin, side="right") - 1
                flat.append(np.array(e.ids, np.uint32))
                sizes.append(np.bincount(whose, minlength=len(group)))
        return np.concatenate(flat), np.concatenate(sizes)

    def _library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        if not self.spaced:
            return self._joined(words)
        # What begins with a space or line break follows any word; other words stand alone.
        first = np.fromiter((w[:1] in " \n" for w in words), bool, len(words)) if words else np.zeros(0, bool)
        parts = []
        for chosen, encode in ((first, self._joined), (~first, self._texts)):
            at = np.flatnonzero(chosen)
            flat, sizes = encode([words[k] for k in at.tolist()])
            parts.append((at, flat, sizes))
        counts = np.zeros(len(words), np.int64)
        for at, _, sizes in parts:
            counts[at] = sizes
        starts = np.cumsum(counts) - counts
        whole = np.zeros(int(counts.sum()), np.uint32)
        for at, flat, sizes in parts:
            whole[np.repeat(starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(flat))] = flat
        return whole, counts

    def _words(self, texts: pa.Array, cut: bool) -> pa.Array:
        """Texts as lists of words; ``cut``: points and commas begin a word too."""
        if not self.spaced:
            texts = pc.ascii_lower(texts) if cut else texts
        mark = "\x00" if self.spaced else " "
        for first in ".," if cut else "":
            texts = pc.replace_substring(texts, first, mark + first)
        if not self.spaced:
            return pc.ascii_split_whitespace(texts)
        for first in " \n":
            texts = pc.replace_substring(texts, first, mark + first)
        return pc.split_pattern(texts, mark)

    def _by_words(self, texts: pa.Array, cut: bool) -> list[np.ndarray]:
        lists = self._words(texts, cut)
        bounds = lists.offsets.to_numpy()
        words = lists.flatten().dictionary_encode()
        codes = words.indices.to_numpy()
        distinct = words.dictionary.to_pylist()
        get = self.known.get
        place = np.fromiter(map(get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(place < 0)
        new = [distinct[i] for i in missing.tolist()]
        flat, sizes = self._library(new)
        place[missing] = len(self.starts) + np.arange(len(new))
        starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        flat, sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
        if len(starts) <= KNOWN_WORDS:
            self.known.update(zip(new, range(len(self.starts), len(starts)), strict=True))
            self.flat, self.starts, self.sizes = flat, starts, sizes
        place = place[codes]
        counts = sizes[place]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat(starts[place] - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = ends[bounds - bounds[0]].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        kinds = pc.if_else(pc.match_substring_regex(texts, BOUND if self.spaced else MARKS), 1, 0)
        if self.spaced:
            kinds = pc.if_else(pc.match_substring_regex(texts, TOGETHER), 2, kinds)
        kinds, found = kinds.to_numpy(zero_copy_only=False), [None] * len(texts)
        for kind in np.unique(kinds).tolist():
            rows = np.flatnonzero(kinds == kind)
            some = texts.take(pa.array(rows))
            if kind == 2:
                flat, sizes = self._texts(some.to_pylist())
                each = np.split(flat, np.cumsum(sizes)[:-1])
            else:
                each = self._by_words(some, kind == 0)
            for row, ids in zip(rows.tolist(), each, strict=True):
                found[row] = ids
        return found


@cache
def word_encoder(path: str, spaced: bool) -> WordEncoder:
    """One per process and tokenizer file."""
    return WordEncoder(path, spaced)
