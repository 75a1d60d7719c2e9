"""Token ids of whole texts from the ids of their distinct words.

White space separates what a word-level BPE may merge, so a text's ids are those
of its white-space-separated words in order. Each worker keeps the words it has met and
their ids in flat arrays, and a batch of texts becomes one gather from them; only
words not met before are encoded. The store is emptied when it grows past a bound,
so its memory is fixed.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress
from functools import wraps
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_WORDS = 300_000  # of each generation
MAX_IDS = 2_500_000
BATCH_BYTES = 8 << 20
PUNCTUATION = ".,;:!?"
PLAIN = rf"^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<end>[{PUNCTUATION}]*)$"


def plain_pieces(word: str) -> tuple[str, str] | None:
    """A word of Latin letters, in lower case, and the punctuation after it; None for any other word.

    Such letters are in NFC already, and the two are the pieces that the vocabulary's own text rules find.
    """
    stem = word.rstrip(PUNCTUATION)
    if not stem.isalpha():
        return None
    low = stem.lower()
    if not low.isascii() and (max(stem) >= "\u0250" or not low.isalpha()):
        return None
    return low, word[len(stem) :]


class _Store:
    """Words and their ids, one after the other. Both are flat arrays, which take far less memory than objects."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.string())
        self._ids = np.empty(1 << 16, np.int32)
        self._starts = np.zeros(1 << 14, np.int64)

    @property
    def n_ids(self) -> int:
        return int(self._starts[len(self.words)])

    def find(self, words: pa.Array) -> np.ndarray:
        """The number of each word, -1 for one that isn't here."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)

    def add(self, words: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The numbers of these new words."""
        have, n = len(self.words), self.n_ids
        while len(self._starts) < have + len(words) + 1:
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
        while len(self._ids) < n + len(ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        self._starts[have + 1 : have + 1 + len(words)] = n + np.cumsum(lengths)
        self._ids[n : n + len(ids)] = ids
        self.words = pa.concat_arrays([self.words, words])
        return np.arange(have, have + len(words))

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of these words has, and all of them."""
        return gathered(self._starts[codes], self._starts[codes + 1] - self._starts[codes], self._ids)


def gathered(starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``lengths``, and the stretches of ``ids`` of these starts and lengths."""
    ends = np.cumsum(lengths)
    return lengths, ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


class WordIds:
    """``encode_new`` gives the id lists of words; this keeps them, up to ``max_words`` and ``max_ids`` in each generation."""

    def __init__(self, encode_new: Callable[[list[str]], Sequence[Sequence[int]]], max_words: int = MAX_WORDS, max_ids: int = MAX_IDS):
        self._encode_new, self._max_words, self._max_ids = encode_new, max_words, max_ids
        self._young, self._old = _Store(), _Store()

    def codes(self, distinct: pa.Array) -> np.ndarray:
        """The numbers of ``distinct`` words in the young generation, where all of them are after this."""
        codes = self._young.find(distinct)
        new = np.flatnonzero(codes < 0)
        if len(new):
            words = distinct.take(pa.array(new))
            at = self._old.find(words)
            met = at >= 0
            codes[new[met]] = self._young.add(words.filter(pa.array(met)), *self._old.gather(at[met]))
            words, new = words.filter(pa.array(~met)), new[~met]
        if len(new):  # only these become Python strings
            found = self._encode_new(words.to_pylist())
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            codes[new] = self._young.add(words, lengths, np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())))
        return codes

    def of_words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of the ``distinct`` words has, and all of them."""
        return self._young.gather(self.codes(distinct))

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts``, one after the other, and where each begins (one more at the end)."""
        if len(self._young.words) > self._max_words or self._young.n_ids > self._max_ids:
            self._young, self._old = _Store(), self._young
        # Cut at ASCII blanks and numbered in Arrow.
        parts = pc.ascii_split_whitespace(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        numbered = parts.flatten().dictionary_encode()
        n, own = self.of_words(numbered.dictionary.cast(pa.string()))
        at = numbered.indices.to_numpy()
        lengths, ids = gathered((np.cumsum(n) - n)[at], n[at], own)
        first = np.asarray(parts.offsets).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[first - first[0]]


class PieceIds(WordIds):
    """Keeps a plain word as its stem in lower case and, after a blank, the punctuation after it: the two pieces that the
    vocabulary's own text rules find (see :func:`plain_pieces`). Words that differ in case or punctuation are one then.

    Stems of the letters in ``PLAIN`` alone are cut in Arrow. All other words are kept, and asked for, as they are."""

    def of_words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.extract_regex(distinct, PLAIN)
        stems = pc.coalesce(pc.utf8_lower(pc.struct_field(cut, "stem")), distinct).dictionary_encode()
        ends = pc.binary_join_element_wise(" ", pc.coalesce(pc.struct_field(cut, "end"), ""), "").dictionary_encode()
        codes = self.codes(pa.concat_arrays([stems.dictionary, ends.dictionary]))  # no word has a blank
        both = np.stack([stems.indices.to_numpy(), len(stems.dictionary) + ends.indices.to_numpy()], axis=1)
        lengths, ids = self._young.gather(codes[both.ravel()])
        return lengths.reshape(-1, 2).sum(axis=1), ids


#: How to drop what a worker holds of each operator's model and store.
MODELS: dict[str, Callable[[], None]] = {}


def give_back(model: str | None = None) -> None:
    """Memory that nothing holds goes back to the system, since Spark keeps idle workers; with ``model``, all other models go."""
    for name, drop in MODELS.items() if model is not None else ():
        if name != model:
            drop()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], model: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for one partition. Before it, the models of other operators go that the worker has from an earlier job."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(model)
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batches`` of at most about ``limit`` bytes of ``column``; a longer row is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        sizes = np.array([0 if v is None else v for v in pc.binary_length(values).to_pylist()], np.int64)
        groups = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The column with null as the empty string."""
    return batch.column(column).fill_null("")
