"""Words and windows of many texts as numpy arrays of 64-bit hashes, and their exchange between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two hash families
NO_ID = -(1 << 63)  # stands for a null id
KEY = ("d", "t", "u")  # the columns that name a document
Names = tuple[np.ndarray, ...]  # these columns, or others that name what entries belong to


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, family: int = 0) -> np.ndarray:
    out = np.full(max(1, n), _STEP[family], np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) and where each begins, one more at the end."""
    texts = pa.array(texts.fill_null(""), pa.string()) if texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text (one more at the end)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begin = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[begin] = word[begin]
    starts = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[np.append(begin[1:], len(data)) - 1] |= word[np.append(begin[1:], len(data)) - 1]
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    if not len(starts):
        return np.empty(0, np.uint64)
    data = _LOWER[data] if lower else data
    out = np.empty(len(starts), np.uint64)
    longest = powers(int((ends - starts).max()))
    step = 1 << 18  # words at a time, so that the arrays of single bytes stay small
    for a in range(0, len(starts), step):
        s, n = starts[a : a + step], (ends - starts)[a : a + step]
        cut = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(cut, n)
        values = BYTES[data[np.repeat(s, n) + place]] * longest[place]
        out[a : a + step] = mixed(np.add.reduceat(values, cut))
    return out


def window_hashes(words: np.ndarray, k: int, family: int = 0) -> np.ndarray:
    """A hash of the ``k`` words from each word on, over text ends; as many as ``words`` less ``k - 1``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, p in enumerate(powers(k, family)):
        total += words[i : i + n] * p
    return mixed(total)


def window_starts(first_word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows of ``k`` words that stay in one text, and that text."""
    counts = np.maximum(np.diff(first_word) - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.repeat(first_word[:-1] - (np.cumsum(counts) - counts), counts)
    return begin + np.arange(len(text)), text


# -- exchange -----------------------------------------------------------------------------


def keyed(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``d``, ``t``, ``u``, ``text`` and more. (d, t, u) names a document: its id (null as NO_ID) and 128 bits of
    hashes of its text, which tell rows of one id apart. Rows equal in all are one document, repeated."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    # The hash of the number is the seed of the second.
    return df.select(d.alias("d"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit(_STEP[1] >> 1), text).alias("u"), text.alias("text"), *more)


def real_id(d: Column) -> Column:
    return F.when(d != NO_ID, d)


def part_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt_schema(x: str = "int", names: str = "d array<bigint>, t array<bigint>, u array<bigint>", h: str = "bigint") -> str:
    """Entries of one part, document by document: ``n`` says how many each has; ``x`` is each entry's number."""
    return f"p int, known boolean, {names}, n array<int>, h array<{h}>, x array<{x}>"


def names_of(batch: pa.RecordBatch) -> Names:
    return tuple(batch.column(c).to_numpy() for c in KEY)


def pick(names: Names, at: np.ndarray) -> Names:
    return tuple(c[at] for c in names)


def distinct(names: Names) -> tuple[np.ndarray, np.ndarray]:
    """In order of the names, the first place of each, and for each place the number of its name in that order."""
    order = np.lexsort(names[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in names], axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def owner_part(names: Names, parts: int) -> np.ndarray:
    """The part that gathers what is found of a document."""
    h = names[0].view(np.uint64)
    for c, step in zip(names[1:], _STEP, strict=False):
        h = h ^ (c.astype(np.uint64) * np.uint64(step))
    return (mixed(h) % np.uint64(parts)).astype(np.int64)


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def deal(
    parts: int, part: np.ndarray, doc: np.ndarray, names: Names, h: np.ndarray | None, x: np.ndarray, kind: type = np.int64
) -> pa.RecordBatch:
    """Entries (part, document, hash, number) as one row per part; without hashes they are ``known`` ones.
    ``kind`` is the signed integer that hashes travel as."""
    order = np.lexsort((doc, part.astype(np.uint32)))
    part, doc = part[order].astype(np.int64), doc[order]
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
    runs = np.flatnonzero(new)
    counts = np.diff(np.append(runs, len(part)))
    ids = np.unique(part)
    entries = np.append(np.searchsorted(part, ids), len(part))
    docs = np.append(np.searchsorted(part[runs], ids), len(runs))
    hashes = (
        _lists(np.empty(0, kind), np.zeros(len(ids) + 1, np.int64), pa.from_numpy_dtype(kind))
        if h is None
        else _lists(h[order].view(kind), entries, pa.from_numpy_dtype(kind))
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int32()),
            pa.array([h is None] * len(ids), pa.bool_()),
            *(_lists(c[doc[runs]], docs, pa.from_numpy_dtype(c.dtype)) for c in names),
            _lists(counts, docs, pa.int32()),
            hashes,
            _lists(x[order], entries, pa.from_numpy_dtype(x.dtype)),
        ],
        names=["p", "known", *KEY[: len(names)], "n", "h", "x"],
    )


def _flat(table: pa.Table, name: str) -> np.ndarray:
    column = table[name].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False)


class Entries:
    """What ``deal`` made of one part, gathered from all tasks."""

    def __init__(self, table: pa.Table):
        self.names = tuple(_flat(table, c) for c in KEY if c in table.column_names)
        self.doc = np.repeat(np.arange(len(self.names[0])), _flat(table, "n"))
        h = _flat(table, "h")
        self.h = h.view(f"u{h.itemsize}")
        self.x = _flat(table, "x")

    def found(self, parts: int, chosen: np.ndarray, kind: type = np.int64) -> pa.RecordBatch:
        """The numbers of the chosen entries, dealt to the parts that gather their documents."""
        doc = self.doc[chosen]
        return deal(parts, owner_part(pick(self.names, doc), parts), doc, self.names, None, self.x[chosen], kind)


def runs_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts ``h``, stably, and where runs of equal values begin in it (one more at the end)."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    return order, np.append(np.flatnonzero(np.append(True, s[1:] != s[:-1])), len(s)) if len(s) else np.zeros(1, np.int64)


def first_documents(names: Names) -> np.ndarray:
    """Places of the documents of a batch, each once."""
    return np.sort(distinct(names)[0])


def gathered(found: DataFrame, x: str = "int") -> DataFrame:
    """One row per document with all its numbers, each once, in order. ``found`` holds rows of ``deal``, so
    what travels are a few arrays between parts, not a row for each document and part."""

    def gather(table: pa.Table) -> pa.Table:
        own = Entries(table)
        docs, number = distinct(own.names)
        doc = number[own.doc]
        order = np.lexsort((own.x, doc))
        doc, values = doc[order], own.x[order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])) if len(doc) else np.empty(0, bool)
        doc, values = doc[new], values[new]
        cuts = np.searchsorted(doc, np.arange(len(docs) + 1))
        names = dict(zip(KEY, map(pa.array, pick(own.names, docs)), strict=True))
        return pa.table({**names, "x": _lists(values, cuts, pa.from_numpy_dtype(values.dtype))})

    return found.groupBy("p").applyInArrow(gather, f"d bigint, t bigint, u bigint, x array<{x}>")


def shared_entries(parts: int):
    """Of one part, the entries known to repeat and those whose hash another batch has as well."""

    def shared(table: pa.Table) -> pa.Table:
        known = Entries(table.filter(table["known"]))
        rest = Entries(table.filter(pa.compute.invert(table["known"])))
        order, runs = runs_of(rest.h)
        size = np.diff(runs)
        chosen = order[np.repeat(size > 1, size)]
        return pa.Table.from_batches([known.found(parts, np.arange(len(known.x))), rest.found(parts, chosen)])

    return shared
