"""Stretches of words that repeat with a period: ``a b c a b c a b c a b c``.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical) of at least ``min_words`` words and ``min_exponent`` periods, which no
neighbouring word extends. Runs are found by multi-scale minimizers:

- Scale ``K`` (8, 16, 32, ...) serves the periods above ``K / 2`` up to ``K``. Each window
  of ``K / 2`` consecutive ``K``-word hashes marks the place of its smallest hash. Inside a
  run the hashes repeat after ``q`` words, so the marks do, and since ``K >= q`` two equal
  hashes in it lie a multiple of ``q`` apart. So some two marks of equal hash, next to each
  other among the marks of that hash, lie exactly ``q`` apart. With four periods or more a
  run always holds a window and the same window ``q`` words on.
- Each such pair of marks is a seed: its distance is a candidate period, and the stretch
  around it is extended by comparing words, not hashes. A stretch that a smaller period
  explains is left to the scale of that one.
- Periods up to ``DIRECT`` are too short for a scale; they are found by comparing all words
  with those one, two, ... words on.

Hashes only propose seeds, so no wrong run can come out; a run could only be missed if
64-bit hashes collided at each of its marks. Work per word is a few array passes per
scale, and the number of scales grows with the logarithm of the longest text.

Documents are independent: nothing is shuffled, and a task holds a few megabytes of text
at a time (or one text, if it is longer). Longer texts come first in a batch, so that a
large scale looks only at those that can hold its periods.

Defined cases: a null or empty text, or one of white space, has no words, no runs and an
empty ``collapsed``; repeated rows are treated one by one; an empty table gives an empty
one; other columns, of whatever name, are kept, but for ``runs`` and ``collapsed``, which
the results replace.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table, words
from tierline.llm.hashing import mixed
from tierline.llm.word_ids import text_batches, texts_of

MIN_WORDS = 6
MIN_EXPONENT = 4
DIRECT = 4  # periods found by direct comparison; scales begin at twice as much
_STEP = np.uint64(0x9E3779B97F4A7C15)
_RESULTS = ("runs", "collapsed")


def sliding_minimum(values: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each ``w`` consecutive values, by prefix and suffix minima of blocks of ``w``."""
    n = len(values) - w + 1
    padded = np.full(-(-len(values) // w) * w, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, w)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[w - 1 : w - 1 + n])


def seeds(grams: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of marks of equal hash that suggest a period above ``k / 2`` up to ``k``."""
    w = k // 2
    if len(grams) < w + 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = np.uint64((1 << len(grams).bit_length()) - 1)
    # The place in the low bits: of equal hashes the leftmost is the smallest.
    smallest = sliding_minimum((grams & ~low) | np.arange(len(grams), dtype=np.uint64), w)
    place = (smallest & low).astype(np.int64)
    place = place[np.append(True, place[1:] != place[:-1])]
    order = np.argsort(grams[place], kind="stable")
    value, place = grams[place][order], place[order]
    lag = place[1:] - place[:-1]
    chosen = (value[1:] == value[:-1]) & (lag > w) & (lag <= k)
    return place[:-1][chosen], lag[chosen]


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of ``a`` and ``b`` agree."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : min(n, at + step)] != b[at : min(n, at + step)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return n


def stretch(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """Begin and end of the longest stretch around ``at`` in which words ``lag`` apart are equal."""
    right = _reach(codes[at:], codes[at + lag :])
    left = _reach(codes[at - 1 :: -1] if at else codes[:0], codes[at + lag - 1 :: -1])
    return at - left, at + right + lag


def _prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def has_smaller_period(codes: np.ndarray, begin: int, period: int) -> bool:
    """Whether a stretch of at least two of these periods has a smaller one; that then divides it."""
    head = codes[begin : begin + period]
    return any(np.array_equal(head, codes[begin + d : begin + d + period]) for d in (period // r for r in _prime_factors(period)))


def _short_periods(codes: np.ndarray, min_words: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    for q in range(1, DIRECT + 1):
        if len(codes) <= q:
            return
        edge = np.flatnonzero(np.diff(np.concatenate([[False], codes[:-q] == codes[q:], [False]])))
        begin, end = edge[::2], edge[1::2] + q
        enough = end - begin >= max(min_words, min_exponent * q)
        for b, e in zip(begin[enough].tolist(), end[enough].tolist(), strict=True):
            if not has_smaller_period(codes, b, q):
                yield b, e, q


def _scaled_periods(codes: np.ndarray, sizes: np.ndarray, min_words: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """``sizes``: words of each text, separator included, longest text first."""
    ends = np.cumsum(sizes)
    k, grams = 1, mixed(codes.view(np.uint64) * _STEP + _STEP)
    while True:
        # Only the texts that can hold a period of this scale; they lead.
        n = int(np.searchsorted(-sizes, -(min_exponent * (k // 2 + 1) + 1), "right")) if k > DIRECT else len(sizes)
        if not n:
            return
        codes = codes[: ends[n - 1]]
        grams = grams[: max(0, len(codes) - k + 1)]
        if k > DIRECT:
            place, lag = seeds(grams, k)
            order = np.lexsort((place, lag))
            place, lag = place[order], lag[order]
            key = lag * (len(codes) + 1) + place  # seeds in order of period, then place
            i = 0
            while i < len(key):
                at, q = int(place[i]), int(lag[i])
                b, e = stretch(codes, at, q)
                # Whatever lies in this stretch with this period is the same stretch.
                i = max(i + 1, int(np.searchsorted(key, q * (len(codes) + 1) + e - q)))
                if e - b >= max(min_words, min_exponent * q) and not has_smaller_period(codes, b, q):
                    yield b, e, q
        if len(grams) <= k:
            return
        grams = mixed(grams[:-k] * _STEP + grams[k:])
        k *= 2


def batch_runs(codes: np.ndarray, starts: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Runs of many texts as rows (text, start, length, period), ordered.

    ``codes`` numbers the words of all texts, equal numbers for equal words (0 or more);
    ``starts`` says where each text begins, one more at the end.
    """
    counts = np.diff(starts)
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order] + 1  # a number of its own after each text: nothing matches across it
    begin = np.cumsum(sizes) - sizes
    line = np.empty(int(sizes.sum()), np.int64)
    at = np.repeat(starts[:-1][order] - begin, sizes) + np.arange(len(line))
    last = begin + sizes - 1
    at[last] = 0
    line[:] = codes[at] if len(codes) else -1
    line[last] = -1 - np.arange(len(order))
    found = [*_short_periods(line, min_words, min_exponent), *_scaled_periods(line, sizes, min_words, min_exponent)]
    if not found:
        return np.empty((0, 4), np.int64)
    b, e, q = np.array(found, np.int64).T
    text = np.searchsorted(begin, b, "right") - 1
    rows = np.stack([order[text], b - begin[text], e - b, q], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and where each text begins in them (one more at the end)."""
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat = parts.flatten()
    real = np.asarray(pc.binary_length(flat)) > 0  # a text without words is cut into one empty part
    offsets = np.asarray(parts.offsets).astype(np.int64)
    return flat.filter(pa.array(real)), np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]


def _found_in(batch: pa.RecordBatch, text_col: str, min_words: int, min_exponent: int) -> tuple[pa.Array, pa.Array]:
    flat, starts = split_words(texts_of(batch, text_col))
    numbered = flat.dictionary_encode()
    runs = batch_runs(np.asarray(numbered.indices).astype(np.int64), starts, min_words, min_exponent)
    text, start, length, period = runs.T
    cuts = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)), pa.int32())
    columns = [pa.array(np.ascontiguousarray(c), pa.int64()) for c in (start, length, period)]
    found = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    depth = np.zeros(len(flat) + 1, np.int64)  # runs that cover a word after their first period
    np.add.at(depth, starts[text] + start + period, 1)
    np.add.at(depth, starts[text] + start + length, -1)
    kept = np.cumsum(depth)[:-1] == 0
    offsets = np.concatenate([[0], np.cumsum(kept)])[starts]
    left = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.filter(pa.array(kept)))
    return found, pc.binary_join(left, " ")


def find_runs(df: DataFrame, *, text_col: str = "text", min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``df`` with ``runs`` (array of start, length, period, by start and then period; words counted from 0) and
    ``collapsed`` (the words joined by one blank, without those in any run after that run's first period)."""
    if min_exponent < MIN_EXPONENT:
        raise ValueError(f"runs of fewer than {MIN_EXPONENT} periods could be missed")
    others = [c for c in df.columns if c.lower() not in _RESULTS]
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "_text"):
            found, collapsed = _found_in(batch, "_text", min_words, min_exponent)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), found, collapsed], names=["_row", *_RESULTS])

    kinds = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = packed.select("_row", F.lit(None).cast(kinds).alias("runs"), F.lit(None).cast("string").alias("collapsed")).schema
    return packed.mapInArrow(run, schema).select("_row.*", *_RESULTS)


def looped(id_col: Column, text: Column) -> Column:
    """The text whose tail repeats a piece of itself in one of ten documents, as the id's CRC-32 says.

    With ``h`` the CRC of the decimal id and ``g = h div 10``, a text of ``n`` words of which ``h`` is a multiple of
    10 goes on from word ``a = g % n`` with the ``1 + (n - a) div (3 + g % 8)`` words found there, over and over.
    A null id leaves its text as it is.
    """
    h = F.crc32(id_col.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def turned(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + (i - a) % p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")

    found = words(text)
    again = F.transform(F.array(found), lambda w: F.when(F.size(w) > 0, turned(w)).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, again).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    found = find_runs(docs)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest.alias("_top"),
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("_top.start").alias("start"),
        (-F.col("_top.less")).alias("length"),
        F.col("_top.period").alias("period"),
        F.expr("(-1000 * _top.less) div _top.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
