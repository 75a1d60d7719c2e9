"""Substring de-duplication by difference-cover anchors.

A window is ``window`` consecutive words of one text; a word goes when a window that
covers it has the same words as an earlier window (smaller id, or the same document
and an earlier start). Hashing all windows would move every word of the corpus. Instead
short anchor windows are hashed, and only at places whose number modulo a period lies in
a difference cover: of any two places there is a shift below the period that takes both
into the cover, so two equal windows share an anchor at one such shift. Anchors that
occur twice are found by exchanging hashes; only windows around these are then hashed
in full (128 bits) and exchanged, which extends each anchor to whole windows and finds
the earliest. Repeats within one batch are settled there, so a passage that most
documents share sends one entry per batch.

Defined cases: null and empty texts have no words; a text of fewer words than a window
loses none; rows equal in id and text are one document, and each row gets its result; of
rows with one id but other texts one (by a hash of the text) counts as earlier; a null id
counts as smaller than any other; other columns are ignored by the marks and kept by
``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table, stored
from tierline.llm.hashing import (
    KEY, Entries, Names, deal, dealt_schema, first_documents, gathered, keyed, names_of, owner_part, part_count, pick,
    runs_of, shared_entries, text_bytes, window_hashes, window_starts, word_hashes, word_spans,
)
from tierline.llm.word_ids import text_batches

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13 is one of two of these
ANCHOR = WINDOW - PERIOD + 1
BATCH_BYTES = 8 << 20


def _batch_words(batch: pa.RecordBatch) -> tuple[Names, np.ndarray, np.ndarray]:
    """Names, word hashes and first words of the batch's documents, each once."""
    names = names_of(batch)
    once = first_documents(names)
    data, bounds = text_bytes(batch.column("text").take(pa.array(once)))
    starts, ends, first = word_spans(data, bounds)
    return pick(names, once), word_hashes(data, starts, ends), first


def _anchors(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            names, words, first = _batch_words(batch)
            place, doc = window_starts(first, ANCHOR)
            within = place - first[doc]
            chosen = np.isin(within % PERIOD, COVER)
            place, doc, within = place[chosen], doc[chosen], within[chosen].astype(np.int32)
            if not len(place):
                continue
            h = window_hashes(words, ANCHOR)[place]
            order, runs = runs_of(h)
            sent = order[runs[:-1]]
            yield deal(parts, h[sent] % np.uint64(parts), doc[sent], names, h[sent], within[sent])
            known = order[np.repeat(np.diff(runs) > 1, np.diff(runs))]
            if len(known):
                yield deal(parts, owner_part(pick(names, doc[known]), parts), doc[known], names, None, within[known])

    return run


def _candidate_windows(parts: int):
    """Full windows that hold a shared anchor; ``g`` is the second half of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            names = names_of(batch)
            once = first_documents(names)
            batch = batch.take(pa.array(once))
            data, bounds = text_bytes(batch.column("text"))
            starts, ends, first = word_spans(data, bounds)
            names, words = pick(names, once), word_hashes(data, starts, ends)
            anchors = batch.column("x")
            owner = np.repeat(np.arange(len(anchors)), np.diff(np.asarray(anchors.offsets)))
            at = anchors.flatten().to_numpy() + first[owner]
            # Windows from 12 words before an anchor up to the anchor itself.
            near = np.zeros(len(words) + 1, np.int32)
            np.add.at(near, np.maximum(at - (PERIOD - 1), first[owner]), 1)
            np.add.at(near, at + 1, -1)
            near = np.cumsum(near) > 0
            place, doc = window_starts(first, WINDOW)
            chosen = near[place]
            place, doc = place[chosen], doc[chosen]
            if not len(place):
                continue
            h, g = window_hashes(words, WINDOW)[place], window_hashes(words, WINDOW, 1)[place]
            within = (place - first[doc]).astype(np.int32)
            # Earliest of each window in the batch: by id, then hashes of the text, then start.
            order = np.lexsort((within, *pick(names, doc)[::-1], g, h))
            new = np.append(True, (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1]))
            sent, known = order[new], order[~new]
            out = deal(parts, h[sent] % np.uint64(parts), doc[sent], names, h[sent], within[sent])
            second = deal(parts, h[sent] % np.uint64(parts), doc[sent], names, g[sent], within[sent])
            yield out.append_column("g", second.column("h"))
            if len(known):
                out = deal(parts, owner_part(pick(names, doc[known]), parts), doc[known], names, None, within[known])
                yield out.append_column("g", out.column("h"))

    return run


def _later(parts: int):
    """Windows that aren't the earliest with their words."""

    def later(table: pa.Table) -> pa.Table:
        known = Entries(table.filter(table["known"]))
        table = table.filter(pc.invert(table["known"]))
        rest, g = Entries(table), Entries(table.set_column(table.column_names.index("h"), "h", table["g"])).h
        full = (*pick(rest.names, rest.doc), rest.x)
        order = np.lexsort((*full[::-1], g, rest.h))
        h, g = rest.h[order], g[order]
        new = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])) if len(order) else np.empty(0, bool)
        # The same document may have been sent by two batches, if its row is repeated.
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
        later = np.any([c[order] != c[head] for c in full], axis=0)
        return pa.Table.from_batches([known.found(parts, np.arange(len(known.x))), rest.found(parts, order[later])])

    return later


def later_windows(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """d, t, u, x: of each document the starts (in words) of the windows that repeat an earlier one."""
    docs, parts = keyed(df, id_col, text_col), part_count(df)
    shared = docs.mapInArrow(_anchors(parts), dealt_schema()).groupBy("p").applyInArrow(shared_entries(parts), dealt_schema())
    shared = stored(gathered(shared), "shared-anchors")
    windows = docs.join(shared, list(KEY)).select(*KEY, "text", "x")
    windows = windows.mapInArrow(_candidate_windows(parts), dealt_schema() + ", g array<bigint>")
    return stored(gathered(windows.groupBy("p").applyInArrow(_later(parts), dealt_schema())), "later-windows")


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one blank)."""
    results = ("n_words", "n_removed", "kept_text")
    kept = [c for c in df.columns if c.lower() not in results]
    row = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")
    marks = later_windows(df, id_col=id_col, text_col=text_col)
    given = keyed(df, id_col, text_col, row).join(marks, list(KEY), "left")
    given = given.select("row", "text", F.coalesce("x", F.array().cast("array<int>")).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            data, bounds = text_bytes(batch.column("text"))
            starts, ends, first = word_spans(data, bounds)
            marks = batch.column("x")
            owner = np.repeat(np.arange(len(marks)), np.diff(np.asarray(marks.offsets)))
            at = marks.flatten().to_numpy() + first[owner]
            cover = np.zeros(len(starts) + WINDOW + 1, np.int32)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + WINDOW, -1)
            gone = (np.cumsum(cover) > 0)[: len(starts)]
            raw, texts, removed = data.tobytes(), [], []
            for a, b in zip(first, first[1:], strict=False):
                stay = np.flatnonzero(~gone[a:b]) + a
                texts.append(b" ".join([raw[i:j] for i, j in zip(starts[stay], ends[stay], strict=True)]).decode())
                removed.append(int(b - a) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["row", *results],
            )

    row_type = given.schema["row"].dataType.simpleString()
    return given.mapInArrow(run, f"row {row_type}, n_words bigint, n_removed bigint, kept_text string").select("row.*", *results)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB SQL of the same rows, for tables of unique ids and of a size that it can hold.
ORACLE = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})),
later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS k FROM later) GROUP BY doc_id),
words AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, w.w, coalesce(ks, []) AS ks FROM w LEFT JOIN gone USING (doc_id)),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words) u
  WHERE NOT EXISTS (FROM (SELECT doc_id, unnest(ks) AS k FROM words) g WHERE g.doc_id = u.doc_id AND g.k = u.i)
  GROUP BY doc_id)
SELECT doc_id, n_words, (n_words - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""
