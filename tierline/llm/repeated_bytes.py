"""Suffix-array de-duplication of repeated byte strings.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere else
in the corpus. Sorting a suffix for each byte of the corpus would move it hundreds of
times over, so suffixes are sorted only where a repeat is possible:

1. In each text the places that hold the smallest hash of 32 bytes within any string of
   ``LENGTH`` bytes are its anchors, about one byte in 85. Equal strings have their anchor
   at the same offset. An anchor stands for strings that reach at most 84 bytes to its
   left, and for those that reach further; either kind has 116 bytes in common, whose
   hash is exchanged. Only anchors whose hash occurs twice go on, so a common short line
   with different neighbours ends here.
2. The bytes around these anchors are exchanged by that hash. In each part the suffixes
   that begin at the anchors, and the reversed prefixes that end there, are put in order
   by deep-shallow sorting; neighbours' common prefixes tell for each offset which
   strings of ``LENGTH`` bytes are equal.

Equal surroundings within one batch are settled there and sent once, so large groups of
copies don't meet in one task. Common bytes that ``HOT`` or more places have (a passage of
very many documents, whose text around it differs) are counted in step 1. Their
surroundings aren't put in order in one task: each string of ``LENGTH`` bytes is dealt by a
128-bit digest of its own, so that only equal strings meet, those of a batch as one entry.

Defined cases: null and shorter texts lose nothing; rows equal in id and text are one
document, and each row gets its result; other columns are kept; what is left of a text
whose removed bytes cut a character is decoded with the broken bytes left out, while the
hash that ``query`` gives is that of the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table, stored
from tierline.llm.hashing import (
    BYTES, KEY, Entries, Names, deal, dealt_schema, distinct, first_documents, gathered, keyed, mixed, names_of, owner_part,
    part_count, pick, powers, runs_of, text_bytes,
)
from tierline.llm.suffix_sort import deep_shallow_order, neighbour_prefixes
from tierline.llm.word_ids import text_batches, tidy

LENGTH = 200
GRAM = 32  # bytes of an anchor
SPREAD = LENGTH - GRAM + 1  # an anchor among so many places
NEAR = 84  # strings reaching up to so far to the left of their anchor, and those reaching further
COMMON = LENGTH - NEAR
REACHES = (range(NEAR + 1), range(NEAR + 1, SPREAD))  # by kind
HOT = 10_000  # places of the same common bytes from which on their strings are dealt one by one
HOT_AT_ONCE = 1 << 17  # strings
BATCH_BYTES = 4 << 20
_KIND = np.uint64(0x5851F42D4C957F2D)


def _sliding(values: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``w`` consecutive values, by running values within blocks of ``w``."""
    n = len(values)
    pad = -n % w
    full = np.concatenate([values, np.repeat(values[-1:], pad)]).reshape(-1, w)
    ahead = op.accumulate(full, axis=1).ravel()
    back = op.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places of all anchors in ``data``, the texts one after the other."""
    lengths = np.diff(bounds)
    if not (lengths >= LENGTH).any():
        return np.empty(0, np.int64)
    h, step = BYTES[data], 1
    power = powers(GRAM)
    while step < GRAM:  # the hash of twice as many bytes from two of the last
        h = h[:-step] + h[step:] * power[step]
        step *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
    least = _sliding(h, SPREAD, np.minimum)
    # Strings that leave their text have no anchor: 0 is below every hash.
    last = np.maximum(bounds[1:] - LENGTH + 1, bounds[:-1])
    for a, b in zip(last, np.minimum(bounds[1:], len(least)), strict=True):
        least[a:b] = 0
    highest = _sliding(np.concatenate([np.zeros(SPREAD - 1, np.uint64), least, np.zeros(SPREAD - 1, np.uint64)]), SPREAD, np.maximum)
    return np.flatnonzero(highest == h)


def _spans(data: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of anchors at ``at``: place, text, kind (0: near, 1: far) and key, for each kind whose common bytes lie in the text."""
    doc = np.searchsorted(bounds, at, "right") - 1
    near, far = at + COMMON <= bounds[doc + 1], (at - NEAR >= bounds[doc]) & (at + GRAM <= bounds[doc + 1])
    place, text = np.concatenate([at[near], at[far]]), np.concatenate([doc[near], doc[far]])
    kind = np.repeat([0, 1], [int(near.sum()), int(far.sum())])
    return place, text, kind, _keys(data, place, kind)


def _keys(data: np.ndarray, place: np.ndarray, kind: np.ndarray) -> np.ndarray:
    power, out = powers(COMMON), np.empty(len(place), np.uint64)
    step = 1 << 14
    for a in range(0, len(place), step):
        begin = (place - NEAR * kind)[a : a + step]
        out[a : a + step] = (BYTES[data[begin[:, None] + np.arange(COMMON)]] * power).sum(axis=1, dtype=np.uint64)
    return mixed(out ^ (kind.astype(np.uint64) * _KIND))


def _exchange_anchors(parts: int):
    """``x`` is an anchor's place and kind; above 32 bits, how many of the batch have its hash."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            names = names_of(batch)
            once = first_documents(names)
            names = pick(names, once)
            data, bounds = text_bytes(batch.column("text").take(pa.array(once)))
            place, doc, kind, h = _spans(data, bounds, anchors(data, bounds))
            if not len(place):
                continue
            x = (place - bounds[doc]) * 2 + kind
            order, runs = runs_of(h)
            sent = order[runs[:-1]]
            yield deal(parts, h[sent] % np.uint64(parts), doc[sent], names, h[sent], x[sent] + (np.diff(runs) << 32))
            known = order[np.repeat(np.diff(runs) > 1, np.diff(runs))]
            if len(known):
                yield deal(parts, owner_part(pick(names, doc[known]), parts), doc[known], names, None, x[known])

    return run


_HOT_MARK = -1  # the part, and the only number, of what stands for a hot hash among the documents


def _shared_anchors(parts: int, hot: int):
    """Anchors whose hash occurs twice, and each hash that ``hot`` or more places have as a document of its own."""

    def shared(table: pa.Table) -> pa.Table:
        known = Entries(table.filter(table["known"]))
        rest = Entries(table.filter(pc.invert(table["known"])))
        order, runs = runs_of(rest.h)
        size = np.diff(runs)
        often = np.add.reduceat(rest.x[order] >> 32, runs[:-1]) >= hot if len(order) else np.empty(0, bool)
        often = rest.h[order[runs[:-1]][often]].view(np.int64)
        for entries in (known, rest):
            entries.x = (entries.x & 0xFFFFFFFF).astype(np.int32)
        n = len(often)
        marks = deal(parts, np.full(n, _HOT_MARK), np.arange(n), (often, *np.zeros((2, n), np.int64)), None, np.full(n, _HOT_MARK, np.int32))
        return pa.Table.from_batches([known.found(parts, np.arange(len(known.x))), rest.found(parts, order[np.repeat(size > 1, size)]), marks])

    return shared


_AROUND = "p int, d array<bigint>, t array<bigint>, u array<bigint>, x array<bigint>, kind array<int>, o array<int>, c array<binary>"


def _rows_by_part(part: np.ndarray, columns: dict[str, tuple]) -> pa.RecordBatch:
    """One row per part; each column a list. ``columns``: name to (values in any order, Arrow type)."""
    order = np.argsort(part, kind="stable")
    ids = np.unique(part)
    cuts = pa.array(np.append(np.searchsorted(part[order], ids), len(part)), pa.int32())
    lists = [
        pa.ListArray.from_arrays(cuts, values.take(pa.array(order)) if kind == pa.binary() else pa.array(values[order], kind))
        for values, kind in columns.values()
    ]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), *lists], names=["p", *columns])


def _hot_strings(raw: bytes, place: np.ndarray, kind: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor and start of all strings around these anchors, and their digests (two numbers each)."""
    low, high = (np.array([f(r) for r in REACHES])[kind] for f in (min, max))
    first, last = np.maximum(place - high, begin), np.minimum(place - low, end - LENGTH)
    n = np.maximum(last - first + 1, 0)
    who = np.repeat(np.arange(len(place)), n)
    start = np.arange(len(who)) + np.repeat(first - (np.cumsum(n) - n), n)
    digests = b"".join(hashlib.blake2b(raw[a : a + LENGTH], digest_size=16).digest() for a in start.tolist())
    return who, start, np.frombuffer(digests, np.int64).reshape(-1, 2)


def _same_strings(digest: np.ndarray, *names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries named by document and start: one of each string, and all whose string another name has."""
    order = np.lexsort((*names[::-1], digest[:, 1], digest[:, 0]))
    if not len(order):
        return order, order
    s = digest[order]
    new = np.append(True, (s[1:] != s[:-1]).any(axis=1))
    other = np.append(True, np.any([c[order][1:] != c[order][:-1] for c in names], axis=0)) | new  # of two anchors, a string may come twice
    order, new = order[other], new[other]
    size = np.diff(np.append(np.flatnonzero(new), len(order)))
    return order[new], order[np.repeat(size > 1, size)]


def _exchange_surroundings(parts: int, hot: np.ndarray):
    """Surroundings of shared anchors; ``x`` is the anchor's place, or, where ``o`` is -1, a span to be removed.
    Where ``o`` is -2, ``c`` is the digest of a string whose anchor is ``hot``, and ``x`` its start."""

    def dealt_strings(names: Names, doc: np.ndarray, origin: np.ndarray, start: np.ndarray, digest: np.ndarray) -> pa.RecordBatch:
        sent, known = _same_strings(digest, doc, start)
        chosen = np.concatenate([sent, known])
        is_known = np.arange(len(chosen)) >= len(sent)
        own, x = pick(names, doc[chosen]), (start - origin)[chosen]
        part = (digest[chosen, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64)
        c = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(chosen), [None, pa.py_buffer(np.ascontiguousarray(digest[chosen]))])
        return _rows_by_part(
            np.where(is_known, owner_part(own, parts), part),
            {
                **{c: (v, pa.int64()) for c, v in zip(KEY, own, strict=True)},
                "x": (np.where(is_known, (x << 32) + x + LENGTH, x), pa.int64()),
                "kind": (np.zeros(len(chosen), np.int32), pa.int32()),
                "o": (np.where(is_known, -1, -2), pa.int32()),
                "c": (pc.if_else(pa.array(is_known), pa.scalar(b"", pa.binary()), c.cast(pa.binary())), pa.binary()),
            },
        )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            batch = batch.take(pa.array(first_documents(names_of(batch))))
            names = names_of(batch)
            data, bounds = text_bytes(batch.column("text"))
            found = batch.column("x")
            doc = np.repeat(np.arange(len(found)), np.diff(np.asarray(found.offsets)))
            x = found.flatten().to_numpy()
            kind, place = x % 2, x // 2 + bounds[doc]
            begin = np.maximum(place - np.where(kind == 0, NEAR, SPREAD - 1), bounds[doc])
            end = np.minimum(place + np.where(kind == 0, LENGTH, COMMON - 1), bounds[doc + 1])
            whole = end - begin >= LENGTH
            doc, kind, place, begin, end = doc[whole], kind[whole], place[whole], begin[whole], end[whole]
            if not len(doc):
                continue
            h, raw = _keys(data, place, kind), data.tobytes()
            around = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            first: dict[tuple, int] = {}
            repeated: set[int] = set()
            sent = []
            for i, key in enumerate(zip(kind.tolist(), (place - begin).tolist(), around, strict=True)):
                j = first.setdefault(key, i)
                if j == i:
                    sent.append(i)
                else:
                    repeated |= {i, j}
            sent, known = np.array(sent, np.int64), np.array(sorted(repeated), np.int64)
            if len(hot):
                is_hot = np.isin(h[sent], hot)
                often, sent = sent[is_hot], sent[~is_hot]
                step = max(1, HOT_AT_ONCE // (NEAR + 1))
                for a in range(0, len(often), step):
                    i = often[a : a + step]
                    who, start, digest = _hot_strings(raw, place[i], kind[i], begin[i], end[i])
                    yield dealt_strings(names, doc[i][who], bounds[doc[i][who]], start, digest)
            own = place - bounds[doc]
            part, offset, what = (h % np.uint64(parts)).astype(np.int64), place - begin, own.astype(np.int64)
            chosen = np.concatenate([sent, known])
            is_known = np.arange(len(chosen)) >= len(sent)
            span = ((begin - bounds[doc]) << 32) + (end - bounds[doc])
            yield _rows_by_part(
                np.where(is_known, owner_part(pick(names, doc[chosen]), parts), part[chosen]),
                {
                    **{c: (v, pa.int64()) for c, v in zip(KEY, pick(names, doc[chosen]), strict=True)},
                    "x": (np.where(is_known, span[chosen], what[chosen]), pa.int64()),
                    "kind": (kind[chosen], pa.int32()),
                    "o": (np.where(is_known, -1, offset[chosen]), pa.int32()),
                    "c": (pa.array([b"" if k else around[i] for i, k in zip(chosen.tolist(), is_known.tolist(), strict=True)], pa.binary()), pa.binary()),
                },
            )

    return run


def equal_offsets(around: list[bytes], offset: np.ndarray, kind: int) -> list[list[tuple[int, int]]]:
    """For each anchor (``offset`` bytes into its surroundings) the runs of string starts, relative to the
    anchor and both ends included, whose strings some other surroundings hold at the same offset."""
    n = len(around)
    right = [c[o:] for c, o in zip(around, offset.tolist(), strict=True)]
    left = [c[:o][::-1] for c, o in zip(around, offset.tolist(), strict=True)]
    order_r, order_l = deep_shallow_order(right), deep_shallow_order(left)
    prefix_r, prefix_l = neighbour_prefixes(right, order_r, LENGTH), neighbour_prefixes(left, order_l, SPREAD)
    size_r, size_l = np.fromiter(map(len, right), np.int64, n), np.fromiter(map(len, left), np.int64, n)
    reaches = REACHES[kind]
    equal = np.zeros((n, len(reaches)), bool)
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, reach in enumerate(reaches):
        class_r[order_r] = np.cumsum(prefix_r < LENGTH - reach)
        class_l[order_l] = np.cumsum(prefix_l < reach)
        holds = np.flatnonzero((size_l >= reach) & (size_r >= LENGTH - reach))
        if len(holds) < 2:
            continue
        both = class_r[holds] * (n + 1) + class_l[holds]
        order = np.argsort(both, kind="stable")
        s = both[order]
        same = s[1:] == s[:-1]
        equal[holds[order[np.append(same, False) | np.append(False, same)]], k] = True
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    edge = np.diff(np.pad(equal, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    for i, a, b in zip(*np.nonzero(edge == 1), np.nonzero(edge == -1)[1], strict=True):
        out[i].append((-reaches[b - 1], -reaches[a]))
    return out


def _mark(parts: int):
    def mark(table: pa.Table) -> pa.Table:
        columns = {c: pc.list_flatten(table[c]) for c in (*KEY, "x", "kind", "o", "c")}
        names = tuple(columns[c].to_numpy() for c in KEY)
        x, kind, o = (columns[c].to_numpy() for c in ("x", "kind", "o"))
        known, single = o == -1, np.flatnonzero(o == -2)
        out = [(*pick(names, known), x[known])]
        digest = columns["c"].take(pa.array(single)).to_pylist()
        digest = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        again = single[_same_strings(digest, *pick(names, single), x[single])[1]]
        out.append((*pick(names, again), (x[again] << 32) + x[again] + LENGTH))
        for k in (0, 1):
            own = np.flatnonzero((o >= 0) & (kind == k))
            own = own[distinct((*pick(names, own), x[own]))[0]]
            if len(own) < 2:
                continue
            runs = equal_offsets(columns["c"].take(pa.array(own)).to_pylist(), o[own], k)
            who = np.repeat(own, [len(r) for r in runs])
            if len(who):
                spans = [((x[i] + a) << 32) + (x[i] + b + LENGTH) for i, r in zip(own, runs, strict=True) for a, b in r]
                out.append((*pick(names, who), np.array(spans, np.int64)))
        *names, x = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.Table.from_batches([deal(parts, owner_part(names, parts), np.arange(len(x)), names, None, x)])

    return mark


def surroundings(docs: DataFrame, parts: int, hot: int = HOT) -> DataFrame:
    """What ``_exchange_surroundings`` deals of ``docs`` (as ``keyed``)."""
    dealt = docs.mapInArrow(_exchange_anchors(parts), dealt_schema("bigint"))
    shared = stored(gathered(dealt.groupBy("p").applyInArrow(_shared_anchors(parts, hot), dealt_schema())), "shared-anchors")
    # Fewer than one in ``hot`` of all anchors' hashes.
    marked = F.col("x")[0] == _HOT_MARK
    often = np.array([r.d for r in shared.where(marked).select("d").collect()], np.int64).view(np.uint64)
    shared = shared.where(~marked)
    return docs.join(shared, list(KEY)).select(*KEY, "text", "x").mapInArrow(_exchange_surroundings(parts, often), _AROUND)


def repeated_spans(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """d, t, u, x: of each document the spans to be removed, each as ``start * 2**32 + end``; they may overlap."""
    docs, parts = keyed(df, id_col, text_col), part_count(df)
    around = surroundings(docs, parts, hot)
    return stored(gathered(around.groupBy("p").applyInArrow(_mark(parts), dealt_schema("bigint")), "bigint"), "repeated-spans")


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes)."""
    results = ("n_bytes", "n_removed", "n_spans", "kept")
    others = [c for c in df.columns if c.lower() not in results]
    row = F.struct(*(F.col(f"`{c}`") for c in others)).alias("row")
    spans = repeated_spans(df, id_col=id_col, text_col=text_col, hot=hot)
    given = keyed(df, id_col, text_col, row).join(spans, list(KEY), "left")
    given = given.select("row", "text", F.coalesce("x", F.array().cast("array<bigint>")).alias("x"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            data, bounds = text_bytes(batch.column("text"))
            raw, kept, removed, runs = data.tobytes(), [], [], []
            for a, b, xs in zip(bounds.tolist(), bounds[1:].tolist(), batch.column("x").to_pylist(), strict=False):
                pieces, at, gone, n = [], 0, 0, 0
                for x in sorted(xs):
                    start, end = x >> 32, x & 0xFFFFFFFF
                    if start > at or not n:
                        pieces.append(raw[a + at : a + start])
                        n += 1
                        gone += end - start
                    elif end > at:
                        gone += end - at
                    at = max(at, end)
                pieces.append(raw[a + at : b])
                kept.append(b"".join(pieces))
                removed.append(gone)
                runs.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(bounds), pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                names=["row", *results],
            )

    row_type = given.schema["row"].dataType.simpleString()
    return given.mapInArrow(run, f"row {row_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").select("row.*", *results)


def strip(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with repeated strings taken out of ``text_col``; all columns, of whatever name, are kept."""
    packed = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    left = remove_repeats(packed, id_col="_id", text_col="_text").select("_row", "kept")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([k.decode("utf-8", "ignore") for k in batch.column("kept").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), texts], names=["_row", "kept"])

    left = left.mapInArrow(run, f"_row {left.schema['_row'].dataType.simpleString()}, kept string")
    return left.select(*((F.col("kept") if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in df.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
