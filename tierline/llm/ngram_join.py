"""N-gram Jaccard join with signature trees, exact.

A document's set is its distinct five-word shingles (128 bits name a set, 64 a shingle;
step 2 counts with half of either, so that what is counted is never too little).
Two documents link when the sets' Jaccard similarity is at least ``PERCENT`` / 100.

1. Equal sets become one representative, the document with the smallest id.
2. Hashes of all shingles are exchanged to see which occur in more than one set. A set
   links with another only if at least ``PERCENT`` per cent of its shingles do, so most
   sets end here. Repeats within a batch are settled there and sent once. A bitmap of what
   is left, of bounded size, keeps most other texts from being moved to meet it.
3. Sets that have a smallest shingle in common, under a few orders, are verified against
   one centre each. Links that this finds join sets to clusters, so that a large group of
   near copies is one cluster and its pairs need no look.
4. In one order of all shingles, those of a single candidate first, then by hash, linked
   sets share one among the first ``100 - PERCENT`` per cent of either (prefix filter).
   Shingles whose sets lie in one cluster are dropped. For the others the sets are the
   leaves of signature trees: nodes hold the OR of their sets' token bitmaps, a size
   range, the most tokens that any set lost to shared bits and the most that any has from
   its place in the order on. Pairs of nodes, of any two blocks of a bucket, are followed
   down together while the largest overlap that they allow meets the threshold; pairs of
   sets of different clusters that are left are verified with all their shingles.
5. Connected components of all links, by alternating large and small stars.

No step is sampled or capped, and blocks bound what a task holds of a bucket.

Defined cases: null and empty texts, and texts without words, have an empty set and link
with nothing; a text of fewer words than a shingle has its whole sequence as only member;
rows equal in id and text are one document, and each row gets its result; rows of one id
but other texts are documents of their own; a null id counts as smaller than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table, stored
from tierline.llm.hashing import (
    KEY, Entries, deal, dealt_schema, distinct, first_documents, gathered, keyed, mixed, names_of, owner_part, part_count,
    pick, real_id, runs_of, shared_entries, text_bytes, window_hashes, window_starts, word_hashes, word_spans,
)
from tierline.llm.word_ids import text_batches, tidy

SHINGLE = 5
PERCENT = 75
ORDERS = 4
SIGNATURE_WORDS = 16  # of 64 bits
BLOCK = 256  # sets in a tree
FAN = 16  # sets in a node above them
BATCH_BYTES = 4 << 20
_NODE = "struct<d:bigint,t:bigint,u:bigint>"
FILTER_WORDS = 1 << 19  # of 64 bits, in the bitmap of documents that may be needed


# -- sets of a batch --------------------------------------------------------------------


class Sets:
    """The distinct shingles of each document of a batch, in ascending order as signed integers."""

    def __init__(self, batch: pa.RecordBatch):
        data, bounds = text_bytes(batch.column("text"))
        starts, ends, first = word_spans(data, bounds)
        words = word_hashes(data, starts, ends, lower=True)
        place, doc = window_starts(first, SHINGLE)
        hashes = [window_hashes(words, SHINGLE)[place]]
        docs = [doc]
        counts = np.diff(first)
        for k in range(1, SHINGLE):  # whole texts of k words
            short = np.flatnonzero(counts == k)
            if len(short):
                hashes.append(mixed(window_hashes(words, k)[first[:-1][short]] + np.uint64(k)))
                docs.append(short)
        h, doc = np.concatenate(hashes).view(np.int64), np.concatenate(docs)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])) if len(h) else np.empty(0, bool)
        self.h, self.doc = h[new], doc[new]
        self.starts = np.searchsorted(self.doc, np.arange(len(bounds)))
        self.sizes = np.diff(self.starts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        h = self.h.view(np.uint64)
        return self.sums(mixed(h)).view(np.int64), self.sums(mixed(h ^ np.uint64(0xA0761D6478BD642F))).view(np.int64)


_MEMBERS = "d bigint, t bigint, u bigint, n bigint, f bigint, g bigint"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text", BATCH_BYTES):
        sets = Sets(batch)
        f, g = sets.fingerprints()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in KEY), pa.array(sets.sizes, pa.int64()), pa.array(f), pa.array(g)], names=[*KEY, "n", "f", "g"]
        )


def _deal_shingles(parts: int):
    """Entries named by set, not by document: ``d`` is half its fingerprint; ``x`` is 1 for a shingle that
    another set of the batch has, and ``known`` entries count such shingles of sets that didn't send them.

    A shingle is its part and the upper half of its hash. Two shingles that agree in these count as shared, also
    those of one set: a set may get a larger count than it has, but never a smaller one."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", BATCH_BYTES):
            sets = Sets(batch)
            names = sets.fingerprints()[:1]
            alone = np.zeros(len(sets.sizes), bool)
            alone[first_documents(names)] = True
            use = alone[sets.doc]
            h, doc = sets.h[use].view(np.uint64), sets.doc[use]
            if not len(h):
                continue
            part, half = h % np.uint64(parts), h >> np.uint64(32)
            order, runs = runs_of(part << np.uint64(32) | half)
            size = np.diff(runs)
            sent = order[runs[:-1]]
            yield deal(parts, part[sent], doc[sent], names, half[sent].astype(np.uint32), (size > 1).astype(np.int32), np.int32)
            others = np.delete(order, runs[:-1])
            if len(others):
                own, n = np.unique(doc[others], return_counts=True)
                yield deal(parts, owner_part(pick(names, own), parts), own, names, None, n.astype(np.int32), np.int32)

    return run


def _count_shared(parts: int):
    """How many shingles of one part each set shares with others, dealt to the parts that add them up."""

    def count(table: pa.Table) -> pa.Table:
        known = Entries(table.filter(table["known"]))
        rest = Entries(table.filter(pc.invert(table["known"])))
        # One entry for each shingle and set, however many batches hold a copy of the set.
        f = rest.names[0][rest.doc]
        order = np.lexsort((-rest.x, f, rest.h))
        h, f, x = rest.h[order], f[order], rest.x[order]
        new = np.append(True, (h[1:] != h[:-1]) | (f[1:] != f[:-1])) if len(h) else np.empty(0, bool)
        h, f, x = h[new], f[new], x[new]
        again = np.append(False, h[1:] == h[:-1]) if len(h) else np.empty(0, bool)
        shared = again | np.append(again[1:], False) | (x > 0) if len(h) else again
        f, n = np.unique(f[shared], return_counts=True)
        counted = deal(parts, owner_part((f,), parts), np.arange(len(f)), (f,), None, n.astype(np.int32), np.int32)
        return pa.Table.from_batches([known.found(parts, np.arange(len(known.x)), np.int32), counted])

    return count


def _add_up(table: pa.Table) -> pa.Table:
    own = Entries(table)
    sets, number = distinct(own.names)
    total = np.bincount(number[own.doc], own.x, len(sets)) if len(sets) else np.empty(0)
    return pa.table({"f": pa.array(own.names[0][sets]), "c": pa.array(total.astype(np.int64))})


def _deal_places(parts: int):
    """Each shingle of the candidate sets with its place in its set."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(first_documents(names_of(batch))))
            names, sets = names_of(batch), batch.column("h")
            starts = np.asarray(sets.offsets).astype(np.int64)
            doc = np.repeat(np.arange(len(sets)), np.diff(starts))
            h, x = sets.flatten().to_numpy().view(np.uint64), (np.arange(len(doc)) - (starts - starts[:1])[doc]).astype(np.int32)
            if not len(h):
                continue
            order, runs = runs_of(h)
            sent = order[runs[:-1]]
            yield deal(parts, h[sent] % np.uint64(parts), doc[sent], names, h[sent], x[sent])
            known = order[np.repeat(np.diff(runs) > 1, np.diff(runs))]
            if len(known):
                yield deal(parts, owner_part(pick(names, doc[known]), parts), doc[known], names, None, x[known])

    return run


_SETS = "d bigint, t bigint, u bigint, n bigint, h array<bigint>, k array<bigint>, s array<bigint>"


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles, the smallest under each order, and the bitmap of each set that may link."""
    seeds = np.random.default_rng(5).integers(1, 1 << 63, ORDERS, np.uint64)
    for batch in text_batches(batches, "text", BATCH_BYTES):
        sets = Sets(batch)
        u, n = sets.h.view(np.uint64), len(sets.sizes)
        some = np.flatnonzero(sets.sizes)
        if len(some) < n:  # a set that may link isn't empty
            raise ValueError("an empty set can't be a candidate")
        least = np.stack([np.minimum.reduceat(mixed(u ^ s), sets.starts[:-1]) for s in seeds], axis=1).view(np.int64)
        bits = np.zeros((n, SIGNATURE_WORDS * 64), bool)
        bits[sets.doc, (mixed(u) % np.uint64(SIGNATURE_WORDS * 64)).astype(np.int64)] = True
        words = np.packbits(bits, axis=1).view(np.int64)
        lists = lambda v, k: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(v.ravel()))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in KEY),
                pa.array(sets.sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(sets.starts, pa.int32()), pa.array(sets.h)),
                lists(least, ORDERS),
                lists(words, SIGNATURE_WORDS),
            ],
            names=[*KEY, "n", "h", "k", "s"],
        )


def _perhaps(rows: DataFrame, some: DataFrame) -> DataFrame:
    """The ``rows`` whose document may be among ``some``: all that are, and of the others the few that share a bit of a
    bitmap with one. The bitmap goes to every task and has at most FILTER_WORDS rows of a number each, so that rows
    that a join would drop needn't be moved to it; the more bits are set, the fewer rows are dropped."""
    place = F.pmod(F.xxhash64(*KEY), F.lit(64 * FILTER_WORDS))
    bit = lambda x: F.pmod(x, F.lit(64)).cast("int")
    bits = some.select(F.shiftright(place, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(place)).alias("_bit"))
    bitmap = bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = rows.withColumn("_place", place).join(F.broadcast(bitmap), F.shiftright("_place", 6) == F.col("_word"))
    return met.where(F.getbit("_bits", bit(F.col("_place"))) == 1).select(*rows.columns)


# -- verification -----------------------------------------------------------------------


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold. Each join is on one side's document, so Spark
    can split the rows of a centre with many partners. ``sets`` has each document once, so no pair multiplies."""
    # Stored pairs have a size that Spark knows: where they are small, the sets aren't moved to meet them.
    pairs = stored(pairs, "pairs")
    side = lambda name: sets.select(F.struct(*KEY).alias(name), F.col("n").alias(f"n{name}"), F.col("h").alias(f"h{name}"))
    centres = side("a").join(pairs.select("a").distinct(), "a", "left_semi")
    both = pairs.join(side("b"), "b").join(centres, "a")
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    both = both.where(100 * small >= PERCENT * large).select("a", "b", "ha", "hb")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (xa, oa), (xb, ob) = (
                (c.flatten().to_numpy(), np.asarray(c.offsets) - np.asarray(c.offsets)[0]) for c in (batch.column("ha"), batch.column("hb"))
            )
            good = []
            for i in range(batch.num_rows):
                x, y = xa[oa[i] : oa[i + 1]], xb[ob[i] : ob[i + 1]]
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                overlap = int((x[at] == y).sum())
                good.append(100 * overlap >= PERCENT * (len(x) + len(y) - overlap))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(run, f"a {_NODE}, b {_NODE}")


# -- components -------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """node, label: of each node on an edge (a, b) the smallest node that it reaches."""
    pairs = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        # Large star: what is larger than a node goes to the smallest around it.
        around = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = large.distinct()
        # Small star: what is smaller goes there too.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    tops = pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stored(pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).union(tops), "components")


# -- signature trees --------------------------------------------------------------------


def _popcount(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words.view(np.uint64)).sum(axis=-1, dtype=np.int64)


class _Level:
    """Nodes of one level: bitmaps, size ranges, the most tokens lost to shared bits, the most from the bucket's place on."""

    def __init__(self, bits: np.ndarray, low: np.ndarray, high: np.ndarray, lost: np.ndarray, rest: np.ndarray):
        self.bits, self.low, self.high, self.lost, self.rest = bits, low, high, lost, rest

    def above(self, fan: int) -> _Level:
        at = np.arange(0, len(self.bits), fan)
        return _Level(
            np.bitwise_or.reduceat(self.bits, at, axis=0),
            np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at), np.maximum.reduceat(self.lost, at),
            np.maximum.reduceat(self.rest, at),
        )

    def may_link(self, i: np.ndarray, other: _Level, j: np.ndarray) -> np.ndarray:
        """Whether any sets below node i and node j of ``other`` can reach the threshold."""
        sizes = (100 * self.high[i] >= PERCENT * other.low[j]) & (100 * other.high[j] >= PERCENT * self.low[i])
        overlap = _popcount(self.bits[i] & other.bits[j]) + np.minimum(self.lost[i], other.lost[j])
        # In the bucket of the first token that two sets share, nothing before it counts.
        overlap = np.minimum(overlap, np.minimum(self.rest[i], other.rest[j]))
        # A Jaccard similarity of p per cent of sets of a and b tokens takes an overlap of p (a + b) / (100 + p).
        return sizes & ((100 + PERCENT) * overlap >= PERCENT * (self.low[i] + other.low[j]))


class Tree:
    """A signature tree of at most a block's sets: leaves ordered by cluster, nodes of FAN, one root."""

    def __init__(self, cluster: np.ndarray, n: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.order = np.lexsort((n, cluster))
        self.cluster, n, bits = cluster[self.order], n[self.order], bits[self.order]
        self.leaves = _Level(bits, n, n, n - _popcount(bits), rest[self.order])
        self.nodes = self.leaves.above(FAN)
        self.root = self.nodes.above(len(self.nodes.bits))


def dual_traversal(a: Tree, b: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the trees' own order) of pairs of sets that may link and lie in different clusters."""
    none = np.empty(0, np.int64)
    zero = np.zeros(1, np.int64)
    if not a.root.may_link(zero, b.root, zero)[0]:
        return none, none
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.nodes.bits)), np.arange(len(b.nodes.bits)), indexing="ij"))
    if a is b:
        i, j = i[i <= j], j[i <= j]
    ok = a.nodes.may_link(i, b.nodes, j)
    out_i, out_j = [], []
    for p, q in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
        x, y = np.meshgrid(
            np.arange(p * FAN, min((p + 1) * FAN, len(a.cluster))), np.arange(q * FAN, min((q + 1) * FAN, len(b.cluster))), indexing="ij"
        )
        x, y = x.ravel(), y.ravel()
        ok = a.cluster[x] != b.cluster[y]
        x, y = x[ok], y[ok]
        ok = a.leaves.may_link(x, b.leaves, y)
        out_i.append(x[ok])
        out_j.append(y[ok])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (none, none)


def _candidates(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different clusters that share a prefix shingle and pass the trees."""
    node = F.struct(*KEY).alias("node")
    parts = part_count(sets)
    dealt = sets.select(*KEY, "h").mapInArrow(_deal_places(parts), dealt_schema())
    shared = stored(gathered(dealt.groupBy("p").applyInArrow(shared_entries(parts), dealt_schema())), "shared-places")
    # Shingles that no other candidate has come first, so they use up the prefix; a set has ``rest`` from the bucket's on.
    prefix = (F.size("x") - F.ceil(F.col("n") * PERCENT / 100) + 1).cast("int")
    found = sets.join(shared, list(KEY)).where(prefix > 0)
    first = F.transform(F.slice("x", F.lit(1), prefix), lambda i: F.get("h", i))
    entries = found.select(node, "n", F.size("x").alias("from"), F.posexplode(first).alias("place", "h"))
    entries = entries.withColumn("rest", (F.col("from") - F.col("place")).cast("bigint")).drop("from", "place")
    entries = entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # Buckets of one cluster are dropped; a partial aggregate decides, whatever their size.
    spread = entries.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("h")
    entries = stored(entries.join(spread, "h"), "bucket-entries")
    # A bucket is dealt to blocks by size class and hash, so that no task holds a whole one.
    size_class = F.floor(F.log(100 / PERCENT, F.col("n").cast("double"))).cast("int")
    entries = entries.withColumn("size_class", size_class)
    counts = entries.groupBy("h", "size_class").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    entries = entries.join(counts, ["h", "size_class"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    signatures = sets.select(node, "s")
    member = F.struct("node", "n", "rest", "label", "s")
    blocks = entries.join(signatures, "node").groupBy("h", "size_class", "block").agg(F.collect_list(member).alias("m"))
    blocks = stored(blocks, "bucket-blocks")
    left = blocks.select("h", F.col("size_class").alias("c"), F.col("block").alias("i"), F.col("m").alias("ma"))
    # Each block meets itself and, once, each later block of its own or the next two size classes.
    right = blocks.select("h", F.col("size_class").alias("e"), F.col("block").alias("j"), F.col("m").alias("mb"))
    met = left.join(right, "h").where("(e = c and j >= i) or (e > c and e <= c + 2)")
    met = met.where("e != c or i != j or size(ma) > 1").select(((F.col("c") == F.col("e")) & (F.col("i") == F.col("j"))).alias("self"), "ma", "mb")

    ends = [side + c for side in "ab" for c in KEY]

    def columns(members: pa.StructArray) -> tuple:
        label, own = members.field("label"), members.field("node")
        key, names = (tuple(s.field(c).to_numpy() for c in KEY) for s in (label, own))
        return key, names, members.field("n").to_numpy(), members.field("s").flatten().to_numpy().reshape(len(own), -1), members.field("rest").to_numpy()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            ma, mb, same = batch.column("ma"), batch.column("mb"), batch.column("self").to_pylist()
            for r in range(batch.num_rows):
                sides = [columns(m[r].values) for m in ((ma,) if same[r] else (ma, mb))]
                # Clusters are numbered alike on both sides.
                _, number = distinct(tuple(np.concatenate(c) for c in zip(*(s[0] for s in sides), strict=True)))
                if number.max(initial=0) == 0:
                    continue
                cut = len(sides[0][0][0])
                trees = [Tree(c, *s[2:]) for s, c in zip(sides, (number[:cut], number[cut:]), strict=False)]
                i, j = dual_traversal(trees[0], trees[-1])
                if len(i):
                    a, b = trees[0].order[i], trees[-1].order[j]
                    found.append((*pick(sides[0][1], a), *pick(sides[-1][1], b)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=ends)

    pairs = met.mapInArrow(run, ", ".join(f"{c} bigint" for c in ends))
    a, b = (F.struct(*(F.col(side + c).alias(c) for c in KEY)) for side in "ab")
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a != b").distinct()


# -- the join ---------------------------------------------------------------------------


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """d, t, u, n (set size), rep, label (both as struct d, t, u): of each document its set's representative and component."""
    docs, parts = keyed(df, id_col, text_col), part_count(df)
    members = stored(docs.mapInArrow(tidy(_members), _MEMBERS), "set-members")
    node = F.struct(*KEY)
    reps = members.where("n > 0").groupBy("n", "f", "g").agg(F.min(node).alias("rep"))
    members = stored(members.join(reps, ["n", "f", "g"], "left").withColumn("rep", F.coalesce("rep", node)), "set-members")

    halves = dealt_schema(names="d array<bigint>", h="int")
    dealt = docs.mapInArrow(tidy(_deal_shingles(parts)), halves).groupBy("p").applyInArrow(_count_shared(parts), halves)
    counted = stored(dealt.groupBy("p").applyInArrow(_add_up, "f bigint, c bigint"), "shared-shingles")
    own = members.where(F.col("rep") == node)
    maybe = own.join(counted, "f").where(100 * F.col("c") >= PERCENT * F.col("n")).select(*KEY).distinct()
    maybe = stored(maybe, "candidates")
    # One row for each document, however often it is repeated.
    texts = _perhaps(docs, maybe).join(maybe, list(KEY)).select(*KEY, "text").dropDuplicates(list(KEY))
    sets = stored(texts.mapInArrow(tidy(_whole_sets), _SETS), "candidate-sets")

    bands = sets.select(node.alias("b"), F.posexplode("k").alias("o", "k"))
    centres = bands.groupBy("o", "k").agg(F.min("b").alias("a"))
    stars = bands.join(centres, ["o", "k"]).where("a != b").select("a", "b").distinct()
    first = components(_verify(stars, sets))
    second = stored(_verify(_candidates(sets, first), sets), "links")

    # The rest joins clusters: edges between their labels.
    label = lambda side: first.select(F.col("node").alias(side), F.col("label").alias(f"l{side}"))
    across = second.join(label("a"), "a", "left").join(label("b"), "b", "left")
    across = across.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    top = components(across).select(F.col("node").alias("first"), F.col("label").alias("last"))
    found = members.select(*KEY, "n", "rep").join(first.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.withColumn("first", F.coalesce("label", "rep")).drop("label").join(top, "first", "left")
    return found.select(*KEY, "n", "rep", F.coalesce("last", "first").alias("label"))


def keep_one(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component one row, of the document with the smallest id, with the columns of ``df``; all rows of texts
    without words stay. Of rows equal in id and text the smallest stays (where a column has no order, by its JSON)."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    found = near_duplicates(df, id_col=id_col, text_col=text_col).where(F.struct(*KEY) == F.col("label"))
    kept = stored(found.groupBy(*KEY).agg((F.count("*") * F.sign(F.max("n"))).alias("rows")), "kept")
    rows = keyed(df, id_col, text_col, row).select(*KEY, "row")
    once = rows.join(kept.where("rows <= 1").select(*KEY), list(KEY)).select("row")
    # Few documents have more rows than one, and only those rows are grouped; partial aggregates shrink a large group first.
    several = rows.join(kept.where("rows > 1").select(*KEY), list(KEY))
    ordered = not any(kind in df.select(row).schema.simpleString() for kind in ("map<", "variant", "interval"))
    first = F.min("row") if ordered else F.min_by("row", F.to_json("row"))
    return once.union(several.groupBy(*KEY).agg(first.alias("row")).select("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select(real_id(F.col("d")).alias("doc_id"), F.col("n").alias("n_shingles"), real_id(F.col("label.d")).alias("component_id"))
