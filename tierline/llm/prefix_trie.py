"""The trie of conversation prefixes, from vertical bitmaps.

A node is a distinct sequence of the first ``d`` turns (role and text) of some
conversation; the root has none. Conversations that begin with it are its members.

Conversations are numbered by ascending id and cut into shards of ``SHARD``, and
their turns into blocks of ``BLOCK``; a task holds one block of one shard, so its size is
bounded however long a conversation is or however many share a beginning. A task indexes
each (position, turn) to the bitset of conversations that have that turn there, and walks
depth first: a node's bitset intersected with the postings of its members' next turns
gives its children. A node's name is the XOR of 128-bit hashes of its (position, turn)
pairs, so tasks name the same node alike, and a later block starts from the names that
the earlier ones end with.

1. The first walk yields each node's members in the shard (a popcount) and the smallest of
   them. Merged over shards, by partial sums, this is the table of nodes; a node belongs
   to its smallest member. A conversation's own nodes are the last of its path, and one of
   them at most is a leaf.
2. So sums over a subtree are sums over members. The second walk counts, in each node's
   bitset, the members that own a leaf, and adds up for each member the code points from
   this node to where its own nodes begin: those turns are saved. It also lists the members
   that end in the node, in pieces per shard; their digest is taken in order of shards,
   from a stream.

What a task sends out is one row per node and shard, so a beginning that a third of all
conversations share is one row of each shard; a parent of very many children is joined
apart from the others (``common.attach``). A digest of a list of ids can only be taken one
after the other, so the list of one node is streamed through one task, in bounded memory.

Defined cases: a null role or text is empty; turns are in order of ``turn`` (null first),
then role, then text, and repeated rows are turns of their own; rows without a conversation
id are left out; a table without conversations has no nodes, not even a root; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tierline.llm.common import attach, numbered, read_table, stored

SHARD = 512
BLOCK = 256
END_PIECE = 512  # ids in one row of a list of ends
BLOCK_OF = 100  # the query: conversations that share one beginning
MAX_SHARED = 6  # the query: fewer turns than this are shared
_SEED = 0x5BD1E995
_EMPTY = hashlib.sha256(b"").hexdigest()


class Turns(NamedTuple):
    """``turns``: c, pos (from 0), a, b (hashes of role and text), chars. ``convs``: c, n_turns, each conversation once."""

    turns: DataFrame
    convs: DataFrame


def ordered_turns(
    df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Turns:
    """Turns with their place in the conversation. A long conversation is sorted by many tasks."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.select(F.col(f"`{conv_col}`").cast("bigint").alias("c"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"))
    order = [F.col("c"), F.col("turn").asc_nulls_first()]
    cut = [F.substring(c, 1, 32) for c in ("role", "text")]  # ranges are cut by sampled keys: those stay short
    hashes = [F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(_SEED), "role", "text").alias("b")]
    ranged = (
        rows.where("c is not null")
        .repartitionByRange(*order, *cut)
        .sortWithinPartitions(*order, "role", "text")
        .select("c", *hashes, F.char_length("text").cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("place"))
    )
    table = stored(ranged, "trie-order").withColumn("part", F.shiftright("place", 33))
    # A conversation's piece in one part, and how many of its turns lie in earlier parts.
    pieces = table.groupBy("c", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = W.partitionBy("c").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    pieces = stored(pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "trie-pieces")
    pos = F.col("place") - F.col("first") + F.col("before")
    turns = table.join(pieces.drop("n"), ["c", "part"]).select("c", pos.alias("pos"), "a", "b", "chars")
    return Turns(stored(turns, "trie-places"), stored(pieces.groupBy("c").agg(F.sum("n").alias("n_turns")), "trie-conversations"))


def rebuilt(found: Turns) -> Turns:
    """Each conversation ``c`` with its first ``h`` turns replaced by those of conversation ``c - c % 100``,
    ``h`` being the CRC-32 of the decimal id modulo 6."""
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % MAX_SHARED).alias("h")
    own = found.convs.select("c", F.col("n_turns").alias("n_own"), h, (F.col("c") - F.col("c") % BLOCK_OF).alias("base"))
    bases = found.convs.where(F.col("c") % BLOCK_OF == 0).select(F.col("c").alias("base"), F.col("n_turns").alias("n_base"))
    lead = F.least("h", F.coalesce("n_base", F.lit(0)))
    plan = stored(own.join(bases, "base", "left").select("c", "n_own", "h", "base", lead.alias("lead")), "trie-plan")
    rest = attach(found.turns, plan.select("c", "n_own", "h", "lead"), "c", "n_own").where("pos >= h")
    rest = rest.select("c", (F.col("lead") + F.col("pos") - F.col("h")).alias("pos"), "a", "b", "chars")
    firsts = found.turns.where((F.col("c") % BLOCK_OF == 0) & (F.col("pos") < MAX_SHARED)).withColumnRenamed("c", "base")
    shared = firsts.join(plan.select("c", "base", "h"), "base").where("pos < h").select("c", "pos", "a", "b", "chars")
    n_turns = F.col("lead") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    return Turns(stored(rest.unionByName(shared), "trie-rebuilt"), plan.select("c", n_turns.alias("n_turns")))


# -- one block of one shard ---------------------------------------------------------------

_HEAD = "shard bigint, block bigint, bit int, pos bigint, z1 bigint, z2 bigint, chars bigint, c bigint, n_turns bigint, before bigint, leaf boolean"
_NODE = "x1 bigint, x2 bigint, p1 bigint, p2 bigint, depth bigint, n bigint, c bigint, chars bigint, cum bigint"
_SUM = "x1 bigint, x2 bigint, shard bigint, piece int, leaves bigint, saved bigint, ends string"


def members(bits: int) -> list[int]:
    """The numbers of the set bits, ascending."""
    if bits.bit_count() < 8:
        out = []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()


def bitset(places: np.ndarray, n: int) -> int:
    if len(places) == 1:
        return 1 << int(places[0])
    flags = np.zeros(n, bool)
    flags[places] = True
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


class Node(NamedTuple):
    bits: int  # members in this shard
    ends: int  # those that have no more turns
    name: tuple[int, int]
    parent: tuple[int, int] | None
    depth: int
    chars: int  # of the last turn
    cum: int  # of all turns


class Block:
    """Index of one block of one shard: ``c``, ``n_turns``, ``before``, ``leaf`` of its conversations, and postings."""

    def __init__(self, table: pa.Table, block_turns: int):
        self.shard, self.start = table["shard"][0].as_py(), table["block"][0].as_py() * block_turns
        self.stop = self.start + block_turns
        is_head = np.asarray(table["c"].is_valid())
        heads, turns = table.filter(pa.array(is_head)).sort_by("bit"), table.filter(pa.array(~is_head))
        bit = heads["bit"].to_numpy()
        self.c, self.n_turns = heads["c"].to_numpy(), heads["n_turns"].to_numpy()
        self.before = heads["before"].fill_null(0).to_numpy()
        self.leaves = bitset(np.flatnonzero(heads["leaf"].fill_null(False).to_numpy()), len(bit))
        self.roots: dict[tuple[int, int, int], list[int]] = {}
        for i, key in enumerate(zip(*(heads[x].to_pylist() for x in ("z1", "z2", "chars")), strict=True)):
            self.roots.setdefault(key, []).append(i)
        who, pos, z1, z2 = np.searchsorted(bit, turns["bit"].to_numpy()), *(turns[x].to_numpy() for x in ("pos", "z1", "z2"))
        place = np.lexsort((pos, who))
        who, pos, z1, z2 = who[place], pos[place], z1[place], z2[place]
        self.first = np.searchsorted(who, np.arange(len(bit))).tolist()  # a conversation's first turn here
        self.z1, self.z2, self.chars = z1.tolist(), z2.tolist(), turns["chars"].to_numpy()[place].tolist()
        same = np.lexsort((z2, z1, pos))
        new = np.ones(len(same), bool)
        new[1:] = np.any([x[same][1:] != x[same][:-1] for x in (pos, z1, z2)], axis=0)
        code = np.empty(len(same), np.int64)
        code[same] = np.cumsum(new) - 1
        self.code = code.tolist()
        cuts = np.append(np.flatnonzero(new), len(same)).tolist()
        self.postings = [bitset(who[same[a:b]], len(bit)) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.ended = {int(d): bitset(np.flatnonzero(self.n_turns == d), len(bit)) for d in np.unique(self.n_turns)}

    def walk(self) -> Iterator[Node]:
        """All nodes of this block, parents first. The names that a later block starts from are the earlier one's nodes."""
        for (x1, x2, cum), convs in self.roots.items():
            bits = bitset(np.array(convs), len(self.c))
            stack = [Node(bits, bits & self.ended.get(self.start, 0), (x1, x2), None, self.start, 0, cum)]
            while stack:
                node = stack.pop()
                if node.depth > self.start or not self.start:
                    yield node
                live = node.bits ^ node.ends if node.depth < self.stop else 0
                while live:
                    row = self.first[(live & -live).bit_length() - 1] + node.depth - self.start
                    child = node.bits & self.postings[self.code[row]]
                    live ^= child
                    name = node.name[0] ^ self.z1[row], node.name[1] ^ self.z2[row]
                    depth, chars = node.depth + 1, self.chars[row]
                    stack.append(Node(child, child & self.ended.get(depth, 0), name, node.name, depth, chars, node.cum + chars))


def _columns(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split(" ") for f in schema.split(", ")]
    found = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.table({name: pa.array(x, kinds[kind]) for (name, kind), x in zip(fields, found, strict=True)})


def _nodes(table: pa.Table, block_turns: int) -> pa.Table:
    block, rows = Block(table, block_turns), []
    for x in block.walk():
        low = (x.bits & -x.bits).bit_length() - 1
        rows.append((*x.name, *(x.parent or (None, None)), x.depth, x.bits.bit_count(), int(block.c[low]), x.chars, x.cum))
    return _columns(rows, _NODE)


def _sums(table: pa.Table, block_turns: int) -> pa.Table:
    block, rows = Block(table, block_turns), []
    for x in block.walk():
        known = x.cum - x.chars  # code points before this node's turn
        saved = int(np.maximum(block.before[members(x.bits)] - known, 0).sum())
        ends = block.c[members(x.ends)].tolist()
        pieces = [",".join(map(str, ends[i : i + END_PIECE])) for i in range(0, len(ends), END_PIECE)] or [None]
        rows.append((*x.name, block.shard, 0, (x.bits & block.leaves).bit_count(), saved, pieces[0]))
        rows += [(*x.name, block.shard, i, 0, 0, text) for i, text in enumerate(pieces[1:], 1)]
    return _columns(rows, _SUM)


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, joined by commas; the pieces come in order and are not kept."""
    key, digest, done = None, None, []
    for batch in batches:
        for x1, x2, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (x1, x2) == key:
                digest.update(b"," + text.encode())
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = (x1, x2), hashlib.sha256(text.encode())
        if len(done) > 10_000:
            yield from _columns(done, "x1 bigint, x2 bigint, ends_sha256 string").to_batches()
            done = []
    if key is not None:
        done.append((*key, digest.hexdigest()))
    yield from _columns(done, "x1 bigint, x2 bigint, ends_sha256 string").to_batches()


# -- all shards ---------------------------------------------------------------------------


def trie(found: Turns, *, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (see the module's text) and ends_sha256 (of the comma-joined ids of members without more turns)."""
    at = (F.col("_n") - 1).cast("bigint")
    convs = numbered(found.convs, F.col("c")).select("c", "n_turns", F.floor(at / shard).alias("shard"), (at % shard).cast("int").alias("bit"))
    convs = stored(convs, "trie-shards")
    turns = attach(found.turns, convs, "c", "n_turns")
    named = [F.xxhash64("pos", "a", "b").alias("z1"), F.xxhash64(F.lit(_SEED), "pos", "b", "a").alias("z2")]
    turns = turns.select("shard", F.floor(F.col("pos") / block).alias("block"), "bit", F.col("pos").cast("bigint").alias("pos"), *named, "chars")
    turns = stored(turns, "trie-turns")

    # One head per conversation and block: what the path up to the block is named, and its code points.
    last = F.floor(F.greatest(F.col("n_turns") - 1, F.lit(0)) / block)
    heads = convs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    pieces = turns.groupBy("shard", "bit", "block").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.sum("chars").alias("chars"))
    earlier = W.partitionBy("shard", "bit").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    path = [F.coalesce(f(x).over(earlier), F.lit(0)).alias(x) for f, x in ((F.bit_xor, "z1"), (F.bit_xor, "z2"), (F.sum, "chars"))]
    path = pieces.select("shard", "bit", "block", *path, F.sum("chars").over(W.partitionBy("shard", "bit")).alias("total"))
    heads = heads.join(path, ["shard", "bit", "block"], "left").fillna(0, ["z1", "z2", "chars", "total"])
    heads = stored(heads, "trie-heads")

    def walked(known: DataFrame, task, schema: str) -> DataFrame:
        both = known.unionByName(turns, allowMissingColumns=True)
        kinds = [f.split(" ") for f in _HEAD.split(", ")]
        both = both.select(*((F.col(x) if x in both.columns else F.lit(None)).cast(kind).alias(x) for x, kind in kinds))
        return both.groupBy("shard", "block").applyInArrow(lambda table: task(table, block), schema)

    alike = [F.min(x).alias(x) for x in ("p1", "p2", "depth", "chars", "cum", "c")]  # all but c are equal in all shards
    nodes = walked(heads, _nodes, _NODE).groupBy("x1", "x2").agg(*alike, F.sum("n").alias("n_convs"))
    nodes = stored(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, ["x1", "x2"], "left").fillna(0, ["n_children"]), "trie-children")

    owned = nodes.groupBy("c").agg(F.min(F.col("cum") - F.col("chars")).alias("from"), F.max(F.col("n_children") == 0).alias("leaf"))
    before = F.coalesce("from", "total").alias("before")  # code points of the turns in which it follows another
    known = heads.join(owned, "c", "left").select(*(x for x in heads.columns if x != "total"), before, "leaf")
    sums = stored(walked(known, _sums, _SUM), "trie-sums")
    totals = sums.groupBy("x1", "x2").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    lists = sums.where("ends is not null").select("x1", "x2", "ends", "shard", "piece")
    lists = lists.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "shard", "piece").select("x1", "x2", "ends")
    digests = lists.mapInArrow(_list_digests, "x1 bigint, x2 bigint, ends_sha256 string")
    full = nodes.join(totals, ["x1", "x2"]).join(digests, ["x1", "x2"], "left").fillna(_EMPTY, ["ends_sha256"])

    parents = nodes.where("n_children > 0").select(F.struct("x1", "x2").alias("parent"), F.col("c").alias("parent_conv_id"), "n_children")
    rows = full.withColumn("parent", F.when(F.col("depth") > 0, F.struct(F.col("p1").alias("x1"), F.col("p2").alias("x2"))))
    return attach(rows, parents, "parent", "n_children").select(
        F.col("c").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def prefix_trie(df: DataFrame, *, shard: int = SHARD, block: int = BLOCK, **columns: str) -> DataFrame:
    """The trie of the conversations of ``df``; ``columns`` name conv_col, turn_col, role_col and text_col."""
    return trie(ordered_turns(df, **columns), shard=shard, block=block)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(ordered_turns(read_table(spark, sf_dir, "conversations"))))


_CRC_STEP = "list_reduce(list_concat([xor(x, y)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda u, v: xor(u >> 1, 3988292384 * (u & 1)))"
_CRC = f"""xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda x, y: {_CRC_STEP}), 4294967295)"""
ORACLE = f"""
WITH ordered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, count(*) AS n_own, {_CRC} % {MAX_SHARED} AS h, c - c % {BLOCK_OF} AS base FROM ordered GROUP BY c),
rebuilt AS (
  SELECT v.c, o.i AS pos, o.role, o.text FROM convs v JOIN ordered o ON o.c = v.base AND o.i < v.h
  UNION ALL
  SELECT v.c, coalesce(least(v.h, b.n_own), 0) + o.i - v.h, o.role, o.text
  FROM convs v JOIN ordered o ON o.c = v.c AND o.i >= v.h LEFT JOIN convs b ON b.c = v.base),
steps AS (
  SELECT c, 0 AS d, '' AS k, 0 AS chars FROM convs
  UNION ALL
  SELECT c, pos + 1, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY c ORDER BY pos)), length(text) FROM rebuilt),
nodes AS (SELECT k, d, min(c) AS c, count(*) AS n, max(chars) AS chars FROM steps GROUP BY k, d),
linked AS (
  SELECT nodes.*, p.k AS parent FROM nodes LEFT JOIN steps p ON p.c = nodes.c AND p.d = nodes.d - 1),
children AS (SELECT parent, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
  SELECT above.k, count(*) FILTER (WHERE children.n IS NULL) AS n_leaves, sum((u.n - 1) * u.chars)::BIGINT AS saved_tokens
  FROM nodes u LEFT JOIN children ON children.parent = u.k JOIN steps above ON above.c = u.c AND above.d <= u.d
  GROUP BY above.k),
ends AS (
  SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest
  FROM (SELECT c, arg_max(k, d) AS k FROM steps GROUP BY c) GROUP BY k)
SELECT x.c AS conv_id, x.d::BIGINT AS depth, p.c AS parent_conv_id, x.n AS n_convs, coalesce(children.n, 0) AS n_children,
       n_leaves, saved_tokens, coalesce(ends.digest, sha256('')) AS ends_sha256
FROM linked x LEFT JOIN nodes p ON p.k = x.parent LEFT JOIN children ON children.parent = x.k
JOIN sums ON sums.k = x.k LEFT JOIN ends ON ends.k = x.k"""
