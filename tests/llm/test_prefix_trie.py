"""The trie of conversation prefixes against a plain one in memory."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from tests.llm import cases
from tierline.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def nodes_in_memory(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    held, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sorted(convs.items()):
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            held[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for x, members in held.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += x not in children
            saved[x[:d]] += (len(members) - 1) * len(x[-1][1]) if x else 0
    return sorted(
        (
            members[0],
            len(x),
            held[x[:-1]][0] if x else -1,
            len(members),
            len(children[x]) if x in children else 0,
            leaves[x],
            saved[x],
            cases.digest(",".join(map(str, ends[x])).encode() if x in ends else b""),
        )
        for x, members in held.items()
    )


def ordered(rows) -> dict[int, list[tuple[str, str]]]:
    out = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if c is not None:
            out[c].append((role or "", text or ""))
    return out


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), [])[:h] + turns[h:]
    return out


def awkward_rows(seed: int, n: int) -> list[tuple]:
    rnd = random.Random(seed)
    rows = [(None, 1, "user", "nobody's"), (7, None, None, None), (7, None, "user", "x"), (7, 3, "user", "same"), (7, 3, "user", "same"), (7, 3, "a", "tie")]
    paths = [[("user", f"t{rnd.randrange(3)}é😀"[: rnd.randint(0, 4)]) for _ in range(rnd.randint(1, 9))] for _ in range(6)]
    for i in range(n):
        c = rnd.choice([i, i + 100, -i, i * 1000])
        path = rnd.choice(paths)
        path = path[: rnd.randint(1, len(path))] + [("assistant", str(rnd.randrange(4)))] * rnd.choice([0, 0, 1, 3])
        rows += [(c, t, *x) for t, x in enumerate(path)]
    rows += [(5000, t, "user", str(t % 3)) for t in range(60)] + [(5001, t, "user", str(t % 3)) for t in range(47)]
    rnd.shuffle(rows)
    return rows


def collected(df) -> list[tuple]:
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def frame(spark, rows):
    return cases.with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(5))


@pytest.mark.parametrize("shard, block", [(512, 256), (7, 4), (1, 1)])
def test_trie(spark, shard, block):
    rows = awkward_rows(3, 60)
    df = frame(spark, rows)
    assert collected(pt.prefix_trie(df, shard=shard, block=block)) == nodes_in_memory(ordered(rows))


def test_rebuilt_conversations(spark):
    rows = awkward_rows(4, 150)
    got = pt.trie(pt.rebuilt(pt.ordered_turns(frame(spark, rows))), shard=16)
    want = rebuilt(ordered(rows))
    assert any(not turns for turns in want.values())
    assert collected(got) == nodes_in_memory(want)


def test_no_conversations_and_one_beginning_for_all(spark):
    df = spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)
    assert pt.prefix_trie(df).collect() == []
    assert pt.prefix_trie(df.limit(0)).collect() == []
    rows = [(c, t, "user", "hello") for c in range(1500) for t in range(2)] + [(c, 2, "user", str(c)) for c in range(0, 1500, 2)]
    assert collected(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard=600)) == nodes_in_memory(ordered(rows))


def test_members():
    for bits in (0, 1, 2, 0b1011, (1 << 4000) | (1 << 17) | 1, (1 << 300) - 1):
        assert pt.members(bits) == [i for i in range(bits.bit_length()) if bits >> i & 1]
