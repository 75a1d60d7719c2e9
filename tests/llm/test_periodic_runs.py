"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import random
import zlib

import numpy as np

from tests.conftest import SF_SMALL
from tests.llm import cases
from tierline.llm import periodic_runs as pr


def runs_by_search(w: list, min_words: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            length = e + q - i
            smaller = any(all(w[j] == w[j + p] for j in range(i, i + length - p)) for p in range(1, q))
            if length >= max(min_words, exponent * q) and not smaller:
                out.append((i, length, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def awkward_words(rnd: random.Random) -> list[str]:
    """Random words over a small or large vocabulary, loops of many lengths in and beside each other."""
    vocab = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 6, 40]))]
    out: list[str] = []
    while len(out) < rnd.choice([0, 5, 40, 300]):
        unit = [rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 50]))]
        times = rnd.choice([1, 1, 2, 3, 4, 5, 9])
        piece = unit * times + unit[: rnd.randrange(len(unit))]
        out += piece * rnd.choice([1, 1, 1, 4]) if len(piece) < 60 else piece
    return out


def found_in(texts: list[list[str]], **limits) -> list[list[tuple[int, int, int]]]:
    code: dict[str, int] = {}
    flat = np.array([code.setdefault(x, len(code)) for w in texts for x in w], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for t, *run in pr.batch_runs(flat, starts, **limits).tolist():
        out[t].append(tuple(run))
    return out


def test_batches_against_search():
    rnd = random.Random(5)
    for _ in range(12):
        texts = [awkward_words(rnd) for _ in range(25)]
        assert found_in(texts) == [runs_by_search(w) for w in texts]
        assert found_in(texts, min_words=9, min_exponent=5) == [runs_by_search(w, 9, 5) for w in texts]


def test_long_periods_and_thue_morse():
    rnd = random.Random(6)
    unit = [str(rnd.random()) for _ in range(1500)]
    morse = [str(bin(i).count("1") % 2) for i in range(1 << 12)]  # no period three times over
    texts = [["x", *unit * 4, *unit[:7], "y"], morse, morse[:256] * 5, ["a"] * 5000, ["a", "b"] * 3, ["a"] * 6]
    want = [[(1, 6007, 1500)], [], [(0, 1280, 256)], [(0, 5000, 1)], [], [(0, 6, 1)]]
    assert found_in(texts) == want


def test_operator_keeps_columns_and_takes_odd_texts(spark):
    rnd = random.Random(7)
    texts = [None, "", " \t\n\x0b", "a a a a a a", "\x0ba b\x0ca b\ta  b\na b ", "a a " * 9, *(" ".join(awkward_words(rnd)) for _ in range(30))]
    rows = [(i, t, "en", None, 0) for i, t in enumerate(texts)] * 2 + [(None, "z " * 7, None, None, None)]
    df = cases.with_clashes(cases.frame(spark, rows))
    got = pr.find_runs(df)
    assert got.columns == [*df.columns, "runs", "collapsed"]
    found = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
    want = []
    for i, t, *_ in rows:
        runs = runs_by_search(cases.words(t))
        want.append((i, runs, collapsed(cases.words(t), runs)))
    assert found == sorted(want, key=str)
    assert pr.find_runs(got).columns == got.columns
    assert pr.find_runs(df.limit(0)).collect() == []


def expected_row(doc_id, text):
    w = cases.words(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = runs_by_search(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    listing = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, cases.digest(listing.encode()), cases.digest(collapsed(w, runs).encode()))


def test_query_against_search(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = pr.query(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected_row(*r) for r in docs]
    assert sum(r[1] > 0 for r in want) > 5
    assert sorted(map(tuple, got.collect())) == sorted(want, key=lambda r: r[0])
