"""Awkward documents for the corpus operators, and plain models of what the operators compute."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = "d t n h x row p ids kept size copies rate label text2 block weight _source _size _null _key _k _row _text _w _lines _s _q _failed _kept"


def make_documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, nulls, empty and long texts."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice(["an", "to", "ré", "li", "mo", "ß", "us"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    words = lambda k: [rnd.choice(vocab) for _ in range(k)]
    passage = words(70)
    texts: list[str | None] = [None, "", " \t\n", "one", "two words", "Two Words", "a b c d", "é" * 300, "x" * 450, "ab " * 300]
    for i in range(n):
        w = words(rnd.choice([3, 30, 120, 200]))
        if i % 4 == 0:
            w[len(w) // 2 : len(w) // 2] = passage
        texts.append(" ".join(w))
        if i % 3 == 0:
            texts.append(" ".join(w))  # an exact copy
        if i % 3 == 1:  # near copies, one word after the other changed
            for _ in range(3):
                w = list(w)
                w[rnd.randrange(len(w))] = "changed" + str(rnd.random())
                texts.append("\n".join(w).upper() if i % 2 else " ".join(w))
    texts.append(" ".join(words(9000)))
    rnd.shuffle(texts)
    return [(i, t, "en", [None, "a", "b", "c"][i % 4] if i % 3 else "hot", len(t or "")) for i, t in enumerate(texts)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows, parts: int = 5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def with_clashes(df):
    """More columns, of names that operators may use inside."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES.split())))


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def components(rows, percent: int = 75, k: int = 5) -> dict:
    """doc_id -> (set size, smallest linked doc_id), all pairs compared through shared shingles."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, text, *_ in rows:
        w = words((text or "").translate(lower))
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    holders, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common: Counter = Counter()
    for members in holders.values():
        for a in members:
            common.update((a, b) for b in members if a < b)

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


def without_repeats(rows, k: int = 200) -> dict:
    """doc_id -> (bytes, removed, spans, what is left)."""
    data = {i: (t or "").encode() for i, t, *_ in rows}
    seen = Counter(b[a : a + k] for b in data.values() for a in range(len(b) - k + 1))
    out = {}
    for i, b in data.items():
        gone = [False] * len(b)
        for a in range(len(b) - k + 1):
            if seen[b[a : a + k]] > 1:
                gone[a : a + k] = [True] * k
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out[i] = (len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g))
    return out


def without_later_windows(rows, k: int = 20) -> dict:
    seen, out = set(), {}
    for i, text, *_ in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            if key in seen:
                gone[a : a + k] = [True] * k
            seen.add(key)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out
