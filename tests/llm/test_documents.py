"""Operators on documents against plain models, with awkward rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from tierline.llm import bpe, mixing, ngram_join, packing, quality_rules, repeated_bytes, repeated_windows
from tierline.llm.hashing import keyed, real_id


CLASHING = ("6934541", "0bf770e")  # followed by a blank, of one 32-bit hash; so are texts that go on alike


@pytest.fixture(scope="module")
def rows():
    return cases.make_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return cases.with_clashes(cases.frame(spark, rows))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def near_duplicates(df) -> dict:
    found = ngram_join.near_duplicates(df).select(real_id(F.col("d")).alias("i"), "n", F.col("label.d").alias("c"))
    return {r["i"]: (r["n"], r["c"]) for r in found.collect()}


def test_ngram_join(docs, rows):
    assert near_duplicates(docs) == cases.components(rows)


def test_ngram_join_links_that_no_smallest_shingle_shows(spark):
    """Chains of variants, each near the next only: links between clusters come from the trees."""
    rows, base = [], [f"w{i}" for i in range(60)]
    for i in range(80):
        base = list(base)
        base[(i * 7) % 60] = f"v{i}"
        rows.append((i, " ".join(base), "en", "a", 0))
    assert near_duplicates(cases.frame(spark, rows)) == cases.components(rows)


def test_ngram_join_threshold_is_met_exactly(spark):
    shared = [f"s{i}" for i in range(19)]  # 15 shingles; 5 more in the second: 15 / 20
    rows = [(1, " ".join(shared), "", "", 0), (2, " ".join([*shared, *"abcde"]), "", "", 0), (3, " ".join([*shared, *"vwxyzq"]), "", "", 0)]
    found = near_duplicates(cases.frame(spark, rows))
    assert {i: c for i, (_, c) in found.items()} == {1: 1, 2: 1, 3: 3}


def test_ngram_join_counts_shared_shingles_in_few_bytes():
    """The exchange grows with the number of parts a set is spread over: 8 bytes of name for each, 4 for a shingle."""
    import pyarrow as pa

    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], names=["d", "text"])
    dealt = pa.Table.from_batches(ngram_join._deal_shingles(3000)(iter([batch])))
    entries = sum(len(x) for x in dealt["h"].to_pylist())
    assert entries == 40 * 56
    assert sum(pa.compute.sum(pa.compute.list_value_length(dealt[c])).as_py() * dealt[c].type.value_type.bit_width // 8 for c in "dh") <= 12 * entries
    assert not {"t", "u"} & set(dealt.column_names)


def test_ngram_join_never_counts_too_few_shared_shingles(monkeypatch):
    """Shingles of which only the lower half of the hash differs, also within one set, and copies in other batches."""
    import numpy as np
    import pyarrow as pa

    whole = ngram_join.window_hashes
    monkeypatch.setattr(ngram_join, "window_hashes", lambda words, k: whole(words, k) & np.uint64(0x3FFFFFFFF))
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join([*base[:30], *"abcdefgh"]), " ".join(f"v{i}" for i in range(60)), " ".join(base), "", "one two"]
    batches = [pa.RecordBatch.from_arrays([pa.array(t)], names=["text"]) for t in (texts[:2], texts[2:], texts[1:2])]
    dealt = pa.Table.from_batches(x for b in batches for x in ngram_join._deal_shingles(5)(iter([b])))
    part = lambda table, p: table.filter(pa.compute.equal(table["p"], p))
    counted = pa.concat_tables(ngram_join._count_shared(5)(part(dealt, p)) for p in range(5))
    found = pa.concat_tables(ngram_join._add_up(part(counted, p)) for p in range(5))
    found = dict(zip(found["f"].to_pylist(), found["c"].to_pylist(), strict=True))
    sets = ngram_join.Sets(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))
    members = [set(sets.h[a:b].tolist()) for a, b in zip(sets.starts[:-1], sets.starts[1:], strict=True)]
    for own, f in zip(members, sets.fingerprints()[0].tolist(), strict=True):
        others = set().union(*(m for m in members if m != own))
        assert found.get(f, 0) >= len(own & others)


def test_ngram_join_bitmap_drops_no_document_that_is_needed(spark):
    from pyspark.sql import types as T

    null = T.StructType([T.StructField(c, T.LongType()) for c in "dtu"])
    rows = [(i, i * 7919 - 50_000, -i) for i in range(20_000)]
    df = spark.createDataFrame([*rows, *rows[:100]], null)
    some = spark.createDataFrame([*rows[::40], *rows[::400]], null)  # repeated names don't repeat rows
    kept = [tuple(r) for r in ngram_join._perhaps(df, some).collect()]
    assert set(rows[::40]) <= set(kept) and len(kept) < 600
    assert kept.count(rows[40]) == 2 and kept.count(rows[400]) == 1
    assert ngram_join._perhaps(df, some.limit(0)).count() == 0


def test_ngram_join_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base[: i % 90], f"x{i}", *base[i % 90 + 1 :]]), "en", "a", 0) for i in range(600)]
    assert {c for _, c in near_duplicates(cases.frame(spark, rows)).values()} == {0}


def test_repeated_rows_multiply_no_pairs(spark, monkeypatch):
    """Two near copies in 200 rows each are one pair of sets."""
    words = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(words), "", "", 0), (None, " ".join([*words[:-1], "z"]), "", "", 0)] * 200
    met = []
    whole = ngram_join._verify
    monkeypatch.setattr(ngram_join, "_verify", lambda pairs, sets: met.append((pairs.count(), sets.count())) or whole(pairs, sets))
    found = ngram_join.near_duplicates(cases.frame(spark, rows)).select("t", "label").distinct().collect()
    assert len({r.t for r in found}) == 2 and len({r.label for r in found}) == 1
    assert met[0] == (1, 2) and met[1][0] <= 1


def test_keep_one_keeps_columns_and_texts_without_words(docs, rows):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in cases.components(rows).items() if i == c}


def test_keep_one_of_equal_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "b", 0)] * 5 + [(1, text, "en", "a", 0)] + [(None, text.replace("w", "z"), "en", "a", 0)] * 4
    rows += [(2, "quite other words", "en", "a", 0), (3, None, "en", "a", 0), (3, None, "en", "a", 0)]
    want = sorted([rows[5], rows[6], *rows[10:]], key=str)
    df = cases.frame(spark, rows)
    assert sorted(map(tuple, ngram_join.keep_one(df).collect()), key=str) == want
    more = ngram_join.keep_one(df.withColumn("more", F.create_map("source", "n_chars")))  # a column without order
    assert sorted((tuple(r)[:-1] for r in more.collect()), key=str) == want


def test_repeated_ids_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "", "", 0), (1, text, "", "", 0), (1, "other words here now then", "", "", 0), (None, text, "", "", 0), (None, None, "", "", 0)]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    found = ngram_join.near_duplicates(df).select(real_id(F.col("d")).alias("i"), "n", real_id(F.col("label.d")).alias("c")).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, 56, None), (1, 56, None), (1, 1, 1), (None, 56, None), (None, 0, None)], key=str)
    assert repeated_windows.remove_repeats(df).where("n_removed > 0").count() == 2  # the null id counts as earlier
    assert repeated_bytes.remove_repeats(df).count() == len(rows)
    assert packing_rows(spark, df).count() == len(rows)
    assert mixing.mix(df).count() == len(rows)


def test_texts_of_one_id_and_equal_32_bit_hash(spark):
    """Two texts that Spark's 32-bit hash doesn't tell apart are documents of their own."""
    body = " ".join(f"w{i}" for i in range(90))
    df = spark.createDataFrame([(None, f"{p} {body}") for p in CLASHING], "doc_id bigint, text string")
    assert df.select(F.hash("text")).distinct().count() == 1
    assert [r.n_removed > 300 for r in repeated_bytes.remove_repeats(df).collect()] == [True, True]
    assert sorted(r.n_removed for r in repeated_windows.remove_repeats(df).collect()) == [0, 90]
    assert ngram_join.keep_one(df).count() == 1


def test_repeated_bytes(docs, rows):
    found = repeated_bytes.remove_repeats(docs.select("doc_id", "text", "p"))
    assert found.columns == ["doc_id", "text", "p", "n_bytes", "n_removed", "n_spans", "kept"]
    want = cases.without_repeats(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()} == want
    stripped = repeated_bytes.strip(docs)
    assert stripped.columns == docs.columns
    assert {r.doc_id: r.text for r in stripped.collect()} == {i: v[3].decode("utf-8", "ignore") for i, v in want.items()}


def test_repeated_bytes_of_hot_anchors(spark, docs, rows):
    """All strings dealt one by one give the same result, and a passage of all documents doesn't meet in one part."""
    found = repeated_bytes.remove_repeats(docs, hot=2)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()} == cases.without_repeats(rows)
    rnd = random.Random(3)
    noise = lambda: "".join(rnd.choices("abcdefghij", k=260))
    passage = noise()
    hot_rows = [(i, noise() + passage + noise(), "en", "a", 0) for i in range(1500)]
    hot_docs = cases.frame(spark, hot_rows)
    found = repeated_bytes.remove_repeats(hot_docs, hot=500)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()} == cases.without_repeats(hot_rows)

    def largest_share(hot: int) -> float:
        sent = repeated_bytes.surroundings(keyed(hot_docs, "doc_id", "text"), 50, hot).select("p", F.explode("o").alias("o")).where("o != -1")
        sizes = [r["count"] for r in sent.groupBy("p").count().collect()]
        return max(sizes) / sum(sizes)

    assert largest_share(500) < 0.1 < largest_share(1 << 40)


def test_repeated_windows(docs, rows):
    found = repeated_windows.remove_repeats(docs)
    assert found.columns == [*docs.columns, "n_words", "n_removed", "kept_text"]
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in found.collect()} == cases.without_later_windows(rows)


def test_bpe_round_trip_equals_the_library(docs, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.default_path())
    special = [(900, "It's they'RE <|startoftext|>x<|endoftext|> ΣΑΣ İ a\x1c!\x1db 　 ź 12"), (901, "<|endoftext|>")]
    more = docs.sparkSession.createDataFrame(special, "doc_id bigint, text string")
    coded = bpe.encode(docs.select("doc_id", "text", "p").unionByName(more, allowMissingColumns=True), decoded=True)
    assert coded.columns == ["doc_id", "text", "p", "ids", "decoded"]
    again = bpe.decode(coded.drop("decoded"))
    for r, same in ((r, r2) for r, r2 in zip(coded.orderBy("doc_id").collect(), again.orderBy("doc_id").collect(), strict=True)):
        want = tok.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == same.decoded == tok.decode(want, skip_special_tokens=False)


def test_bpe_cuts_every_letter_as_the_library_does():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(bpe.default_path()), bpe.Bpe(bpe.default_path())
    store = bpe.WordIds(own.encode_words)
    texts = [f"a{chr(c)}b {chr(c)} x{chr(c)}. {chr(c)}'s" for c in [*range(0x600), *range(0x1E00, 0x2100)]]
    ids, starts = store.encode(texts)
    for i, e in enumerate(tok.encode_batch(texts, add_special_tokens=False)):
        assert ids[starts[i] : starts[i + 1]].tolist() == e.ids, texts[i]


def packing_rows(spark, df, **options):
    from tierline.session import scratch_path

    folder = scratch_path(spark, "test-shards")
    packing.write_shards(df, folder, **options)
    return packing.with_corpus_start(packing.read_shards(spark, folder, batch_ids=500))


def test_packed_ids_round_trip(spark, docs, rows):
    import numpy as np
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.default_path())
    got = {r.doc_id: (r.start, r.n_tokens, bytes(r.ids_le)) for r in packing_rows(spark, docs, block_ids=777).collect()}
    start = 0
    for i, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        assert got[i] == (start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_packing_asks_for_each_piece_once():
    """Case and punctuation make no new word of a plain one."""
    from tierline.llm.word_ids import PieceIds

    asked: list[str] = []

    def encode(words):
        asked.extend(words)
        return [[ord(c) for c in w] for w in words]

    store = PieceIds(encode)
    ids, starts = store.encode(["Élan élan, ÉLAN! x2 elan", None or "", "élan. x2, élan,"])
    text = lambda k: "".join(map(chr, ids[starts[k] : starts[k + 1]]))
    assert [text(0), text(1), text(2)] == ["élan élan ,élan !x2 elan ", " ", "élan .x2, élan ,"]
    assert sorted(asked) == sorted(set(asked)) == sorted(["", " ", " ,", " !", " .", "élan", "elan", "x2", "x2,"])


def test_packing_cuts_every_letter_as_the_library_does():
    from tokenizers import Tokenizer

    tok, store = Tokenizer.from_file(bpe.default_path()), packing._tokenizer(bpe.default_path())[1]
    texts = [f"a{chr(c)}b {chr(c)} x{chr(c)}. A{chr(c)}Z?! {chr(c)}, {chr(c)}{chr(c)}'s .{chr(c)}" for c in [*range(0x600), *range(0x1E00, 0x2100)]]
    for _ in range(2):  # met and not met before
        ids, starts = store.encode(texts)
        for i, e in enumerate(tok.encode_batch(texts, add_special_tokens=False)):
            assert ids[starts[i] : starts[i + 1]].tolist() == e.ids, texts[i]


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_pack_any_width(bits):
    import numpy as np

    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, np.uint64).astype(np.uint32)
    packed = packing.pack(ids, bits)
    assert len(packed) == (1001 * bits + 7) // 8
    assert (packing.unpack(packed, 1001, bits) == ids).all()


def test_shard_random_access():
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([5, None, 9]), pa.array(["a b c " * 50, None, "tail"])], names=["id", "text"])
    data = b"".join(r + b"\n" for r in packing._shard_records(iter([batch]), bpe.default_path(), 2, 16))
    shard = packing.Shard(data)
    assert shard.nulls.tolist() == [False, True, False]
    assert shard.document(1).tolist() == [2]
    whole = shard.ids(0, shard.n_ids)
    assert all((shard.ids(a, a + 5) == whole[a : a + 5]).all() for a in range(0, shard.n_ids - 5, 7))
    assert np.concatenate([shard.document(k) for k in range(3)]).tolist() == whole.tolist()


def test_mix_targets_and_copies(docs, rows):
    mixed = mixing.mix(docs.drop("size", "rate", "copies")).collect()
    size = {i: len(cases.words(t)) for i, t, *_ in rows}
    own: dict = {}
    for i, _, _, s, _ in rows:
        own[s] = own.get(s, 0) + size[i]
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted((s for s in own if s is not None)) + [None])}
    full: set = set()
    while True:
        level = (sum(own.values()) - sum(3 * own[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in own if s not in full and weight[s] * level > 3 * own[s]}
        if not more:
            break
        full |= more
    for r in mixed:
        assert r["size"] == size[r.doc_id] and r.source_size == own[r.source]
        assert r.target == pytest.approx(3 * own[r.source] if r.source in full else weight[r.source] * level)
        assert r.copies in (int(r.rate), int(r.rate) + 1) and r.copies <= 3
    assert sum({r.source: r.target for r in mixed}.values()) == pytest.approx(sum(own.values()))
    again = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(2)).collect()}
    assert again == {r.doc_id: r.copies for r in mixed}
    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns
    assert emitted.count() == sum(again.values())


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "abc"[i % 3], 0) for i in range(6000)]
    taken, target = {}, {}
    for r in mixing.mix(cases.frame(spark, rows)).collect():
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        target[r.source] = r.target
    for s in target:
        assert taken[s] == pytest.approx(target[s], rel=0.05)


def test_mix_of_null_and_repeated_ids_comes_near_its_targets(spark):
    """Rows without an id, of one id, and equal rows have draws of their own; a rerun takes as many."""
    for change in (lambda i: (None, "w " * 100), lambda i: (7, "w " * 100), lambda i: (None, f"w{i} " * 100), lambda i: (i, "w " * 100)):
        rows = [(*change(i), "en", "a" if i < 1000 else "b", 0) for i in range(1600)]
        found = []
        for parts in (5, 3):
            taken, seen = {}, {}
            for r in mixing.mix(cases.frame(spark, rows, parts)).collect():
                taken[r.source] = taken.get(r.source, 0) + r.copies
                seen[r.source] = (r.rate, r.target)
            found.append(taken)
            for s, (rate, target) in seen.items():
                n = 1000 if s == "a" else 600
                assert abs(taken[s] - target / 100) <= 3 * (n * (rate % 1) * (1 - rate % 1)) ** 0.5 + 1e-6
        assert found[0] == found[1]


def test_columns_of_any_name_stay(spark, docs):
    """Also those that operators use inside keep their values."""
    plain = [c for c in cases.CLASHES.split() if c not in ("size", "copies", "rate", "kept")]
    want = [i for i, c in enumerate(cases.CLASHES.split()) if c in plain]
    for out in (mixing.mix(docs), quality_rules.judge(docs)):
        assert [out.first()[c] for c in plain] == want


def test_word_store_keeps_two_generations():
    from tierline.llm.word_ids import WordIds

    asked: list[str] = []

    def encode(words):
        asked.extend(words)
        return [[len(w), ord(w[0])] if w else [] for w in words]

    store = WordIds(encode, max_words=3, max_ids=100)
    for text in ("a bb ccc", "dddd a", "a e f g", "a h", "bb"):
        ids, starts = store.encode([text, ""])
        assert ids.tolist() == [x for w in text.split() for x in (len(w), ord(w[0]))] and starts.tolist() == [0, len(ids), len(ids)]
    assert asked.count("a") == 1 and asked.count("bb") == 2


def test_shards_of_repeated_ids_are_the_same_in_every_run(spark):
    rows = [(i % 3 or None, f"text number {i % 40} here", "en", "a", 0) for i in range(300)]
    runs = [sorted(packing_rows(spark, cases.frame(spark, rows, parts)).select("start", "n_tokens", "ids_le").collect()) for parts in (2, 7)]
    assert [r.n_tokens for r in runs[0]] == [r.n_tokens for r in runs[1]]
    assert [bytes(r.ids_le) for r in runs[0]] == [bytes(r.ids_le) for r in runs[1]]


def test_quality_measures(docs, rows):
    judged = quality_rules.judge(docs)
    for r in judged.collect():
        w = cases.words(rows[r.doc_id][1])
        grams: dict = {}
        for a in range(len(w) - 2):
            grams.setdefault(tuple(w[a : a + 3]), []).append(a)
        covered = {b + k for at in grams.values() if len(at) > 1 for b in at for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in judged.where("kept").collect()}


def test_quality_keeps_clean_text_and_rejects_junk(spark):
    small = "the of and to in is that for on with".split()
    line = " ".join(f"{small[i % 10]} thing{'abcdefghij'[i // 10]}{'klmnopqrst'[i % 10]}" for i in range(60))
    texts = {
        "clean": line,
        "symbols": " ".join(w + "###" for w in line.split()),
        "shouting": line.upper().replace(" ", "!! "),
        "lists": " | ".join(f"entry{i}" for i in range(90)),
        "lines": "\n".join([line] + ["See the terms of use."] * 6),
        "short": "the cat",
        "marked": "\n".join(f"(The {w}s) “{w}x” FÜR, {w}." for w in line.split() if w.startswith("thing")),
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    assert {r["name"]: r.kept for r in quality_rules.judge(df).collect()} == {k: k in ("clean", "marked") for k in texts}
    others = quality_rules.judge(df, stop_words={"xx": "thingak"}).where("kept").count()
    assert others == 0


def test_empty_tables(spark, empty):
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.keep_one(empty).count() == 0
    assert repeated_bytes.strip(empty).count() == 0
    assert repeated_windows.remove_repeats(empty).count() == 0
    assert bpe.encode(empty, decoded=True).count() == 0
    assert packing_rows(spark, empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert mixing.emit(empty).count() == 0
    assert quality_rules.keep(empty).count() == 0
