"""Token counts against the libraries, and what the cache holds."""

from __future__ import annotations

import random
import unicodedata

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import cases
from tierline.llm import common, token_counts as tc

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def by_library(path: str, texts: list[str]) -> list[int]:
    if path.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def odd_texts(n: int = 400) -> list[str]:
    rnd = random.Random(11)
    parts = ["a", "The", "don't", "it's", "'s", "3rd", "x1.5", "...", ",", "!?", "é", "ß", "naïve", "Ünder.", "日本", "ª", "ı", "İ", "😀"]
    parts += ["<|endoftext|>", "<|endoftext", "|>", " ", "　", "\x1c", "\x85", "​", "é", "_", "foo_bar", "w" * 150]
    parts += [chr(rnd.choice([*range(0x20, 0x2000), 0x2028, 0x2029, 0x205F])) for _ in range(200)]
    blanks = ["", " ", " ", " ", "  ", "   ", "\n", " \n", "\n ", "\t", "\r\n", " \t "]
    return ["".join(rnd.choice(parts) + rnd.choice(blanks) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_pieces_against_library():
    texts = ["", " ", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "\n", *odd_texts()]
    texts += [f"x{chr(c)} {chr(c)}y {chr(c)} z" for c in range(0x20, 0x3100) if unicodedata.category(chr(c)) != "Cs"]
    count = tc.counter(BYTES)
    assert isinstance(count, tc.PieceCounter)
    want = by_library(BYTES, texts)
    assert count(pa.array(texts)).tolist() == want
    assert count(pa.array(texts)[3:]).tolist() == want[3:]  # from what is kept, of a slice
    small = tc.PieceCounter(tc._tokenizer(BYTES)[0], tc.Kept(7, 50))
    assert small(pa.array(texts)).tolist() == want
    assert len(small._kept._young) <= 7 and len(small._kept._old) <= 7
    assert count(pa.array([], pa.string())).tolist() == []


@pytest.mark.parametrize("path", [WORDS, PIECES])
def test_other_tokenizers_get_whole_texts(path):
    texts = odd_texts(60)
    assert not isinstance(tc.counter(path), tc.PieceCounter)
    assert tc.counter(path)(pa.array(texts)).tolist() == by_library(path, texts)


def test_rules_that_join_over_blanks():
    rules = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "model": {"type": "BPE"}, "added_tokens": []}
    assert tc.cuts_before_blanks(rules)
    token = {"content": "<x>", "lstrip": True, "rstrip": False, "single_word": False}
    for change in ({"normalizer": {"type": "NFC"}}, {"added_tokens": [token]}, {"pre_tokenizer": None}, {"model": {"type": "BPE", "dropout": 0.1}}):
        assert not tc.cuts_before_blanks(rules | change)


def test_cache_is_asked_first_and_appended_to(spark, tmp_path, monkeypatch):
    cache = str(tmp_path / "cache")
    rows = [(1, "one two", "en", "a", 0), (2, "one two", "en", "a", 0), (2, "one two", "en", "a", 0), (None, None, None, None, None), (3, "", "", "", 0)]
    df = cases.with_clashes(cases.frame(spark, rows)).withColumn("N_Tokens", F.lit("x"))
    read = lambda: {bytes(r.digest): r.n_tokens for r in spark.read.parquet(cache).collect()}
    first = tc.count_tokens(df, cache, path=BYTES)
    assert first.columns == [*df.columns[:-1], "n_tokens"]
    assert sorted((r.doc_id or 0, r.n_tokens) for r in first.collect()) == [(0, 0), (1, 2), (2, 2), (2, 2), (3, 0)]
    assert sorted(read().values()) == [0, 2]  # two contents
    assert spark.read.parquet(cache).count() == 2
    # What the cache says is believed: known content is not encoded again.
    known = spark.read.schema(tc.CACHE_SCHEMA).parquet(cache).withColumn("n_tokens", F.col("n_tokens") + 100)
    other = str(tmp_path / "other")
    known.write.partitionBy("version").parquet(other)
    known.write.partitionBy("version").mode("append").parquet(other)  # the same digests, appended twice
    more = df.unionByName(df.limit(1).withColumn("text", F.lit("new here now")))
    assert sorted(r.n_tokens for r in tc.count_tokens(more, other, path=BYTES, keep=["doc_id"]).collect()) == [3, 100, 100, 102, 102, 102]
    assert spark.read.parquet(other).count() == 5
    # Another tokenizer is another version.
    tc.count_tokens(df, cache, path=WORDS)
    assert spark.read.parquet(cache).groupBy("version").count().count() == 2
    assert tc.count_tokens(df.limit(0), str(tmp_path / "none"), path=BYTES).collect() == []


def test_attach_spreads_heavy_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(-1, None), (-2, "lacking")], "i int, k string")
    table = rows.where("k is not null and k <> 'lacking'").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("v"))
    got = common.attach(rows, table, "k", "n")
    assert got.columns == ["i", "k", "v"]
    assert {r.i: r.v for r in got.collect()} == {i: 299 if i % 3 else i for i in range(300)} | {-1: None, -2: None}
    assert got.count() == 302


def test_query_against_library(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    want = [(i, len(t.encode()), n, n > 1024) for (i, t), n in zip(docs.items(), by_library(BYTES, list(docs.values())), strict=True)]
    got = tc.query(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
