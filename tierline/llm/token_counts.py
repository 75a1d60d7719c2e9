"""Token counts of texts, kept in a cache by digests of content and tokenizer.

A count depends on the text and on the tokenizer alone. The cache is a Parquet table in
shared storage of ``(digest, n_tokens)``, with one folder per tokenizer version:

1. The rows are grouped by the SHA-256 of their content, each task collapsing its own
   copies first, so a text that a third of all rows hold is moved once per task.
2. Digests that the cache lacks for this version are the misses. One text of each is
   encoded, and its count is appended to the cache.
3. Every row gets its count from the cache, by its digest. Digests of very many rows are
   joined apart from the others (``common.attach``).

The version is the SHA-256 of the library's name and version and of the tokenizer's file,
so another file or library counts anew. Content is normalised only as far as no count can
change: null becomes the empty string. White space and case matter to tokenizers, so they
stay. Jobs that append at the same time may add a digest twice, with the same count; such
rows are read as one. A job that fails before its append is committed adds nothing.

A text is cut into pieces that the tokenizer's own rules never join, and each worker keeps
the counts of the pieces it met, in bounded memory. With a byte-level vocabulary whose
rules cut before a blank (see ``cuts_before_blanks``), a piece is a blank and what follows
up to the next one; all other tokenizers are given whole texts.

Defined cases: a null text counts as an empty one, of 0 tokens; special strings in a text
are treated as the library does by default; repeated rows get one count each; an empty
table gives an empty one and adds nothing; other columns, of whatever name, are kept, but
for ``n_tokens``, which the result replaces.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from importlib.metadata import version as installed

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.bpe import byte_characters
from tierline.llm.common import attach, read_table
from tierline.llm.word_ids import MODELS, PUNCTUATION, text_batches
from tierline.session import scratch_path

LIMIT = 1024
MAX_PIECES = 250_000  # of each of two generations
MAX_CHARACTERS = 4_000_000
BATCH_BYTES = 8 << 20
CACHE_SCHEMA = "digest binary, n_tokens bigint, version string"
#: Before a blank that follows something else than white space.
_CUT = re.compile(r"(?<=\S)(?= )")


def tokenizer_version(path: str) -> str:
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{library} {installed(library)} {content}".encode()).hexdigest()


def cuts_before_blanks(rules: dict) -> bool:
    """Whether these rules (a tokenizer's JSON) always cut before a blank that follows no white space: a byte-level
    vocabulary that changes no text, and special strings without blanks that take none from their surroundings."""
    cutter = rules.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space", True)
    special = [t for t in rules.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]]
    model = rules["model"]
    exact = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    return bool(plain and rules.get("normalizer") is None and not special and model.get("type", "BPE") == "BPE" and exact)


class Kept:
    """Counts by piece in two generations: when the younger is full it becomes the older, so what is often met stays."""

    def __init__(self, max_pieces: int = MAX_PIECES, max_characters: int = MAX_CHARACTERS):
        self._limits = max_pieces, max_characters
        self._young: dict[str, int] = {}
        self._old: dict[str, int] = {}
        self._characters = 0

    def get(self, piece: str) -> int | None:
        n = self._young.get(piece)
        if n is None:
            n = self._old.get(piece)
            if n is not None:
                self.put(piece, n)
        return n

    def put(self, piece: str, n: int) -> None:
        self._young[piece] = n
        self._characters += len(piece)
        if len(self._young) >= self._limits[0] or self._characters >= self._limits[1]:
            self._young, self._old, self._characters = {}, self._young, 0


class PieceCounter:
    """Counts of whole texts from the counts of their pieces, for tokenizers that cut before blanks."""

    def __init__(self, tokenizer, kept: Kept | None = None):
        self._tok, self._kept, self._characters = tokenizer, kept or Kept(), byte_characters()

    def _plain(self, piece: str) -> int:
        """Of a piece that the rules keep whole: letters with or without a blank before them, or marks alone."""
        n = self._kept.get(piece)
        if n is None:
            n = len(self._tok.model.tokenize("".join(map(self._characters.__getitem__, piece.encode()))))
            self._kept.put(piece, n)
        return n

    def pieces(self, found: Sequence[str]) -> np.ndarray:
        """The number of tokens of each of ``found``."""
        out, others = np.zeros(len(found), np.int64), []
        for i, piece in enumerate(found):
            stem = piece.rstrip(PUNCTUATION)
            letters = stem[1:] if stem[:1] == " " else stem
            if letters.isalpha() and max(letters) < "ɐ":
                out[i] = self._plain(stem) + (self._plain(piece[len(stem) :]) if len(stem) < len(piece) else 0)
            elif piece:
                n = self._kept.get(piece)
                if n is None:
                    others.append(i)
                else:
                    out[i] = n
        for a in range(0, len(others), 1000):  # the library's results are large
            some = others[a : a + 1000]
            for i, e in zip(some, self._tok.encode_batch_fast([found[i] for i in some], add_special_tokens=False), strict=True):
                out[i] = len(e.ids)
                if len(found[i]) <= 100:
                    self._kept.put(found[i], len(e.ids))
        return out

    def __call__(self, texts: pa.Array) -> np.ndarray:
        cut = pc.split_pattern(texts, " ")
        numbered = cut.flatten().dictionary_encode()
        codes, distinct = np.asarray(numbered.indices), numbered.dictionary.to_pylist()
        starts = np.asarray(cut.offsets).astype(np.int64)
        starts = starts - starts[0]
        first, last = starts[:-1], starts[1:] - 1  # the empty string is one empty part
        counts = self.pieces([" " + x for x in distinct])[codes]
        counts[first] = self.pieces([distinct[c] for c in codes[first]])
        out = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        # A blank after white space is no such place: those texts are cut one by one.
        open_end = np.fromiter((not x or x[-1].isspace() for x in distinct), bool, len(distinct))[codes]
        open_end[last] = False
        for i in np.flatnonzero(np.add.reduceat(open_end, first) if len(first) else first):
            out[i] = self.pieces(_CUT.split(texts[int(i)].as_py())).sum()
        return out


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer, and whether its texts may be cut before blanks."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path), False
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as file:
        return tok, cuts_before_blanks(json.load(file))


MODELS["token_counts"] = _tokenizer.cache_clear


def counter(path: str) -> Callable[[pa.Array], np.ndarray]:
    """From texts to their numbers of tokens. What it keeps lives as long as the function that is returned."""
    tok, pieces = _tokenizer(path)
    if pieces:
        return PieceCounter(tok)
    if path.endswith(".model"):
        return lambda texts: np.array([len(x) for x in tok.encode(texts.to_pylist(), num_threads=1)], np.int64)
    return lambda texts: np.array([len(e.ids) for e in tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)], np.int64)


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """digest, n_tokens of one tokenizer version, each digest once."""
    found = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
    return found.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def digest_of(text_col: str):
    content = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return F.unhex(F.sha2(content.cast("binary"), 256)), content


def add_misses(df: DataFrame, cache: str, *, text_col: str = "text", path: str) -> None:
    """Encode one text of each digest of ``df`` that the cache lacks, and append the counts to it."""
    spark, version = df.sparkSession, tokenizer_version(path)
    spark.createDataFrame([], CACHE_SCHEMA).write.partitionBy("version").mode("ignore").parquet(cache)
    digest, content = digest_of(text_col)
    distinct = df.select(digest.alias("digest"), content.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(read_cache(spark, cache, version).select("digest"), "digest", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in text_batches(batches, "text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(count(batch.column("text")), pa.int64())], names=["digest", "n_tokens"])

    counted = misses.select("digest", "text").mapInArrow(run, "digest binary, n_tokens bigint")
    counted.withColumn("version", F.lit(version)).write.partitionBy("version").mode("append").parquet(cache)


def count_tokens(df: DataFrame, cache: str, *, text_col: str = "text", path: str, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``n_tokens``; ``cache`` is a folder that all executors share."""
    add_misses(df, cache, text_col=text_col, path=path)
    digest, _ = digest_of(text_col)
    others = [c for c in (df.columns if keep is None else keep) if c.lower() != "n_tokens"]
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), digest.alias("digest"))
    copies = df.select(digest.alias("digest")).groupBy("digest").agg(F.count("*").alias("_copies"))
    table = copies.join(read_cache(df.sparkSession, cache, tokenizer_version(path)), "digest")
    return attach(rows, table, "digest", "_copies").select("_row.*", "n_tokens")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counts through a cache of its own, empty at first."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    counted = count_tokens(docs, scratch_path(spark, "token-counts"), path=public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id", "n_bytes"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
