"""Byte-pair encoding with a pair occurrence index, and decoding.

The distinct words of a batch are laid out as one linked list of symbols. An index
maps every mergeable pair to all its places; active ranks are taken in ascending
order from a heap, all places of a rank's pair are merged, and the lists of the
pairs that this makes are extended. Places that an earlier merge has consumed are
recognised when their list is reached. The vocabulary's merges must build larger
symbols after their parts (checked on loading), which makes this order equal to
merging each word alone.

The vocabulary is a file of the tokenizers library: BPE with word ends over
byte-level characters, text in NFC and lower case, white space dropped. Its path is
a parameter and must exist on the executors.

Defined cases: null and empty texts have no ids and decode to the empty string;
strings of special tokens in a text become their ids; other columns are kept, but
for those that carry a result's name, which the result replaces.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tierline.llm.common import read_table
from tierline.llm.word_ids import MODELS, WordIds, plain_pieces, text_batches, texts_of, tidy

#: Fixed value of the vocabulary: what a word is cut into.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


#: What a worker keeps of words and pieces, in each of two generations, and takes at a time. Spark keeps idle workers,
#: so this stays in memory beside other steps.
MAX_WORDS, MAX_IDS, MAX_PIECES = 130_000, 1_000_000, 80_000
BATCH_BYTES = 2 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> list[str]:
    """The visible character that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merge = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
        self.by_rank = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        made: dict[int, int] = {}
        for r, (a, b, c) in enumerate(self.by_rank):
            if made.get(a, -1) >= r or made.get(b, -1) >= r:
                raise ValueError("a merge uses a symbol that a later merge makes")
            made.setdefault(c, r)
        used: dict[int, int] = {}
        for r, (a, b, _) in enumerate(self.by_rank):
            used.setdefault(a, r)
            used.setdefault(b, r)
        if any(used.get(c, len(merges)) <= r for r, (_, _, c) in enumerate(self.by_rank)):
            raise ValueError("a symbol is used before one of the merges that make it")
        characters = byte_characters()
        self.inner = [vocab[c] for c in characters]
        self.last = [vocab[c + suffix] for c in characters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: t for t, i in (vocab | self.special).items()}
        self.tokens = pa.array([tokens.get(i, "") for i in range(max(tokens) + 1)], pa.string())
        # Beyond Latin letters, Unicode versions differ: there the file's own text rules cut the word.
        rules = Tokenizer.from_file(path)
        self._normal, self._cut = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self._byte = {c: b for b, c in enumerate(characters)}
        self._kept: dict[bytes, tuple[int, ...]] = {}
        self._older: dict[bytes, tuple[int, ...]] = {}
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, all pieces merged together through one pair index."""
        symbol: list[int] = []
        ends: list[int] = []
        for piece in pieces:
            symbol += map(self.inner.__getitem__, piece[:-1])
            symbol.append(self.last[piece[-1]])
            ends.append(len(symbol))
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        start = 0
        for end in ends:
            before[start], after[end - 1], start = -1, -1, end
        merge, places, active = self.merge, {}, []
        for i, j in enumerate(after):
            if j >= 0 and (m := merge.get((symbol[i], symbol[j]))) is not None:
                if m[0] in places:
                    places[m[0]].append(i)
                else:
                    places[m[0]] = [i]
                    active.append(m[0])
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            a, b, c = self.by_rank[rank]
            found = places.pop(rank)
            found.sort()
            for i in found:
                j = after[i]
                if j < 0 or symbol[i] != a or symbol[j] != b:
                    continue  # consumed by an earlier merge
                k = after[j]
                symbol[i], symbol[j], after[i] = c, -1, k
                pairs = []
                if k >= 0:
                    before[k] = i
                    pairs.append((i, merge.get((c, symbol[k]))))
                h = before[i]
                if h >= 0:
                    pairs.append((h, merge.get((symbol[h], c))))
                for at, m in pairs:
                    if m is not None:
                        if m[0] in places:
                            places[m[0]].append(at)
                        else:
                            places[m[0]] = [at]
                            heapq.heappush(active, m[0])
        out, start = [], 0
        for end in ends:
            out.append([s for s in symbol[start:end] if s >= 0])
            start = end
        return out

    def cut(self, word: str) -> list[bytes | int]:
        """The pieces of a word as bytes, and the ids of special tokens in it."""
        if "<|" in word and self.special_cut.search(word):
            out: list[bytes | int] = []
            for part in self.special_cut.split(word):
                out += [self.special[part]] if part in self.special else self.cut(part)
            return out
        if not word.isascii():
            if max(word) >= "\u0250":
                return [bytes(map(self._byte.__getitem__, p)) for p, _ in self._cut(self._normal(word))]
            word = unicodedata.normalize("NFC", word)
        return [p.encode() for p in PIECES.findall(word.lower())]

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        if len(self._kept) > MAX_PIECES:
            self._kept, self._older = {}, self._kept
        kept, older = self._kept, self._older
        cuts = [[x.encode() for x in plain if x] if (plain := plain_pieces(w)) else self.cut(w) for w in words]
        new = []
        for p in dict.fromkeys(p for c in cuts for p in c if isinstance(p, bytes) and p not in kept):
            if p in older:
                kept[p] = older[p]
            else:
                new.append(p)
        kept.update(zip(new, map(tuple, self.encode_pieces(new)), strict=True))
        return [
            kept[c[0]] if len(c) == 1 and c[0] in kept else tuple(i for p in c for i in (kept[p] if isinstance(p, bytes) else (p,)))
            for c in cuts
        ]


@lru_cache(maxsize=2)
def _model(path: str) -> tuple[Bpe, WordIds]:
    bpe = Bpe(path)
    return bpe, WordIds(bpe.encode_words, MAX_WORDS, MAX_IDS)


MODELS["bpe"] = _model.cache_clear


def _lists(ids: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))


def _decoded(bpe: Bpe, lists: pa.ListArray) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, bpe.tokens.take(lists.values)), " ")


def _replaced(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c.lower() not in names]


def encode(df: DataFrame, text_col: str = "text", *, path: str | None = None, decoded: bool = False) -> DataFrame:
    """``df`` with ``ids`` (array of int), and with ``decoded`` also the text that they decode to."""
    path = path or default_path()
    results = ("ids", "decoded") if decoded else ("ids",)
    kept = _replaced(df, results)
    given = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add("decoded", T.StringType())

    @partial(tidy, model="bpe")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, store = _model(path)
        for batch in text_batches(batches, "_text", BATCH_BYTES):
            lists = _lists(*store.encode(texts_of(batch, "_text")))
            columns = [*batch.columns[:-1], lists, *([_decoded(bpe, lists)] if decoded else [])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(run, schema).toDF(*kept, *results)


def decode(df: DataFrame, ids_col: str = "ids", *, path: str | None = None) -> DataFrame:
    """``df`` with ``decoded``: the tokens of ``ids_col`` joined by blanks; empty for null or no ids."""
    path = path or default_path()
    kept = _replaced(df, ("decoded",))
    ids = F.filter(F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")), lambda i: i.isNotNull())
    given = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), ids.alias("_ids"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = _model(path)
        for batch in batches:
            lists = batch.columns[-1]
            starts = np.asarray(lists.offsets)
            plain = _lists(np.asarray(lists.values)[starts[0] : starts[-1]] if len(lists) else np.empty(0, np.int32), starts - starts[0])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _decoded(bpe, plain)], names=schema.names)

    return given.mapInArrow(run, schema).toDF(*kept, "decoded")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.col("ids")
    return encode(docs, decoded=True).select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
