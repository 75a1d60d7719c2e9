"""Token files: ids in the fewest bits the vocabulary needs, read by block.

A corpus is a folder of shards in ascending id order, each written by one task with
Spark's own file writer, so a lost executor leaves no half shard. A shard is

- one record per block: ``bits`` bits for each of ``block_ids`` ids (fewer in the
  last), most significant bit first, filled up to a whole byte;
- one index record: document ids (int64), their null flags (uint8), where each
  document's ids begin in the shard, one more at the end (int64), where each block
  begins in the file (int64), then the trailer (see ``_TRAILER``);
- and, after every record, one line feed.

The trailer has a fixed size, so a reader finds the index from the end of the file,
and from the index the block and bit of any id. Blocks unpack with numpy.

Defined cases: a null or empty text has only the end id; a null id comes first and is
flagged; documents with one id follow each other in the order of 128 bits of hashes of their
texts, so reruns agree; an empty table gives no documents; other columns are not stored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tierline.llm.bpe import byte_characters
from tierline.llm.common import read_table, stored
from tierline.llm.word_ids import MODELS, PieceIds, plain_pieces, text_batches, texts_of, tidy
from tierline.session import scratch_path

BLOCK_IDS = 1 << 16
END_ID = 2
_MAGIC = b"tlpack01"
# Magic, bits, ids a block, documents, ids, blocks, where the index begins.
_TRAILER = struct.Struct("<8sIIqqqq")


def bits_for(vocab_size: int) -> int:
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    whole = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return whole[:, 4 - bits // 8 :].tobytes()
    rows = np.unpackbits(whole, axis=1)
    return np.packbits(rows[:, 32 - bits :]).tobytes()


def unpack(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    if bits % 8 == 0:
        whole = np.zeros((n, 4), np.uint8)
        whole[:, 4 - bits // 8 :] = np.frombuffer(data, np.uint8, n * bits // 8).reshape(n, bits // 8)
        return whole.view(">u4").ravel().astype(np.uint32)
    rows = np.zeros((n, 32), np.uint8)
    rows[:, 32 - bits :] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    return np.packbits(rows, axis=1).view(">u4").ravel().astype(np.uint32)


class Shard:
    """Random access to one shard's bytes."""

    def __init__(self, data: bytes | memoryview):
        self._data = memoryview(data)
        magic, self.bits, self.block_ids, docs, self.n_ids, blocks, at = _TRAILER.unpack(self._data[-_TRAILER.size - 1 : -1])
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        parts = []
        for kind, n in (("<i8", docs), ("u1", docs), ("<i8", docs + 1), ("<i8", blocks)):
            parts.append(np.frombuffer(self._data, kind, n, at))
            at += parts[-1].nbytes
        self.doc_ids, nulls, self.starts, self._blocks = parts
        self.nulls = nulls.astype(bool)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, unpacking only the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        out = []
        for b in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - b * self.block_ids)
            at = int(self._blocks[b])
            out.append(unpack(self._data[at : at + (n * self.bits + 7) // 8], n, self.bits))
        return np.concatenate(out)[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The vocabulary's size and a store of pieces' and words' ids as the tokenizers library gives them.

    A plain word's pieces go to the library's model directly; other words take the library's whole way.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    tokenize, characters = tok.model.tokenize, byte_characters()

    def ids_of(piece: str) -> list[int]:
        letters = piece if piece.isascii() else "".join(map(characters.__getitem__, piece.encode()))
        return [t.id for t in tokenize(letters)] if letters else []

    def encode(words: list[str]) -> list[list[int]]:
        out, others = [], []
        for word in words:
            if word[:1] == " ":  # punctuation after a plain word
                out.append(ids_of(word[1:]))
            elif cut := plain_pieces(word):
                out.append(ids_of(cut[0]) + ids_of(cut[1]))
            else:
                others.append(len(out))
                out.append([])
        for a in range(0, len(others), 1000):  # the library's results are large
            batch = others[a : a + 1000]
            for i, e in zip(batch, tok.encode_batch_fast([words[i] for i in batch], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return out

    return tok.get_vocab_size(with_added_tokens=True), PieceIds(encode)


MODELS["packing"] = _tokenizer.cache_clear


def _shard_records(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_ids: int) -> Iterator[bytes]:
    vocab, store = _tokenizer(path)
    bits = bits_for(max(vocab, end_id + 1))
    doc_ids, nulls, lengths, offsets = [], [], [], []
    rest, at, total = np.empty(0, np.int32), 0, 0
    for batch in text_batches(batches, "text"):
        ids, starts = store.encode(texts_of(batch, "text"))
        ids = np.insert(ids, starts[1:], end_id)
        column = batch.column("id")
        nulls.append(np.asarray(column.is_null()).astype(np.uint8))
        doc_ids.append(np.asarray(column.fill_null(0)).astype("<i8"))
        lengths.append(np.diff(starts) + 1)
        total += len(ids)
        rest = np.concatenate([rest, ids])
        while len(rest) >= block_ids:
            record, rest = pack(rest[:block_ids], bits), rest[block_ids:]
            offsets.append(at)
            at += len(record) + 1
            yield record
    if not doc_ids:
        return
    if len(rest):
        record = pack(rest, bits)
        offsets.append(at)
        at += len(record) + 1
        yield record
    starts = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<i8")
    index = [np.concatenate(doc_ids), np.concatenate(nulls), starts, np.array(offsets, "<i8")]
    trailer = _TRAILER.pack(_MAGIC, bits, block_ids, len(starts) - 1, total, len(offsets), at)
    yield b"".join(x.tobytes() for x in index) + trailer


def write_shards(
    df: DataFrame,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text, add ``end_id`` and write the shards in ascending id order (null first)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    # Documents of one id are ordered by hashes of their texts, so that reruns agree and one id's rows fill several shards.
    text = F.col(text_col).cast("string")
    order = [F.col("id").asc_nulls_first(), F.col("t"), F.col("u")]
    named = df.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit(1), text).alias("u"))
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    @partial(tidy, model="packing")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in _shard_records(batches, path, end_id, block_ids):
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["record"])

    # The text writer puts a string's bytes as they are, and then a line feed.
    ordered.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")).write.text(folder)


def read_shards(spark: SparkSession, folder: str, *, batch_ids: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, shard (file name), start (its first id's place in the shard),
    n_tokens, ids_le (its ids as little-endian unsigned 32-bit integers)."""
    schema = "doc_id bigint, shard string, start bigint, n_tokens bigint, ids_le binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                if not content.as_buffer().size:
                    continue
                shard = Shard(content.as_buffer())
                k, n = 0, len(shard.doc_ids)
                while k < n:  # whole documents, about batch_ids ids at a time
                    stop = max(k + 1, int(np.searchsorted(shard.starts, shard.starts[k] + batch_ids, "right")) - 1)
                    begin = shard.starts[k : stop + 1]
                    values = shard.ids(int(begin[0]), int(begin[-1])).astype("<u4")
                    offsets = pa.py_buffer(((begin - begin[0]) * 4).astype("<i4").tobytes())
                    raw = pa.Array.from_buffers(pa.binary(), stop - k, [None, offsets, pa.py_buffer(values.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[k:stop], pa.int64(), mask=shard.nulls[k:stop]),
                            pa.array([name.rpartition("/")[2]] * (stop - k), pa.string()),
                            pa.array(begin[:-1], pa.int64()),
                            pa.array(np.diff(begin), pa.int64()),
                            raw,
                        ],
                        names=["doc_id", "shard", "start", "n_tokens", "ids_le"],
                    )
                    k = stop

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, schema)


def with_corpus_start(docs: DataFrame) -> DataFrame:
    """``start`` counted over the whole corpus: shards follow each other by name."""
    sizes = docs.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))  # one row per file
    before = W.orderBy(F.length("shard"), "shard").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("_before"))
    return docs.join(starts, "shard").withColumn("start", F.col("start") + F.col("_before")).drop("_before")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-shards")
    write_shards(read_table(spark, sf_dir, "documents"), folder)
    docs = read_shards(spark, folder).withColumn("ids_crc32", F.crc32("ids_le")).drop("ids_le")
    return with_corpus_start(stored(docs, "token-index")).select("doc_id", "start", "n_tokens", "ids_crc32")
