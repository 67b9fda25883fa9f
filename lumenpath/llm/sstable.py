"""Token ids in sorted-string-table shards.

A shard holds documents in ascending key order: data blocks, a sparse block index, a Bloom
filter over the keys and a footer of fixed length. All integers are little-endian except
inside keys.

    block    zstd of entries: varint shared, varint rest, varint size, rest of key, value
    index    per block: 2-byte key length, its last key, 8-byte offset, 4-byte length
    bloom    BLOOM_BITS bits per key, BLOOM_HASHES probes
    footer   offsets and lengths of index and bloom, entries, tokens, first-key length, magic

A key is one flag byte (0: null) and the id as 8 bytes, big-endian with the sign bit turned,
so that byte order is id order. Inside a block a key stores only what differs from the key
before. A value is one byte with the width of an id (2 or 4) and the ids.
"""

from __future__ import annotations

import bisect
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.llm.bpe_automaton import byte_characters, in_byte_characters, pieces, words
from lumenpath.llm.chunk_table import ChunkTable
from lumenpath.llm.common import held, texts_of
from lumenpath.session import shared_dir

MAGIC = b"LPSST\x00\x00\x01"
FOOTER = struct.Struct("<QQQQQQ8s")
ENTRY = struct.Struct("<QI")
BLOCK_BYTES, SHARD_BYTES, BLOOM_BITS, BLOOM_HASHES = 1 << 16, 1 << 26, 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"\x00" * 9 if doc_id is None else b"\x01" + struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return n, at


def pack_value(ids: np.ndarray) -> bytes:
    return b"\x02" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\x04" + ids.astype("<u4").tobytes()


def unpack_value(value: bytes) -> np.ndarray:
    return np.frombuffer(value, f"<u{value[0]}", offset=1).astype("<u4")


def probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % bits for i in range(BLOOM_HASHES)]


class Writer:
    """Writes one shard to a stream, keeping one open block and the keys' hashes in memory."""

    def __init__(self, out) -> None:
        self.out, self.block, self.raw, self.index, self.keys = out, [], 0, [], []
        self.last = self.before = None
        self.offset = self.tokens = 0
        self.first = b""

    def add(self, key: bytes, ids: np.ndarray) -> None:
        """Keys come in ascending order; equal keys are kept in the order given."""
        if self.last is not None and key < self.last:
            raise ValueError("keys must ascend")
        self.first = self.first or key
        shared = 0
        if self.block:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        value = pack_value(ids)
        entry = varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.block.append(entry)
        self.raw += len(entry)
        self.tokens += len(ids)
        self.keys.append(key)
        self.last = key
        if self.raw >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.block:
            data = zstandard.ZstdCompressor(level=1).compress(b"".join(self.block))
            self.out.write(data)
            self.index.append((self.last, self.offset, len(data)))
            self.offset += len(data)
            self.block, self.raw = [], 0

    def close(self) -> None:
        self._flush()
        index = b"".join(struct.pack("<H", len(k)) + k + ENTRY.pack(o, n) for k, o, n in self.index)
        bits = max(64, BLOOM_BITS * len(self.keys))
        bloom = np.zeros(bits, dtype=bool)
        for key in self.keys:
            bloom[probes(key, bits)] = True
        packed = struct.pack("<Q", bits) + np.packbits(bloom).tobytes()
        self.out.write(index + packed + FOOTER.pack(self.offset, len(index), self.offset + len(index), len(packed), len(self.keys), self.tokens, MAGIC))


class Reader:
    """Random access to one shard: footer, index and Bloom filter are read at once, blocks on demand."""

    def __init__(self, stream) -> None:
        self.stream = stream
        size = stream.size()
        if size < FOOTER.size:
            raise ValueError("not a shard")
        at, n, bloom_at, bloom_n, self.entries, self.tokens, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        data, self.index, i = self._read(at, n), [], 0
        while i < n:
            k = struct.unpack_from("<H", data, i)[0]
            self.index.append((data[i + 2 : i + 2 + k], *ENTRY.unpack_from(data, i + 2 + k)))
            i += 2 + k + ENTRY.size
        packed = self._read(bloom_at, bloom_n)
        self.bits = struct.unpack_from("<Q", packed)[0]
        self.bloom = packed[8:]

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def may_have(self, key: bytes) -> bool:
        return all(self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in probes(key, self.bits))

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, at, n = self.index[i]
        data = zstandard.ZstdDecompressor().decompress(self._read(at, n))
        at, key = 0, b""
        while at < len(data):
            shared, at = read_varint(data, at)
            rest, at = read_varint(data, at)
            size, at = read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, unpack_value(data[at : at + size])
            at += size

    def scan(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.index)):
            yield from self.block(i)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document with this id: Bloom filter, binary search of the index, then blocks."""
        key = key_of(doc_id)
        if not self.may_have(key):
            return []
        out, i = [], bisect.bisect_left([k for k, _, _ in self.index], key)
        while i < len(self.index):
            block = list(self.block(i))
            out += [ids for k, ids in block if k == key]
            if block[-1][0] > key:
                break
            i += 1
        return out


def table_of_library(vocab: str) -> ChunkTable:
    """Texts to ids as the library gives them: its model encodes each word once, words are told apart as its file does."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok, shown = Tokenizer.from_str(vocab), byte_characters()
    added = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    strings, model = list(added), tok.model
    return ChunkTable(lambda w: [t.id for t in model.tokenize(in_byte_characters(w, shown))], words, lambda t: pieces(t, strings), added)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_shards(docs: DataFrame, vocab_path: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents; return the manifest ``path, first_key, n_docs, n_tokens``.

    The texts are dealt out by ranges of the id and sorted within them (one shuffle), then
    encoded and written where they lie. A task starts a new shard every SHARD_BYTES of ids.
    Shards have names of their attempt, and only the manifest tells which count: it lists those
    of finished tasks, so a repeated or speculative task does no harm and nothing is renamed.
    Null ids come first; equal ids are ordered by a hash of the text; null texts are empty; an
    empty table gives no shard. The manifest is written
    beside the shards, so that the work is done once.
    """
    spark = docs.sparkSession
    with open(vocab_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    # A repeated id, null included, is split by a hash of the text, and equal rows by where they lie.
    order = [F.col("doc_id").asc_nulls_first(), F.col("th"), F.col("row")]
    placed = texts_of(docs, id_col, text_col).withColumn("th", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    keyed = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        enc, part = held(f"library {vocab_path}", lambda: table_of_library(spec.value)), TaskContext.get().partitionId()
        store, root = open_folder(folder)
        state = {"k": 0, "writer": None}

        def close():
            w = state["writer"]
            w.close()
            w.out.close()
            path = state["path"]
            state.update(k=state["k"] + 1, writer=None)
            return pa.RecordBatch.from_pylist([{"path": path, "first_key": w.first, "n_docs": len(w.keys), "n_tokens": w.tokens}], schema=pa.schema([("path", pa.string()), ("first_key", pa.binary()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for at in range(0, len(batch), 1000):
                ids, texts = batch.column(0)[at : at + 1000].to_pylist(), batch.column(1)[at : at + 1000].to_pylist()
                flat, cuts = enc.encode(texts)
                for k, doc_id in enumerate(ids):
                    if state["writer"] is None:
                        state["path"] = f"{root}/shard-{part:06d}-{state['k']:04d}-{uuid.uuid4().hex[:12]}.sst"
                        state["writer"] = Writer(store.open_output_stream(state["path"]))
                    state["writer"].add(key_of(doc_id), np.append(flat[cuts[k] : cuts[k + 1]], np.uint32(end_id)))
                    if state["writer"].tokens * 4 >= SHARD_BYTES:
                        yield close()
        if state["writer"] is not None:
            yield close()

    manifest = f"{folder}/manifest"
    keyed.mapInArrow(run, "path string, first_key binary, n_docs long, n_tokens long").write.mode("overwrite").parquet(manifest)
    return spark.read.parquet(manifest)


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Scan the shards of a manifest: ``doc_id, start, n_tokens, ids_crc32, ids`` per document.

    ``start`` counts the ids of all documents before. Its base per shard is a running sum over
    the manifest, which has one row per shard (up to SHARD_BYTES of ids), not per document.
    """
    order = Window.orderBy("first_key", "path").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("path", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("base"))

    def run(batches):
        store, _ = open_folder(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(path) as f:
                    reader = Reader(f)
                    for i in range(len(reader.index)):
                        rows = []
                        for key, ids in reader.block(i):
                            rows.append((id_of(key), base, len(ids), zlib.crc32(ids.tobytes())))
                            base += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    spread = based.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(folder: str, paths: list[str], doc_id: int) -> list[np.ndarray]:
    """The ids of one document from the given shards, without a scan."""
    store, _ = open_folder(folder)
    found = []
    for path in paths:
        with store.open_input_file(path) as f:
            found += Reader(f).get(doc_id)
    return found


def encode_to_shards(docs: DataFrame, vocab_path: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write shards into ``folder`` (default: a new one in the shared folder) and read them back."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/sst-{uuid.uuid4().hex}"
    store, root = open_folder(folder)
    store.create_dir(root)
    return read_shards(write_shards(docs, vocab_path, folder, end_id), folder)
