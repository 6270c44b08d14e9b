"""Token ids in fixed-width bit-packed files.

File layout, all numbers little-endian::

    magic "SWTOK1\\0\\0", u32 bits per id, u32 ids per block, u32 end id, u32 reserved
    blocks: ids of ``bits`` bits each, lowest bit first; every block starts on a byte
    footer: i64 doc ids, u8 has-an-id flags, i64 first id of each document and the end, i64 offsets of blocks and the end
    trailer: u64 footer offset, u64 documents, u64 blocks, u64 ids, u32 crc32 of the footer, magic

A document's ids are found from its start: blocks start // block to (end - 1) // block.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.store import attempt_name, open_store
from sievework.llm.units import UnitEncoder, pieces
from sievework.session import scratch_path, through_storage

MAGIC = b"SWTOK1\0\0"
BLOCK = 8192
_HEAD, _TAIL = struct.Struct("<8sIIII"), struct.Struct("<QQQQI8s")


def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits``-wide numbers, lowest bit first."""
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed ``data``."""
    raw = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
    at = np.arange(count, dtype=np.int64) * bits
    byte, shift = at >> 3, (at & 7).astype(np.uint64)
    value = np.zeros(count, dtype=np.uint64)
    for k in range((bits + 14) // 8):
        value |= raw[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return ((value >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class TokenWriter:
    """Appends documents to one file; holds one block of ids and three numbers per document."""

    def __init__(self, sink, bits: int, end_id: int, block: int = BLOCK):
        self.sink, self.bits, self.block, self.end_id = sink, bits, block, end_id
        self.held, self.n_held, self.n_ids = [], 0, 0
        self.doc_ids, self.has_id, self.starts, self.offsets = [], [], [], []
        self.at = _HEAD.size
        sink.write(_HEAD.pack(MAGIC, bits, block, end_id, 0))

    def begin(self, doc_id: int | None) -> None:
        self.doc_ids.append(doc_id or 0)
        self.has_id.append(doc_id is not None)
        self.starts.append(self.n_ids)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= 64 * self.block:
            self._flush(False)

    def end(self) -> None:
        self.add(np.array([self.end_id], dtype=np.uint32))

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        n = len(ids) if last else len(ids) // self.block * self.block
        for k in range(0, n, self.block):
            packed = pack(ids[k:min(n, k + self.block)], self.bits)
            self.offsets.append(self.at)
            self.sink.write(packed)
            self.at += len(packed)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(True)
        footer = b"".join([np.array(self.doc_ids, "<i8").tobytes(), np.array(self.has_id, "u1").tobytes(),
                           np.array([*self.starts, self.n_ids], "<i8").tobytes(), np.array([*self.offsets, self.at], "<i8").tobytes()])
        self.sink.write(footer)
        self.sink.write(_TAIL.pack(self.at, len(self.doc_ids), len(self.offsets), self.n_ids, zlib.crc32(footer), MAGIC))


class TokenFile:
    """Random access to the documents of one file."""

    def __init__(self, source, size: int):
        self.source = source
        tail = source.read_at(_TAIL.size, size - _TAIL.size)
        at, n, blocks, self.n_ids, crc, magic = _TAIL.unpack(tail)
        head, self.bits, self.block, self.end_id, _ = _HEAD.unpack(source.read_at(_HEAD.size, 0))
        footer = source.read_at(size - _TAIL.size - at, at)
        if magic != MAGIC or head != MAGIC or zlib.crc32(footer) != crc:
            raise ValueError("not a whole token file")
        self.doc_ids = np.frombuffer(footer, "<i8", n)
        self.has_id = np.frombuffer(footer, "u1", n, 8 * n).astype(bool)
        self.starts = np.frombuffer(footer, "<i8", n + 1, 9 * n)
        self.offsets = np.frombuffer(footer, "<i8", blocks + 1, 9 * n + 8 * (n + 1))

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the file; only their blocks are read."""
        if end <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        lo, hi = int(self.offsets[first]), int(self.offsets[last + 1])
        base = first * self.block
        count = min(self.n_ids, (last + 1) * self.block) - base
        return unpack(self.source.read_at(hi - lo, lo), self.bits, count)[start - base:end - base]

    def document(self, row: int) -> np.ndarray:
        return self.ids(int(self.starts[row]), int(self.starts[row + 1]))

    def runs(self, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
        """Rows [a, b) that together have about ``limit`` ids."""
        a = 0
        while a < len(self.doc_ids):
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + limit, "right")) - 1)
            yield a, b
            a = b


_TOKENIZERS: dict[str, object] = {}
#: A control character that becomes one id of its own parts the units of one call to the library.
_PART, _PER_CALL = "\x01", 256


def tokenizer(path: str):
    """The tokenizer of a file, read once per Python worker, without threads, truncation and padding, and its unit encoder."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        ids_of = lambda texts: [np.array(e.ids, dtype=np.uint32) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        part = ids_of([f"a {_PART} a", "a", _PART])
        single = len(part[2]) == 1 and part[0].tolist() == [*part[1], *part[2], *part[1]]

        def encode(units: list[str]) -> list[np.ndarray]:
            if not single:
                return ids_of(units)
            out: list[np.ndarray] = []
            for k in range(0, len(units), _PER_CALL):
                some = units[k:k + _PER_CALL]
                joined = f" {_PART} ".join(some)
                if joined.count(_PART) != len(some) - 1:  # a unit has the character itself
                    out += ids_of(some)
                    continue
                ids = ids_of([joined])[0]
                cuts = np.flatnonzero(ids == part[2][0])
                out += [ids[a:b] for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])]
            return out

        _TOKENIZERS[path] = (t, UnitEncoder(encode))
    return _TOKENIZERS[path]


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int | None = None,
                      folder: str | None = None) -> DataFrame:
    """Encode every text, end it with ``end_id`` and write files in ascending doc_id order; returns the manifest.

    The manifest has part, path, n_docs, n_ids, start (ids of all files before), in file order.
    Needs doc_id and text.  NULL text is empty; a NULL doc_id sorts first and is kept as NULL;
    repeated ids are kept, in the order of their texts; extra columns are not read; an empty
    table gives an empty manifest.  Texts of any length are encoded whole: white space ends a
    word in the tokenizer used, so they are cut between words and joined again.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    if vocabulary is None:
        t, _ = tokenizer(tokenizer_path)
        vocabulary = max(t.get_vocab_size(with_added_tokens=True), end_id + 1)
    bits = bits_for(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        _, units = tokenizer(tokenizer_path)
        writer = sink = path = None
        for batch in batches:
            if writer is None:
                part = TaskContext.get().partitionId()
                fs, root = open_store(folder)
                fs.create_dir(root, recursive=True)
                path = attempt_name(folder, f"part-{part:06d}") + ".tok"
                sink = fs.open_output_stream(open_store(path)[1])
                writer = TokenWriter(sink, bits, end_id)
            doc_ids = batch.column(0).to_pylist()
            texts = [x or b"" for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            done = -1
            for group in pieces(texts):
                ids, counts = units.ids_of([p for _, p in group])
                at = 0
                for (row, _), n in zip(group, counts.tolist()):
                    if row != done:
                        if done >= 0:
                            writer.end()
                        writer.begin(doc_ids[row])
                        done = row
                    writer.add(ids[at:at + n])
                    at += n
            if done >= 0:
                writer.end()
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path],
                                              "n_docs": pa.array([len(writer.doc_ids)], pa.int64()),
                                              "n_ids": pa.array([writer.n_ids], pa.int64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = through_storage(ordered.mapInArrow(write, "part int, path string, n_docs long, n_ids long"), "token-manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document of the files of a manifest: doc_id, start, n_tokens, ids_crc32 (of ids as 32-bit numbers)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = open_store(uri)
                with fs.open_input_file(path) as source:
                    file = TokenFile(source, fs.get_file_info(path).size)
                    for a, b in file.runs():
                        first = int(file.starts[a])
                        ids = file.ids(first, int(file.starts[b])).astype("<u4")
                        cut = (file.starts[a:b + 1] - first).tolist()
                        crc = [zlib.crc32(ids[x:y].data) for x, y in zip(cut, cut[1:])]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(file.doc_ids[a:b], pa.int64(), mask=~file.has_id[a:b]),
                            "start": pa.array(file.starts[a:b] + start, pa.int64()),
                            "n_tokens": pa.array(np.diff(file.starts[a:b + 1]), pa.int64()),
                            "ids_crc32": pa.array(crc, pa.int64())})

    files = manifest.select("path", "start")
    # Few rows, one per file, each of which stands for a whole file: with a number given, Spark does not put them together.
    return (files.repartition(max(1, files.count()), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
