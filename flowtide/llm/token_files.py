"""Token ids in bit-packed files: fixed width, block offsets, random access.

File layout, little-endian: magic ``FTID0001``, then ten unsigned 64-bit numbers (bits per id,
ids per block, documents, ids, blocks, and five zeros), then per document its key and null mark and
its number of ids, then the byte offset of each block, then the blocks. A block holds a fixed number
of ids (the last may hold fewer), each in the fewest bits that fit the vocabulary, lowest bit first, and starts at a
whole byte. A range of ids is read from the blocks it touches alone, and unpacked by numpy.

``write`` sorts by key with a range partitioning, so the files in order hold the documents in order;
every file appears by renaming a finished one, and only files of successful tasks enter the manifest,
so repeated or lost tasks do no harm. ``read`` spreads the files of a manifest over the tasks.

Null keys sort first and stay null; a null text is an empty text with only its end id. Documents with
equal keys are ordered by text; repeated rows are all written. Extra columns are not stored. An empty
table gives no file, an empty manifest and an empty result. Long texts are encoded in slices of rows and
one text may fill a file of its own.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowtide.llm.tables import TEXT_BYTES, slices, texts_of, written
from flowtide.llm.tokens import encoder
from flowtide.session import new_folder

MAGIC = b"FTID0001"
BLOCK_IDS = 8192
FILE_IDS = 4 << 20
MANIFEST = "part int, number int, path string, n_docs long, n_ids long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def width(vocabulary: int) -> int:
    """Bits that number ``vocabulary`` different ids."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    table = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(table.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The ``n`` ids packed in ``data``."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    table = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (table.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def file_bytes(keys: list[int | None], lengths: np.ndarray, ids: np.ndarray, bits: int,
               block_ids: int = BLOCK_IDS) -> bytes:
    """One file's content."""
    blocks = [pack(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    head = np.array([bits, block_ids, len(keys), len(ids), len(blocks), 0, 0, 0, 0, 0], "<u8").tobytes()
    table = b"".join([
        np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([k is None for k in keys], "u1").tobytes(),
        np.asarray(lengths).astype("<i8").tobytes()])
    first = len(MAGIC) + len(head) + len(table) + 8 * len(blocks)
    at = first + np.cumsum([0, *map(len, blocks)])[:-1]
    return b"".join([MAGIC, head, table, at.astype("<u8").tobytes(), *blocks])


class TokenFile:
    """A file opened for reading; ``source`` has ``seek`` and ``read``."""

    def __init__(self, source) -> None:
        self.source = source
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block_ids, n, self.n_ids, blocks = np.frombuffer(self._read(8, 80), "<u8")[:5].tolist()
        table = self._read(88, 17 * n + 8 * blocks)
        nulls = np.frombuffer(table, "u1", n, 8 * n)
        self.keys = [None if x else k for k, x in zip(np.frombuffer(table, "<i8", n).tolist(), nulls)]
        self.lengths = np.frombuffer(table, "<i8", n, 9 * n)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.at = np.frombuffer(table, "<u8", blocks, 17 * n).astype(np.int64)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file, from the blocks they lie in."""
        if not n:
            return np.zeros(0, np.uint32)
        low, high = start // self.block_ids, (start + n - 1) // self.block_ids
        size = lambda k: min(self.block_ids, self.n_ids - k * self.block_ids)
        end = int(self.at[high]) + (size(high) * self.bits + 7) // 8
        data = self._read(int(self.at[low]), end - int(self.at[low]))
        base = int(self.at[low])
        parts = [unpack(data[int(self.at[k]) - base:], size(k), self.bits) for k in range(low, high + 1)]
        skip = start - low * self.block_ids
        return np.concatenate(parts)[skip:skip + n]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.lengths[number]))


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write(docs: DataFrame, folder: str, end_id: int = 2, vocabulary: str | None = None,
          file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of every text in ascending key order; returns the manifest of files.

    ``vocabulary`` is a path every executor can read (default: the installed public vocabulary).
    """
    _store(folder)[0].create_dir(_store(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _store(folder)
        codes = encoder(vocabulary)
        bits, part = width(max(codes.size, end_id + 1)), TaskContext.get().partitionId()
        keys, lengths, ids, held, number = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, lengths, ids, held, number
            flat = np.concatenate(ids)
            path = f"{base}/part-{part:06d}-{number:06d}.ids"
            trial = f"{base}/.{uuid.uuid4().hex}.tmp"
            with files.open_output_stream(trial) as out:
                out.write(file_bytes(keys, np.concatenate(lengths), flat, bits, block_ids))
            files.move(trial, path)
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                "path": [path], "n_docs": [len(keys)], "n_ids": [len(flat)]})
            keys, lengths, ids, held, number = [], [], [], 0, number + 1
            return row

        for batch in slices(batches, most=min(TEXT_BYTES, 2 * file_ids)):
            flat, offsets = codes.encode(batch.column("text"))
            n = np.diff(offsets)
            out = np.full(len(flat) + len(n), end_id, np.int32)
            out[np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)] = flat
            keys += batch.column("doc_id").to_pylist()
            lengths.append(n + 1)
            ids.append(out)
            held += len(out)
            if held >= file_ids:
                yield flush()
        if keys:
            yield flush()

    ordered = texts_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: key, ids before it, number of ids, ids as 32-bit integers."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files_in_order = manifest.select(  # one row per file of millions of ids
        "part", "number", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _store(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                with files.open_input_file(path) as source:
                    held = TokenFile(source)
                    n = len(held.keys)
                    low = 0
                    while low < n:
                        high = max(low + 1, int(np.searchsorted(held.starts, held.starts[low] + (1 << 20))))
                        flat = held.ids(int(held.starts[low]), int(held.lengths[low:high].sum())).astype("<u4")
                        ends = 4 * (held.starts[low:high] + held.lengths[low:high] - held.starts[low])
                        cuts = pa.array(np.concatenate([[0], ends]).astype(np.int64))
                        data = pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), high - low, [None, cuts.buffers()[1], pa.py_buffer(flat.tobytes())])
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(held.keys[low:high], pa.int64()),
                            "start": start + held.starts[low:high],
                            "n_tokens": held.lengths[low:high], "ids": data.cast(pa.binary())})
                        low = high

    spread = files_in_order.repartition(F.col("path"))
    return spread.mapInArrow(run, DOCUMENTS)


def crc32_of(column: pa.Array) -> pa.Array:
    """Unsigned crc32 of each binary value."""
    return pa.array([zlib.crc32(x.as_buffer()) for x in column], pa.int64())


def digest(documents: DataFrame) -> DataFrame:
    """Start, length and checksum of every document that was read back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("doc_id", "start", "n_tokens")},
                "ids_crc32": crc32_of(batch.column("ids"))})

    return documents.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, end_id: int = 2) -> DataFrame:
    """Write to a fresh shared folder, read back, and digest what was read."""
    folder = new_folder(spark, "token-files")
    return digest(read(write(docs, folder, end_id), folder))


