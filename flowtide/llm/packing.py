"""Minimum bin slack: pack token pieces into as few sequences as possible.

Texts are encoded whole, ended by ``end_id`` and cut into pieces of at most ``capacity`` ids. Only
lengths matter for packing, so the search runs on the histogram of lengths, at most ``capacity``
numbers whatever the corpus: starting from the longest length left, a bitset of reachable sums
(subset-sum over the lengths still available) finds the fullest bin that holds it. That combination is
then removed as often as its lengths last, and the search goes on. The resulting plan has a few entries
per length. The pieces of each length are numbered by Spark in parallel, and a piece's number tells its
sequence and offset by binary search in the plan; no table is joined and no length is gathered in one task.

A null text is an empty text (only its end id). Null and repeated keys are packed row by row like any
others; ties in length are numbered by key, piece and checksum. An empty table gives an empty result.
Only key and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm.tables import slices, texts_of, written
from flowtide.llm.tokens import encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, ids: bool = False,
               vocabulary: str | None = None) -> DataFrame:
    """Pieces of every document; with ``ids`` also their ids as binary 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(vocabulary)
        for batch in slices(batches):
            flat, offsets = codes.encode(batch.column("text"))
            keys = batch.column("doc_id").to_pylist()
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            end = np.array([end_id], "<u4").tobytes()
            flat = flat.astype("<u4")
            for d, key in enumerate(keys):
                data = flat[offsets[d]:offsets[d + 1]].tobytes() + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at:at + 4 * capacity]
                    out["doc_id"].append(key)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(own) // 4)
                    out["ids_crc32"].append(zlib.crc32(own))
                    if ids:
                        out["ids"].append(own)
            types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
                     "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if ids else {})
            yield pa.RecordBatch.from_pydict({k: pa.array(out[k], t) for k, t in types.items()})

    return texts_of(docs).mapInArrow(run, PIECES + (", ids binary" if ids else ""))


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The fullest combination holding the longest available length, as (length, copies)."""
    top = max(counts)
    room = capacity - top
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []  # bit s of reach: some choice so far sums to s
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == top), room // length)
        power = 1
        while left > 0 and not reach >> room & 1:
            take = min(power, left)
            grown = (reach | reach << take * length) & mask
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left -= take
            power *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = {top: 1}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return sorted(chosen.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first number, first sequence, copies, offset).

    Pieces numbered from ``first number`` on fill sequences from ``first sequence`` on, ``copies`` in
    each, side by side from ``offset``; the next entry of the length ends the run.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    entries, sequence = [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[length] // copies for length, copies in chosen)
        offset = 0
        for length, copies in chosen:
            entries.append((length, used[length], sequence, copies, offset))
            used[length] += copies * times
            left[length] -= copies * times
            offset += length * copies
            if not left[length]:
                del left[length]
        sequence += times
    return entries


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces with a column ``length``."""
    pieces = written(pieces.withColumn("part", F.spark_partition_id()), "pieces")
    counts = pieces.groupBy("part", "length").count()
    totals = {r["length"]: r["n"] for r in  # at most `capacity` rows
              counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    entries = sorted(plan(totals, capacity))
    length, number, sequence, copies, offset = (
        np.array([e[i] for e in entries], np.int64) for i in range(5))
    keys = (length << 48) + number

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("part", "length").orderBy(*(
        c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns))
    numbered = (pieces.withColumn("own", F.row_number().over(order) - 1)
                .join(before, ["part", "length"])
                .withColumn("number", F.col("before") + F.col("own")).drop("own", "before", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("number").to_numpy(zero_copy_only=False)
            size = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (size << 48) + n, "right") - 1
            own = n - number[at]
            out = {f.name: batch.column(f.name) for f in batch.schema if f.name != "number"}
            out["sequence_id"] = pa.array(sequence[at] + own // copies[at])
            out["offset"] = pa.array(offset[at] + own % copies[at] * size)
            yield pa.RecordBatch.from_pydict(out)

    fields = [f"`{n}` {t}" for n, t in numbered.dtypes if n != "number"]
    return numbered.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, ids: bool = True,
                   vocabulary: str | None = None) -> DataFrame:
    """Encode, cut and pack every document; one row per piece, with its ids unless ``ids`` is off."""
    return assign(cut_pieces(docs, capacity, end_id, ids, vocabulary), capacity)
