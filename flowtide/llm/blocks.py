"""Blocks of documents that ask buckets of keys: corpus-wide questions without a row per key.

Documents are dealt by a hash of their key into blocks of a few megabytes of text. A block sends its
distinct 64-bit keys, sorted, as one packet per key range (bucket). A bucket sees the packets of all
blocks and answers each packet with one value per key, in order; answers go back to their blocks, which
still hold, or rebuild in the same order, their keys. Each step is an ordinary grouped map: Spark shuffles
packets by bucket and answers by block, every group has a bounded size, and lost tasks are simply repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 3 << 20
PACKET = "bucket int, block int, keys binary, extra binary"


def sizes(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """Numbers of blocks and of buckets for this amount of text (one pass over the text lengths)."""
    total = docs.select(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    blocks = max(16, -(-total // block_bytes))
    return blocks, max(16, blocks // 2)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def dealt(docs: DataFrame, blocks: int, column: str = "block", key: str = "doc_id", text: str | None = None) -> DataFrame:
    """The rows with the number of their block, by key, or by key and text where rows are answered one by one."""
    parts = [F.col(key).cast("long"), *([F.col(text).cast("string")] if text else [])]
    number = F.pmod(F.xxhash64(*parts), F.lit(blocks)).cast("int")
    return docs.withColumn(column, number)


def in_order(table: pa.Table) -> pa.Table:
    """Rows by key (null first), ties by text: the same order in every pass."""
    keys = pa.table({"k": table["doc_id"].cast(pa.int64()), "t": table["text"].cast(pa.string())})
    if keys["k"].null_count == 0:
        k = keys["k"].to_numpy()
        order = np.argsort(k, kind="stable")
        if len(k) < 2 or (np.diff(k[order]) > 0).all():
            return table.take(pa.array(order))
    order = pc.sort_indices(keys, [("k", "ascending"), ("t", "ascending")], null_placement="at_start")
    return table.take(order)


def edges(buckets: int) -> np.ndarray:
    """First key of each bucket but the first."""
    return np.array([-(-(k << 64) // buckets) for k in range(1, buckets)], np.uint64)


def packets(block: int, keys: np.ndarray, buckets: int, extra: np.ndarray | None = None) -> pa.Table:
    """Sorted distinct keys (and a value beside each) as one row per bucket."""
    cuts = np.concatenate([[0], np.searchsorted(keys, edges(buckets)), [len(keys)]])
    some = np.flatnonzero(np.diff(cuts))
    part = lambda x: pa.array([x[cuts[b]:cuts[b + 1]].tobytes() for b in some], pa.binary())
    return pa.table({
        "bucket": pa.array(some, pa.int32()), "block": pa.array(np.full(len(some), block), pa.int32()),
        "keys": part(keys), "extra": part(extra) if extra is not None else pa.nulls(len(some), pa.binary())})


def opened(table: pa.Table, extra: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """All keys of a bucket's packets end to end, the packet of each, and the values beside them."""
    lists = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["keys"]]
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    values = None
    if extra:
        values = np.concatenate([np.frombuffer(x.as_buffer(), extra) for x in table["extra"]])
    return np.concatenate(lists), owner, values


def answers(table: pa.Table, owner: np.ndarray, values: np.ndarray, bits: bool = True) -> pa.Table:
    """Values for the keys of a bucket's packets, cut up by packet again."""
    cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=table.num_rows))])
    cut = lambda a, b: (np.packbits(values[a:b]) if bits else values[a:b]).tobytes()
    return pa.table({
        "bucket": table["bucket"].combine_chunks(), "block": table["block"].combine_chunks(),
        "keys": pa.array([cut(a, b) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
        "extra": pa.nulls(table.num_rows, pa.binary())})


def gathered(table: pa.Table, keys: np.ndarray, buckets: int, kind: str | None = None) -> np.ndarray:
    """The answers for a block's sorted keys, in their order."""
    cuts = np.concatenate([[0], np.searchsorted(keys, edges(buckets)), [len(keys)]])
    out = np.zeros(len(keys), kind or bool)
    for bucket, data in zip(table["bucket"].to_pylist(), table["keys"]):
        low, high = cuts[bucket], cuts[bucket + 1]
        raw = np.frombuffer(data.as_buffer(), kind or np.uint8)
        out[low:high] = raw if kind else np.unpackbits(raw, count=high - low)
    return out
