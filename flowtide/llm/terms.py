"""Runs of a class of bytes in whole texts, counted by their exact bytes.

A batch's texts are read as one numpy array of bytes; the bytes inside the class are kept end to end, which with
the lengths of the runs already is an Arrow array of all terms. Terms are told apart by Arrow's dictionary, that
is by their bytes and never by a hash alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flowtide.llm.words import text_bytes

#: Rows of counts that a task adds up before it sends them on.
POOL_ROWS = 500_000

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Letters of ASCII and every byte of other characters.
TERM = LETTER.copy()
TERM[0x80:] = True
#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def runs(texts: pa.Array, inside: np.ndarray = TERM) -> tuple[pa.Array, np.ndarray]:
    """All lower-cased runs of bytes of the class, and the text each is from."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    word = inside[data]
    borders = offsets[offsets < len(data)]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    before[borders] = False
    begin = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[borders[borders > 0] - 1] = False
    length = np.flatnonzero(word & ~after) + 1 - begin
    flat = LOWER[data[word]]
    cuts = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
    terms = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(flat)])
    return terms, np.searchsorted(offsets, begin, "right") - 1


@dataclass
class Counted:
    """Distinct terms of a batch, and the distinct (text, term) pairs in order of text."""

    terms: pa.Array      # large_binary, distinct
    text: np.ndarray     # of each pair
    term: np.ndarray
    times: np.ndarray    # occurrences of the term in the text


def counted(texts: pa.Array, inside: np.ndarray = TERM) -> Counted:
    found, owner = runs(texts, inside)
    coded = found.dictionary_encode()
    terms = coded.dictionary
    size = max(1, len(terms))
    pairs, times = np.unique(owner * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    return Counted(terms, pairs // size, pairs % size, times)


def totals(group: np.ndarray, size: int, item: np.ndarray, *values: np.ndarray):
    """Distinct (group, item) pairs and the sums of ``values``, or without any how many rows each has."""
    code = group.astype(np.int64) * max(1, size) + item
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(v[order], first) if len(first) else np.zeros(0, np.int64) for v in values]
    return code[first] // max(1, size), code[first] % max(1, size), *(sums or [np.diff(np.append(first, len(code)))])


def pooled(parts: Iterator[tuple], most: int = POOL_ROWS) -> Iterator[tuple]:
    """Counts of many slices added up: parts of (labels, group, items, *values) by label and item.

    ``group`` points into the labels of its part. Yields (labels, group, distinct items, item, *sums) whenever ``most``
    rows have come together, so that memory is bounded however long a task's input is.
    """
    labels: dict = {}
    held: list[tuple] = []

    def summed() -> tuple:
        coded = pa.concat_arrays([h[1] for h in held]).dictionary_encode()
        rest = [np.concatenate([h[k] for h in held]) for k in (0, *range(2, len(held[0])))]
        found = totals(rest[0], len(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False), *rest[1:])
        return list(labels), found[0], coded.dictionary, *found[1:]

    for names, group, items, *values in parts:
        own = np.array([labels.setdefault(name, len(labels)) for name in names], np.int64)
        held.append((own[group], items, *values))
        if sum(len(h[0]) for h in held) >= most:
            yield summed()
            labels, held = {}, []
            # Arrow keeps freed memory, which the next slices would add to.
            pa.default_memory_pool().release_unused()
    if held:
        yield summed()
    held = []
    pa.default_memory_pool().release_unused()


def prefixes(terms: pa.Array, size: int) -> pa.Array:
    """The first ``size`` bytes of each."""
    return pc.binary_slice(terms, 0, size)


def out_batches(columns: dict[str, pa.Array], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_pydict(columns)
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
