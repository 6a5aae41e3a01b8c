"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence with its transpose.

A document is the set of its 64-bit hashed word shingles. Two documents link when the intersection is at
least ``PERCENT`` per cent of the union, that is when it holds at least 4/9 of both sizes together at 80.

* Documents with equal sets are one class (128-bit set fingerprint); the product is over classes.
* Shingles are put in one order for all documents, frequent ones last (any order is right, but one that lets chance
  repeats into prefixes makes unrelated documents meet). They are counted in 2^34 cells, range by range, and a table of
  fixed size holds the level of the most frequent cell of each counter. With that order only the first entries of a row can hold the first
  shared shingle of a linked pair: the size-derived prefix. Only prefixes enter the product.
* The product is cut into blocks of shingles (ranges of hashes). A block adds one to the overlap count of
  each pair in a column, unless sizes and places show the pair cannot link; counts of all blocks are
  summed, and a pair whose count plus everything behind its prefixes stays below the bound is discarded.
* A column with more than ``LONG`` classes is not multiplied out pair by pair. Its classes hang on one pivot
  per size band, and all classes that hang together this way meet in tiles of ``PART`` by ``PART`` classes, where
  the product of their whole rows is taken at once (frequent shingles by a dense matrix product, others entry by
  entry). A tile sends on a spanning forest of its links, never pairs. No link is lost. Tiles that ask for many more
  texts than there are classes are worked off in rounds, each of which ships about as many texts.
* Pairs of short columns are verified on whole sets, and components are found by star contraction.

A document of fewer words than a shingle is its whole word sequence; without words (null or empty text) it has
size 0 and links with nothing. Words are lowered in A-Z. Repeated rows are copies and link; rows of one doc_id
are one node; a null doc_id counts as the largest, and a group of nothing else has a null component. Empty tables give empty results; only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm.blocks import edges as bucket_edges
from flowtide.llm.blocks import BLOCK_BYTES, fresh_name, sizes
from flowtide.llm.components import components
from flowtide.llm.tables import brief_shuffles, discard, slices, texts_of, written
from flowtide.llm.words import U64, mix, split_words

SHINGLE, PERCENT = 5, 80
BAND = 1.08
#: Shingles are counted by the leading bits of their hashes; so many are sorted at a time, so many meet in a range.
CELL_BITS, COUNTED, RANGE = 34, 1 << 22, 1 << 21
DENSE, COLUMNS = 256, 2048
LEAST_COUNTERS, MOST_COUNTERS = 1 << 18, 1 << 24
LONG, PART, TILE_PAIRS, SENT = 24, 512, 2048, 1_000_000
ENTRY = np.dtype([("node", "<i8"), ("size", "<i4"), ("place", "<i4")])
PAIRS = "a long, b long, size_a int, size_b int, overlap int, star boolean"


NO_KEY = (1 << 63) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """Key and text of every row; a null key counts as the largest, so it names no group with others."""
    return texts_of(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_KEY)))


def least_overlap(sum_of_sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The smallest intersection with which sets of these sizes link."""
    return -(-percent * sum_of_sizes // (100 + percent))


NO_SHINGLE = np.zeros(0, U64)


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text end to end, and the offsets of the texts in them."""
    words = split_words(texts, lower=True)
    at, hashes = words.windows(n)
    bounds = np.searchsorted(at, words.first)
    count = np.diff(words.first)
    sets = []
    for d in range(words.texts):
        if count[d] >= n:
            own = np.sort(hashes[bounds[d]:bounds[d + 1]])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            sets.append(words.window_hashes(words.first[d:d + 1], int(count[d])) if count[d] else NO_SHINGLE)
    return (np.concatenate(sets) if sets else NO_SHINGLE,
            np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64))


def fingerprints(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of each set."""
    out = []
    for salt in (0x51ED270B4D2C6A31, 0x2545F4914F6CDD1D):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(sets ^ U64(salt)), dtype=U64)])
        out.append(mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(U64)).view(np.int64))
    return out[0], out[1]


def counted_cells(hashes: np.ndarray, lots: int) -> dict[str, pa.Array]:
    """How often each cell of hashes occurs, as a packet per range of cells that has any.

    A packet holds the steps from one different cell to the next, and a count for those that occur again.
    """
    cells = np.sort(hashes) >> U64(64 - CELL_BITS)
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(cells)))
    cells = cells[first].astype(np.int64)
    wide = 1 << CELL_BITS - lots.bit_length() + 1
    cuts = np.searchsorted(cells, np.arange(lots + 1) * wide)
    again = np.flatnonzero(count > 1)
    cuts_again = np.searchsorted(again, cuts)
    step = np.diff(cells, prepend=0)
    some = np.flatnonzero(np.diff(cuts))
    steps, more = [], []
    for lot in some.tolist():
        own = step[cuts[lot]:cuts[lot + 1]].copy()
        own[0] = cells[cuts[lot]] - lot * wide
        steps.append(own.astype("<u2" if own.max() < 1 << 16 else "<u4").tobytes())
        at = again[cuts_again[lot]:cuts_again[lot + 1]]
        more.append(np.stack([at - cuts[lot], count[at]], 1).astype("<u4").tobytes())
    return {"lot": pa.array(some, pa.int32()), "cells": pa.array(np.diff(cuts)[some], pa.int32()),
            "steps": pa.array(steps, pa.binary()), "more": pa.array(more, pa.binary())}


def counter_levels(packets: pa.Table, lots: int, counters: int) -> np.ndarray:
    """The order level of each counter of a range of cells: that of its most frequent cell."""
    found = []
    for k, steps, more in zip(packets["cells"].to_pylist(), packets["steps"], packets["more"]):
        steps, more = steps.as_buffer(), np.frombuffer(more.as_buffer(), "<u4").reshape(-1, 2)
        cell = np.cumsum(np.frombuffer(steps, "<u2" if steps.size == 2 * k else "<u4"), dtype=U64) << U64(32)
        cell += U64(1)
        cell[more[:, 0]] += more[:, 1] - U64(1)
        found.append(cell)
    found = np.sort(np.concatenate(found))
    cell, count = found >> U64(32), found & U64((1 << 32) - 1)
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    count = np.add.reduceat(count, first)
    load = float(count.sum()) * lots / (1 << CELL_BITS)
    usual = load + 4 * np.sqrt(load) + 4  # what rare shingles that share a cell come to
    often = np.flatnonzero(count > usual)
    level = np.ceil(4 * np.log2(1 + count[often] - usual)).clip(0, 255).astype(np.uint8)
    out = np.zeros(counters // lots, np.uint8)
    np.maximum.at(out, (cell[first[often]] >> U64(CELL_BITS - counters.bit_length() + 1)).astype(np.int64), level)
    return out


def _survey(docs: DataFrame, n: int, counters: int, lots: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, size, f1, f2) of every row, and the order level of each counter (0: not frequent).

    Shingles are counted in ``2 ** CELL_BITS`` cells, by ranges of cells; only levels come together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = lambda k, kind: pa.nulls(k, kind)

        def packets(held: list[np.ndarray]) -> pa.RecordBatch:
            found = counted_cells(np.concatenate(held), lots)
            k = len(found["lot"])
            return pa.RecordBatch.from_pydict({
                "doc_id": nothing(k, pa.int64()), "size": nothing(k, pa.int32()), "f1": nothing(k, pa.int64()),
                "f2": nothing(k, pa.int64()), **found})

        held: list[np.ndarray] = []
        for batch in slices(batches):
            sets, offsets = shingle_sets(batch.column("text"), n)
            f1, f2 = fingerprints(sets, offsets)
            k = batch.num_rows
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "size": np.diff(offsets).astype(np.int32), "f1": f1, "f2": f2,
                "lot": nothing(k, pa.int32()), "cells": nothing(k, pa.int32()), "steps": nothing(k, pa.binary()),
                "more": nothing(k, pa.binary())})
            held.append(sets)
            if sum(map(len, held)) >= COUNTED:
                yield packets(held)
                held = []
        if held:
            yield packets(held)

    survey = written(_keyed(docs).mapInArrow(
        run, "doc_id long, size int, f1 long, f2 long, lot int, cells int, steps binary, more binary"), "shingle-survey")

    def levels(table: pa.Table) -> pa.Table:
        own = counter_levels(table, lots, counters)
        return pa.table({"lot": table["lot"][:1].combine_chunks(), "levels": pa.array([own.tobytes()], pa.binary())})

    rows = written(survey.filter("lot is null").select("doc_id", "size", "f1", "f2"), "shingle-sizes")
    found = (survey.filter("lot is not null").select("lot", "cells", "steps", "more")
             .groupBy("lot").applyInArrow(levels, "lot int, levels binary").collect())
    level = np.zeros(counters, np.uint8)  # `counters` bytes, whatever the corpus
    for r in found:
        own = np.frombuffer(r["levels"], np.uint8)
        level[r["lot"] * len(own):(r["lot"] + 1) * len(own)] = own
    discard(survey)
    return rows, level


def _prefixes(docs: DataFrame, level: np.ndarray, n: int, percent: int, buckets: int) -> DataFrame:
    """Prefix entries of every document as packets by range of hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(level)  # one byte per counter
    borders = bucket_edges(buckets)
    shift = U64(64 - len(level).bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, offsets = shingle_sets(batch.column("text"), n)
            f1, _ = fingerprints(sets, offsets)
            size = np.diff(offsets)
            keep = np.zeros(len(size), bool)
            keep[np.unique(f1, return_index=True)[1]] = True  # one of equal sets in a slice
            first = np.where(keep & (size > 0), size - -(-percent * size // 100) + 1, 0)
            owner = np.repeat(np.arange(len(size)), size)
            order = np.lexsort([shared.value[(sets >> shift).astype(np.int64)], owner])  # stable: then by hash
            place = np.arange(len(sets)) - offsets[:-1][owner]
            chosen = np.flatnonzero(place < first[owner])
            keys = sets[order[chosen]]
            entry = np.empty(len(chosen), ENTRY)
            entry["node"], entry["size"], entry["place"] = f1[owner[chosen]], size[owner[chosen]], place[chosen]
            by = np.argsort(keys, kind="stable")
            keys, entry = keys[by], entry[by]
            cuts = np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])
            some = np.flatnonzero(np.diff(cuts))
            part = lambda x: pa.array([x[cuts[b]:cuts[b + 1]].tobytes() for b in some], pa.binary())
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "keys": part(keys), "entries": part(entry)})

    return texts_of(docs).mapInArrow(run, "bucket int, keys binary, entries binary")


def _column_pairs(key: np.ndarray, entry: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of pairs within each run of equal keys that sizes and places let link.

    Entries are sorted by key, then size.
    """
    size, place = entry["size"].astype(np.int64), entry["place"].astype(np.int64)
    run = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    wide = np.int64(1) << 32
    # Later in the run (so at least as large), at most 100 / percent times as large.
    high = np.searchsorted(run * wide + size, run * wide + 100 * size // percent, "right")
    at = np.arange(len(key))
    times = np.maximum(high - at - 1, 0)
    i = np.repeat(at, times)
    j = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times) + i + 1
    before = np.minimum(place[i], place[j])
    rest = np.minimum(size[i] - place[i], size[j] - place[j])
    good = before + rest >= least_overlap(size[i] + size[j], percent)
    return i[good], j[good]


def _multiply(packets: DataFrame, percent: int, long: int) -> DataFrame:
    """Overlap counts of pairs in short columns, and the pivots that classes of long ones hang on."""
    bands = int(np.ceil(np.log(100 / percent) / np.log(BAND))) + 1  # sizes further apart cannot link

    def run(table: pa.Table) -> pa.Table:
        key = np.concatenate([np.frombuffer(x.as_buffer(), U64) for x in table["keys"]])
        entry = np.concatenate([np.frombuffer(x.as_buffer(), ENTRY) for x in table["entries"]])
        order = np.lexsort([entry["node"], entry["size"], key])
        key, entry = key[order], entry[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (entry["node"][1:] != entry["node"][:-1])
        key, entry = key[new], entry[new]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        length = np.diff(np.append(start, len(key)))
        length = np.repeat(length, length)
        short = (length > 1) & (length <= long)
        key_s, entry_s = key[short], entry[short]
        i, j = _column_pairs(key_s, entry_s, percent) if len(key_s) else (np.zeros(0, np.int64),) * 2
        pair = np.stack([entry_s["node"][i], entry_s["node"][j]], 1) if len(i) else np.zeros((0, 2), np.int64)
        flip = pair[:, 0] > pair[:, 1]
        sizes_ = np.stack([entry_s["size"][i], entry_s["size"][j]], 1) if len(i) else np.zeros((0, 2), np.int32)
        pair[flip], sizes_[flip] = pair[flip][:, ::-1], sizes_[flip][:, ::-1]
        unique, at, overlap = np.unique(pair, axis=0, return_index=True, return_counts=True)
        a, b, size_a, size_b = unique[:, 0], unique[:, 1], sizes_[at, 0], sizes_[at, 1]

        hot = length > long
        key_h, entry_h = key[hot], entry[hot]
        star = np.zeros((0, 4), np.int64)
        if len(key_h):
            band = np.floor(np.log(entry_h["size"]) / np.log(BAND)).astype(np.int64)
            rank = mix(entry_h["node"].view(U64))
            order = np.lexsort([rank, band, key_h])
            lead = np.ones(len(order), bool)
            k, g = key_h[order], band[order]
            lead[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
            pivot = order[lead][np.cumsum(lead) - 1]
            heads = order[lead]
            near = np.flatnonzero((key_h[heads][1:] == key_h[heads][:-1]) & (np.diff(band[heads]) <= bands))
            left, right = np.concatenate([order, heads[near]]), np.concatenate([pivot, heads[near + 1]])
            x, y = entry_h[left], entry_h[right]
            ok = x["node"] != y["node"]
            star = np.stack([x["node"], y["node"], x["size"], y["size"]], 1)[ok]
            flip = star[:, 0] > star[:, 1]
            star[flip] = star[flip][:, [1, 0, 3, 2]]
            star = np.unique(star, axis=0)
        n, m = len(unique), len(star)
        ints = lambda *parts: pa.array(np.concatenate(parts).astype(np.int32))
        longs = lambda *parts: pa.array(np.concatenate(parts).astype(np.int64))
        return pa.table({
            "a": longs(a, star[:, 0]), "b": longs(b, star[:, 1]), "size_a": ints(size_a, star[:, 2]),
            "size_b": ints(size_b, star[:, 3]), "overlap": ints(overlap, np.zeros(m)),
            "star": pa.array([False] * n + [True] * m, pa.bool_())})

    return packets.groupBy("bucket").applyInArrow(run, PAIRS)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that do link, by their whole sets.

    Candidates with the same smallest neighbour meet in one group, so a text travels about once; a large such
    group is cut into tiles of about ``TILE_PAIRS`` pairs. What travels is the text, which is smaller than its set.
    """
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    heads = ends.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("head"))
    headed = written(pairs.join(heads, "a"), "headed")
    shape = headed.groupBy("head").agg(F.ceil(F.sqrt(F.count("*") / TILE_PAIRS)).cast("int").alias("parts"))
    large = shape.filter("parts > 1")
    lots = max(16, headed.count() // TILE_PAIRS)
    part = lambda c: F.pmod(F.xxhash64(c), F.col("parts"))
    tiled = written(headed.join(large, "head", "left").select(
        "a", "b", F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("head"), F.lit(lots)))
        .otherwise(lots + F.pmod(F.xxhash64("head", part("a"), part("b")), F.lit(1 << 40))).alias("tile")), "tiles")
    asked = tiled.select("tile", F.col("a").alias("node")).union(tiled.select("tile", "b")).distinct()
    wanted = written(asked.join(classes.select("node", F.col("component").alias("doc_id")), "node")
                     .select("doc_id", "tile").distinct(), "wanted")
    # Ids and tiles are sent along while they are few, else the texts are shuffled to them.
    few = wanted.count() <= SENT
    texts = _keyed(docs).join(F.broadcast(wanted) if few else wanted, "doc_id").select("tile", "text")

    def run(key: tuple, texts: pa.Table, pairs: pa.Table) -> pa.Table:
        sets, offsets = shingle_sets(texts["text"], n)
        f1, _ = fingerprints(sets, offsets)
        order = np.argsort(f1, kind="stable")
        ends = pairs.select(["a", "b"])
        a, b = (ends[c].to_numpy() for c in ("a", "b"))
        at_a, at_b = (order[np.searchsorted(f1, x, sorter=order)] for x in (a, b))  # every class has its text here
        good = np.zeros(len(a), bool)
        for k, (i, j) in enumerate(zip(at_a.tolist(), at_b.tolist())):
            x, y = sets[offsets[i]:offsets[i + 1]], sets[offsets[j]:offsets[j + 1]]
            if len(x) > len(y):
                x, y = y, x
            shared = int((y[np.searchsorted(y, x).clip(max=len(y) - 1)] == x).sum())
            good[k] = (100 + percent) * shared >= percent * (len(x) + len(y))
        return ends.filter(pa.array(good))

    return texts.groupBy("tile").cogroup(tiled.groupBy("tile")).applyInArrow(run, "a long, b long")


def overlaps(flat_a: np.ndarray, first_a: np.ndarray, flat_b: np.ndarray, first_b: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of sets a with sets b (each end to end, with offsets)."""
    rows_a, rows_b = (np.repeat(np.arange(len(f) - 1), np.diff(f)) for f in (first_a, first_b))
    shared = np.intersect1d(flat_a, flat_b)
    held = lambda flat: (shared[(at := np.searchsorted(shared, flat).clip(max=max(0, len(shared) - 1)))] == flat, at)
    out = np.zeros((len(first_a) - 1, len(first_b) - 1), np.float32)
    if not len(shared):
        return out
    (in_a, at_a), (in_b, at_b) = held(flat_a), held(flat_b)
    rows_a, at_a, rows_b, at_b = rows_a[in_a], at_a[in_a], rows_b[in_b], at_b[in_b]
    n_b = np.bincount(at_b, minlength=len(shared))
    work = np.bincount(at_a, minlength=len(shared)) * n_b
    dense = work >= DENSE
    column = np.cumsum(dense) - 1
    for low in range(0, int(dense.sum()), COLUMNS):
        sides = []
        for rows, at, height in ((rows_a, at_a, out.shape[0]), (rows_b, at_b, out.shape[1])):
            own = dense[at] & (column[at] >= low) & (column[at] < low + COLUMNS)
            side = np.zeros((height, COLUMNS), np.float32)
            side[rows[own], column[at[own]] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    order = np.argsort(at_b, kind="stable")
    rows_b, start = rows_b[order], np.cumsum(n_b) - n_b
    thin = np.flatnonzero(~dense[at_a])
    for low in range(0, len(thin), COLUMNS * 16):
        own = thin[low:low + COLUMNS * 16]
        times = n_b[at_a[own]]
        place = np.repeat(start[at_a[own]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        out += np.bincount(np.repeat(rows_a[own], times) * out.shape[1] + rows_b[place],
                           minlength=out.size).reshape(out.shape).astype(np.float32)
    return out


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a matrix of links between rows and columns, the first row each row, and each column, hangs on."""
    rows, columns = np.arange(len(linked)), np.full(linked.shape[1], len(linked))
    while True:
        new_columns = np.minimum(columns, np.where(linked, rows[:, None], len(rows)).min(0, initial=len(rows)))
        new_rows = np.minimum(rows, np.where(linked, new_columns[None, :], len(rows)).min(1, initial=len(rows)))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def _hanging(groups: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int, part: int) -> DataFrame:
    """Spanning links (a, b) among classes that hang together (node, component), tile by tile."""
    shape = groups.groupBy("component").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"), F.count("*").alias("members"))
    asked = shape.agg(F.sum(F.col("parts") * F.col("members"))).first()[0] or 0
    rounds = max(1, -(-asked // max(SENT, classes.count())))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tiles = (groups.join(shape, "component").withColumn("own", own).withColumn("other", other)
             .select("node", F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
                     (F.col("own") <= F.col("other")).alias("low"), (F.col("own") >= F.col("other")).alias("high")))

    def run(table: pa.Table) -> pa.Table:
        flat, first = shingle_sets(table["text"], n)
        f1, _ = fingerprints(flat, first)
        node = table["node"].to_numpy()
        good = np.zeros(len(node), bool)
        good[np.unique(node, return_index=True)[1]] = True
        if not (f1 == node)[good].all():  # rows of one doc_id with other texts
            match = np.flatnonzero(f1 == node)
            good[:] = False
            good[match[np.unique(node[match], return_index=True)[1]]] = True
        size = np.diff(first)

        def side(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            chosen = np.flatnonzero(good & table[name].to_numpy(zero_copy_only=False))
            cuts = np.concatenate([[0], np.cumsum(size[chosen])])
            return chosen, np.concatenate([flat[first[i]:first[i + 1]] for i in chosen] or [NO_SHINGLE]), cuts

        (rows, flat_a, first_a), (columns, flat_b, first_b) = side("low"), side("high")
        shared = overlaps(flat_a, first_a, flat_b, first_b)
        linked = (100 + percent) * shared >= percent * (size[rows][:, None] + size[columns][None, :])
        top, under = forest(linked)
        a = np.concatenate([node[rows], node[columns[under < len(rows)]]])
        b = np.concatenate([node[rows[top]], node[rows[under[under < len(rows)]]]])
        return pa.table({"a": a[a != b], "b": b[a != b]})

    links = None
    for k in range(rounds):
        with brief_shuffles(docs.sparkSession):
            own_tiles = tiles.filter(F.pmod(F.xxhash64("tile"), F.lit(rounds)) == k)
            wanted = written(own_tiles.join(classes.select("node", F.col("component").alias("doc_id")), "node"), "wanted")
            few = wanted.count() <= SENT
            texts = (_keyed(docs).join(F.broadcast(wanted) if few else wanted, "doc_id")
                     .select("tile", "node", "low", "high", "text"))
            found = written(texts.groupBy("tile").applyInArrow(run, "a long, b long"), "hanging-links")
        discard(wanted)
        links = found if links is None else links.unionByName(found)
    return links


def classes_of(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, counters: int | None = None,
               long: int = LONG, part: int = PART) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    ``counters`` (default: one per 200 bytes of text, within fixed bounds) only serve the order of shingles.
    """
    blocks, buckets = sizes(docs)
    if counters is None:
        counters = min(MOST_COUNTERS, max(LEAST_COUNTERS, 1 << round(np.log2(blocks * BLOCK_BYTES / 200))))
    lots = min(counters, 4096, max(16, 1 << round(np.log2(max(1, blocks * BLOCK_BYTES / (6 * RANGE))))))
    with brief_shuffles(docs.sparkSession):
        survey, level = _survey(docs, n, counters, lots)
    classes = written(survey.filter("size > 0").groupBy(F.col("f1").alias("node"), "f2").agg(
        F.min("doc_id").alias("component")), "classes")
    with brief_shuffles(docs.sparkSession):
        product = written(_multiply(_prefixes(docs, level, n, percent, buckets), percent, long), "overlaps")

    stars = product.filter("star").select("a", "b").distinct()
    groups = written(components(stars), "hanging")
    links = _hanging(groups, classes, docs, n, percent, part)

    prefix = lambda c: F.col(c) - F.ceil(percent * F.col(c) / 100) + 1
    behind = lambda s: F.col(s) - prefix(s)
    bound = F.ceil(percent * (F.col("size_a") + F.col("size_b")) / (100 + percent))
    # A pair that shares a long column hangs together; for any other pair the count is complete.
    side = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"group_{c}"))
    pairs = (product.filter("not star").groupBy("a", "b")
             .agg(F.sum("overlap").alias("overlap"), F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b"))
             .filter(F.col("overlap") + F.greatest(behind("size_a"), behind("size_b")) >= bound)
             .join(side("a"), "a", "left").join(side("b"), "b", "left")
             .filter(~F.coalesce(F.col("group_a") == F.col("group_b"), F.lit(False))).select("a", "b"))
    links = links.unionByName(_verified(written(pairs, "candidates"), classes, docs, n, percent))
    labels = written(components(links), "labels")

    named = classes.join(labels.withColumnRenamed("component", "label"), "node", "left")
    smallest = named.filter("label is not null").groupBy("label").agg(F.min("component").alias("smallest"))
    named = (named.join(smallest, "label", "left")
             .select("node", "f2", F.coalesce("smallest", "component").alias("component_id")))
    out = survey.select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.col("f1").alias("node"), "f2")
    # Copies of one text meet in one class row, which is small: Spark can split the many rows.
    return (out.join(named, ["node", "f2"], "left")
            .select(F.nullif("doc_id", F.lit(NO_KEY)).alias("doc_id"), "n_shingles",
                    F.nullif(F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")),
                             F.lit(NO_KEY)).alias("component_id")))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One document of each group: the one with the smallest doc_id. All columns stay.

    Rows of one doc_id count as one document, of which one row stays. Rows without doc_id all stay,
    as nothing tells them apart.
    """
    found = (classes_of(docs, **options).filter("doc_id is not null")
             .groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    kept, number = fresh_name(docs, "kept_doc_id"), fresh_name(docs, "row_of_document")
    stay = found.filter("doc_id = component_id").select(F.col("doc_id").alias(kept))
    named = docs.join(stay, docs["doc_id"] == F.col(kept), "left_semi")
    row = Window.partitionBy("doc_id").orderBy("text")
    one = named.withColumn(number, F.row_number().over(row)).filter(F.col(number) == 1).drop(number)
    return one.unionByName(docs.filter("doc_id is null"))


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents)),
grams AS (
  SELECT doc_id, n, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s
  FROM words),
shingles AS (SELECT DISTINCT doc_id, md5(s) AS s FROM grams WHERE i <= n - 4 OR (n < 5 AND i = 1)),
sized AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
linked AS (
  SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT e.b AS node, r.root FROM reach r JOIN both_ways e ON e.a = r.node WHERE r.root < e.b)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.root)::BIGINT AS component_id
FROM documents d LEFT JOIN sized s USING (doc_id) JOIN reach r ON r.node = d.doc_id GROUP BY d.doc_id, s.n
"""
