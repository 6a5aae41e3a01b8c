"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are lowered and cut into plain words (punctuation parts words). Of every run of ``SPREAD``
neighbouring n-grams of a test item, the one that is rarest in the corpus is a seed, so any copy that
keeps n + SPREAD - 1 consecutive words of the item is met, however common the passage is. Every place
where a document holds a seed is aligned with the item: +2 for an equal word, -1 for another word or
a gap. The best local score over the perfect score of the item is the result's ``score``. A pair is contaminated
when that share reaches ``THRESHOLD``, or when the local score itself reaches ``ENOUGH``, that of 13 equal words in
a row: an excerpt counts however long its item is.

Test items are taken in blocks of at most ``BLOCK_WORDS`` words; a block's index is what is sent to the
tasks, so its size is bounded, and every block meets all documents. Documents are scanned twice per block
(counts of the item n-grams, then seeds) and never shuffled.

Null or empty texts match nothing, nor do items shorter than one n-gram. Repeated documents give
repeated rows, repeated items (equal id and text) count once. Ties between places of a document go to the first.
Empty tables give an empty result. Other columns are not read by ``find`` and pass through ``drop``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.tables import slices, texts_of
from flowtide.llm.words import NOT_PLAIN, U64, Words, split_words

GRAM, SPREAD, THRESHOLD, BLOCK_WORDS = 3, 2, 0.55, 500_000
MATCH, MISS, GAP = 2, -1, -1
ENOUGH = 13 * MATCH
CELLS = 1 << 20
RESULT = "doc_id long, item_id long, score double, first_word long, last_word long"


def plain_words(texts: pa.Array) -> Words:
    return split_words(pc.utf8_lower(texts.cast(pa.string())), space=NOT_PLAIN)


class Index:
    """The items of a block: their words, their n-grams, and after ``choose`` the seeds."""

    def __init__(self, ids: list[int | None], texts: list[str | None], n: int = GRAM) -> None:
        self.n, self.ids = n, ids
        words = plain_words(pa.array(texts, pa.string()))
        self.words, self.first = words.hashes, words.first
        self.at, grams = words.windows(n)
        self.grams, self.gram = np.unique(grams, return_inverse=True)

    def choose(self, counts: np.ndarray, spread: int = SPREAD) -> Index:
        """Keep as seeds the rarest n-gram of each run of ``spread`` neighbours (ties by hash)."""
        rank = np.lexsort([self.grams, counts]).argsort()[self.gram]
        seed = np.zeros(len(self.at), bool)
        item = np.searchsorted(self.first, self.at, "right") - 1
        for low, high in zip(np.searchsorted(item, np.arange(len(self.ids))),
                             np.searchsorted(item, np.arange(len(self.ids)), "right")):
            if high - low <= spread:
                if high > low:
                    seed[low + rank[low:high].argmin()] = True
                continue
            runs = np.lib.stride_tricks.sliding_window_view(rank[low:high], spread)
            seed[low + np.arange(len(runs)) + runs.argmin(1)] = True
        chosen = np.flatnonzero(seed)
        hashes = self.grams[self.gram[chosen]]
        order = np.argsort(hashes, kind="stable")
        self.seeds, self.seed_item = hashes[order], item[chosen][order]
        self.seed_place = (self.at[chosen] - self.first[item[chosen]])[order]
        del self.grams, self.gram, self.at
        return self


def align(items: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local scores of item rows against region rows, and where they end (item, region).

    Rows are padded: items with 0, regions with 1, which equal nothing.
    """
    pairs, width = regions.shape
    slope = GAP * np.arange(width, dtype=np.int32)
    score = np.zeros((pairs, width + 1), np.int32)
    best, row, column = (np.zeros(pairs, np.int32) for _ in range(3))
    for i in range(items.shape[1]):
        step = np.where(regions == items[:, i, None], MATCH, MISS).astype(np.int32)
        new = np.maximum(score[:, :-1] + step, score[:, 1:] + GAP)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new - slope, axis=1) + slope
        score[:, 1:] = new
        at = new.argmax(1)
        top = new[np.arange(pairs), at]
        better = (top > best) & (items[:, i] != 0)
        best[better], row[better], column[better] = top[better], i, at[better]
    return best, row, column


def _padded(parts: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(parts), max(map(len, parts))), fill, U64)
    for i, x in enumerate(parts):
        out[i, :len(x)] = x
    return out


def _places(words: Words, index: Index) -> list[tuple[int, int, int, int]]:
    """Regions of documents to align, as (document, item, first word, end word)."""
    at, grams = words.windows(index.n)
    if not len(at) or not len(index.seeds):
        return []
    low = np.searchsorted(index.seeds, grams)
    hit = np.flatnonzero(index.seeds[low.clip(max=len(index.seeds) - 1)] == grams)
    if not len(hit):
        return []
    low, high = low[hit], np.searchsorted(index.seeds, grams[hit], "right")
    times = high - low
    seed = np.arange(times.sum()) + np.repeat(low - (np.cumsum(times) - times), times)
    place = np.repeat(at[hit], times)
    item = index.seed_item[seed]
    doc = np.searchsorted(words.first, place, "right") - 1
    diagonal = place - index.seed_place[seed]
    length = np.diff(index.first)[item]
    order = np.lexsort([diagonal, item, doc])
    doc, item, diagonal, length = doc[order], item[order], diagonal[order], length[order]
    new = np.ones(len(order), bool)  # neighbours within an item's length are aligned together
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > length[1:])
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(order)) - 1
    slack = length[lead] // 2 + 2
    begin = np.maximum(diagonal[lead] - slack, words.first[doc[lead]])
    end = np.minimum(diagonal[last] + length[lead] + slack, words.first[doc[lead] + 1])
    return list(zip(doc[lead].tolist(), item[lead].tolist(), begin.tolist(), end.tolist()))


def matches(texts: pa.Array, index: Index, threshold: float = THRESHOLD) -> dict[tuple[int, int], tuple[float, int, int]]:
    """Contaminated (document, item) positions with score and first and last word of the best place."""
    words = plain_words(texts)
    places = sorted(_places(words, index), key=lambda p: (p[3] - p[2], p))
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    done = 0
    while done < len(places):
        end = done + 1
        while end < len(places) and (end + 1 - done) * (places[end][3] - places[end][2]) <= CELLS // 8:
            end += 1
        lot, done = places[done:end], end
        items = [index.words[index.first[i]:index.first[i + 1]] for _, i, _, _ in lot]
        regions = [words.hashes[a:b] for _, _, a, b in lot]
        best, row, column = align(_padded(items, 0), _padded(regions, 1))
        share = best / (MATCH * np.array([len(x) for x in items]))
        keep = np.flatnonzero((share >= threshold) | (best >= ENOUGH))
        if not len(keep):
            continue
        back = align(_padded([items[k][:row[k] + 1][::-1] for k in keep], 0),
                     _padded([regions[k][:column[k] + 1][::-1] for k in keep], 1))
        for k, length in zip(keep, back[2]):
            doc, item, begin, _ = lot[k]
            last = begin + int(column[k]) - int(words.first[doc])
            new = (float(share[k]), last - int(length), last)
            old = found.get((doc, item))
            if old is None or (-new[0], new[1]) < (-old[0], old[1]):
                found[doc, item] = new
    return found


def indexes(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Broadcast]:
    """One index with seeds per block of test items, sent to the executors."""
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .filter("text is not null").dropDuplicates())
    size = items.select(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x80-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = -(-size // block_words)
    texts = texts_of(docs)
    context = docs.sparkSession.sparkContext
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(own.collect(), key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"]))
        index = Index([r["item_id"] for r in rows], [r["text"] for r in rows])
        grams = context.broadcast(index.grams)  # at most block_words hashes

        def count(batches: Iterator[pa.RecordBatch], grams=grams, n=index.n) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(grams.value), np.int64)
            for batch in slices(batches):
                _, own = plain_words(batch.column("text")).windows(n)
                at = np.searchsorted(grams.value, own).clip(max=max(0, len(grams.value) - 1))
                if len(grams.value):
                    total += np.bincount(at[grams.value[at] == own], minlength=len(total))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"gram": some, "n": total[some]})

        counts = np.zeros(len(index.grams), np.int64)
        sums = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
        counts[sums["gram"].to_numpy()] = sums["n"].to_numpy()
        grams.unpersist()
        yield context.broadcast(index.choose(counts))


def find(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All contaminated pairs: doc_id, item_id, score, and the words of the document they cover."""
    def scan(index: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = sorted(matches(batch.column("text"), index.value, threshold).items())
                doc = pa.array([d for (d, _), _ in found], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(doc),
                    "item_id": pa.array([index.value.ids[i] for (_, i), _ in found], pa.int64()),
                    "score": pa.array([v[0] for _, v in found], pa.float64()),
                    "first_word": pa.array([v[1] for _, v in found], pa.int64()),
                    "last_word": pa.array([v[2] for _, v in found], pa.int64())})
        return run

    parts = [texts_of(docs).mapInArrow(scan(index), RESULT) for index in indexes(docs, benchmark)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], RESULT)


def drop(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without a contaminated passage, all columns kept."""
    def sieve(index: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, _ in matches(batch.column("text"), index.value, threshold)]] = False
                yield batch.filter(pa.array(keep))
        return run

    for index in list(indexes(docs, benchmark)):
        docs = docs.mapInArrow(sieve(index), docs.schema)
    return docs
