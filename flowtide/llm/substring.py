"""Substring deduplication by difference-cover anchors.

A window is ``window`` consecutive words of one document. Every word covered by a window whose word
sequence also starts earlier (smaller doc_id, or earlier in the same document) is removed; windows are
judged on the input, not on what is left.

Positions p of a document whose remainder modulo a period v lies in a difference cover D are hashed
there over the next window - v + 1 words. Any two equal windows, wherever they start, share a shift
below v that puts both on cover positions, so they share an aligned anchor. First pass: blocks ask which
of their anchors occur again anywhere. Second pass: each repeated anchor is extended to the full windows
around it, and blocks ask whether a window's sequence starts in an earlier document. Third pass: covered
words are cut. A passage shared by any number of documents costs one key per block, never a pair.

Documents are ordered by doc_id, null first; equal ids by text. A null or empty text has no words. Repeated
rows count as documents of their own, the first one is kept. A document shorter than the window stays
whole. An empty table gives an empty result. ``deduplicate`` carries all other columns along untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.blocks import (PACKET, answers, dealt, fresh_name, gathered, in_order, opened, packets, sizes)
from flowtide.llm.words import Words, covered, per_text, split_words

WINDOW = 20
# Perfect difference sets, each covering all differences modulo its period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of at least a third of the window."""
    period = max(v for v in COVERS if v == 1 or 3 * (window - v + 1) >= window)
    return period, COVERS[period]


class _Block:
    """Words of a block's documents in order, with the anchors at cover positions."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.table = in_order(table)
        self.words: Words = split_words(self.table["text"])
        self.window = window
        period, places = cover(window)
        self.period = period
        first, n = self.words.first, np.diff(self.words.first)
        total = len(self.words.hashes)
        owner = np.repeat(np.arange(len(n)), n)
        self.owner = owner
        place = np.arange(total) - first[:-1][owner]
        self.starts_window = place + window <= n[owner]
        length = window - period + 1
        anchor = np.isin(place % period, places) & (place + length <= n[owner]) & (n[owner] >= window)
        self.at = np.flatnonzero(anchor)
        hashes = self.words.window_hashes(self.at, length)
        self.keys, self.inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        self.twice = counts > 1

    def extend(self, repeated: np.ndarray) -> None:
        """Windows around repeated anchors: their sequences, and the first start of each in the block."""
        at = self.at[repeated[self.inverse]]
        near = np.zeros(len(self.words.hashes), bool)
        if len(at):  # a window starts at most period - 1 words before its anchor
            begin = np.maximum(at - self.period + 1, 0)
            steps = np.bincount(begin, minlength=len(near) + 1) - np.bincount(at + 1, minlength=len(near) + 1)
            near = np.cumsum(steps)[:-1] > 0
        self.windows = np.flatnonzero(near & self.starts_window)
        hashes = self.words.window_hashes(self.windows, self.window)
        self.sequences, first, self.sequence = np.unique(hashes, return_index=True, return_inverse=True)
        self.later = np.ones(len(hashes), bool)
        self.later[first] = False
        ids = self.table["doc_id"].cast(pa.int64()).combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()
        self.first_ids = ids[self.owner[self.windows[first]]]


def deduplicate(docs: DataFrame, window: int = WINDOW, block_bytes: int | None = None) -> DataFrame:
    """All rows and columns, with ``n_words``, ``n_removed`` and ``kept_text`` (words joined by one space).

    Columns of these names in the input are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text")
    blocks, buckets = sizes(docs, block_bytes) if block_bytes else sizes(docs)
    mark = fresh_name(docs, "block")
    whole = dealt(docs, blocks, mark)  # one exchange by block serves all three passes

    def ask_anchors(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(table, window)
        return packets(key[0].as_py(), block.keys, buckets, block.twice.astype(np.uint8))

    def meet_anchors(key: tuple, table: pa.Table) -> pa.Table:
        keys, owner, twice = opened(table, "u1")
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = counts > 1
        again |= np.bincount(inverse, twice, len(counts)) > 0
        return answers(table, owner, again[inverse])

    def ask_windows(key: tuple, texts: pa.Table, flags: pa.Table) -> pa.Table:
        block = _Block(texts, window)
        block.extend(gathered(flags, block.keys, buckets))
        return packets(key[0].as_py(), block.sequences, buckets, block.first_ids)

    def meet_windows(key: tuple, table: pa.Table) -> pa.Table:
        keys, owner, ids = opened(table, "i8")
        order = np.lexsort([ids, keys])
        lead = np.ones(len(keys), bool)
        lead[1:] = keys[order][1:] != keys[order][:-1]
        smallest = ids[order][lead][np.cumsum(lead) - 1]
        later = np.zeros(len(keys), bool)
        later[order] = ids[order] > smallest
        return answers(table, owner, later)

    def cut(key: tuple, texts: pa.Table, flags: pa.Table) -> pa.Table:
        block = _Block(texts, window)
        kind = flags["kind"].to_numpy()
        block.extend(gathered(flags.filter(pa.array(kind == 0)), block.keys, buckets))
        elsewhere = gathered(flags.filter(pa.array(kind == 1)), block.sequences, buckets)
        again = block.windows[block.later | elsewhere[block.sequence]]
        words = block.words
        gone = covered(again, window, len(words.hashes))
        removed = per_text(gone, words.first)
        raw, kept = words.data, []
        for d in range(words.texts):
            a, b = words.first[d], words.first[d + 1]
            whole = raw[words.offsets[d]:words.offsets[d + 1]].tobytes()
            if removed[d]:
                base = words.offsets[d]
                stay = np.flatnonzero(~gone[a:b]) + a
                own = b" ".join([whole[s:e] for s, e in zip((words.starts[stay] - base).tolist(),
                                                            (words.ends[stay] - base).tolist())]).decode("utf-8", "replace")
            else:
                own = b" ".join(whole.split()).decode("utf-8", "replace")
            kept.append(own)
        out = block.table.drop_columns([mark])
        return (out.append_column("n_words", pa.array(np.diff(words.first)))
                .append_column("n_removed", pa.array(removed))
                .append_column("kept_text", pa.array(kept, pa.string())))

    flags = (whole.groupBy(mark).applyInArrow(ask_anchors, PACKET)
             .groupBy("bucket").applyInArrow(meet_anchors, PACKET).withColumnRenamed("block", mark))
    later = (whole.groupBy(mark).cogroup(flags.groupBy(mark)).applyInArrow(ask_windows, PACKET)
             .groupBy("bucket").applyInArrow(meet_windows, PACKET).withColumnRenamed("block", mark))
    both = flags.withColumn("kind", F.lit(0)).unionByName(later.withColumn("kind", F.lit(1)))
    schema = ", ".join([*(f"`{n}` {t}" for n, t in whole.dtypes if n != mark),
                        "n_words long, n_removed long, kept_text string"])
    return whole.groupBy(mark).cogroup(both.groupBy(mark)).applyInArrow(cut, schema)


def cut(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated passages removed; the columns stay as they are.

    A text that loses nothing keeps its white space, one that loses words has one space between the words
    left, one that loses all its words goes. A column ``n_chars`` is brought up to date.
    """
    own = {c: f"own_{i}_{c}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    found = (deduplicate(docs.withColumnsRenamed(own), window)
             .filter((F.col("n_words") == 0) | (F.col("n_removed") < F.col("n_words"))))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")).alias("text")
    out = found.select(*(text if c == "text" else F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, words, removed words and the sha256 of the kept text."""
    rows = deduplicate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), window)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SUBSTRING_SQL = rf"""
WITH words AS (
  SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
    SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
windows AS (
  SELECT r, i, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS seq,
         lead(i, {WINDOW - 1}) OVER (PARTITION BY r ORDER BY i) IS NOT NULL AS full_window
  FROM words),
later AS (
  SELECT r, i FROM (
    SELECT r, i, row_number() OVER (PARTITION BY md5(seq) ORDER BY r, i) AS nth FROM windows WHERE full_window)
  WHERE nth > 1),
gone AS (SELECT DISTINCT r, i + k AS i FROM later, range({WINDOW}) t(k)),
kept AS (
  SELECT w.r, count(*) AS n, count(g.i) AS removed,
         string_agg(w.word, ' ' ORDER BY w.i) FILTER (g.i IS NULL) AS body
  FROM words w LEFT JOIN gone g ON w.r = g.r AND w.i = g.i GROUP BY w.r)
SELECT d.doc_id, coalesce(k.n, 0)::BIGINT AS n_words, coalesce(k.removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS r, doc_id FROM documents) d LEFT JOIN kept k USING (r)
"""
