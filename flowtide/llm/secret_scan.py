"""Secrets in whole texts: fixed patterns, and values in a credential's place that are too costly to guess.

The patterns give the base spans: assignments to a credential's name, access keys and long runs of hex digits. Wider
credential contexts give further values, with any characters: ``pwd: ...``, ``passphrase is ...``, ``bearer ...``.
Such a value outside the base spans becomes a span of kind ``guess`` if the cheapest segmentation into words, dates,
repeats, keyboard walks and single characters (:mod:`flowtide.llm.guess_cost`) takes ``STRONG`` guesses or more, so
that ``password is required`` or ``pwd: qwerty2024`` are left alone.

Word ranks come from all texts: every word of 3 to 24 characters outside of values and spans is counted. The pieces
of the values are joined with the counts, so no dictionary is sent along and none is cut off; a word's rank is the
number of words in its own or a higher power of two of occurrences. Values are cut into blocks of 64 code points;
each different block is judged once, however often it occurs.

One pass finds spans and values and is written, one counts words. Texts are not shuffled.

Defined results: a null or empty text has no spans (the digest is that of the empty text). Repeated rows are answered
one by one, also with equal or null doc_id. A doubtful value of any length is judged whole. An empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm import guess_cost
from flowtide.llm.guess_cost import MAX_WORD, MIN_WORD
from flowtide.llm.tables import slices, texts_of, written
from flowtide.llm.terms import out_batches, pooled, runs

#: Guesses, as thousandths of the decimal logarithm, from which a value counts as a secret.
STRONG = 10_000

KINDS = ("assign", "access", "hex", "guess")
_ANY_CASE = re.IGNORECASE | re.ASCII
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _ANY_CASE)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: Where a credential's value is expected; the value ends at white space, a quote, a comma or a bracket.
CONTEXT = re.compile(
    r"""(?:(?:password|passwd|passphrase|passcode|pwd|secret|token|(?:api|access|private|secret)[_-]?key|credentials?)
        ["']?[\x20\t]*(?::=|=>|[:=]|(?<=[\x20\t])is(?=[\x20\t]))[\x20\t]*|bearer[\x20\t]+)
        ["']?([^\x20\x09-\x0D"'`,;<>(){}\[\]]+)""", _ANY_CASE | re.VERBOSE)
_CLOSING = ".:!?"
#: What any span or value holds; texts without it are not searched.
_HINT = "passw|passphrase|passcode|pwd|secret|token|api_?key|[_-]key|accesskey|privatekey|credential|bearer|akia|[0-9a-f]{32}"

FOUND = ("doc_id long, row long, base array<struct<start:int,kind:int,stop:int>>, "
         "found array<struct<start:int,stop:int,parts:int,blocks:array<string>>>")
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
_VALUE = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("parts", pa.int32()),
                             ("blocks", pa.list_(pa.string()))]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the patterns' matches, in code points, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(out)


def values(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, stop) of the values in a credential's place that no base span covers."""
    out = []
    for m in CONTEXT.finditer(text):
        start, stop = m.start(1), m.start(1) + len(m[1].rstrip(_CLOSING))
        if stop > start and not any(a <= start and stop <= b for a, _, b in base):
            out.append((start, stop))
    return out


def _hinted(texts: pa.Array) -> list[int]:
    hit = pc.match_substring_regex(texts, _HINT, ignore_case=True)
    return np.flatnonzero(pc.fill_null(hit, False).to_numpy(zero_copy_only=False)).tolist()


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and doubtful values of each text."""
    for batch in slices(batches):
        texts = batch.column("text")
        base: list[list] = [[] for _ in range(batch.num_rows)]
        found: list[list] = [[] for _ in range(batch.num_rows)]
        for i in _hinted(texts):
            text = texts[i].as_py()
            spans = base_spans(text)
            base[i] = [{"start": a, "kind": k, "stop": b} for a, k, b in spans]
            for start, stop in values(text, spans):
                own, parts = guess_cost.blocks(text[start:stop])
                found[i].append({"start": start, "stop": stop, "parts": parts, "blocks": own})
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(base, _SPAN), pa.array(found, _VALUE)],
            names=["doc_id", "row", "base", "found"])


def _without_values(texts: pa.Array) -> pa.Array:
    """The texts with spaces for their spans and values."""
    hinted = _hinted(texts)
    if not hinted:
        return texts
    whole = texts.to_pylist()
    for i in hinted:
        spans = base_spans(whole[i])
        for start, stop in [*[(a, b) for a, _, b in spans], *values(whole[i], spans)]:
            whole[i] = whole[i][:start] + " " * (stop - start) + whole[i][stop:]
    return pa.array(whole, pa.large_string())


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word occurs outside of spans and values, added up within a task."""
    def parts() -> Iterator[tuple]:
        for batch in slices(batches):
            found, _ = runs(_without_values(batch.column("text")))
            coded = found.dictionary_encode()
            times = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
            length = pc.utf8_length(coded.dictionary.cast(pa.large_string())).to_numpy(zero_copy_only=False)
            kept = np.flatnonzero((length >= MIN_WORD) & (length <= MAX_WORD))
            yield [None], np.zeros(len(kept), np.int64), coded.dictionary.take(pa.array(kept)), times[kept]

    for _, _, words, word, n in pooled(parts()):
        yield from out_batches({"word": words.take(pa.array(word)).cast(pa.large_string()).cast(pa.string()),
                                "n": pa.array(n, pa.int64())})


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            own = batch.column("block").slice(low, 512).to_pylist()
            rows = [(b, p) for b in own for p in sorted(guess_cost.pieces(b))]
            yield pa.RecordBatch.from_pydict({"block": pa.array([b for b, _ in rows], pa.string()),
                                              "word": pa.array([p for _, p in rows], pa.string())})


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("block").to_pylist(), batch.column("ranks").to_pylist())
        costs = [guess_cost.block_cost(block, {r["word"]: r["cost"] for r in ranks or ()}) for block, ranks in rows]
        yield pa.RecordBatch.from_pydict({"block": batch.column("block"), "cost": pa.array(costs, pa.int64())})


def word_costs(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word, cost) of the wanted words that the corpus has, by rank."""
    counts = written(docs.select("text").mapInArrow(word_counts, "word string, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")), "words")
    size = F.length(F.bin("n"))
    # At most 63 rows: words by the power of two of their occurrences.
    sizes = sorted(counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
    rank, costs = 0, []
    for r in sizes:
        rank += r["words"]
        costs.append((r["size"], guess_cost._milli(rank)))
    table = F.create_map(*[F.lit(x) for pair in costs for x in pair]) if costs else F.create_map().cast("map<int,int>")
    held = counts.join(wanted.select("word").distinct(), "word", "left_semi")
    return held.select("word", table[size].alias("cost"))


def block_costs(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, cost) of every different block."""
    pieces = blocks.mapInArrow(_pieces, "block string, word string")
    ranked = pieces.join(word_costs(docs, pieces), "word").groupBy("block").agg(
        F.collect_list(F.struct("word", "cost")).alias("ranks"))  # at most 64 x 22 pieces
    return blocks.join(ranked, "block", "left").select("block", "ranks").mapInArrow(_judged, "block string, cost long")


def _joined(spans) -> F.Column:
    kinds = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["stop"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, one row per document."""
    docs = texts_of(docs)
    scanned = written(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(scan, FOUND), "scanned")
    doubtful = scanned.select("row", F.inline("found")).select(
        "row", "start", "stop", "parts", F.explode("blocks").alias("block"))
    blocks = written(doubtful.select("block").distinct(), "blocks")
    costs = written(block_costs(docs, blocks), "costs")
    number = F.round(F.log10(F.col("parts").cast("double")) * 1000).cast("long")
    secrets = (doubtful.join(costs, "block").groupBy("row", "start", "stop", "parts").agg(F.sum("cost").alias("cost"))
               .filter(F.col("cost") + number >= STRONG)
               .groupBy("row").agg(F.collect_list(F.struct(
                   "start", F.lit(KINDS.index("guess")).alias("kind"), "stop")).alias("guess")))
    empty = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    base = F.array_sort("base")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.join(secrets, "row", "left").select(
        "doc_id", *[of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])],
        F.coalesce(F.size("guess"), F.lit(0)).cast("long").alias("n_guess"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", F.coalesce("guess", empty)))).alias("spans"))
