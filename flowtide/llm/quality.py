r"""Line-first quality rules: judge each line, drop the failing ones, then judge what is lost.

A line without a word is neutral. A line with words fails when one of the rules holds:

* ``punctuation``: it does not end in an end mark of any script (closing quotes and brackets may follow), and has
  fewer than 10 words or holds no finished sentence,
* ``navigation``: at least a fifth of its words are bare separators such as ``|`` or ``>``,
* ``symbols``: more than three characters of ``[#*$%&|<>]`` per ten words,
* ``boilerplate``: it holds stock phrases of notices, menus or licences as whole words, and at most
  ``PHRASE_WORDS`` words for each of them.

``judge`` reports these rules, ``clean`` applies them; both hold the same verdict on every document.

A document is rejected when its base measures fail (fewer than 10 words, or more than a fifth of
its words in repeated 5-word windows) or when more than half of its words were in failing lines.

Nulls and empty texts have no words and fail the base. Rows are judged one by one: repeated rows
give repeated results, ties do not arise, an empty table gives an empty result, other columns are
not read by ``judge`` and pass through ``clean`` unchanged. Long texts are read in slices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.tables import slices, texts_of
from flowtide.llm.words import SLICE, SPACE, U64, Words, covered, mix, per_text, split_words

SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", ">", "<", "/", "-", "*", "»", "›", "•", "·")
PHRASES = (
    "cookie", "javascript", "privacy policy", "terms of use", "terms of service",
    "all rights reserved", "lorem ipsum", "licensed under", "click here", "sign up", "log in",
    "subscribe to", "skip to content", "powered by", "read more", "share this",
)
PHRASE_WORDS = 15
MIN_WORDS, MAX_REPEAT, MAX_LOST, REPEAT_WINDOW = 10, 20, 50, 5

FIELDS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, n_failed_lines long, n_lost_words long, base_failed boolean, kept boolean")

# Latin end marks finish a sentence before white space, those of other scripts anywhere.
LATIN_ENDERS, OTHER_ENDERS = ".!?…", "。！？｡．؟۔।॥።፧፨։။។᠃‽⁇⁈⁉⸮"
LATIN_CLOSERS, CLOSERS = "\"'”’)]»", "\"'”’)]»」』）】》〉〕"
SPACES = " \t\r\x0b\x0c"
_ENDERS = tuple(LATIN_ENDERS + OTHER_ENDERS)
_FINISHED = re.compile(rf"[^\W_][{LATIN_ENDERS}]+[{re.escape(LATIN_CLOSERS)}]*[{SPACES}]|[{OTHER_ENDERS}]")
_PHRASE = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, PHRASES))})s?(?!\w)")
_PHRASE_BYTES = [p.encode() for p in PHRASES]
_LETTERS = ~SPACE & ((np.arange(256) & 0xC0) != 0x80)
_MARKS = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_SEPARATOR_HASHES = np.sort(split_words(pa.array(SEPARATORS)).hashes)


def unfinished(line: str, n: int) -> bool:
    """Whether a line of ``n`` words lacks terminal punctuation and is short or holds no finished sentence."""
    if line.rstrip(SPACES).rstrip(CLOSERS).endswith(_ENDERS):
        return False
    return n < MIN_WORDS or not _FINISHED.search(line)


def may_hold_phrase(line: bytes) -> bool:
    """Whether bytes, A-Z lowered, hold the letters of a stock phrase."""
    return any(p in line for p in _PHRASE_BYTES)


def stock_phrases(line: bytes, n: int) -> bool:
    """Whether whole stock phrases dominate a line of ``n`` words, given in bytes with A-Z lowered."""
    return n <= PHRASE_WORDS * len(_PHRASE.findall(line.decode()))


def count_bytes(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many bytes of each range are among ``values`` (a 256-entry mask)."""
    out = np.zeros(len(offsets), np.int64)
    before = 0
    for low in range(0, len(data), SLICE):
        sums = np.cumsum(values[data[low:low + SLICE]], dtype=np.int64)
        here = slice(*np.searchsorted(offsets, [low + 1, low + SLICE + 1]))
        out[here] = before + sums[offsets[here] - low - 1]
        before += int(sums[-1])
    return np.diff(out)


def repeated_words(words: Words, n: int) -> np.ndarray:
    """Words of each text that lie in an n-word window found twice or more in it."""
    at, hashes = words.windows(n)
    owner = np.searchsorted(words.first, at, "right") - 1
    keys = mix(hashes + owner.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return per_text(covered(np.sort(at[twice]), n, len(words.hashes)), words.first)


def failing_lines(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of all texts in order: start in bytes, number of words, whether navigation or symbols fail it."""
    starts = np.sort(np.concatenate([words.offsets[:-1], np.flatnonzero(words.data == 10) + 1]))
    borders = np.concatenate([starts, words.offsets[-1:]])
    first = np.searchsorted(words.starts, borders)
    n = np.diff(first)
    place = np.searchsorted(_SEPARATOR_HASHES, words.hashes).clip(max=len(_SEPARATOR_HASHES) - 1)
    bare = per_text(_SEPARATOR_HASHES[place] == words.hashes, first)
    marks = count_bytes(words.data, borders, _MARKS)
    return starts, n, (n > 0) & ((5 * bare >= n) | (10 * marks > 3 * n))


def _measure(texts: pa.Array, keep_text: bool) -> tuple[dict[str, np.ndarray], list[str | None]]:
    words = split_words(texts)
    n_words = np.diff(words.first)
    repeat = repeated_words(words, REPEAT_WINDOW)
    _, line_words, line_bad = failing_lines(words)
    line_words, line_bad, place = line_words.tolist(), line_bad.tolist(), 0
    duplicate, failed, lost, cleaned = [], [], [], []
    for d, text in enumerate(texts.to_pylist()):
        lines = (text or "").split("\n")
        low = words.data[words.offsets[d]:words.offsets[d + 1]].tobytes().lower()
        low_lines = low.split(b"\n") if may_hold_phrase(low) else None
        seen: set[str] = set()
        again = bad = gone = 0
        good = []
        for k, line in enumerate(lines):
            n = line_words[place + k]
            fails = False
            if n:
                again += line in seen
                seen.add(line)
                fails = line_bad[place + k] or unfinished(line, n) or (
                    low_lines is not None and may_hold_phrase(low_lines[k]) and stock_phrases(low_lines[k], n))
            if fails:
                bad += 1
                gone += n
            elif keep_text:
                good.append(line)
        place += len(lines)
        duplicate.append(again)
        failed.append(bad)
        lost.append(gone)
        if keep_text:
            cleaned.append(text if text is None or not bad else "\n".join(good))
    lost = np.array(lost, np.int64)
    base = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT * n_words)
    return {
        "n_words": n_words, "word_chars": count_bytes(words.data, words.offsets, _LETTERS),
        "n_symbols": count_bytes(words.data, words.offsets, _MARKS),
        "n_dup_lines": np.array(duplicate, np.int64), "n_repeat_words": repeat,
        "n_failed_lines": np.array(failed, np.int64), "n_lost_words": lost,
        "base_failed": base, "kept": ~base & (100 * lost <= MAX_LOST * n_words),
    }, cleaned


def judge(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            measures, _ = _measure(batch.column("text"), False)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **measures})

    return texts_of(docs).mapInArrow(run, FIELDS)


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents with their failing lines removed; all columns stay.

    A column ``n_chars`` is brought up to date with the shortened text.
    """
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            measures, cleaned = _measure(batch.column("text"), True)
            out = batch.set_column(place, batch.schema.field(place), pa.array(cleaned, batch.schema.field(place).type))
            yield out.filter(pa.array(measures["kept"]))

    kept = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept
