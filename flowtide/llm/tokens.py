"""Token ids of whole texts with a public vocabulary, encoding each different word once.

The vocabulary drops white space and no merge crosses it, so the ids of a text are those of its
words in order. Each Python worker keeps the ids of words it has met in flat sorted arrays, up to
``KEPT`` words; a word outside them is encoded again, so results do not depend on the store.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from flowtide.llm.words import U64, Words, split_words

VOCABULARY = "word_bpe_49k.json"
KEPT = 4_000_000
_TOGETHER = 256
_encoders: dict[str, Encoder] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str | None = None) -> Encoder:
    """This process's encoder for a vocabulary file."""
    path = path or vocabulary_path()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges ``start, start + 1, ...`` of the given lengths."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.size = self.model.get_vocab_size(with_added_tokens=True)
        added = self.model.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        mark = max(added, default=None)
        self.kind = np.uint16 if self.size <= 1 << 16 else np.int32
        self.mark, self.between = mark, added[mark].content if added else None
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, U64)
        self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, self.kind), 0

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words, end to end, and how many each has."""
        if self.between is None or any(s in w for s in self.special for w in words):
            out = [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
            return (np.array([i for ids in out for i in ids], np.int32),
                    np.array([len(ids) for ids in out], np.int64))
        # Words are set apart by a special token, which no word here contains.
        lots = [self.between.join(words[i:i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)]
        ids = []
        for e in self.model.encode_batch_fast(lots, add_special_tokens=False):
            ids += e.ids
            ids.append(self.mark)
        ids = np.array(ids, np.int32)
        marks = np.flatnonzero(ids == self.mark)
        return ids[ids != self.mark], np.diff(marks, prepend=-1) - 1

    def _learn(self, words: Words, hashes: np.ndarray, where: np.ndarray) -> None:
        raw = words.data.tobytes() if len(where) > 1000 else words.data
        text = [bytes(raw[a:b]).decode("utf-8", "replace")
                for a, b in zip(words.starts[where].tolist(), words.ends[where].tolist())]
        odd = [i for i, w in enumerate(text) if any(s in w for s in self.special)]
        for part in ([i for i in range(len(text)) if i not in set(odd)] if odd else range(len(text)), odd):
            if not len(part):
                continue
            flat, length = self._encode_words([text[i] for i in part])
            own = hashes[list(part)] if odd else hashes
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat[:self.used], np.zeros(self.used + len(flat), self.kind)])
            self.flat[self.used:self.used + len(flat)] = flat
            start = (self.used + np.cumsum(length) - length).astype(np.int32)
            self.used += len(flat)
            known = np.concatenate([self.known, own])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.start = np.concatenate([self.start, start])[order]
            self.length = np.concatenate([self.length, length.astype(np.int32)])[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of each text in them."""
        words = split_words(texts)
        if len(self.known) > KEPT:
            self._clear()
        distinct, where, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        missing = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        missing[inside] = self.known[at[inside]] != distinct[inside]
        if missing.any():
            self._learn(words, distinct[missing], where[missing])
            at = np.searchsorted(self.known, distinct)
        start, length = self.start[at][inverse], self.length[at][inverse]
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
        return self.flat[ranges(start, length)], before[words.first]
