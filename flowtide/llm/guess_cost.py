"""What a password costs to guess: the cheapest way to cut it into words, dates, repeats, keyboard walks and rest.

Costs are thousandths of the decimal logarithm of a number of guesses, as whole numbers, so that sums are exact. A
segmentation costs the sum of its parts, and dynamic programming over the end positions finds the smallest.

- a character by itself: the size of its class (10 digits, 26 small or large letters, 33 others);
- a word of 3 to 24 characters: its rank among the words of the corpus or in ``COMMON``, doubled for every character
  written as a look-alike and for every large letter (once if only the first or all are large);
- a date: a year from 1900 to 2099, or day, month and year in one of the usual orders, with or without marks between;
- a repeat: a unit of one to four characters (three times at least if one, else twice) pays its characters once
  and the number of times;
- a walk: three or more characters, each beside the last on a keyboard, or next to it in the alphabet or the digits;
  it pays a start, its length, and a factor of three for each turn.

A value longer than ``BLOCK`` code points is cut every ``BLOCK``; equal blocks are paid once, and so is their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from math import log10

BLOCK = 64
MIN_WORD, MAX_WORD = 3, 24

# Look-alikes, the rows of a keyboard, and common passwords by rank.
LOOK_ALIKES = {"4": "a", "@": "a", "8": "b", "3": "e", "6": "g", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
COMMON = ("password", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "login", "master", "iloveyou", "secret",
          "abc", "test", "guest", "root", "changeme", "default", "football", "baseball", "superman", "batman", "trustno",
          "sunshine", "princess", "shadow", "user", "demo", "example", "sample", "temp", "none", "null", "true", "false")

_milli = lambda x: round(1000 * log10(x))
DIGIT, LETTER, OTHER = _milli(10), _milli(26), _milli(33)
TWICE, TURN, START = _milli(2), _milli(3), _milli(47)
YEAR, DATE, MARKED = _milli(200), _milli(365 * 200), _milli(4)

_PLACE = {c: (row, column) for row, keys in enumerate(KEYBOARD) for column, c in enumerate(keys)}
_COMMON = {word: _milli(rank) for rank, word in enumerate(COMMON, 1)}

_D, _M, _Y = "(?:0[1-9]|[12][0-9]|3[01])", "(?:0[1-9]|1[0-2])", "(?:19|20)[0-9][0-9]"
_d, _m = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])"
#: Pattern and cost; each may match at any place, and the date forms end in a fixed or the longest way.
DATES = [(re.compile(p), cost) for p, cost in [
    (_Y, YEAR), (f"{_Y}{_M}{_D}", DATE), (f"{_D}{_M}{_Y}", DATE), (f"{_M}{_D}{_Y}", DATE),
    (f"{_D}{_M}[0-9][0-9]", DATE), (f"[0-9][0-9]{_M}{_D}", DATE),
    (f"{_Y}([-/._]){_m}\\1{_d}", DATE + MARKED), (f"{_d}([-/._]){_m}\\1{_Y}", DATE + MARKED),
    (f"{_m}([-/._]){_d}\\1{_Y}", DATE + MARKED)]]


def character(c: str) -> int:
    if "0" <= c <= "9":
        return DIGIT
    return LETTER if "a" <= c.lower() <= "z" and c.isascii() else OTHER


def plain(c: str) -> str:
    """A character as words are looked up: small letter, look-alikes undone."""
    return c.lower() if c.isascii() and c.isalpha() else LOOK_ALIKES.get(c, c)


def _wordlike(c: str) -> bool:
    return not c.isascii() or (c.isalpha() and c.islower())


def pieces(text: str) -> set[str]:
    """Every piece of a block that could be a word."""
    flat = [plain(c) for c in text]
    out = set()
    for i in range(len(flat)):
        for j in range(i, min(len(flat), i + MAX_WORD)):
            if not _wordlike(flat[j]):
                break
            if j - i + 1 >= MIN_WORD:
                out.add("".join(flat[i:j + 1]))
    return out


def variants(written: str) -> int:
    """Cost of large letters and look-alikes in a word as it is written."""
    large = [c.isascii() and c.isupper() for c in written]
    letters = sum(c.isascii() and c.isalpha() for c in written)
    count = sum(large)
    if count and (count == letters or (count == 1 and large[0])):
        count = 1
    return TWICE * (count + sum(c in LOOK_ALIKES for c in written))


def _words(text: str, i: int, flat: str, ranks: Mapping[str, int]) -> Iterator[tuple[int, int]]:
    for j in range(i + 1, min(len(text), i + MAX_WORD) + 1):
        if not _wordlike(flat[j - 1]):
            return
        if j - i >= MIN_WORD:
            piece = flat[i:j]
            known = [table[piece] for table in (ranks, _COMMON) if piece in table]
            if known:
                yield j, min(known) + variants(text[i:j])


def _repeats(text: str, i: int) -> Iterator[tuple[int, int]]:
    for size in range(1, 5):
        unit, times = text[i:i + size], 1
        own = sum(map(character, unit))
        while text[i + size * times:i + size * (times + 1)] == unit and len(unit) == size:
            times += 1
            if times >= (3 if size == 1 else 2):
                yield i + size * times, own + _milli(times)


def step(a: str, b: str) -> tuple[int, int] | None:
    """How a walk gets from one character to the next: a direction, or nothing if they are not neighbours."""
    if a.isascii() and a.isalnum() and b.isalnum() and a.isdigit() == b.isdigit() and abs(ord(b) - ord(a)) == 1:
        return (9, ord(b) - ord(a))  # along the alphabet or the digits
    if a in _PLACE and b in _PLACE:
        down, right = (y - x for x, y in zip(_PLACE[a], _PLACE[b]))
        if abs(down) <= 1 and abs(right) <= 1 and (down or right):
            return (down, right)
    return None


def _walks(text: str, i: int) -> Iterator[tuple[int, int]]:
    low, turns, last, large = text.lower() if text.isascii() else text, 0, None, False
    for j in range(i + 1, len(text)):
        way = step(low[j - 1], low[j])
        if way is None:
            return
        turns += last is not None and way != last
        last = way
        if j - i >= 2:
            large = any(c.isupper() for c in text[i:j + 1])
            yield j + 1, START + _milli(j + 1 - i) + TURN * turns + TWICE * large


def _dates(text: str, i: int) -> Iterator[tuple[int, int]]:
    for pattern, cost in DATES:
        found = pattern.match(text, i)
        if found:
            yield found.end(), cost


def block_cost(text: str, ranks: Mapping[str, int]) -> int:
    """The smallest cost of a block; ``ranks`` gives the cost of the words of the corpus among its pieces."""
    flat = "".join(map(plain, text))
    best = [0] + [-1] * len(text)
    for i, c in enumerate(text):
        for j, cost in ((i + 1, character(c)), *_words(text, i, flat, ranks), *_repeats(text, i), *_walks(text, i),
                        *_dates(text, i)):
            if best[j] < 0 or best[i] + cost < best[j]:
                best[j] = best[i] + cost
    return best[-1]


def blocks(value: str) -> tuple[list[str], int]:
    """The different blocks of a value, and how many blocks it has."""
    cut = [value[i:i + BLOCK] for i in range(0, len(value), BLOCK)]
    return list(dict.fromkeys(cut)), len(cut)
