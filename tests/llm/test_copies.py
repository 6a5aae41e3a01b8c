"""N-gram join, components and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from flowtide.llm import ngram_join, substring
from flowtide.llm.components import components
from tests.llm.samples import near_copies, table, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def brute_classes(rows):
    sets = []
    for _, text in rows:
        w = lowered(text)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = {d: d for d, _ in rows}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((top(rows[i][0]), top(rows[j][0])))
                parent[y] = x
    return sorted((d, len(s), top(d)) for (d, _), s in zip(rows, sets))


@pytest.mark.parametrize("long, part, seed", [(24, 512, 3), (1, 2, 3), (3, 3, 4), (2, 50, 5)])
def test_join_equals_brute_force(spark, long, part, seed):
    rows = near_copies(seed)
    found = ngram_join.classes_of(table(spark, rows), long=long, part=part).collect()
    assert sorted(tuple(r) for r in found) == brute_classes(rows)


def test_frequent_shingles_do_not_change_the_join(spark):
    rows = near_copies(6)
    few = ngram_join.classes_of(table(spark, rows), counters=64, long=2).collect()
    assert sorted(tuple(r) for r in few) == brute_classes(rows)


def test_chance_repeats_stay_out_of_prefixes(spark, monkeypatch):
    """Passages of 60 documents are told from rare ones though each of few counters holds hundreds of shingles."""
    shared = [f"{w}{p}" for p in range(12) for w in ("all", "of", "these", "agree", "here", "")]
    rows = [(d, " ".join([f"w{d}x{k}" for k in range(200)] + [w if d < 60 and w.strip("0123456789") else f"{w}y{d}"
                                                              for w in shared])) for d in range(300)]
    hanging, whole = [], ngram_join._hanging
    monkeypatch.setattr(ngram_join, "_hanging", lambda groups, *a: hanging.append(groups.count()) or whole(groups, *a))
    found = ngram_join.classes_of(table(spark, rows), counters=256, long=2).collect()
    assert sorted(tuple(r) for r in found) == [(d, len(t.split()) - 4, d) for d, t in rows]
    assert hanging == [0]


def test_counts_of_shingles_by_ranges():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 64, 5000, np.uint64)
    often = hashes[:3]
    runs = [np.concatenate([hashes[k::4], np.repeat(often, 30)]) for k in range(4)] + [hashes[:0]]
    tables = [pa.table(ngram_join.counted_cells(x, 16)) for x in runs]
    whole = pa.concat_tables(tables).to_pylist()
    level = np.zeros(1 << 12, np.uint8)
    for lot in range(16):
        own = pa.Table.from_pylist([r for r in whole if r["lot"] == lot], tables[0].schema)
        level[lot << 8:(lot + 1) << 8] = ngram_join.counter_levels(own, 16, 1 << 12)
    assert sum(len(t) for t in tables) <= 64 and sum(r["cells"] for r in whole) < 5020
    at = (often >> np.uint64(52)).astype(int)
    assert sorted(np.flatnonzero(level)) == sorted(at)
    assert abs(level[at].astype(int) - np.ceil(4 * np.log2(1 + 121 - 4))).max() <= 1


@pytest.mark.parametrize("stage", [False, True])
def test_large_groups_meet_in_rounds(spark, monkeypatch, stage):
    """Tiles ask for more texts than there are classes: no round asks for many more than that."""
    rows = near_copies(7)
    whole, asked = ngram_join.written, []

    def counted(df, purpose):
        out = whole(df, purpose)
        if purpose == "wanted" and "low" in df.columns:
            asked.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    monkeypatch.setattr(ngram_join, "SENT", 1)
    if stage:  # as the pipeline asks for it
        kept = ngram_join.keep_first(table(spark, rows), long=1, part=1).collect()
        assert sorted(r["doc_id"] for r in kept) == [d for d, _, c in brute_classes(rows) if d == c]
    else:
        found = ngram_join.classes_of(table(spark, rows), long=1, part=1).collect()
        assert sorted(tuple(r) for r in found) == brute_classes(rows)
    assert len(asked) > 2 and max(asked) <= 2 * len(rows)


def test_join_of_empty_and_repeated_rows(spark):
    assert ngram_join.classes_of(table(spark, [])).count() == 0
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (7, None),
            (None, "g h i j k l"), (None, None)]
    found = {tuple(r) for r in ngram_join.classes_of(table(spark, rows)).collect()}
    assert found == {(5, 2, 2), (2, 2, 2), (None, 2, 2), (7, 0, 7), (None, 2, None), (None, 0, None)}
    kept = ngram_join.keep_first(table(spark, rows))
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["2", "7", "None", "None", "None"] and kept.columns[1] == "text"


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (4, 4), (None, 5), (21, 20)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {
        1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20}
    chain = [(i, i + 1) for i in range(60)]
    assert {r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()} == {0}


def brute_cut(rows, n):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        w = WORD.findall(rows[i][1] or "")
        gone = set()
        for k in range(len(w) - n + 1):
            window = tuple(w[k:k + n])
            if window in seen:
                gone.update(range(k, k + n))
            seen.add(window)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((rows[i][0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, seed", [(20, 3), (20, 5), (4, 3), (1, 4), (7, 6)])
def test_substrings_equal_brute_force(spark, window, seed):
    rows = near_copies(seed) + [(700, " ".join(words(30, 9) * 3)), (701, " ".join(words(30, 9)))]
    found = substring.digest(table(spark, rows), window).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_cut(rows, window)


def test_substrings_of_nulls_ties_and_odd_columns(spark):
    text = " ".join(words(40, 1))
    rows = [(None, text), (1, text), (1, text), (2, None), (3, ""), (4, text + " tail")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, block int, kept_text string")
    out = sorted(substring.deduplicate(docs).collect(), key=lambda r: (str(r["doc_id"]), r["n_removed"]))
    assert [(r["doc_id"], r["n_removed"], r["block"]) for r in out] == [
        (1, 40, 1), (1, 40, 1), (2, 0, 1), (3, 0, 1), (4, 40, 1), (None, 0, 1)]
    assert substring.digest(table(spark, [])).count() == 0


def test_covers_are_complete():
    for period, places in substring.COVERS.items():
        assert {(a - b) % period for a in places for b in places} == set(range(period))


def test_least_overlap():
    sums = np.arange(2, 200)
    for s, k in zip(sums.tolist(), ngram_join.least_overlap(sums).tolist()):
        assert 180 * k >= 80 * s > 180 * (k - 1)


def test_overlaps_and_forest():
    rng = np.random.default_rng(2)
    for dense in (1, 4, 10_000):
        kept, ngram_join.DENSE = ngram_join.DENSE, dense
        try:
            sets = [np.unique(rng.integers(0, 60, rng.integers(0, 30))).astype(np.uint64) for _ in range(25)]
            flat, first = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
            found = ngram_join.overlaps(flat, first, flat[first[5]:], first[5:] - first[5])
        finally:
            ngram_join.DENSE = kept
        assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets]
    linked = np.array([[0, 1, 0, 0], [0, 1, 1, 0], [0, 0, 1, 0], [1, 0, 0, 0]], bool)
    rows, columns = ngram_join.forest(linked)
    assert rows.tolist() == [0, 0, 0, 3] and columns.tolist() == [3, 0, 0, 4]
