"""Decontamination against a plain alignment of every document with every item."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from flowtide.llm import decontaminate
from tests.llm.samples import words


def plain(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def local_score(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        best, row = max(best, *new), new
    return best


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng.randrange(8, 50), 100 + i, 3000)).capitalize() + ".") for i in range(25)]
    items += [(100, None), (101, ""), (102, "too short"), (103, items[3][1]), (3, items[3][1])]
    docs = []
    for d in range(120):
        own = words(rng.randrange(5, 200), 1000 + d, 3000)
        if d % 3 == 0:
            text = plain(items[rng.randrange(25)][1])
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                k = rng.randrange(len(text))
                text[k:k + 1] = rng.choice([["edit"], [], [text[k], "more"]])
            at = rng.randrange(len(own))
            if d % 9 == 0:  # an excerpt
                low = rng.randrange(max(1, len(text) - 12))
                text = text[low:low + rng.randrange(10, 20)]
            own[at:at] = [w.upper() + "," for w in text]
        docs.append((d, " ".join(own)))
    docs += [(500, None), (501, ""), (None, items[0][1]), (502, items[1][1] + " " + items[1][1]), (502, items[1][1])]
    return (spark.createDataFrame([(d, t, 5) for d, t in docs], "doc_id long, text string, item_id int"),
            spark.createDataFrame(items, "item_id long, text string"), docs, items)


@pytest.mark.parametrize("block", [500_000, 60])
def test_equals_plain_alignment(tables, monkeypatch, block):
    docs, items, doc_rows, item_rows = tables
    monkeypatch.setattr(decontaminate.indexes, "__defaults__", (block,))
    found = sorted((str(r["doc_id"]), r["item_id"], round(r["score"], 6)) for r in decontaminate.find(docs, items).collect())
    expected = []
    for d, text in doc_rows:
        for i, item in dict.fromkeys(item_rows):
            a = plain(item)
            if len(a) >= decontaminate.GRAM:
                best = local_score(a, plain(text))
                share = best / (2 * len(a))
                if share >= decontaminate.THRESHOLD or best >= 26:
                    expected.append((str(d), i, round(share, 6)))
    assert found == sorted(expected) and len(found) > 40


def test_drop_keeps_clean_rows_and_columns(tables):
    docs, items, doc_rows, _ = tables
    bad = {str(r["doc_id"]) for r in decontaminate.find(docs, items).select("doc_id").collect()}
    kept = decontaminate.drop(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in doc_rows if str(d) not in bad)


def test_empty_tables(tables):
    docs, items, doc_rows, _ = tables
    assert decontaminate.find(docs.limit(0), items).count() == 0
    assert decontaminate.find(docs, items.limit(0)).count() == 0
    assert decontaminate.drop(docs, items.limit(0)).count() == len(doc_rows)


@pytest.mark.parametrize("taken", [12, 13, 21, 200])
def test_excerpts_of_long_items(taken):
    item, other = words(400, 1, 10**6), words(300, 2, 10**6)
    index = decontaminate.Index([7], [" ".join(item)])
    index.choose(pa.array([0] * len(index.grams)).to_numpy())
    for low in (0, 150, 400 - taken):
        text = " ".join(other[:100] + item[low:low + taken] + other[100:])
        found = decontaminate.matches(pa.array([text]), index)
        assert found == ({} if taken < 13 else {(0, 0): (taken / 400, 100, 99 + taken)})


def test_place_of_a_match():
    index = decontaminate.Index([7], ["alpha beta gamma delta epsilon zeta eta theta"])
    index.choose(pa.array([0] * len(index.grams)).to_numpy())
    text = "x y z alpha beta gamma delta edited zeta eta theta and so on"
    assert decontaminate.matches(pa.array([text, None]), index) == {(0, 0): (13 / 16, 3, 10)}
