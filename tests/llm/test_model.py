"""The Pitman-Yor model: exact counts, chances that sum to one, and a better held-out score."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flowtide.llm import pitman_yor
from tests.llm.samples import near_copies, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")] + [None]


def held_out(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1


@pytest.fixture(scope="module")
def rows():
    return near_copies() + [(None, "Null KEY"), (None, None)]


def test_base_columns_equal_brute_force(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, block int, bucket int")
    found = sorted(pitman_yor.score_all(docs).collect(), key=str)
    counts = Counter(w for d, t in rows if not held_out(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(((d, held_out(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                        sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for d, t in rows), key=str)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    assert [tuple(r)[:5] for r in sorted(found, key=key)] == [r[:5] for r in sorted(expected, key=key)]
    for r, e in zip(sorted(found, key=key), sorted(expected, key=key)):
        assert math.isclose(r["base_score"], e[5], rel_tol=1e-9) and r["score"] < 0


def test_chances_sum_to_one(spark):
    rng = random.Random(4)
    known = [f"k{i}" for i in range(12)]
    docs = table(spark, [(i, " ".join(rng.choice(known[:3 + i % 10]) for _ in range(20))) for i in range(40)])
    model = pitman_yor.fit(docs, buckets=4)
    names = [*known, None, "unknown"]  # None: the end
    assert model.vocabulary == len(known) + 1
    held = {}
    for r in model.state.collect():
        held.setdefault(r["bucket"], []).append({**r.asDict(), "tables": list(r["tables"])})
    for before in (None, "k0", "k7", "unseen"):  # None: the start
        texts = [" ".join(w for w in (before, name) if w) for name in names]
        found = pitman_yor.Tokens(pa.array(texts))
        counts, mean = pitman_yor.chances(found, _told(found, held, len(model.roots), 4), model.roots, 4)
        last = 0 if before is None else 1
        own = {w: mean[found.pair[found.first[i] + last]] for i, w in enumerate(texts)}
        assert len(own) == len(names) and math.isclose(sum(own.values()), 1.0, rel_tol=1e-9)


def _told(found, held, samples, buckets):
    """What the buckets tell a block, without Spark."""
    asked = pa.table(pitman_yor._packed(found.words, found.before, found.words[found.word] >> pitman_yor.DISH, None, 0, buckets))
    schema = pa.schema({"bucket": pa.int32(), "sample": pa.int32(), **dict.fromkeys(("words", "runs", "followers", "counts"), pa.binary()),
                        "tables": pa.list_(pa.binary())})
    return pa.concat_tables([pitman_yor._answer(samples)(
        (), asked.filter(pa.array([b == bucket for b in asked["bucket"].to_pylist()])), pa.Table.from_pylist(held.get(bucket, []), schema))
        for bucket in asked["bucket"].to_pylist()])


def test_scores_equal_brute_force_on_the_same_seatings(spark, rows):
    docs = table(spark, rows)
    training = [t for d, t in rows if not held_out(d)]
    model = pitman_yor.fit(spark.createDataFrame([(t,) for t in training], "text string"), buckets=3)
    seatings, roots = {}, [{} for _ in model.roots]  # (previous, word) -> customers and tables; word -> the same
    for r in model.state.collect():
        row = next(pitman_yor._rows(pa.Table.from_pylist([{**r.asDict(), "tables": list(r["tables"])}], pa.schema(
            {"bucket": pa.int32(), "sample": pa.int32(), **dict.fromkeys(("words", "runs", "followers", "counts"), pa.binary()),
             "tables": pa.list_(pa.binary())}))))
        if r["sample"] >= 0:
            dishes = pitman_yor.from_rising(row["followers"].as_buffer())
            both = (pitman_yor.from_small(x.as_buffer(), len(dishes)) for x in (row["counts"], row["tables"].values[0]))
            roots[r["sample"]] |= {d: (c, t) for d, c, t in zip(dishes.tolist(), *map(np.ndarray.tolist, both))}
        else:
            s = pitman_yor.Seating(row)
            tables = [s.tables(row, k).tolist() for k in range(len(model.roots))]
            seatings |= {(w, d): (c, t) for w, d, c, *t in zip(s.words[s.room].tolist(), s.dishes[s.dish].tolist(), s.counts.tolist(), *tables)}
    every = sorted({w for _, t in rows for w in tokens(t) if w})
    number = {w: int(h) for w, h in zip(every, pitman_yor.split_words(pa.array(every), lower=True).hashes)}
    number |= {None: int(pitman_yor.mix(np.array([pitman_yor.END]))[0]), "": int(pitman_yor.mix(np.array([pitman_yor.START]))[0])}
    pairs = Counter(p for t in training for p in zip(["", *tokens(t)[:-1]], tokens(t)))
    assert {k: v[0] for k, v in seatings.items()} == {(number[u], number[w] >> 24): n for (u, w), n in pairs.items()}
    for k, root in enumerate(roots):  # each table sends one customer to the root
        sent = Counter()
        for (_, d), (_, t) in seatings.items():
            sent[d] += t[k]
        assert sent == {d: c for d, (c, _) in root.items()}
    rooms = {}
    for (u, _), (c, t) in seatings.items():
        old = rooms.get(u, (0, [0] * len(roots)))
        rooms[u] = (old[0] + c, [x + y for x, y in zip(old[1], t)])
    vocabulary = len({w for _, w in pairs})

    def log_chance(u, w):
        mean = 0.0
        for k, root in enumerate(roots):
            (d0, d), (s0, s) = pitman_yor.DISCOUNTS, pitman_yor.STRENGTHS
            c, t = root.get(w >> 24, (0, 0))
            parent = (c - d0 * t + (s0 + d0 * sum(x[1] for x in root.values())) / (vocabulary + 1)) / (s0 + sum(x[0] for x in root.values()))
            c, t = seatings.get((u, w >> 24), (0, [0] * len(roots)))
            all_c, all_t = rooms.get(u, (0, [0] * len(roots)))
            mean += (c - d * t[k] + (s + d * all_t[k]) * parent) / (s + all_c) / len(roots)
        return math.log10(mean)

    found = pitman_yor.score(docs.selectExpr("doc_id", "text", "false AS held_out"), model, 5).collect()
    expected = sorted((str(d), sum(log_chance(number[u], number[w]) for u, w in zip(["", *tokens(t)[:-1]], tokens(t)))) for d, t in rows[::9] + rows[-10:])
    own = {}
    for r in found:
        own.setdefault(str(r["doc_id"]), []).append(r["score"])
    for d, e in expected:
        assert any(math.isclose(x, e, rel_tol=1e-9) for x in own[d])


def test_seating_keeps_its_bounds():
    rng = np.random.default_rng(1)
    customers = np.array([1, 2, 3, 50, 10_000, 1_000_000])
    tables = pitman_yor.seat(customers, np.full(6, 0.5), 0.5, rng)
    assert (tables >= 1).all() and (tables <= customers).all() and tables[0] == 1
    # One customer at a time: the mean of many seatings equals the exact recursion.
    mean = np.mean([pitman_yor.seat(np.full(4000, 15), np.full(4000, 2.0), 0.3, rng).mean() for _ in range(5)])
    share = {1: 1.0}
    for n in range(1, 15):
        new: dict[int, float] = {}
        for t, p in share.items():
            q = 2.0 / (2.0 + n - 0.3 * t)
            new[t + 1] = new.get(t + 1, 0) + p * q
            new[t] = new.get(t, 0) + p * (1 - q)
        share = new
    assert abs(mean - sum(t * p for t, p in share.items())) < 0.05


def test_better_than_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in pitman_yor.score_all(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rows_of_one_key_are_scored_in_many_blocks(spark, monkeypatch):
    dealt, seen = pitman_yor.dealt, []
    monkeypatch.setattr(pitman_yor, "dealt", lambda *a, **b: seen.append(dealt(*a, **b)) or seen[-1])
    docs = table(spark, [(None if i % 2 else 7, f"text number {i} of one key") for i in range(400)])
    found = pitman_yor.score_all(docs).collect()
    assert len(found) == 400 and max(r["count"] for r in seen[0].groupBy("block").count().collect()) < 60


def test_empty_tables(spark):
    docs = table(spark, [])
    assert pitman_yor.score_all(docs).count() == 0
    only_held = table(spark, [(d, "some text") for d in range(40) if held_out(d)])
    found = pitman_yor.score_all(only_held).collect()
    assert found and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == pytest.approx(0) for r in found)
