"""Language identification against a plain version: frequencies, vectors, centroids, limits and predictions."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from flowtide.llm import language

DIMENSIONS = 512


def grams(text: str | None) -> Counter:
    data = regex.sub(r"[^\p{L}]+", " ", (text or "").lower()).encode()
    numbers = (int.from_bytes(data[i:i + 3], "big") for i in range(len(data) - 2))
    return Counter((n * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % DIMENSIONS for n in numbers)


def unit(counts: Counter, idf: list[float]) -> dict[int, float]:
    weights = {g: math.log1p(n) * idf[g] for g, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {g: w / norm for g, w in weights.items()} if norm else {}


def cosine(point: dict[int, float], centre: np.ndarray) -> float:
    return sum(w * float(centre[g]) for g, w in point.items())


@pytest.fixture(scope="module")
def rows(spark):
    found = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    odd = [(90_001, None, "en"), (90_002, "", "en"), (90_003, "12 34", "en"), (90_004, "ab", "en"), (90_005, "Some text", None),
           (None, "Some more text", "en")]
    return found + odd + found[:3]


@pytest.fixture(scope="module")
def fitted(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, language.fit(docs.filter(language.remainder("doc_id", 5) != 0), DIMENSIONS, centroids=3, rounds=60)


def training(rows):
    return [(d, t, lang) for d, t, lang in rows
            if zlib.crc32(("" if d is None else str(d)).encode()) % 5 and t is not None and lang is not None]


def test_frequencies_equal_brute_force(rows, fitted):
    own = training(rows)
    held = Counter(g for _, t, _ in own for g in grams(t))
    expected = [math.log((1 + len(own)) / (1 + held[g])) + 1 for g in range(DIMENSIONS)]
    assert np.allclose(fitted[1].idf, expected, rtol=1e-6)


def test_centroids_are_means_of_their_texts(rows, fitted):
    model = fitted[1]
    idf = model.idf.tolist()
    assert sorted(set(model.languages)) == sorted({lang for _, _, lang in training(rows)})
    for name in set(model.languages):
        own = [k for k, lang in enumerate(model.languages) if lang == name]
        sums = {k: np.zeros(DIMENSIONS) for k in own}
        near = {k: [] for k in own}
        for _, t, lang in training(rows):
            point = unit(grams(t), idf)
            if lang == name and point:
                best = max(own, key=lambda k: cosine(point, model.centres[k]))
                near[best].append(cosine(point, model.centres[best]))
                for g, w in point.items():
                    sums[best][g] += w
        for k in own:
            assert near[k]
            assert np.allclose(model.centres[k], sums[k] / np.linalg.norm(sums[k]), atol=1e-5)
            assert math.isclose(model.limits[k], np.quantile(near[k], language.QUANTILE), abs_tol=1e-5)


def test_predictions_equal_brute_force(rows, fitted):
    docs, model = fitted
    idf = model.idf.tolist()
    expected = []
    for d, t, _ in rows:
        if not regex.search(r"\p{L}", t or ""):
            expected.append((str(d), "und", 0.0, True))
            continue
        near = [cosine(unit(grams(t), idf), c) for c in model.centres]
        best = int(np.argmax(near))
        # A text on the edge of its centroid may fall on either side of the limit by rounding.
        side = None if abs(near[best] - model.limits[best]) < 1e-5 else near[best] < model.limits[best]
        expected.append((str(d), model.languages[best], near[best], side))
    found = sorted((str(r["doc_id"]), r["lang_pred"], r["score"], r["rejected"]) for r in language.predict(docs, model).collect())
    assert len(found) == len(expected)
    for f, e in zip(found, sorted(expected, key=lambda x: x[:3])):
        assert f[:2] == e[:2] and math.isclose(f[2], e[2], abs_tol=1e-5) and e[3] in (None, f[3])
