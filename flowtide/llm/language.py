"""Nearest-centroid language identification on normalised TF-IDF vectors of letter n-grams.

A text is lowered and everything but letters becomes one blank; its byte trigrams, hashed to
``DIMENSIONS`` columns, give log(1 + count) * idf, scaled to length one. Document frequencies come from
all training rows. Each language gets several centroids by spherical k-means on a sample of at most
``SAMPLE`` of its rows (the rows with the smallest key hashes). A text takes the language of the centroid
with the highest cosine, which is also its score; ``rejected`` tells that the text lies farther from
that centroid than all but a thousandth of the sample lay from theirs.

Texts that are null or hold no letter are ``und`` with score 0 and rejected. Rows without language do
not train. Repeated rows are predicted alike (ties between centroids go to the first language by name);
without any training row everything is ``und``; an empty table gives an empty result. Texts are read
whole, in slices; other columns are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm.tables import remainder, slices
from flowtide.llm.words import U64, text_bytes

DIMENSIONS, CENTROIDS, SAMPLE, ROUNDS, QUANTILE = 8192, 6, 1500, 8, 0.001
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def letters_only(texts: pa.Array) -> pa.Array:
    """Lowered texts in which each run of other characters than letters is one blank."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+", " ")


def counts(texts: pa.Array, dimensions: int) -> Iterator[tuple[int, np.ndarray]]:
    """Trigram counts of texts, for runs of texts: (first text, matrix)."""
    data, offsets = text_bytes(letters_only(texts))
    step = max(1, (4 << 20) // dimensions)
    for low in range(0, len(offsets) - 1, step):
        own = offsets[low:low + step + 1]
        part = data[own[0]:own[-1]].astype(U64)
        out = np.zeros((len(own) - 1) * dimensions, np.int64)
        if len(part) >= 3:
            grams = part[:-2] << U64(16) | part[1:-1] << U64(8) | part[2:]
            column = ((grams * U64(0x9E3779B97F4A7C15)) >> U64(40)).astype(np.int64) % dimensions
            owner = np.repeat(np.arange(len(own) - 1), np.diff(own))
            inside = owner[:-2] == owner[2:]
            out = np.bincount(owner[:-2][inside] * dimensions + column[inside], minlength=len(out))
        yield low, out.reshape(-1, dimensions)


def vectors(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.zeros(matrix.shape, np.float32)
    some = matrix > 0
    out[some] = np.log1p(matrix[some])
    out *= idf
    norm = np.sqrt(np.einsum("ij,ij->i", out, out))
    return out / np.maximum(norm, 1e-12)[:, None]


def clusters(points: np.ndarray, k: int, rounds: int, quantile: float) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit vectors by spherical k-means, and the cosine below which each rejects."""
    centres = points[:1]
    best = points @ centres[0]
    while len(centres) < min(k, len(points)):  # farthest point next
        centres = np.vstack([centres, points[best.argmin()][None]])
        best = np.maximum(best, points @ centres[-1])
    for _ in range(rounds):
        own = (points @ centres.T).argmax(1)
        centres = np.vstack([points[own == j].sum(0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    near = points @ centres.T
    own = near.argmax(1)
    limit = [np.quantile(near[own == j, j], quantile) if (own == j).any() else 1.0 for j in range(len(centres))]
    return centres.astype(np.float32), np.array(limit, np.float64)


class Model:
    """Centroids of all languages; its size follows the number of languages only."""

    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, limits: np.ndarray) -> None:
        self.idf, self.languages, self.centres, self.limits = idf, languages, centres, limits


def fit(training: DataFrame, dimensions: int = DIMENSIONS, centroids: int = CENTROIDS, sample: int = SAMPLE,
        rounds: int = ROUNDS) -> Model:
    """Learn from rows of (doc_id, text, lang)."""
    training = training.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                               F.col("lang").cast("string").alias("lang")).filter("lang is not null and text is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dimensions, np.int64), 0
        for batch in slices(batches):
            n += batch.num_rows
            for _, matrix in counts(batch.column("text"), dimensions):
                total += (matrix > 0).sum(0)
        yield pa.RecordBatch.from_pydict({"at": np.arange(-1, dimensions), "n": np.concatenate([[n], total])})

    found = (training.select("text").mapInArrow(frequencies, "at long, n long")
             .groupBy("at").agg(F.sum("n").alias("n")).toPandas())  # dimensions + 1 rows
    document_counts = np.zeros(dimensions + 1)
    document_counts[found["at"].to_numpy() + 1] = found["n"].to_numpy()
    idf = (np.log((1 + document_counts[0]) / (1 + document_counts[1:])) + 1).astype(np.float32)

    sizes = {r["lang"]: r["count"] for r in training.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model(idf, [], np.zeros((0, dimensions), np.float32), np.zeros(0))
    chance = F.lit(1.0)
    for name, n in sizes.items():
        chance = F.when(F.col("lang") == name, F.lit(min(1.0, 1.5 * sample / n))).otherwise(chance)
    hashed = F.xxhash64(F.col("doc_id"), F.lit(17))
    order = Window.partitionBy("lang").orderBy("hash", "text")
    chosen = (training.withColumn("hash", hashed)
              .filter(F.pmod(F.col("hash"), F.lit(1_000_000)) < 1_000_000 * chance)
              .withColumn("hash", F.xxhash64("hash"))
              .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample).select("lang", "text"))

    def centres(key: tuple, table: pa.Table) -> pa.Table:
        points = np.vstack([vectors(m, idf) for _, m in counts(table["text"].combine_chunks(), dimensions)])
        points = points[np.abs(points).sum(1) > 0]
        if not len(points):
            return pa.table({"lang": pa.array([], pa.string()), "limit": pa.array([], pa.float64()),
                             "centre": pa.array([], pa.binary())})
        centre, limit = clusters(points, centroids, rounds, QUANTILE)
        return pa.table({"lang": [key[0].as_py()] * len(centre), "limit": limit,
                         "centre": pa.array([c.tobytes() for c in centre], pa.binary())})

    rows = sorted(chosen.groupBy("lang").applyInArrow(centres, "lang string, limit double, centre binary").collect(),
                  key=lambda r: r["lang"])  # languages * centroids rows
    return Model(idf, [r["lang"] for r in rows],
                 np.array([np.frombuffer(r["centre"], np.float32) for r in rows]).reshape(-1, dimensions),
                 np.array([r["limit"] for r in rows]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Language, cosine score and rejection of every text; ``docs`` has doc_id and text (and held_out)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages * centroids * dimensions numbers
    keep = [c for c in ("doc_id", "held_out") if c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            texts = batch.column("text")
            some = pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}").to_numpy(zero_copy_only=False)
            some = some & bool(m.languages)
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            if m.languages:
                for low, matrix in counts(texts, len(m.idf)):
                    near = vectors(matrix, m.idf) @ m.centres.T
                    here = slice(low, low + len(near))
                    best[here] = near.argmax(1)
                    score[here] = near.max(1)
            score = np.where(some, np.clip(score, 0.0, 1.0), 0.0)
            names = [m.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
            limit = m.limits[best] if m.languages else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in keep}, "lang_pred": names,
                                              "score": score, "rejected": ~some | (score < limit)})

    fields = {"doc_id": "doc_id long", "held_out": "held_out boolean"}
    out = ", ".join([*(fields[c] for c in keep), "lang_pred string, score double, rejected boolean"])
    return docs.select(*keep, "text").mapInArrow(run, out)


def identify(docs: DataFrame, base: int = 5, held: int = 0) -> DataFrame:
    """Learn from the rows whose remainder is not ``held``, predict all of them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), (remainder("doc_id", base) == held).alias("held_out"))
    return predict(rows.select("doc_id", "text", "held_out"), fit(rows.filter(~F.col("held_out"))))


