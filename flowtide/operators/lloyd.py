"""K-Means of many settings at once: every pass over the vectors serves all models that still move.

A pass is one job. Each task finds the nearest centres of its vectors for every model, in blocks of rows as numpy arrays,
and hands back one row with the weights and weighted sums of all clusters; the driver adds these rows up. So the vectors
are read and decoded once per iteration, however many models there are, and the driver holds a few numbers per cluster
and task, never vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, functions as F

from flowtide.operators.prep import row_draw

Centers = list[list[float]]

# Rows whose distances to the centres of one model are held at a time.
BLOCK_ROWS = 8_192
# Centres that moved no further have come to rest.
TOLERANCE = 1e-4
# Distinct vectors that one task should hold at most, and at least if the table is small.
MOST_PER_TASK, LEAST_PER_TASK = 200_000, 10_000


def spread_out(vectors: DataFrame) -> DataFrame:
    """The vectors in as many partitions as their number and the cores call for."""
    rows, cores = vectors.count(), vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(max(1, -(-rows // MOST_PER_TASK), min(2 * cores, -(-rows // LEAST_PER_TASK))))


def packed(rows: DataFrame, columns: Sequence[str], weight: str | None = None, nulls: bool = False) -> RDD:
    """The rows as blocks (points, weights) of doubles, some thousand rows each. Blocks are read in every iteration, so they
    hold bytes and not rows. With ``nulls`` rows without a value are left out, else they are an error.
    """
    columns = list(columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            missing = np.zeros(batch.num_rows, bool)
            for c in columns:
                missing |= batch[c].is_null().to_numpy(zero_copy_only=False)
            if missing.any() and not nulls:
                raise ValueError(f"K-Means needs a value in each of {columns}")
            points = np.column_stack([batch[c].to_numpy(zero_copy_only=False) for c in columns])[~missing]
            times = batch["times"].to_numpy(zero_copy_only=False)[~missing]
            if len(points):
                yield pa.RecordBatch.from_pydict({
                    "points": pa.array([points.tobytes()], pa.binary()), "times": pa.array([times.tobytes()], pa.binary())})

    times = F.col(weight).cast("double") if weight else F.lit(1.0)
    own = rows.select(*[F.col(c).cast("double").alias(c) for c in columns], times.alias("times"))
    return own.mapInArrow(pack, "points binary, times binary").rdd.map(lambda r: (bytes(r[0]), bytes(r[1])))


def random_starts(vectors: DataFrame, columns: Sequence[str], most: int, seed: int) -> Centers:
    """Up to ``most`` of the distinct vectors in an order drawn from their values and the seed."""
    drawn = vectors.select(*columns).orderBy(row_draw(vectors, seed, columns), *columns).limit(most)
    return [[float(x) for x in row] for row in drawn.collect()]  # as many rows as the largest model has centres


def _nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Index of the nearest centre, the first of equals; squared lengths of points would change nothing."""
    return (points @ (-2.0 * centers.T) + (centers * centers).sum(axis=1)).argmin(axis=1)


def _summed(blocks: RDD, shapes: Sequence[tuple[int, ...]],
            add: Callable[[list[np.ndarray], np.ndarray, np.ndarray], None]) -> list[np.ndarray]:
    """Sums over all blocks that ``add`` makes of runs of points and weights, in arrays of the given shapes."""
    def task(held: Iterator[tuple[bytes, bytes]]) -> Iterator[np.ndarray]:
        sums = [np.zeros(shape) for shape in shapes]
        for points, times in held:
            times = np.frombuffer(times)
            points = np.frombuffer(points).reshape(len(times), -1)
            for at in range(0, len(times), BLOCK_ROWS):
                add(sums, points[at:at + BLOCK_ROWS], times[at:at + BLOCK_ROWS])
        yield np.concatenate([s.ravel() for s in sums])

    cuts = np.cumsum([0, *[int(np.prod(s)) for s in shapes]])
    flat = sum(blocks.mapPartitions(task).collect(), np.zeros(cuts[-1]))  # one array a task
    return [flat[a:b].reshape(s) for a, b, s in zip(cuts, cuts[1:], shapes)]


def lloyd(blocks: RDD, starts: dict[object, Centers], limits: Sequence[int]) -> dict[object, dict[int, Centers]]:
    """For each start the centres after each limit of iterations, or after fewer if they have come to rest.

    A cluster without vectors keeps its centre. Models at rest take no part in further passes. The
    blocks are read in every iteration and should be cached.
    """
    models = {name: np.array(start, float) for name, start in starts.items()}
    kept: dict[object, dict[int, Centers]] = {name: {} for name in starts}
    moving = list(models)
    for iteration in range(1, max(limits) + 1):
        now = [models[name] for name in moving]

        def add(sums: list[np.ndarray], points: np.ndarray, times: np.ndarray, now=now) -> None:
            weighted = points * times[:, None]
            for own, centers in zip(sums, now):
                nearest = _nearest(points, centers)
                own[:, 0] += np.bincount(nearest, times, len(centers))
                for d in range(points.shape[1]):
                    own[:, d + 1] += np.bincount(nearest, weighted[:, d], len(centers))

        sums = _summed(blocks, [(len(c), c.shape[1] + 1) for c in now], add)
        still = []
        for name, own in zip(moving, sums):
            held = own[:, 0] > 0
            before = models[name]
            models[name] = before.copy()
            models[name][held] = own[held, 1:] / own[held, :1]
            rest = bool((((models[name] - before) ** 2).sum(axis=1) <= TOLERANCE ** 2).all())
            for limit in limits:
                if limit == iteration or rest and limit > iteration:
                    kept[name][limit] = models[name].tolist()
            if not rest:
                still.append(name)
        moving = still
        if not moving:
            break
    return kept


def measures(blocks: RDD, models: dict[object, Centers]) -> dict[object, tuple[float | None, float | None]]:
    """Sum of squared distances to the nearest centre and mean distance, for all models in one pass.

    Distances are worked out from differences. None where there are no rows.
    """
    held = [np.array(c, float) for c in models.values()]

    def add(sums: list[np.ndarray], points: np.ndarray, times: np.ndarray) -> None:
        sums[0][0] += times.sum()
        for own, centers in zip(sums[1:], held):
            square = ((points - centers[_nearest(points, centers)]) ** 2).sum(axis=1)
            own += (square @ times, np.sqrt(square) @ times)

    total, *sums = _summed(blocks, [(1,), *[(2,)] * len(held)], add)
    return {name: (float(s[0]), float(s[1] / total[0])) if total[0] else (None, None) for name, s in zip(models, sums)}
