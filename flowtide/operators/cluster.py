"""K-Means fits, assignments and the measures used to choose k."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, functions as F

from flowtide.functions.distance import euclidean, nearest, squared_distance
from flowtide.operators.lloyd import Centers, lloyd, measures, packed, random_starts, spread_out
from flowtide.operators.prep import assemble, drawn_copies, row_draw
from flowtide.session import materialize

# Models measured in one pass; more would leave generated code.
TOGETHER = 10


WEIGHT = "weight"
# Distinct vectors that one task of a fit should hold.
VECTORS_PER_TASK = 200_000


def weighted_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of the columns with the number of their copies as ``weight``.

    A cost over them is the cost over all rows, as equal rows lie equally far from every centre. Copies are counted
    before the shuffle, so a vector that most rows share costs one row per task.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(WEIGHT))


def fit_kmeans(vectors: DataFrame, k: int = 3, seed: int = 1, vector: str = "features",
               max_iter: int = 20, init: str = "k-means||", weight: str | None = None) -> KMeansModel:
    """Fit K-Means on a vector column, each row counting ``weight`` times if that is given.

    The row solver suits the few features here, and unlike the block solver it copes with
    fewer distinct points than clusters: the model then has fewer centres.
    """
    fit = KMeans(k=k, seed=seed, featuresCol=vector, predictionCol="cluster",
                 maxIter=max_iter, initMode=init, solver="row")
    return (fit.setWeightCol(weight) if weight else fit).fit(vectors)


def centers_of(model: KMeansModel) -> Centers:
    return [[float(x) for x in center] for center in model.clusterCenters()]


def assign(df: DataFrame, columns: Sequence[str], centers: Centers) -> DataFrame:
    """Add the nearest ``cluster`` and the ``distance`` to its centre."""
    point = [F.col(c) for c in columns]
    best = nearest([euclidean(point, c) for c in centers], range(len(centers)),
                   [None] * len(centers))
    return (df.withColumn("_best", best)
            .withColumns({"cluster": F.col("_best.cluster"), "distance": F.col("_best.distance")})
            .drop("_best"))


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"))


def rows_of_cluster(assigned: DataFrame, cluster: int) -> DataFrame:
    return assigned.filter(F.col("cluster") == cluster)


def silhouette(assigned: DataFrame, vector: str = "features") -> float:
    """Mean silhouette with squared Euclidean distance, from per-cluster sums."""
    return ClusteringEvaluator(featuresCol=vector, predictionCol="cluster").evaluate(assigned)


def silhouette_by_sums(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and mean silhouette with squared Euclidean distance, written out in columns.

    A row's mean squared distance to a cluster follows from the cluster's size, mean and sum of squared
    lengths, k rows in all. A row alone in its cluster counts as 0.
    """
    columns = list(columns)
    square = reduce(add, [F.col(c) * F.col(c) for c in columns])
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(square).alias("squares"), *[F.avg(c).alias(c) for c in columns]).collect()
    away = {r["cluster"]: square + F.lit(r["squares"] / r["n"]) - 2 * reduce(
        add, [F.col(c) * F.lit(float(r[c])) for c in columns]) for r in sums}
    own, other = F.lit(0.0), F.lit(float("inf"))
    for r in sums:
        inside = F.col("cluster") == r["cluster"]
        own = F.when(inside, away[r["cluster"]] * F.lit(r["n"] / max(1, r["n"] - 1))).otherwise(own)
        other = F.when(inside, other).otherwise(F.least(other, away[r["cluster"]]))
    alone = F.col("cluster").isin([r["cluster"] for r in sums if r["n"] == 1])
    value = F.when(alone, F.lit(0.0)).otherwise((other - own) / F.greatest(own, other))
    return assigned.select(value.alias("s")).agg(F.count(F.lit(1)).alias("rows"), F.avg("s").alias("silhouette"))


def _with_nearest(vectors: DataFrame, columns: Sequence[str], model: KMeansModel | Centers,
                  name: str) -> DataFrame:
    """Add the index of the nearest centre. A fitted model finds it in compiled code however
    many centres it has; a list of centres is written out and should be short."""
    if isinstance(model, KMeansModel):
        return model.copy().setPredictionCol(name).transform(vectors)
    point = [F.col(c) for c in columns]
    best = nearest([squared_distance(point, c) for c in model], range(len(model)),
                   [None] * len(model))
    return vectors.withColumn(name, best["cluster"])


def costs(df: DataFrame, columns: Sequence[str],
          models: dict[object, KMeansModel | Centers], weight: str | None = None) -> DataFrame:
    """WSSSE and mean distortion of several models over the same rows, ``TOGETHER`` in a pass.

    Columns: model, wssse (sum of squared distances to the nearest centre) and distortion
    (mean distance to it). With ``weight`` a row counts that many times.
    """
    times = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = assemble(df.select(*columns, times.alias(WEIGHT)), columns)
    if len(models) > TOGETHER:
        names = list(models)
        return reduce(DataFrame.unionByName, [
            costs(df, columns, {n: models[n] for n in names[i:i + TOGETHER]}, weight)
            for i in range(0, len(names), TOGETHER)])
    squares = []
    for i, model in enumerate(models.values()):
        rows = _with_nearest(rows, columns, model, f"c{i}")
        centers = centers_of(model) if isinstance(model, KMeansModel) else model
        center = F.lit([[float(x) for x in c] for c in centers])[F.col(f"c{i}")]
        squares.append(reduce(add, [
            (F.col(c) - center[d]) * (F.col(c) - center[d]) for d, c in enumerate(columns)
        ]).alias(f"m{i}"))
    row = rows.select(WEIGHT, *squares).agg(*[
        F.struct(F.sum(F.col(f"m{i}") * F.col(WEIGHT)).alias("wssse"),
                 (F.sum(F.sqrt(f"m{i}") * F.col(WEIGHT)) / F.sum(WEIGHT)).alias("distortion"))
        .alias(f"m{i}") for i in range(len(models))
    ])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"m{i}.wssse").alias("wssse"),
                 F.col(f"m{i}.distortion").alias("distortion"))
        for i, name in enumerate(models)
    ])).alias("row")).select("row.*")


def costs_by_row(df: DataFrame, columns: Sequence[str], models: dict[object, Centers]) -> DataFrame:
    """The same measures written out: the least distance of each row to centres that are given as numbers.

    For checks of :func:`costs`: one pass over the rows as numbers, without models and weights.
    """
    found = measures(packed(df, columns, nulls=True), models)
    return df.sparkSession.createDataFrame(
        [(name, *found[name]) for name in models], "model int, wssse double, distortion double")


def mean_center(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> Centers:
    """The only centre for k = 1, which K-Means itself does not accept."""
    mean = lambda c: F.sum(F.col(c) * F.col(weight)) / F.sum(weight) if weight else F.avg(c)
    row = df.agg(*[mean(c).alias(c) for c in columns]).first()
    return [[float(row[c]) for c in columns]]


def _fit_each(distinct: DataFrame, columns: Sequence[str], settings: dict[object, dict],
              parallel: int) -> dict[object, KMeansModel | Centers]:
    """A model for each setting over weighted vectors, several fits running at once over one cached table.

    The table is gathered in as many partitions as its rows need: every iteration of every fit is a job over all of them.
    """
    def fit(name: object) -> tuple[object, KMeansModel | Centers]:
        how = settings[name]
        if how["k"] == 1:
            return name, mean_center(train, columns, WEIGHT)
        return name, fit_kmeans(train, weight=WEIGHT, **how)

    train = assemble(distinct, columns).repartition(max(1, -(-distinct.count() // VECTORS_PER_TASK))).persist()
    try:
        with ThreadPool(min(parallel, len(settings))) as pool:
            run = inheritable_thread_target(train.sparkSession)(fit)
            # Many centres take the most iterations: first, so that none of them runs alone at the end.
            return dict(pool.map(run, sorted(settings, key=lambda name: -settings[name]["k"]), chunksize=1))
    finally:
        train.unpersist()


def elbow_models(df: DataFrame, columns: Sequence[str], ks: Iterable[int] = range(2, 20),
                 fraction: float | None = 0.1, seed: int = 1, sample_seed: int = 42, max_iter: int = 20,
                 init: str = "k-means||", parallel: int = 8) -> tuple[DataFrame, dict[int, KMeansModel | Centers]]:
    """The weighted distinct vectors of a table, written once, and a model for each k.

    With ``fraction`` the fits use a sample of the rows, drawn among the copies of each vector; where it would be empty,
    as with ``None``, they use everything.
    """
    distinct = materialize(weighted_vectors(df, columns), "vectors")
    train = distinct
    if fraction is not None:
        taken = drawn_copies(F.col(WEIGHT), fraction, row_draw(distinct, sample_seed, columns))
        sample = distinct.withColumn(WEIGHT, taken).filter(F.col(WEIGHT) > 0)
        train = distinct if sample.isEmpty() else sample
    settings = {k: dict(k=k, seed=seed, max_iter=max_iter, init=init) for k in ks}
    return distinct, _fit_each(train, columns, settings, parallel)


def elbow(df: DataFrame, columns: Sequence[str], ks: Iterable[int] = range(2, 20),
          fraction: float | None = 0.1, seed: int = 1, sample_seed: int = 42,
          max_iter: int = 20, init: str = "k-means||", parallel: int = 8) -> DataFrame:
    """Cost of K-Means for each k: (k, wssse, distortion). See :func:`elbow_models`; costs always cover all rows."""
    distinct, models = elbow_models(df, columns, ks, fraction, seed, sample_seed, max_iter, init, parallel)
    return costs(distinct, columns, models, WEIGHT).withColumnRenamed("model", "k")


def iteration_grid(df: DataFrame, columns: Sequence[str],
                   ks: Iterable[int] = range(1, 50),
                   max_iters: Iterable[int] = range(300, 1000, 100),
                   seed: int = 1) -> DataFrame:
    """WSSSE and distortion for each (max_iter, k) with random starting centres.

    With one start, a fit that came to rest after n iterations is the same for every limit of at least n, and a limit
    below n stops the same fit earlier. So each k is fitted once, its centres noted at each limit, and each different
    model is measured once. All fits run side by side, one pass over the vectors an iteration (:mod:`lloyd`).
    """
    ks, limits = list(ks), sorted(max_iters)
    vectors = materialize(weighted_vectors(df, columns), "vectors")
    drawn = random_starts(vectors, columns, max(ks), seed)
    blocks = packed(spread_out(vectors), columns, WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = lloyd(blocks, {k: drawn[:k] for k in ks if k > 1}, limits)
        if 1 in ks:
            fitted[1] = dict.fromkeys(limits, mean_center(vectors, columns, WEIGHT))
        models = {repr(centers): centers for k in ks for centers in fitted[k].values()}
        found = measures(blocks, models)
    finally:
        blocks.unpersist()
    rows = [(n, k, *found[repr(fitted[k][n])]) for n in limits for k in ks]
    return df.sparkSession.createDataFrame(rows, "max_iter int, k int, wssse double, distortion double")
