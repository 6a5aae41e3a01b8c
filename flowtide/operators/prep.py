"""Feature preparation: scaling, interactions, selection, sampling."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowtide.functions.stats import presented, zero_guard


def add_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """A unique number per row, in first position.

    The numbers depend on how rows are partitioned; use a stable key such as window and
    source where rows are joined again.
    """
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def as_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def assemble(df: DataFrame, columns: Sequence[str], vector: str = "features") -> DataFrame:
    """Add the columns as one ML vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=vector).transform(df)


def standardize(df: DataFrame, columns: Sequence[str], center: bool = True,
                sigma: str = "sample") -> DataFrame:
    """Scale columns in place by their deviation, after subtracting the mean if ``center``.

    ``sigma`` is ``sample`` or ``population``. A column without spread becomes 0. The
    moments are one aggregated row that Spark computes once and hands to every task; they
    leave out nulls and NaN, which stay null. ``df`` is read for the moments and again for
    the rows, so what is dear to work out should come from a written table.
    """
    deviation = {"sample": F.stddev_samp, "population": F.stddev_pop}[sigma]
    df = presented(df, columns)
    moments = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), deviation(c).alias("sigma")).alias(c) for c in columns
    ]).alias("moments")).scalar()

    def scaled(c: str):
        mean, spread = F.col(f"_moments.{c}.mean"), F.col(f"_moments.{c}.sigma")
        if center:
            return (F.col(c) - mean) / zero_guard(spread)
        return F.when(spread > 0, F.col(c) / spread).when(F.col(c).isNotNull(), F.lit(0.0))

    return (df.withColumn("_moments", moments)
            .withColumns({c: scaled(c) for c in columns})
            .drop("_moments"))


def scaled_by(df: DataFrame, columns: Sequence[str], deviations: Sequence[float]) -> DataFrame:
    """Columns divided by known deviations; a column without spread becomes 0."""
    def scaled(c: str, spread: float) -> Column:
        return F.col(c) / F.lit(float(spread)) if spread else F.when(F.col(c).isNotNull(), F.lit(0.0))

    return df.withColumns({c: scaled(c, s) for c, s in zip(columns, deviations)})


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def interactions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add the product of every pair of columns, by default the numeric ones, named ``a_b``."""
    columns = list(columns or _numeric(df))
    return df.select("*", *[
        (F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}_{b}")
        for a, b in combinations(columns, 2)
    ])


def drop_zero_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are 0 in every row. One pass, one row of flags to the driver."""
    columns = _numeric(df)
    flags = df.agg(*[
        F.max(F.coalesce(F.col(c) != 0, F.lit(True))).alias(c) for c in columns
    ]).first()
    return df.drop(*[c for c in columns if flags[c] is False])


def drop_prefixed(df: DataFrame, prefix: str = "id_") -> DataFrame:
    """Drop the columns whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def add_interactions(df: DataFrame) -> DataFrame:
    """Pairwise products without all-zero columns and without products of the id."""
    return drop_zero_columns(drop_prefixed(interactions(df)))


def anova_f(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F value of each column against a categorical label.

    Infinite where the label explains a column entirely, null where nothing can be said.

    Per label only count, mean and squared deviation are kept, merged before the shuffle;
    so a label holding most rows costs no more than a rare one.
    """
    groups = presented(df, columns).filter(F.col(label).isNotNull()).groupBy(label).agg(*[
        F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.var_pop(c).alias("var"))
        .alias(c) for c in columns
    ])
    # One row per (label, column).
    parts = groups.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`.n").alias("n"),
                 F.col(f"`{c}`.mean").alias("mean"), F.col(f"`{c}`.var").alias("var"))
        for c in columns
    ])).alias("part")).select("part.*").filter(F.col("n") > 0)
    # The squares between labels are the spread of their means, one row standing for n: two
    # sums per column, merged before the shuffle, whatever the number of labels.
    grand = parts.groupBy("feature").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    n, classes = F.sum("n"), F.count(F.lit(1))
    between = F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), F.lit(2)))
    within = F.sum(F.col("n") * F.col("var"))
    ratio = F.try_divide(between, classes - 1) / F.try_divide(within, n - classes)
    # One row per column is sent along.
    return parts.join(F.broadcast(grand), "feature").groupBy("feature").agg(
        F.when(within > 0, ratio)
        .when((between > 0) & (n > classes), F.lit(float("inf"))).alias("f_value"))


def select_k_best(df: DataFrame, columns: Sequence[str], label: str, k: int = 60) -> list[str]:
    """Names of the ``k`` columns with the largest ANOVA F value."""
    # One row per column reaches the driver.
    scores = {r["feature"]: r["f_value"] for r in anova_f(df, columns, label).collect()}
    ranked = sorted(columns, key=lambda c: -(scores.get(c) or 0.0))
    best = set(ranked[:k])
    return [c for c in columns if c in best]


def row_draw(df: DataFrame, seed: int, keys: Sequence[str] | None) -> Column:
    """A number in [0, 1) per row, from its key and the seed alone."""
    key = F.concat_ws("|", F.lit(str(seed)), *[
        F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in keys or df.columns])
    return F.conv(F.substr(F.md5(key.cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("bigint") / float(1 << 32)


def _counted(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies, ``_copies``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def _repeated(df: DataFrame, times: Column, columns: Sequence[str], step: int = 1 << 16) -> DataFrame:
    """Each row so many times, in runs of ``step``, so that no array holds all copies of one row."""
    runs = df.withColumn("_n", times.cast("long")).filter("_n > 0").select(
        *columns, "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(step).cast("long"))).alias("_from"))
    return runs.select(*columns, F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_n"), F.col("_from") + step) - 1)).alias("_copy")).drop("_copy")


def drawn_copies(copies: Column, fraction: float, draw: Column) -> Column:
    """How many of a row's equal copies a sample takes: the whole part of their share, and by ``draw`` one more.

    Every copy is taken with probability ``fraction``. A row without copies is taken or left, a row with many copies
    gives that share of them to within one.
    """
    return F.floor(copies * F.lit(float(fraction)) + draw).cast("long")


def bernoulli_sample(df: DataFrame, fraction: float = 0.1, seed: int = 42,
                     keys: Sequence[str] | None = None) -> DataFrame:
    """Each row with the given probability, without replacement.

    ``keys`` decide, so a repeated or moved task draws the same rows; rows with equal keys are drawn together, so they
    should tell rows apart. Without keys equal rows are counted, and :func:`drawn_copies` of them are taken.
    """
    if keys is not None:
        return df.filter(row_draw(df, seed, keys) < fraction)
    return _repeated(_counted(df), drawn_copies(F.col("_copies"), fraction, row_draw(df, seed, None)), df.columns)


def train_test_split(df: DataFrame, train: float = 0.8, seed: int = 42,
                     keys: Sequence[str] | None = None) -> list[DataFrame]:
    """Two disjoint parts that together are the input, drawn like :func:`bernoulli_sample`."""
    draw = row_draw(df, seed, keys)
    if keys is not None:
        return [df.filter(draw < train), df.filter(draw >= train)]
    counted = _counted(df)
    taken = drawn_copies(F.col("_copies"), train, draw)
    return [_repeated(counted, n, df.columns) for n in (taken, F.col("_copies") - taken)]
