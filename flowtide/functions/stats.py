"""Column expressions around means and standard deviations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T


def missing(df: DataFrame, column: str) -> Column:
    """Whether a column holds no value: null, or NaN where the type has one."""
    value = F.col(column)
    fractional = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    return value.isNull() | F.isnan(value) if fractional else value.isNull()


def present(df: DataFrame, column: str) -> Column:
    """A numeric column as double, null where it holds no value."""
    return F.when(~missing(df, column), F.col(column).cast("double"))


def presented(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table with null in place of NaN in the columns that can hold it."""
    fractional = [c for c in columns if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast(df.schema[c].dataType)) for c in fractional}) if fractional else df


def zero_guard(deviation: Column) -> Column:
    """A deviation safe to divide by: 1 where it is zero or unknown."""
    return F.when(deviation.isNull() | (deviation == 0), F.lit(1.0)).otherwise(deviation)


def sigma_steps(largest: Column, mean: Column, deviation: Column, start: int = 2) -> Column:
    """Smallest whole n >= ``start`` with ``largest <= mean + n * deviation``.

    Without spread (zero or unknown deviation) no n can help, and ``start`` is returned.
    """
    steps = F.ceil((largest - mean) / F.nullif(deviation, F.lit(0.0))).cast("bigint")
    return F.greatest(F.lit(start).cast("bigint"), steps)


def vector_columns(vector: str, names: Sequence[str]) -> list[Column]:
    """The elements of an ML vector column as named double columns."""
    values = vector_to_array(F.col(vector))
    return [values[i].alias(name) for i, name in enumerate(names)]
