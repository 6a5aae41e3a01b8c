"""Exact quantiles by radix selection: no value is sorted and no sketch is kept.

A double is mapped to a 64-bit whole number in the same order (sign, exponent and fraction, as IEEE 754 lays them
out). Values are counted by the leading 12 bits of that code, sign and exponent; the running counts tell which code
prefixes hold the wanted ranks, and only values with those prefixes are counted by the next 12 bits, and so on. A prefix
whose smallest and largest value are equal needs no further level, so whole numbers up to some millions take three
passes, and nothing takes more than six.

A pass is one aggregation, combined before the shuffle. Its result, at most 4,096 counts for each column and prefix
followed, is summed up on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor, isinf

from pyspark.sql import Column, DataFrame, functions as F

DIGIT_BITS, CODE_BITS = 12, 64
FRACTION_BITS, BIAS = 52, 1023
_SMALLEST_NORMAL = 2.0 ** -1022


def with_codes(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns, each with a whole number ``<column>_code`` in the order of its doubles; both zeros have code 0.

    The exponent comes from a logarithm and is put right by one where that was rounded. Dividing by a power of two
    is exact, so the fraction is too. Worked out in steps, so that no part is computed twice.
    """
    power = lambda e: F.pow(F.lit(2.0), e)
    named = lambda kind, make: [make(c).alias(f"{c}_{kind}") for c in columns]
    held = lambda *kinds: [*columns, *[f"{c}_{k}" for k in kinds for c in columns]]

    def exponent(c: str) -> Column:
        part = F.abs(c) / power(F.col(f"{c}_guess"))
        return F.col(f"{c}_guess") + F.when(part < 1, -1.0).when(part >= 2, 1.0).otherwise(0.0)

    def code(c: str) -> Column:
        size, power_of = F.abs(c), F.col(f"{c}_exponent")
        unit = F.lit(1 << FRACTION_BITS).cast("long")
        fraction = ((size / power(power_of) - 1) * float(1 << FRACTION_BITS)).cast("long")
        bits = (F.when(size == 0, F.lit(0).cast("long"))
                .when(size == float("inf"), F.lit((2 * BIAS + 1) << FRACTION_BITS))
                .when(size < _SMALLEST_NORMAL, (size / power(F.lit(-1074.0))).cast("long"))
                .otherwise((power_of.cast("long") + BIAS) * unit + fraction))
        return bits * F.when(F.col(c) < 0, -1).otherwise(1)

    guessed = table.select(*held(), *named("guess", lambda c: F.floor(F.log2(F.abs(c))).cast("double")))
    placed = guessed.select(*held(), *named("exponent", exponent))
    return placed.select(*held(), *named("code", code))


def _leading(code: Column, bits: int) -> Column:
    return F.shiftright(code, CODE_BITS - bits)


def prefix_counts(table: DataFrame, columns: Sequence[str], before: int, bits: int,
                  parents: dict[str, list[int]] | None) -> DataFrame:
    """(feature, parent, prefix, n, low, high): values by the leading ``bits`` of their code, below certain prefixes of
    ``before`` bits."""
    def entry(c: str) -> Column:
        code = F.col(f"{c}_code")
        parent = _leading(code, before) if before else F.lit(0).cast("long")
        wanted = F.lit(True) if parents is None else parent.isin(parents.get(c, []))
        return F.struct(F.lit(c).alias("feature"), parent.alias("parent"), _leading(code, bits).alias("prefix"),
                        F.when(wanted, F.col(c)).alias("value"))

    rows = with_codes(table, columns).select(F.explode(F.array(*[entry(c) for c in columns])).alias("row")).select("row.*")
    return rows.filter(F.col("value").isNotNull()).groupBy("feature", "parent", "prefix").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def values_at(table: DataFrame, columns: Sequence[str], ranks: dict[str, list[int]]) -> dict[str, dict[int, float]]:
    """The values at the given ranks (from 0) of columns of doubles, one pass per 12 bits of code still in doubt."""
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    # What is followed: by column and prefix, the number of values below it and the ranks inside.
    follow = {(c, 0): (0, sorted(set(ranks[c]))) for c in columns if ranks[c]}
    before, parents = 0, None
    while follow:
        bits = min(CODE_BITS, before + DIGIT_BITS)
        counts = prefix_counts(table, columns, before, bits, parents).collect()
        running = {key: start for key, (start, _) in follow.items()}
        further, parents = {}, {}
        for r in sorted(counts, key=lambda r: r["prefix"]):
            key = (r["feature"], r["parent"])
            if key not in follow:
                continue
            start = running[key]
            running[key] = start + r["n"]
            inside = [k for k in follow[key][1] if start <= k < start + r["n"]]
            if inside and r["low"] == r["high"]:
                found[r["feature"]].update(dict.fromkeys(inside, r["low"]))
            elif inside:
                further[r["feature"], r["prefix"]] = (start, inside)
                parents.setdefault(r["feature"], []).append(r["prefix"])
        follow, before = further, bits
    return found


def quantile_values(table: DataFrame, counts: dict[str, int], probabilities: Sequence[float]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of columns with ``counts`` values each; a column without values has none."""
    counts = {c: n for c, n in counts.items() if n}
    places = {c: [p * (n - 1) for p in probabilities] for c, n in counts.items()}
    at = values_at(table, list(counts), {c: [f(x) for x in xs for f in (floor, ceil)] for c, xs in places.items()})

    def value(c: str, place: float) -> float:
        low, high = at[c][floor(place)], at[c][ceil(place)]
        return low if low == high or isinf(low) else low + (high - low) * (place - floor(place))

    return {c: [value(c, x) for x in xs] for c, xs in places.items()}
