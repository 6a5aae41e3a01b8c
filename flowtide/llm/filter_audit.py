"""How filters interact: what each removes at each place of every order in which they can be applied.

A document's failures are five bits, one per filter. Documents are reduced to cells (part, bits) with their
number and the numbers labelled good and toxic, at most 32 cells a part. Each cell then folds across the array
of all 120 orders: ``aggregate`` walks an order step by step, ``transform`` does so for every order. That gives
600 weighted structs per cell, which are added element by element over the cells of a part. No row of the
corpus meets an order, and all of it is native expressions.

The filters (a word is a run of anything but space and ASCII controls 9 to 13):

- A: under 200 words; B: under half of the words differ; C: over 3 % of the code points are A-Z;
  D: holds one of ``#$%&*|``; E: the same text belongs to a smaller doc_id, in whatever part.

Equal texts are found by their SHA-256. They fail A to D alike, so copies are counted per text and part before
they meet, and a text found in a third of all rows costs a few rows per task.

Defined results: a null text is the empty text (fails A only, and E like any other); a null lang is the part ''.
A row without doc_id never fails E and makes no other row fail it. Rows repeated with one doc_id count each and
do not make each other fail. A document is good (toxic) if any of its label rows says 1; without labels or with
null in them it is neither. Empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.tables import written

FILTERS = "ABCDE"
#: Every order, as text and as an array of filter numbers: a constant of 120 x 5 that travels with the plan.
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_ORDERS = [[FILTERS.index(f) for f in order] for order in ORDERS]

MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
MARKS = "#$%&*|"
_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, copy, mask): the bits of A to D and the digest that copies share, one row per document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"), F.filter(F.split(text, _GAP), lambda w: w != "").alias("words"))
    n, chars = F.size("words"), F.char_length("text")
    upper = chars - F.char_length(F.translate("text", _UPPER, ""))
    tests = [n < MIN_WORDS, 100 * F.size(F.array_distinct("words")) < MIN_DISTINCT * n,
             100 * upper > MAX_UPPER * chars, F.col("text").rlike(f"[{MARKS}]")]
    mask = reduce(add, [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(tests)])
    return whole.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("copy"), mask.alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by their five bits, at most 32 rows a part."""
    rows = failures(docs).groupBy("doc_id", "part", "copy", "mask").agg(F.count(F.lit(1)).alias("n"))
    # Rows without key match no label; the text spreads them over the tasks of the join.
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("copy")).otherwise(0))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("spread"), "quality", "toxic")
    known = known.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "spread").agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    labelled = rows.join(known, ["doc_id", "spread"], "left").withColumns({
        c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})

    keyed = F.col("doc_id").isNotNull()
    copies = labelled.groupBy("copy", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),  # one row per doc_id here, null keys are passed over
        F.sum(F.when(keyed, 0).otherwise(F.col("n"))).alias("unkeyed"))
    # A few rows per different text: its parts and labels. Written, as they are read twice and hold all of the texts' work.
    copies = written(copies, "copies")
    smallest = copies.groupBy("copy").agg(F.min("first").alias("smallest"))
    met = copies.join(smallest, "copy")
    original = F.col("unkeyed") + F.when(F.col("first") == F.col("smallest"), F.col("n_first")).otherwise(0)
    split = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), original.alias("n")),
        F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - original).alias("n"))))
    return (met.select("part", "good", "toxic", split.alias("cell")).groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum("cell.n").alias("n"), F.sum(F.when(F.col("good"), F.col("cell.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("cell.n")).otherwise(0)).alias("toxic")).filter("n > 0"))


def _steps(order: Column) -> Column:
    """One cell walked through one order: a struct per step."""
    def step(state: Column, number: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), number)
        fails, gone = F.col("mask").bitwiseAND(bit) != 0, state["gone"]
        removed = fails & ~gone
        count = lambda when, weight="n": F.when(when, F.col(weight)).otherwise(F.lit(0).cast("long"))
        here = F.struct(
            number.alias("filter"), count(~fails & ~gone).alias("kept"), count(removed).alias("removed"),
            count(fails & gone).alias("redundant"), count(F.col("mask") == bit).alias("unique_fails"),
            count(removed, "good").alias("good_lost"), count(removed, "toxic").alias("toxic_lost"))
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(here)).alias("steps"))

    kind = f"array<struct<filter:int,{','.join(f'{m}:bigint' for m in MEASURES)}>>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(
        x["filter"].alias("filter"), *[(x[m] + y[m]).alias(m) for m in MEASURES]))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: documents kept, removed, redundant and so on (see the contract columns)."""
    folded = cells(docs, labels).select("part", F.flatten(F.transform(F.lit(_ORDERS), _steps)).alias("steps"))
    # At most 32 arrays of 600 structs meet in a part.
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("all")).select(
        "part", F.aggregate(F.slice("all", 2, 31), F.col("all")[0], _added).alias("steps"))
    total = F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda f: F.aggregate(
        "steps", F.lit(0).cast("long"), lambda s, x: s + F.when(x["filter"] == f, x["removed"]).otherwise(0)))
    rows = merged.withColumn("shapley", total).select("part", "shapley", F.posexplode("steps").alias("place", "step"))
    return rows.select(
        "part", F.lit(ORDERS)[(F.col("place") / len(FILTERS)).cast("int")].alias("filter_order"),
        (F.col("place") % len(FILTERS) + 1).cast("int").alias("step"), *[F.col(f"step.{m}").alias(m) for m in MEASURES],
        F.col("shapley")[F.col("step.filter")].alias("shapley"))


AUDIT_SQL = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
known AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         len(w) < {MIN_WORDS} AS a, 100 * len(list_distinct(w)) < {MIN_DISTINCT} * len(w) AS b,
         100 * len(regexp_extract_all(text, '[A-Z]')) > {MAX_UPPER} * length(text) AS c,
         regexp_matches(text, '[{MARKS}]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM doc LEFT JOIN known USING (doc_id)),
cell AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failing GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
walked AS (
  SELECT part, filter_order, o, fails, n, good, toxic,
         coalesce(list_position(list_transform(o, lambda x: fails[x]), true), 6) AS gone FROM cell, orders),
counted AS (
  SELECT part, filter_order, step, o[step] AS f,
         coalesce(sum(n) FILTER (gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed,
         coalesce(sum(n) FILTER (gone < step AND fails[o[step]]), 0) AS redundant,
         coalesce(sum(n) FILTER (fails[o[step]] AND len(list_filter(fails, lambda x: x)) = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (gone = step), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
  FROM walked, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
