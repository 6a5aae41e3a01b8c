"""Preference formatting: a shared prompt and two masked completions per pair of conversations.

Turns are put in order of their number (null numbers last, ties by role and text; repeated rows are
turns of their own). The longest common prefix of turns, equal in role and text, is rendered once as
the prompt; what follows in each conversation is its completion. The mask of a completion lists the
character ranges a model is trained on: the contents of assistant turns with their end marks. Marks
found inside a text are taken apart, so that no text can open or close a turn.

A null role or text counts as empty. Turns without a pair or side are left out, as they belong to no
conversation; a pair with one side has an empty prompt and a null completion for the other side. An
empty table gives an empty result. Only the named columns are read. The work is native: one shuffle by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "array<struct<late:boolean,turn:bigint,role:string,text:string>>"


def _rendered(t: Column) -> Column:
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), clean(t["role"]), F.lit("|>\n"), clean(t["text"]), F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    """A list of turns as one string."""
    return F.array_join(F.transform(turns, _rendered), "")


def trained(turns: Column) -> Column:
    """Character ranges of assistant contents and their end marks in ``render(turns)``."""
    def step(state: Column, t: Column) -> Column:
        text = _rendered(t)
        opening = F.length(F.replace(F.coalesce(t["role"], F.lit("")), F.lit("<|"), F.lit("< |"))) + 5
        span = F.struct((state["at"] + opening).cast("int").alias("first"),
                        (state["at"] + F.length(text) - 1).cast("int").alias("last"))
        return F.struct(
            (state["at"] + F.length(text)).cast("int").alias("at"),
            F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<first:int,last:int>>")
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda s: s["spans"])


def preference_pairs(turns: DataFrame, pair: str = "pair_id", side: str = "side") -> DataFrame:
    """Rows of (pair, side, turn, role, text), with side ``chosen`` or ``rejected``, as one row per pair."""
    row = F.struct(F.col("turn").isNull().alias("late"), F.col("turn").cast("long").alias("turn"), "role", "text")
    lists = [F.array_sort(F.collect_list(F.when(F.col(side) == s, row))).alias(s) for s in ("chosen", "rejected")]
    return formatted(turns.filter(F.col(pair).isNotNull() & F.col(side).isin("chosen", "rejected"))
                     .groupBy(F.col(pair).alias("pair_id")).agg(*lists))


def formatted(pairs: DataFrame) -> DataFrame:
    """The same from pairs whose sides are ordered lists of turns (``TURN``), empty where there is no side."""
    both = F.least(F.size("chosen"), F.size("rejected"))
    same = lambda i: (
        F.coalesce(F.get("chosen", i)["role"], F.lit("")) == F.coalesce(F.get("rejected", i)["role"], F.lit(""))) & (
        F.coalesce(F.get("chosen", i)["text"], F.lit("")) == F.coalesce(F.get("rejected", i)["text"], F.lit("")))
    shared = F.when(both == 0, F.lit(0)).otherwise(F.aggregate(
        F.sequence(F.lit(0), F.greatest(both - 1, F.lit(0))), F.lit(0),
        lambda n, i: F.when((n == i) & same(i), n + 1).otherwise(n)))
    split = pairs.withColumn("n_prompt_turns", shared)
    rest = lambda s: F.slice(s, F.col("n_prompt_turns") + 1, F.greatest(F.size(s), F.lit(1)))
    given = lambda s, c: F.when(F.size(s) > 0, c)
    return split.select(
        "pair_id", "n_prompt_turns",
        render(F.slice("chosen", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
        *(given(s, render(rest(s))).alias(s) for s in ("chosen", "rejected")),
        *(given(s, trained(rest(s))).alias(f"{s}_mask") for s in ("chosen", "rejected")))


def answer_pairs(conversations: DataFrame) -> DataFrame:
    """Two sides for each conversation that has an answer: as it is, and up to its last answer with another in its place.

    The other answer is the last one of the partner, the conversation whose key differs in the last bit; a conversation
    without partner or answer has only the chosen side. Chosen and rejected share all turns before the answer. One
    shuffle of the turns by conversation, and one of the answers to their partners.
    """
    row = F.struct(F.col("turn").isNull().alias("late"), F.col("turn").cast("long").alias("turn"), "role", "text")
    whole = (conversations.filter(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("pair_id"))
             .agg(F.array_sort(F.collect_list(row)).alias("turns")))
    whole = whole.withColumn("last", F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i))))
    answers = whole.filter("last is not null").select(
        F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.get("turns", F.col("last"))["text"].alias("answer"),
        F.lit(True).alias("answered"))
    place = F.get("turns", F.col("last"))
    put = F.struct(place["late"].alias("late"), place["turn"].alias("turn"), place["role"].alias("role"), F.col("answer").alias("text"))
    rejected = F.concat(F.slice("turns", F.lit(1), F.col("last")), F.array(put))
    return whole.join(answers, "pair_id", "left").select(
        "pair_id", F.col("turns").alias("chosen"),
        F.when(F.col("answered") & F.col("last").isNotNull(), rejected).otherwise(F.array().cast(TURN)).alias("rejected"))


def spans_text(mask: Column) -> Column:
    """A mask as text, ``first-last`` ranges joined by commas."""
    return F.when(mask.isNotNull(), F.array_join(F.transform(
        mask, lambda s: F.concat_ws("-", s["first"].cast("string"), s["last"].cast("string"))), ","))


_SIDE = """
  SELECT pair_id, n_prompt,
    CASE WHEN count(*) FILTER (side = '{s}') > 0 THEN
      coalesce(string_agg(body, '' ORDER BY pos) FILTER (side = '{s}' AND pos > n_prompt), '') END AS {s},
    CASE WHEN count(*) FILTER (side = '{s}') > 0 THEN
      coalesce(string_agg((before - prompt_chars + opening)::VARCHAR || '-' || (before - prompt_chars + chars - 1)::VARCHAR, ','
        ORDER BY pos) FILTER (side = '{s}' AND pos > n_prompt AND role = 'assistant'), '') END AS {s}_mask
  FROM placed GROUP BY pair_id, n_prompt"""

CHAT_SQL = f"""
WITH base AS (
  SELECT conv_id AS pair_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
answer AS (
  SELECT pair_id, pos, text FROM base
  QUALIFY role = 'assistant' AND pos = max(pos) FILTER (role = 'assistant') OVER (PARTITION BY pair_id)),
both_sides AS (
  SELECT pair_id, 'chosen' AS side, role, text, pos FROM base
  UNION ALL
  SELECT b.pair_id, 'rejected', b.role, CASE WHEN b.pos = own.pos THEN other.text ELSE b.text END, b.pos
  FROM base b JOIN answer own ON own.pair_id = b.pair_id AND b.pos <= own.pos
  JOIN answer other ON other.pair_id = xor(b.pair_id, 1)),
turns AS (
  SELECT *, '<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM both_sides),
differ AS (
  SELECT pair_id, min(pos) AS pos FROM (
    SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos
    FROM (SELECT * FROM turns WHERE side = 'chosen') a
    FULL JOIN (SELECT * FROM turns WHERE side = 'rejected') b
      ON a.pair_id = b.pair_id AND a.pos = b.pos AND a.role = b.role AND a.text = b.text
    WHERE a.pair_id IS NULL OR b.pair_id IS NULL)
  GROUP BY pair_id),
sized AS (SELECT pair_id, max(pos) AS n FROM turns GROUP BY pair_id),
placed AS (
  SELECT t.*, length(body) AS chars, length(replace(role, '<|', '< |')) + 5 AS opening,
         coalesce(d.pos - 1, s.n) AS n_prompt,
         coalesce(sum(length(body)) OVER (PARTITION BY t.pair_id, side ORDER BY t.pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         coalesce(sum(CASE WHEN t.pos <= coalesce(d.pos - 1, s.n) THEN length(body) END)
           OVER (PARTITION BY t.pair_id, side), 0) AS prompt_chars
  FROM turns t LEFT JOIN differ d USING (pair_id) JOIN sized s USING (pair_id)),
prompts AS (
  SELECT pair_id, coalesce(string_agg(body, '' ORDER BY pos) FILTER (side = 'chosen' AND pos <= n_prompt), '') AS prompt
  FROM placed GROUP BY pair_id),
good AS ({_SIDE.format(s="chosen")}),
bad AS ({_SIDE.format(s="rejected")})
SELECT pair_id::BIGINT AS pair_id, n_prompt::INT AS n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask
FROM prompts JOIN good USING (pair_id) JOIN bad USING (pair_id, n_prompt)
"""
