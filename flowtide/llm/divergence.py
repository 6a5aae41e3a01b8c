"""How the sources of a language differ in their words: chi-square-like distances over all kept terms.

Kept are the terms found in at least three documents of their language. They are found by iceberg refinement of
byte prefixes: a prefix found in fewer documents has no kept extension, so only extensions of surviving prefixes
are counted at the next level, 6, 12, 24, ... bytes, until only whole terms are left. One pass over the texts
counts the distinct documents of every prefix within a task; as a document lies in one task, the numbers add up. A
second pass counts whole terms by language and source; they meet the surviving prefixes of their language in
buckets, and only terms whose longest level prefix survived are summed.

Terms are compared by their bytes. A task adds up its counts before it sends them, so a word in every document costs
one row per task and source. Kept terms are rows with a list of (source, count), at most one entry per source.
Pairs of sources are never joined: kept terms lie in groups of some ten thousand, each group fills a matrix of terms
by sources and sums the distances of all pairs, and the sums of groups are added. That is as many numbers as the
result has rows, per group. Each group also names every source's best terms.

All arithmetic is on integers. ``per_billion`` is exact up to counts of 2.8e14.

Defined results: null text, lang and source are ''. Repeated rows count as documents of their own. A group without
kept terms has count 0 throughout; a language without kept terms has distance 0 between its sources and no term rows.
A language with one source has no pairs. Ties in value are ranked by the item's UTF-8 bytes. An empty table gives an
empty result. Only text, lang and source are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm.blocks import sizes
from flowtide.llm.tables import slices, written
from flowtide.llm.terms import counted, out_batches, pooled, prefixes, totals

MIN_DOCS = 3
FIRST_LEVEL = 6
TOP_TERMS = 200
BILLION = 1_000_000_000
#: Kept terms of a group of the pairwise sums, and numbers in a matrix at a time.
GROUP_TERMS, CELLS = 20_000, 1 << 18

PREFIX = "lang string, prefix binary, docs long"
TERMS = "key binary, source string, term binary, docs long, n long"


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _levels(longest: int) -> list[int]:
    out = [FIRST_LEVEL]
    while out[-1] < longest:
        out.append(2 * out[-1])
    return out


def parent_size(lengths: np.ndarray) -> np.ndarray:
    """Bytes of the longest level prefix shorter than a term; a term of up to ``FIRST_LEVEL`` bytes is its own."""
    size = np.full(len(lengths), FIRST_LEVEL, np.int64)
    while (more := 2 * size < lengths).any():
        size[more] *= 2
    return size


def parent_prefixes(terms: pa.Array, size: np.ndarray) -> pa.Array:
    """Each term cut to its own number of bytes; there are few different numbers."""
    order = np.argsort(size, kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    cut = [prefixes(terms.take(pa.array(np.flatnonzero(size == s))), int(s)) for s in np.unique(size)]
    return pa.concat_arrays([*cut, terms.slice(0, 0)]).take(pa.array(back))


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.cast(pa.string()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _key(prefix: pa.Array, langs: pa.Array) -> pa.Array:
    """Prefix and language as one key; a term holds no NUL, so they can be parted again."""
    return pc.binary_join_element_wise(prefix.cast(pa.binary()), langs.cast(pa.binary()), pa.scalar(b"\0", pa.binary()))


def prefix_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each level prefix of longer terms, by language."""
    def parts() -> Iterator[tuple]:
        for batch in slices(batches):
            langs, names = _coded(batch["lang"])
            found = counted(batch["text"])
            lengths = pc.binary_length(found.terms).to_numpy()
            for size in _levels(int(lengths.max(initial=0)))[:-1]:
                longer = np.flatnonzero(lengths > size)
                coded = prefixes(found.terms.take(pa.array(longer)), size).dictionary_encode()
                of = np.full(len(lengths), -1, np.int64)
                of[longer] = coded.indices.to_numpy()
                own = of[found.term]
                text, prefix, _ = totals(found.text[own >= 0], len(coded.dictionary), own[own >= 0])
                lang, prefix, docs = totals(langs[text], len(coded.dictionary), prefix)
                yield names, lang, coded.dictionary.take(pa.array(prefix)), docs

    for names, lang, items, prefix, docs in pooled(parts()):
        yield from out_batches({
            "lang": pa.array(names, pa.string()).take(pa.array(lang)),
            "prefix": items.take(pa.array(prefix)).cast(pa.binary()), "docs": pa.array(docs, pa.int64())})


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and occurrences of each whole term by language and source, with the prefix it depends on."""
    def parts() -> Iterator[tuple]:
        for batch in slices(batches):
            langs, lang_names = _coded(batch["lang"])
            sources, source_names = _coded(batch["source"])
            found = counted(batch["text"])
            group = langs * max(1, len(source_names)) + sources
            own, term, docs, n = totals(group[found.text], len(found.terms), found.term, np.ones_like(found.times), found.times)
            yield ([(a, b) for a in lang_names for b in source_names], own, found.terms.take(pa.array(term)), docs, n)

    for names, own, items, term, docs, n in pooled(parts()):
        lang, source = (pa.array([name[k] for name in names], pa.string()).take(pa.array(own)) for k in (0, 1))
        parents = parent_prefixes(items, parent_size(pc.binary_length(items).to_numpy()))
        yield from out_batches({
            "key": _key(parents.take(pa.array(term)), lang), "source": source,
            "term": items.take(pa.array(term)).cast(pa.binary()),
            "docs": pa.array(docs, pa.int64()), "n": pa.array(n, pa.int64())})


def surviving_prefixes(docs: DataFrame) -> DataFrame:
    """(lang, prefix) of every level that at least ``MIN_DOCS`` documents hold, refined level by level."""
    spark = docs.sparkSession
    counts = written(docs.select("lang", "text").mapInArrow(prefix_counts, PREFIX), "prefixes")
    sizes = [r["size"] for r in counts.select(F.octet_length("prefix").alias("size")).distinct().collect()]
    kept = spark.createDataFrame([], "lang string, prefix binary")
    level = None
    for size in sorted(sizes):  # doubling sizes: some ten levels for the longest terms
        here = counts.filter(F.octet_length("prefix") == size)
        if level is not None:
            held = level.select("lang", F.col("prefix").alias("parent"))
            here = (here.withColumn("parent", F.substring("prefix", 1, size // 2))
                    .join(held, ["lang", "parent"], "left_semi"))
        level = written(here.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs"))
                        .filter(F.col("docs") >= MIN_DOCS).select("lang", "prefix"), f"level-{size}")
        kept = kept.unionByName(level)
    return kept


def _whole_terms(rows: pa.Table, held: pa.Table) -> pa.Table:
    """The kept terms among those of a bucket, whose surviving prefixes are in the same bucket."""
    rows = rows.combine_chunks()
    short = pc.less_equal(pc.binary_length(rows["term"]), FIRST_LEVEL)
    rows = rows.filter(pc.or_(short, pc.is_in(rows["key"], value_set=held["key"].combine_chunks())))
    code = lambda c: rows[c].combine_chunks().dictionary_encode()
    keys, terms, sources = code("key"), code("term"), code("source")
    index = lambda c: c.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    docs, n = rows["docs"].to_numpy(), rows["n"].to_numpy()
    key, term, docs_of, n_of = totals(index(keys), len(terms.dictionary), index(terms), docs, n)
    number = np.searchsorted(key * max(1, len(terms.dictionary)) + term,
                             index(keys) * max(1, len(terms.dictionary)) + index(terms))
    own, source, n_by = totals(number, len(sources.dictionary), index(sources), n)
    kept = docs_of >= MIN_DOCS
    listed = kept[own]
    sizes = np.bincount(own[listed], minlength=len(kept))[kept]
    langs = pa.array([k.partition(b"\0")[2].decode() for k in keys.dictionary.to_pylist()], pa.string())
    by = pa.StructArray.from_arrays(
        [sources.dictionary.take(pa.array(source[listed])), pa.array(n_by[listed], pa.int64())], names=["source", "n"])
    return pa.table({
        "lang": langs.take(pa.array(key[kept])), "term": terms.dictionary.take(pa.array(term[kept])).cast(pa.string()),
        "n": pa.array(n_of[kept], pa.int64()),
        "by": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), by)})


def kept_terms(docs: DataFrame) -> DataFrame:
    """(lang, term, n, by): kept terms with their occurrences, whole and by source."""
    _, buckets = sizes(docs)
    dealt = lambda rows: rows.withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")).groupBy("bucket")
    rows = docs.mapInArrow(term_counts, TERMS)
    held = surviving_prefixes(docs).select(
        F.concat("prefix", F.lit(b"\0"), F.col("lang").cast("binary")).alias("key"))
    return dealt(rows).cogroup(dealt(held)).applyInArrow(
        _whole_terms, "lang string, term string, n long, by array<struct<source:string,n:long>>")


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, held, lang_held, size): kept occurrences of a group and of its language, kept terms of that."""
    groups = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")).drop("rows")
    own = (kept.select("lang", F.inline("by")).groupBy("lang", "source").agg(F.sum("n").alias("held")))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_held"), F.count(F.lit(1)).alias("size"))
    zero = F.lit(0).cast("long")
    return groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("held", "lang_held", "size")])


def per_billion(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 * (count + 1) / total) in 64 bits: the factor is taken in two parts, so that no product passes 2^63."""
    whole, rest = np.divmod((count + 1) * 31250, total)
    return 1 + whole * 32000 + rest * 32000 // total


def _measured(kept: pa.Table, groups: pa.Table) -> pa.Table:
    """Over one group of a language's kept terms: the distances between all its sources, and each source's best terms."""
    groups = groups.sort_by("source")
    names = groups["source"].combine_chunks()
    total = (groups["held"].to_numpy() + groups["size"].to_numpy())
    s, sums, best = len(names), np.zeros((len(names), len(names)), np.int64), []
    if kept.num_rows:
        kept = kept.sort_by("term")
        lists = kept["by"].combine_chunks()
        flat = lists.flatten()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        column = pc.index_in(flat.field("source"), names).to_numpy()
        p = per_billion(flat.field("n").to_numpy(), total[column])
        absent = per_billion(np.zeros(s, np.int64), total)
        step = max(1, CELLS // s)
        for low in range(0, len(lists), step):
            here = slice(*np.searchsorted(row, [low, low + step]))
            share_of = np.tile(absent, (min(step, len(lists) - low), 1))
            share_of[row[here] - low, column[here]] = p[here]
            for a in range(s):
                away = share_of[:, a:a + 1] - share_of
                sums[a] += (away * away // share_of).sum(axis=0)
        q = per_billion(kept["n"].to_numpy(), (groups["lang_held"].to_numpy() + groups["size"].to_numpy())[:1])[row]
        value = (p - q) * (p - q) // q
        above = np.flatnonzero(p > q)
        order = above[np.lexsort((row[above], -value[above], column[above]))]
        place = np.arange(len(order)) - np.searchsorted(column[order], column[order])
        best = order[place < TOP_TERMS]  # the first of all are among the first of each group
    a, b = np.nonzero(~np.eye(s, dtype=bool))
    text = lambda x, at: x.take(pa.array(at)).cast(pa.string())
    rows = [pa.table({"source": text(names, a), "part": pa.array(["pair"] * len(a), pa.string()), "item": text(names, b),
                      "value": pa.array(sums[a, b], pa.int64())})]
    if len(best):
        rows.append(pa.table({
            "source": text(names, column[best]), "part": pa.array(["term"] * len(best), pa.string()),
            "item": text(kept["term"].combine_chunks(), row[best]), "value": pa.array(value[best], pa.int64())}))
    out = pa.concat_tables(rows)
    return out.add_column(0, "lang", pa.array([groups["lang"][0].as_py()] * out.num_rows, pa.string()))


def divergence(docs: DataFrame) -> DataFrame:
    """Ranked rows (lang, source, part, item, value, rank): ``pair`` for other sources, ``term`` for typical terms."""
    docs = _read(docs)
    kept = written(kept_terms(docs), "kept")
    groups = written(groups_of(docs, kept), "groups")
    buckets = max(1, -(-kept.count() // GROUP_TERMS))
    dealt = kept.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    # Every group of terms needs the sources of its language: as many rows as the group's result has columns.
    asked = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    values = dealt.groupBy("lang", "bucket").cogroup(asked.groupBy("lang", "bucket")).applyInArrow(
        _measured, "lang string, source string, part string, item string, value long")
    by_group = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (values.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(by_group))
            .filter((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS)))


DIVERGENCE_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
hit AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM hit GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
lang_total AS (SELECT lang, sum(n) AS held, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM doc),
own AS (SELECT lang, source, term, count(*) AS n FROM hit SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
own_total AS (SELECT lang, source, sum(n) AS held FROM own GROUP BY lang, source),
g AS (
  SELECT lang, source, coalesce(own_total.held, 0)::HUGEINT AS held, coalesce(v, 0)::HUGEINT AS v,
         coalesce(lang_total.held, 0)::HUGEINT AS lang_held
  FROM grp LEFT JOIN own_total USING (lang, source) LEFT JOIN lang_total USING (lang)),
p AS (
  SELECT lang, source, term, own.n IS NOT NULL AS here,
         1 + ({BILLION}::HUGEINT * (coalesce(own.n, 0) + 1)) // (g.held + g.v) AS p,
         1 + ({BILLION}::HUGEINT * (kept.n + 1)) // (g.lang_held + g.v) AS q
  FROM g JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(far.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
  FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q AS value,
         row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, term)
  FROM p WHERE here AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
