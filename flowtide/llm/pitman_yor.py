"""Word model by a hierarchical Pitman-Yor process, seated by Gibbs sampling in Spark.

Tokens are words lowered in A-Z, then one end token per text. Every previous word (or the start) has a restaurant of
its own; all of them share the root, the restaurant of the shorter, empty context, and the root draws from a uniform
base over the V training tokens and one unknown. In a restaurant, c customers eating a word sit at t tables; each
table sends one customer to the root. The chance of a word is

    (c - d t + (theta + d T) * chance in the parent) / (theta + C),

with C customers and T tables in the whole restaurant. A Gibbs sweep takes up the customers of each word in
each restaurant and seats them again one after another (Chinese restaurant; beyond the first twenty in lots of
five per cent, within which the chance of a new table is held), the previous words' restaurants first, then the root,
given the totals before. After ``BURN`` sweeps, ``SAMPLES`` seatings are kept and their predictive probabilities
averaged.

Counts cover the whole training part and grow with it: one row per (previous word, word), one restaurant per previous
word. They are split by ranges of the previous word's hash (buckets), so that C and T of a restaurant are known where
it lies. For the root, each bucket sends the tables of its distinct words to the buckets of those words and gets the
root's customers and tables back; two sums reach the driver. To score, blocks of documents ask the buckets for their
distinct words and pairs. A restaurant is not split: its rows, one per different word after its own, lie in one group.
Previous words are told apart by 64 bits of hash, the words in a restaurant and in the root by 40.

A null text is an empty text: one end token. Rows count and are scored one by one, so repeated rows weigh twice.
Without training rows all words share one chance. An empty table gives an empty result. Only doc_id and text
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.blocks import dealt, edges, in_order, sizes
from flowtide.llm.tables import brief_shuffles, discard, remainder, slices, texts_of, written
from flowtide.llm.words import U64, mix, split_words

BURN, SAMPLES, SEED = 2, 3, 20
DISCOUNTS, STRENGTHS = (0.75, 0.75), (20.0, 2.0)  # root, previous words
BLOCK_BYTES = 12 << 20
START, END = U64(0x5354415254), U64(0x454E44454E44)
DISH = U64(24)  # bits of a word's hash that its number as a dish leaves out

_ASK = "bucket int, block int, words binary, runs binary, followers binary, counts binary"
_STATE = "bucket int, sample int, words binary, runs binary, followers binary, counts binary, tables array<binary>"
_UP = "bucket int, source int, dishes binary, tables binary"
_ROOT = "bucket int, part int, dishes binary, customers binary, tables binary, all_customers long, all_tables long"
_TOLD = "bucket int, block int, totals binary, pairs binary"


class Tokens:
    """Tokens of some texts as places in their sorted distinct words, and their distinct (previous word, word) pairs.

    ``words`` holds the start and the end too; ``pair[i]`` is the pair of token i, ``before`` and ``word`` are the
    places of the pairs' words, sorted.
    """

    def __init__(self, texts: pa.Array) -> None:
        found = split_words(texts, lower=True, places=False)
        self.first = found.first + np.arange(found.texts + 1)
        token = np.full(self.first[-1] + 2, mix(np.array([END]))[0], U64)  # the start and the end last
        ends = np.zeros(len(token), bool)
        ends[self.first[1:] - 1] = True
        ends[-2:] = True
        token[~ends] = found.hashes
        token[-2] = mix(np.array([START]))[0]
        del found
        self.words, at = np.unique(token, return_inverse=True)
        self.start, self.end = int(at[-2]), int(at[-1])
        del token, ends
        keys = np.empty(len(at) - 2, np.int64)
        keys[1:] = at[:-3]
        keys[self.first[:-1]] = self.start
        keys *= len(self.words)
        keys += at[:-2]
        del at
        keys, self.pair, self.counts = np.unique(keys, return_inverse=True, return_counts=True)
        self.before, self.word = np.divmod(keys, max(1, len(self.words)))


def _edges(buckets: int) -> np.ndarray:
    """First word of each bucket but the first; words of one dish stay together."""
    return edges(buckets) >> DISH << DISH


def small(values: np.ndarray) -> bytes:
    """Counts of which most are small: a byte each, those from 255 on behind, compressed."""
    raw = np.minimum(values, 255).astype("u1").tobytes() + values[values >= 255].astype("<u8").tobytes()
    return zstandard.compress(raw, 1) if raw else raw


def from_small(data: pa.Buffer, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data) if len(data) else b"", "u1")
    out = raw[:n].astype(np.int64)
    out[out == 255] = np.frombuffer(raw[n:].tobytes(), "<u8").astype(np.int64)
    return out


def planes(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers with the highest bytes of all first, compressed: most of those are zero."""
    width = np.dtype(kind).itemsize
    return zstandard.compress(numbers.astype(kind).view("u1").reshape(-1, width).T.tobytes(), 1) if len(numbers) else b""


def from_planes(data: pa.Buffer | bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data) if len(data) else b"", "u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def rising(numbers: np.ndarray) -> bytes:
    """Sorted numbers, by their differences."""
    return planes(np.diff(numbers, prepend=U64(0)), ">u8")


def from_rising(data: pa.Buffer | bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, ">u8"), dtype=U64)


def listed(numbers: np.ndarray) -> bytes:
    """Numbers in any order: the distinct ones, sorted, and the place of each among them."""
    names, at = np.unique(numbers, return_inverse=True)
    head = rising(names)
    return len(head).to_bytes(4, "little") + head + planes(at, ">u4")


def from_listed(data: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    data = data.to_pybytes()
    stop = 4 + int.from_bytes(data[:4], "little")
    return from_rising(data[4:stop]), from_planes(data[stop:], ">u4").astype(np.int64)


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def _packed(words: np.ndarray, before: np.ndarray, dishes: np.ndarray, counts: np.ndarray | None, block: int,
            buckets: int) -> dict[str, pa.Array]:
    """Sorted words and their pairs (place of the previous word, dish) as one row per bucket."""
    borders = _edges(buckets)
    cuts = np.concatenate([[0], np.searchsorted(words, borders), [len(words)]])
    pairs = np.searchsorted(before, cuts)
    runs = np.bincount(before, minlength=len(words))
    some = np.flatnonzero(np.diff(cuts))
    own = [(slice(cuts[b], cuts[b + 1]), slice(pairs[b], pairs[b + 1])) for b in some]
    return {"bucket": pa.array(some, pa.int32()), "block": pa.array(np.full(len(some), block), pa.int32()),
            "words": _binary([rising(words[w]) for w, _ in own]),
            "runs": _binary([small(runs[w]) for w, _ in own]),
            "followers": _binary([listed(dishes[p]) for _, p in own]),
            "counts": _binary([small(counts[p]) if counts is not None else b"" for _, p in own])}


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating ``customers`` anew, where a new table draws with weight ``fresh``."""
    seated, tables = np.ones(len(customers), np.int64), np.ones(len(customers), np.int64)
    active = np.flatnonzero(customers > 1)
    while len(active):
        n, t, a = seated[active], tables[active], fresh[active]
        lot = np.minimum(np.maximum(n // 20, 1), customers[active] - n)
        old = n + (lot - 1) / 2 - discount * t
        tables[active] += rng.binomial(lot, a / (a + old))
        seated[active] += lot
        active = active[seated[active] < customers[active]]
    return tables


class Root:
    """The root's totals, and the base chance of one word."""

    def __init__(self, customers: int, tables: int, vocabulary: int) -> None:
        self.customers, self.tables, self.base = customers, tables, 1 / (vocabulary + 1)

    @property
    def fresh(self) -> float:
        """The weight of a new table."""
        return STRENGTHS[0] + DISCOUNTS[0] * self.tables

    def chance(self, customers, tables):
        return (customers - DISCOUNTS[0] * tables + self.fresh * self.base) / (STRENGTHS[0] + self.customers)


def chance(customers, tables, all_customers, all_tables, parent):
    """The chance of a word in the restaurant of its previous word."""
    d, theta = DISCOUNTS[1], STRENGTHS[1]
    return (customers - d * tables + (theta + d * all_tables) * parent) / (theta + all_customers)


class Seating:
    """The restaurants of one bucket: previous words, and the words eaten in each as places in ``dishes``."""

    def __init__(self, row: dict) -> None:
        self.words = from_rising(row["words"].as_buffer())
        self.runs = from_small(row["runs"].as_buffer(), len(self.words))
        self.dishes, self.dish = from_listed(row["followers"].as_buffer())
        self.counts = from_small(row["counts"].as_buffer(), len(self.dish))
        self.room = np.repeat(np.arange(len(self.words)), self.runs)
        self.first = np.cumsum(self.runs) - self.runs

    def in_rooms(self, values: np.ndarray) -> np.ndarray:
        """Sums of values of pairs by restaurant (none is empty)."""
        return np.add.reduceat(values, self.first) if len(self.first) else np.zeros(0, np.int64)

    def tables(self, row: dict, sample: int = -1) -> np.ndarray:
        return from_small(row["tables"].values[sample].as_buffer(), len(self.dish))


class Model:
    """Seatings by bucket, the root of each kept sample, and the totals of the training tokens."""

    def __init__(self, state: DataFrame, roots: list[Root], train_tokens: int, vocabulary: int, buckets: int) -> None:
        self.state, self.roots, self.buckets = state, roots, buckets
        self.train_tokens, self.vocabulary = train_tokens, vocabulary


def count(training: DataFrame, buckets: int) -> DataFrame:
    """Pair counts of all training texts, one row per bucket of previous words; everyone at a table of their own word."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = Tokens(batch.column("text"))
            held, before = np.unique(found.before, return_inverse=True)
            yield pa.RecordBatch.from_pydict(_packed(
                found.words[held], before, found.words[found.word] >> DISH, found.counts, 0, buckets))

    def add(key: tuple, table: pa.Table) -> pa.Table:
        words, dishes, counts = [], [], []
        for w, r, f, c in zip(*(table[name] for name in ("words", "runs", "followers", "counts"))):
            own = from_rising(w.as_buffer())
            words.append(np.repeat(own, from_small(r.as_buffer(), len(own))))
            names, at = from_listed(f.as_buffer())
            dishes.append(names[at])
            counts.append(from_small(c.as_buffer(), len(dishes[-1])))
        words, room = np.unique(np.concatenate(words), return_inverse=True)
        dishes, dish = np.unique(np.concatenate(dishes), return_inverse=True)
        keys, at = np.unique(room * len(dishes) + dish, return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(keys)).astype(np.int64)
        room, dish = np.divmod(keys, len(dishes))
        return pa.table({
            "bucket": pa.array([key[0].as_py()], pa.int32()), "sample": pa.array([-1], pa.int32()),
            "words": _binary([rising(words)]), "runs": _binary([small(np.bincount(room))]),
            "followers": _binary([listed(dishes[dish])]), "counts": _binary([small(total)]),
            "tables": pa.array([[small(np.ones(len(keys), np.int64))]], pa.list_(pa.binary()))})

    packets = training.select("text").mapInArrow(ask, _ASK)
    return written(packets.groupBy("bucket").applyInArrow(add, _STATE), "seating")


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i] for name in batch.schema.names}


def _sizes(state: DataFrame) -> tuple[int, int]:
    """Training tokens, and different words among them: the previous words, with the start in place of the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [Seating(row) for row in _rows(batch)]
            yield pa.RecordBatch.from_pydict({"n": pa.array([int(s.counts.sum()) for s in held], pa.int64()),
                                              "v": pa.array([len(s.words) for s in held], pa.int64())})

    n, v = state.mapInArrow(run, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return n or 0, v or 0


def seat_root(state: DataFrame, before: Root | None, vocabulary: int, buckets: int, seed: tuple[int, int]) -> tuple[DataFrame, Root]:
    """The root seated anew: a row per bucket of dishes (part -1), and one for each bucket that asked."""
    fresh = (before or Root(0, 0, vocabulary)).fresh / (vocabulary + 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                seating = Seating(row)
                dishes = seating.dishes
                tables = np.bincount(seating.dish, seating.tables(row), len(dishes)).astype(np.int64)
                cuts = np.concatenate([[0], np.searchsorted(dishes, _edges(buckets) >> DISH), [len(dishes)]])
                some = np.flatnonzero(np.diff(cuts))
                own = [slice(cuts[b], cuts[b + 1]) for b in some]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(some, pa.int32()),
                    "source": pa.array([row["bucket"].as_py()] * len(some), pa.int32()),
                    "dishes": _binary([rising(dishes[x]) for x in own]), "tables": _binary([small(tables[x]) for x in own])})

    def run(key: tuple, table: pa.Table) -> pa.Table:
        asked = [from_rising(x.as_buffer()) for x in table["dishes"]]
        sent = [from_small(x.as_buffer(), len(d)) for x, d in zip(table["tables"], asked)]
        dishes, at = np.unique(np.concatenate(asked), return_inverse=True)
        customers = np.bincount(at, np.concatenate(sent), len(dishes)).astype(np.int64)
        own = key[0].as_py()
        tables = seat(customers, np.full(len(dishes), fresh), DISCOUNTS[0], np.random.default_rng([*seed, own, 0]))
        parts = np.split(at, np.cumsum([len(d) for d in asked])[:-1])
        nothing = [0] * len(parts)
        return pa.table({
            "bucket": pa.array([own, *table["source"].to_pylist()], pa.int32()),
            "part": pa.array([-1] + [own] * len(parts), pa.int32()),
            "dishes": _binary([rising(dishes)] + [b""] * len(parts)),
            "customers": _binary([small(customers)] + [small(customers[p]) for p in parts]),
            "tables": _binary([small(tables)] + [small(tables[p]) for p in parts]),
            "all_customers": pa.array([int(customers.sum()), *nothing], pa.int64()),
            "all_tables": pa.array([int(tables.sum()), *nothing], pa.int64())})

    root = written(state.mapInArrow(ask, _UP).groupBy("bucket").applyInArrow(run, _ROOT), "root")
    customers, tables = root.filter("part = -1").agg(F.sum("all_customers"), F.sum("all_tables")).first()
    return root, Root(customers or 0, tables or 0, vocabulary)


def sweep(state: DataFrame, answers: DataFrame, root: Root, buckets: int, keep: bool, seed: tuple[int, int]) -> DataFrame:
    """The previous words' restaurants seated anew; ``keep`` leaves the seating before beside the new one."""
    def run(key: tuple, held: pa.Table, told: pa.Table) -> pa.Table:
        row = next(_rows(held))
        seating = Seating(row)
        dishes = seating.dishes
        cuts = np.concatenate([[0], np.searchsorted(dishes, _edges(buckets) >> DISH), [len(dishes)]])
        parent = np.zeros(len(dishes))
        for part, c, t in zip(told["part"].to_pylist(), told["customers"], told["tables"]):
            n = cuts[part + 1] - cuts[part]
            parent[cuts[part]:cuts[part + 1]] = root.chance(from_small(c.as_buffer(), n), from_small(t.as_buffer(), n))
        all_tables = seating.in_rooms(seating.tables(row))
        fresh = (STRENGTHS[1] + DISCOUNTS[1] * all_tables)[seating.room] * parent[seating.dish]
        tables = seat(seating.counts, fresh, DISCOUNTS[1], np.random.default_rng([*seed, key[0].as_py(), 1]))
        old = [x.as_py() for x in row["tables"].values] if keep else []
        return held.set_column(held.schema.get_field_index("tables"), "tables",
                               pa.array([[*old, small(tables)]], pa.list_(pa.binary())))

    return written(state.groupBy("bucket").cogroup(answers.filter("part >= 0").groupBy("bucket"))
                   .applyInArrow(run, _STATE), "seating")


def fit(training: DataFrame, buckets: int, burn: int = BURN, samples: int = SAMPLES, seed: int = SEED) -> Model:
    """Count the training texts and sample seatings."""
    state = count(training, buckets)
    train_tokens, vocabulary = _sizes(state)
    answers, root = seat_root(state, None, vocabulary, buckets, (seed, 0))
    kept, roots = None, []
    for number in range(1, burn + samples + 1):
        before, state = state, sweep(state, answers, root, buckets, number > burn + 1, (seed, number))
        discard(before)
        discard(answers)
        answers, root = seat_root(state, root, vocabulary, buckets, (seed, number))
        if number > burn:
            own = written(answers.filter("part = -1").select(
                "bucket", F.lit(len(roots)).alias("sample"), F.lit(None).cast("binary").alias("words"),
                F.lit(None).cast("binary").alias("runs"), F.col("dishes").alias("followers"),
                F.col("customers").alias("counts"), F.array("tables").alias("tables")), "root-kept")
            kept = kept.unionByName(own) if kept is not None else own
            roots.append(root)
    discard(answers)
    return Model(state.unionByName(kept) if kept is not None else state, roots, train_tokens, vocabulary, buckets)


def _found(stored: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of asked numbers among sorted ones, and which of them are there."""
    if not len(stored):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.searchsorted(stored, asked).clip(max=len(stored) - 1)
    return at, stored[at] == asked


def _answer(samples: int):
    """What a bucket tells each block.

    Of each word: customers of its restaurant, then per sample the restaurant's tables, and the word's customers and
    tables in the root. Of each pair: customers, then tables per sample.
    """
    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        room, dishes = None, {}
        for row in _rows(held):
            if row["sample"].as_py() < 0:
                room = Seating(row)
                seated = [room.tables(row, s) for s in range(samples)]
                all_customers, all_tables = room.in_rooms(room.counts), [room.in_rooms(t) for t in seated]
                names, stored = room.dishes, room.room * len(room.dishes) + room.dish
            else:
                own = from_rising(row["followers"].as_buffer())
                dishes[row["sample"].as_py()] = (own, from_small(row["counts"].as_buffer(), len(own)),
                                                 from_small(row["tables"].values[0].as_buffer(), len(own)))
        out = {"totals": [], "pairs": []}
        for i in range(asked.num_rows):
            words = from_rising(asked["words"][i].as_buffer())
            runs = from_small(asked["runs"][i].as_buffer(), len(words))
            wanted, dish = from_listed(asked["followers"][i].as_buffer())
            totals, pairs = np.zeros((1 + 3 * samples, len(words)), np.int64), np.zeros((1 + samples, len(dish)), np.int64)
            if room is not None:
                at, known = _found(room.words, words)
                totals[0, known] = all_customers[at[known]]
                in_names, has_name = _found(names, wanted)
                in_pairs, has = _found(stored, np.repeat(at, runs) * len(names) + in_names[dish])
                has &= has_name[dish] & np.repeat(known, runs)
                pairs[0, has] = room.counts[in_pairs[has]]
                for s in range(samples):
                    totals[1 + s, known] = all_tables[s][at[known]]
                    pairs[1 + s, has] = seated[s][in_pairs[has]]
            for s, (own, customers, tables) in dishes.items():
                at, known = _found(own, words >> DISH)
                totals[1 + samples + s, known] = customers[at[known]]
                totals[1 + 2 * samples + s, known] = tables[at[known]]
            out["totals"].append(small(totals.reshape(-1)))
            out["pairs"].append(small(pairs.reshape(-1)))
        return pa.table({"bucket": asked["bucket"], "block": asked["block"]} | {k: _binary(v) for k, v in out.items()})

    return run


def chances(found: Tokens, told: pa.Table, roots: list[Root], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of a block's words, and the averaged chance of each of its pairs."""
    samples, n = len(roots), len(found.words)
    cuts = np.concatenate([[0], np.searchsorted(found.words, _edges(buckets)), [n]])
    pair_cuts = np.searchsorted(found.before, cuts)
    totals = np.zeros((1 + 3 * samples, n), np.int64)
    pairs = np.zeros((1 + samples, len(found.before)), np.int64)
    for b, t, p in zip(told["bucket"].to_pylist(), told["totals"], told["pairs"]):
        for out, data, low, high in ((totals, t, cuts[b], cuts[b + 1]), (pairs, p, pair_cuts[b], pair_cuts[b + 1])):
            out[:, low:high] = from_small(data.as_buffer(), len(out) * (high - low)).reshape(len(out), -1)
    mean = np.zeros(len(found.before))
    for s, root in enumerate(roots):
        parent = root.chance(totals[1 + samples + s], totals[1 + 2 * samples + s])
        mean += chance(pairs[0], pairs[1 + s], totals[0][found.before], totals[1 + s][found.before], parent[found.word])
    counts = totals[0].copy()
    counts[found.end] = counts[found.start]  # one end for each start
    return counts, mean / samples


def score(docs: DataFrame, model: Model, blocks: int) -> DataFrame:
    """Token counts and log10 probabilities of every text; ``docs`` has doc_id, text and held_out."""
    buckets, n, v, roots = model.buckets, model.train_tokens, model.vocabulary, model.roots
    rows = dealt(docs.select("doc_id", "text", "held_out"), blocks, text="text")

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        found = Tokens(in_order(table)["text"])
        return pa.table(_packed(found.words, found.before, found.words[found.word] >> DISH, None, key[0].as_py(), buckets))

    def finish(key: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        texts = in_order(texts)
        found = Tokens(texts["text"])
        counts, mean = chances(found, told, roots, buckets)
        base, log = np.log10((counts + 0.5) / (n + 0.5 * (v + 1))), np.log10(mean)
        sums = lambda x: np.add.reduceat(x[found.pair], found.first[:-1])  # noqa: E731  every text has a token
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": np.diff(found.first),
            "n_known": sums((counts > 0)[found.word].astype(np.int64)), "train_tokens": np.full(texts.num_rows, n),
            "base_score": sums(base[found.word]), "score": sums(log)})

    asked = rows.groupBy("block").applyInArrow(ask, _ASK)
    told = asked.groupBy("bucket").cogroup(model.state.groupBy("bucket")).applyInArrow(_answer(len(roots)), _TOLD)
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_all(docs: DataFrame, base: int = 5, held: int = 1) -> DataFrame:
    """Learn from the rows whose remainder is not ``held``, score all of them.

    A text's perplexity is 10 ** (-score / n_tokens).
    """
    blocks, _ = sizes(docs, BLOCK_BYTES)
    rows = texts_of(docs).withColumn("held_out", remainder("doc_id", base) == held)
    with brief_shuffles(docs.sparkSession):
        model = fit(rows.filter(~F.col("held_out")), blocks)
    return score(rows, model, blocks)
