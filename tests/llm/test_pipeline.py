"""The pipeline against its brute-force version, stage by stage."""

from __future__ import annotations

import random

from tokenizers import Tokenizer

import corpus_pipeline
from flowtide.llm import decontaminate
from flowtide.llm.tokens import vocabulary_path
from flowtide.session import new_folder
from tests.llm.samples import SCHEMA, words
from tests.llm.test_copies import WORD, brute_classes
from tests.llm.test_decontaminate import local_score, plain
from tests.llm.test_text import brute_quality
from tests.llm.test_tokens import crc


def sentences(n, seed):
    return " ".join(words(n, seed, 5000)) + "."


def corpus(seed=2):
    rng = random.Random(seed)
    items = [(i, sentences(rng.randrange(15, 40), 900 + i)) for i in range(6)]
    passage = sentences(70, 77)
    rows = []
    for d in range(90):
        text = "\n".join(sentences(rng.randrange(4, 60), seed * 1000 + d * 10 + k) for k in range(rng.randrange(1, 5)))
        kind = d % 9
        if kind == 1:
            text = rows[rng.randrange(len(rows))][1]
        elif kind == 2 and rows:
            own = (rows[rng.randrange(len(rows))][1] or "none at all.").split(" ")
            own[rng.randrange(len(own))] = "edit"
            text = " ".join(own)
        elif kind == 3:
            text += "\n" + passage
        elif kind == 4:
            text += "\n" + items[rng.randrange(6)][1]
        elif kind == 5:
            text = "Menu | Home | About |\n" * 3 + text
        elif kind == 6:
            text = (sentences(8, d) + "\n") * 8
        rows.append((d * 37 % 1000, text))
    return rows + [(2001, None), (2002, ""), (2003, "Too few words.")], items


def cut_lines(text):
    bad = []
    for line in text.split("\n"):
        if not WORD.findall(line) or brute_quality(line)[5] == 0:
            bad.append(line)
    return "\n".join(bad)


def brute(rows, items):
    kept = [(d, cut_lines(t)) for d, t in rows if brute_quality(t)[-1]]
    yield kept
    first = {d for d, _, c in brute_classes(kept) if d == c}
    kept = [(d, t) for d, t in kept if d in first]
    yield kept
    seen, left = set(), []
    for d, t in sorted(kept):
        w, gone = WORD.findall(t), set()
        for k in range(len(w) - 19):
            if tuple(w[k:k + 20]) in seen:
                gone.update(range(k, k + 20))
            seen.add(tuple(w[k:k + 20]))
        if len(gone) < len(w):
            left.append((d, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    yield left
    yield [(d, t) for d, t in left if all(
        local_score(plain(i), plain(t)) < decontaminate.THRESHOLD * 2 * len(plain(i)) for _, i in items)]


def test_stages_equal_brute_force(spark):
    rows, items = corpus()
    folder = new_folder(spark, "test-tables")
    docs = [(d, t, "en", f"s{d % 3}", None if t is None else len(t)) for d, t in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    source = {d: s for d, _, _, s, _ in docs}
    now, sizes = spark.read.parquet(f"{folder}/documents.parquet"), []
    for (name, stage), expected in zip(corpus_pipeline.STAGES, brute(rows, items)):
        out = stage(spark, now, folder)
        assert out.columns == now.columns, name
        path = new_folder(spark, "test-stage")
        out.write.parquet(path)
        now = spark.read.parquet(path)
        found = sorted(tuple(r) for r in now.collect())
        assert [(r[0], r[1]) for r in found] == sorted(expected), name
        assert all(r[3] == source[r[0]] and r[4] == len(r[1]) for r in found)
        sizes.append(len(found))
    assert len(rows) > sizes[0] > sizes[1] >= sizes[2] > sizes[3] > 20
    last = [(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()]
    model = Tokenizer.from_file(vocabulary_path())
    ids = {d: model.encode(t, add_special_tokens=False).ids + [0] for d, t in expected}
    assert sorted(last) == sorted((d, i // 2048, len(x[i:i + 2048]), crc(x[i:i + 2048])) for d, x in ids.items()
                                  for i in range(0, len(x), 2048))


def test_columns_with_names_of_our_own(spark):
    names = ["block", "n_words", "kept_text", "tile", "kept_doc_id", "row_of_document", "number", "component"]
    docs = spark.createDataFrame([(d, t, *range(8)) for d, t in corpus()[0]], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    folder = new_folder(spark, "test-tables")
    spark.createDataFrame(corpus()[1], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", *names]
    assert all(tuple(r)[2:] == tuple(range(8)) for r in docs.collect())


def test_pipeline_of_nothing(spark):
    folder = new_folder(spark, "test-tables")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
