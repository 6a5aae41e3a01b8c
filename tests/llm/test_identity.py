"""Words that a plain polynomial hash takes for one, through the operators that compare words."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from flowtide.llm import ngram_join, packing, substring, token_files
from flowtide.llm.tokens import vocabulary_path
from tests.llm.samples import table
from tests.llm.test_text import thue_morse


@pytest.fixture(scope="module")
def pair():
    return thue_morse(1024)


def test_structured_words_are_not_near_copies(spark, pair):
    rows = [(1, f"one two three {pair[0]}"), (2, f"one two three {pair[1]}"), (3, f"one two three {pair[0]}")]
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.classes_of(table(spark, rows)).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_structured_words_have_their_own_ids(spark, pair):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary_path())
    rows = [(1, pair[0]), (2, pair[1])]
    crc = lambda text, end: zlib.crc32(np.array([*model.encode(text, add_special_tokens=False).ids, end], "<u4").tobytes())
    files = {r["doc_id"]: r["ids_crc32"] for r in token_files.round_trip(spark, table(spark, rows)).collect()}
    assert files == {d: crc(t, 2) for d, t in rows} and files[1] != files[2]
    packed = {r["doc_id"]: r["ids_crc32"] for r in packing.pack_documents(table(spark, rows)).collect()}
    assert packed == {d: crc(t, 0) for d, t in rows}


def test_structured_words_part_passages(spark, pair):
    tail = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{pair[0]} {tail}"), (2, f"{pair[1]} {tail}"), (3, f"{pair[0]} {tail}")]
    found = {r["doc_id"]: r["n_removed"] for r in substring.digest(table(spark, rows)).collect()}
    assert found == {1: 0, 2: 0, 3: 20}
