"""Token files and packing: exact round trips and brute force."""

from __future__ import annotations

import io
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowtide.llm import packing, token_files
from flowtide.llm.tokens import encoder, vocabulary_path
from flowtide.session import new_folder
from tests.llm.samples import near_copies, table

ODD = ["", "plain words", "It's we'll don't 12 345", "Ünïcode ÇEDILLA — naïve", "<|endoftext|> in a<|startoftext|>b", "  \n",
       "word " * 500, "日本語 text", "á combined é", "\x1c\x85 odd spaces", "🎉🎉 ok"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library():
    plain = Tokenizer.from_file(vocabulary_path())
    own = encoder()
    for texts in (ODD, ODD[::-1] * 3, [None, "new words here"]):
        flat, offsets = own.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert flat[offsets[i]:offsets[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_bits_round_trip(bits, ids):
    ids = np.array([i % (1 << bits) for i in ids], np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert token_files.unpack(data, len(ids), bits).tolist() == ids.tolist()


@pytest.mark.parametrize("bits, block", [(11, 8), (16, 5), (20, 7), (17, 1)])
def test_random_access(bits, block):
    lengths = np.array([3, 1, 0, 17, 8])
    ids = np.arange(29, dtype=np.uint32) * 37 % (1 << bits)
    held = token_files.TokenFile(io.BytesIO(token_files.file_bytes([5, None, -2, 9, 9], lengths, ids, bits, block)))
    assert held.keys == [5, None, -2, 9, 9] and held.bits == bits
    for start, n in itertools.product(range(29), range(12)):
        n = min(n, 29 - start)
        assert held.ids(start, n).tolist() == ids[start:start + n].tolist()
    assert held.document(3).tolist() == ids[4:21].tolist()


@pytest.mark.parametrize("file_ids", [50, 1 << 20])
def test_files_equal_the_library(spark, file_ids):
    rows = [(d * 7 % 97, t) for d, (_, t) in enumerate(near_copies())] + list(enumerate(ODD, 2000)) + [(None, "null key"), (4, None)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").repartition(5)
    folder = new_folder(spark, "test-tokens")
    manifest = token_files.write(docs, folder, 2, file_ids=file_ids, block_ids=16)
    found = token_files.read(manifest, folder).collect()
    plain = Tokenizer.from_file(vocabulary_path())
    start, expected = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in found), key=lambda r: r[1]) == expected
    assert manifest.count() > (5 if file_ids == 50 else 0)


def test_no_documents(spark):
    assert token_files.round_trip(spark, table(spark, [])).count() == 0
    assert packing.pack_documents(table(spark, [])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=7))
def test_fullest_is_the_fullest(counts):
    chosen = dict(packing.fullest(counts, 30))
    assert max(counts) in chosen and all(n <= counts[k] for k, n in chosen.items())
    lists = [[k * n for n in range(c + 1)] if k != max(counts) else [k * n for n in range(1, c + 1)] for k, c in counts.items()]
    assert sum(k * n for k, n in chosen.items()) == max(s for s in map(sum, itertools.product(*lists)) if s <= 30)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), min_size=1, max_size=40))
def test_plan_places_every_piece_once(counts):
    entries = sorted(packing.plan(counts, 64))
    used, filled = {}, {}
    for (length, first, sequence, copies, offset), after in zip(entries, entries[1:] + [None]):
        end = after[1] if after and after[0] == length else counts[length]
        assert used.get(length, 0) == first and (end - first) % copies == 0
        used[length] = end
        times = (end - first) // copies
        filled.setdefault((sequence, times), []).append((offset, length * copies))
    assert used == counts
    for spans in filled.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= 64


def test_packing_equals_the_library(spark):
    rows = near_copies() + list(enumerate(ODD, 5000)) + [(None, "x y z"), (None, "x y z"), (1, "x y z")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, length int, part int")
    found = packing.pack_documents(docs.repartition(6), capacity=64).collect()
    plain = Tokenizer.from_file(vocabulary_path())
    expected = []
    for d, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        expected += [(str(d), i // 64, i, len(ids[i:i + 64]), crc(ids[i:i + 64])) for i in range(0, len(ids), 64)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(expected)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in found)
    bins: dict[int, list] = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in found)
    assert len(bins) <= -(-total // 64) + 1
