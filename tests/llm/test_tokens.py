"""Token counts, ids and packing against the tokenizer library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationloom.llm.packing import pack_documents, plan_packing
from stationloom.llm.tokens import count_tokens, encoder
from stationloom.llm.transducer import CHUNK, Merges, TokenCounter, piece_starts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = [*"abcdersvtlmLE'  \n\t .,!12½é日本語🙂", "'re", "'ll", "'s", "<|endoftext|>", " '", "the", " tion"]


def odd_texts(n: int = 400) -> list:
    rng = random.Random(2)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    return [*out, None, "", " ", "\n\n", "a" * 3000, " " * 700, "'" * 600, "ab " * 4000, "<|endoftext|>" * 3, "x <|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts(spark, library):
    rows = [(i, t, "other") for i, t in enumerate(odd_texts())] + [(None, "some text", "x"), (3, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    found = sorted(map(tuple, count_tokens(docs, PATH).collect()), key=repr)
    sizes = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows]
    assert found == sorted(((d, len((t or "").encode()), n, n > 512) for (d, t, _), n in zip(rows, sizes, strict=True)), key=repr)
    assert count_tokens(docs.limit(0), PATH).count() == 0


def test_transducer_counts_like_the_merges(library):
    counter = TokenCounter(Merges(PATH))
    rng = random.Random(5)
    for _ in range(2000):
        piece = "".join(rng.choice("aabcdehinorstéß") for _ in range(rng.randint(1, 25)))
        assert counter.count(piece.encode()) == len(library.encode(piece, add_special_tokens=False).ids)


def test_chunks_do_not_matter():
    text = "".join(t or "" for t in odd_texts())
    points = np.array([ord(c) for c in text], dtype=np.int32)
    whole = piece_starts(points)
    for shift in (1, 7, CHUNK - 1):
        moved = piece_starts(np.concatenate([np.full(shift, 0x110000, dtype=np.int32), points]))
        assert (moved[shift:] - shift == whole).all()


def test_ids(library):
    texts = [t or "" for t in odd_texts()]
    ids, sizes = encoder(PATH).encode(texts)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for own in expected for i in own] and sizes.tolist() == list(map(len, expected))


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing(spark, library, capacity):
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(None, "no id"), (7, "twice"), (7, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("clash")).repartition(3)
    got = pack_documents(docs, PATH, capacity).collect()
    expected = []
    for d, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        expected += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(expected, key=repr)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(e[3] for e in expected)
    assert len(places) <= 1.05 * total / capacity + 1
    assert pack_documents(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 10, 64, 1024])
    counts = {}
    for _ in range(rng.choice([0, 1, 60, 3000])):
        size = rng.randint(1, capacity)
        counts[size] = counts.get(size, 0) + 1
    used, filled, large = {}, {}, {}
    for r in plan_packing(counts, capacity):
        assert r.first == used.get(r.length, 0)
        used[r.length] = r.first + r.bins * r.each
        for b in range(r.sequence, r.sequence + r.bins):
            assert filled.get(b, 0) == r.offset
            filled[b] = r.offset + r.each * r.length
            large[b] = large.get(b, 0) + r.each * (3 * r.length > capacity)
    assert used == counts and all(x <= capacity for x in filled.values()) and all(x <= 2 for x in large.values())
    with pytest.raises(ValueError):
        plan_packing({capacity + 1: 1}, capacity)


def test_a_worker_keeps_one_kind_of_work():
    from stationloom.llm import words
    text = ["some words " * 50]
    path = public_tokenizers.path("byte_bpe_50k.json")
    first = encoder(path).encode(text)[0].tolist()
    hashes = words.Words(text).hashes().tolist()
    assert list(words._KEPT) == ["powers"]
    assert encoder(path).encode(text)[0].tolist() == first and encoder(path) is encoder(path)
    assert list(words._KEPT) == ["encoders"]
    assert words.Words(text).hashes().tolist() == hashes
