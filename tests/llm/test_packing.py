"""Packing: ids against the tokenizer library, the plan against a packing one sequence at a time."""

import os
import random
import zlib

import numpy as np
import pytest
from docgraph.llm import packing

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SCHEMA = "doc_id long, text string, lang string, offset string, length int"


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_file())


def one_at_a_time(lengths, size):
    """Best-two-fit on a list of documents."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        own, gap = [], size
        for x in left:
            if x <= gap:
                own.append(x)
                gap -= x
        for x in own:
            left.remove(x)
        if gap and len(own) > 1:
            room, least = gap + own[-1], own[-1]
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1:] if least < a + b <= room]
            if pairs:
                _, a, b = max(pairs)
                left.remove(a)
                left.remove(b)
                own[-1:] = [a, b]
                left = sorted(left + [least], reverse=True)
        bins.append(sorted(own, reverse=True))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_patterns_are_those_of_single_steps(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 31, 100])
    lengths = [rng.randint(1, rng.choice([4, size // 2, size])) for _ in range(rng.randint(1, 120))]
    counts = np.bincount(lengths, minlength=size + 1)
    got = [[x for x, n in pattern for _ in range(n)] for pattern, times in packing.patterns(counts, size)
           for _ in range(times)]
    assert sorted(got) == sorted(one_at_a_time(lengths, size))
    assert sorted(x for b in got for x in b) == sorted(lengths)


def test_a_swap_fills_the_gap():
    counts = np.bincount([6, 3, 2, 2], minlength=11)  # 6 and 3 leave a gap of one; 2 and 2 fill it
    assert packing.patterns(counts, 10)[0] == ([(6, 1), (2, 2)], 1)


def test_fewest_is_never_worse_than_greedy():
    for seed in range(30):
        rng = random.Random(seed)
        counts = np.bincount([rng.randint(1, 40) for _ in range(rng.randint(1, 80))], minlength=65)
        n = [sum(t for _, t in p) for p in (packing.fewest(counts, 64), packing.patterns(counts, 64, False))]
        assert n[0] <= n[1]


def test_places_number_every_document_once():
    rng = random.Random(3)
    counts = np.bincount([rng.randint(1, 64) for _ in range(5000)], minlength=65)
    where = packing.places(packing.fewest(counts, 64))
    length = np.repeat(np.arange(65), counts)
    number = np.concatenate([np.arange(n) for n in counts])
    sequence, offset = where.of(length, number)
    for s in np.unique(sequence):
        own = sorted(zip(offset[sequence == s], length[sequence == s]))
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 64


TEXTS = ["Hello world", None, "", " ", "Straße 東京 😀 naïve\tx\r\n\n  y", "word " * 9000,
         "end <|endoftext|> of text", "don't we'll I'm 12345 $$$"] + ["same text"] * 40


@pytest.mark.parametrize("length", [64, 2048])
def test_packed(spark, length):
    rows = list(enumerate(TEXTS)) + [(None, "null id"), (0, TEXTS[0])]
    docs = spark.createDataFrame([(i, t, "en", "o", 1) for i, t in rows], SCHEMA).repartition(4)
    out = packing.packed(docs, length)
    got = out.collect()
    encode = library()
    want = {}
    for i, t in rows:
        ids = np.array(encode.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        cut = [0, *range(len(ids) % length or length, len(ids) + 1, length)] if len(ids) > length \
            else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            want.setdefault((i, k, a, b - a, ids[a:b].tobytes()), []).append(1)
    assert sorted((str(k), len(v)) for k, v in want.items() for _ in v) == sorted(
        (str((r.doc_id, r.piece, r.start, r.length, bytes(r.ids))),
         len(want[r.doc_id, r.piece, r.start, r.length, bytes(r.ids)])) for r in got)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    total = sum(r.length for r in got)
    whole = packing.sequences(out).collect()
    assert len(whole) == -(-total // length) and sum(r.length for r in whole) == total
    for r in whole:
        own = sorted((x.offset, x.ids) for x in got if x.sequence_id == r.sequence_id)
        assert bytes(r.ids) == b"".join(bytes(x) for _, x in own)
        assert [o for o, _ in own] == [0, *np.cumsum([len(x) // 4 for _, x in own])[:-1]]
        assert r.length <= length


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert packing.packed(docs).collect() == []


def test_both_libraries_give_the_same_ids():
    """Every 37th code point, next to letters, digits, blanks, itself and an apostrophe."""
    encode, own = library(), packing.encoding(packing.tokenizer_file())
    points = [c for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 500):
        text = "".join(f"a{chr(c)}b {chr(c)} 1{chr(c)}.{chr(c)}{chr(c)}'s\n" for c in points[at:at + 500])
        assert encode.encode(text, add_special_tokens=False).ids == own.encode(text, allowed_special="all")
