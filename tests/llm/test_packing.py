import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import ODD, PATH, SMALL, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import packing, queries
from wayfare.llm.bpe import library_ids


def sequences(patterns):
    return sum(times for _, times in patterns)


def check(patterns, counts, capacity):
    used = Counter()
    for pattern, times in patterns:
        assert times > 0 and sum(l * k for l, k in pattern) <= capacity
        for length, k in pattern:
            used[length] += k * times
    assert used == Counter({k: v for k, v in counts.items() if v})


def fewest(lengths, capacity):
    """The least number of sequences, by trying all ways."""
    best = len(lengths)

    def place(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for k, room in enumerate(bins):
            if room >= rest[0] and room not in bins[:k]:
                place(rest[1:], [*bins[:k], room - rest[0], *bins[k + 1 :]])
        place(rest[1:], [*bins, capacity - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_plan_holds_every_piece_once(case):
    capacity, lengths = case
    counts = Counter(lengths)
    check(packing.plan(counts, capacity), counts, capacity)


@settings(max_examples=200, deadline=None)
@given(st.integers(4, 20).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c - 1), max_size=8))))
def test_fixed_sets_never_cost_a_sequence(case):
    capacity, lengths = case
    fixed, left = packing.reduce_instance(Counter(lengths), capacity)
    check([*fixed, *(((((k, 1),), v)) for k, v in left.items())], Counter(lengths), capacity)
    rest = [k for k, v in left.items() for _ in range(v)]
    assert sequences(fixed) + fewest(rest, capacity) == fewest(lengths, capacity)


def test_best_fit_goes_piece_by_piece():
    generator = np.random.default_rng(4)
    for _ in range(30):
        lengths = generator.integers(1, 30, 80).tolist()
        rooms = []
        for length in sorted(lengths, reverse=True):
            fits = [k for k, room in enumerate(rooms) if room >= length]
            if fits:
                rooms[min(fits, key=lambda k: rooms[k])] -= length
            else:
                rooms.append(30 - length)
        assert sequences(packing.best_fit(Counter(lengths), 30)) == len(rooms)


def test_reduction_and_best_fit_are_near_the_bound():
    lengths = np.clip(np.random.default_rng(1).lognormal(6.3, 1, 50_000), 1, 2047).astype(int).tolist()
    assert sequences(packing.plan(Counter(lengths), 2048)) <= math.ceil(sum(lengths) / 2048) * 1.002


@pytest.mark.parametrize("n, expected", [(0, []), (5, [(0, 5)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (24, [(0, 8), (8, 8), (16, 8)])])
def test_only_long_documents_are_cut(n, expected):
    assert packing.cuts(n, 8) == expected


def verify(rows, texts, capacity=2048):
    """Every token is placed once and sequences are filled without gaps."""
    placed, documents_of = defaultdict(list), defaultdict(list)
    for r in rows:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
        documents_of[r["doc_id"]].append(r)
    for spans in placed.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1]
        assert sum(n for _, n in spans) <= capacity
    assert set(documents_of) == set(texts)
    for doc_id, text in texts.items():
        ids = np.append(library_ids(text or "", PATH).astype("<u4"), np.uint32(0))
        spans = sorted(documents_of[doc_id], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in spans] == [(k, *c) for k, c in enumerate(packing.cuts(len(ids), capacity))]
        assert [r["ids_crc32"] for r in spans] == [zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in spans]
    return len(placed)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op5_best_fit_packing(spark, SMALL).collect()
    total = sum(r["length"] for r in rows)
    assert verify(rows, texts) <= math.ceil(total / 2048) + 2


def test_odd_rows_ties_and_null_ids(spark):
    rows = packing.pack_documents(documents(spark, ODD), PATH).collect()
    ids = Counter(r["doc_id"] for r in rows if r["piece"] == 0)
    assert ids == Counter(r[0] for r in ODD)
    places = Counter((r["sequence_id"], r["offset"]) for r in rows)
    assert max(places.values()) == 1
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []


def test_equal_lengths_and_refused_lengths(spark):
    pieces = spark.range(1000).selectExpr("id doc_id", "0 piece", "cast(if(id % 3 = 0, 7, 700) as long) length", "'x' offset_of")
    rows = packing.pack(pieces, 2048).collect()
    assert len(rows) == 1000 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 1000
    with pytest.raises(ValueError):
        packing.pack(pieces.selectExpr("doc_id", "piece", "length * 100 length"), 2048)
