from collections import Counter

import numpy as np
from helpers import ODD, PATH, SMALL, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import queries, token_files
from wayfare.llm.bpe import library_ids


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 70).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_segment_tree_finds_what_a_search_of_all_rooms_finds(case):
    capacity, lengths = case
    found = token_files.pack_lengths(lengths, capacity)
    assert sorted(k for s in found for k in s) == list(range(len(lengths)))
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= length
        else:
            rooms.append(capacity - length)
    assert sorted(capacity - sum(lengths[k] for k in s) for s in found) == sorted(rooms)


def restored(packed):
    pieces = {}
    for r in packed.collect():
        ids, places = np.frombuffer(r["input_ids"], "<u4"), np.frombuffer(r["position_ids"], "<u4")
        assert len(ids) == len(places) and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
        for doc_id, start, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert places[a:b].tolist() == list(range(b - a))
            pieces.setdefault((doc_id, start), []).append(ids[a:b].tolist())
        assert not places[r["n_tokens"] :].any()
    return pieces


def test_query_restores_every_document(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    packed = queries.op1_token_matrices(spark, SMALL).cache()
    whole = {}
    for (doc_id, start), (ids,) in sorted(restored(packed).items()):
        assert len(whole.setdefault(doc_id, [])) == start
        whole[doc_id] += ids
    assert whole == {k: [*library_ids(t or "", PATH).tolist(), 50256] for k, t in texts.items()}
    total = packed.selectExpr("sum(n_tokens) t", "count(*) n").first()
    assert total["t"] / (2048 * total["n"]) > 0.9


def test_odd_rows_and_small_windows(spark):
    packed = token_files.packed_matrices(documents(spark, ODD), PATH, capacity=64, window=500).cache()
    tokens = Counter()
    for (doc_id, _), found in restored(packed).items():
        tokens[doc_id] += sum(map(len, found))
    expected = Counter()
    for doc_id, text in ODD:
        expected[doc_id] += len(library_ids(text or "", PATH)) + 1
    assert tokens == expected
    assert token_files.packed_matrices(documents(spark, []), PATH).collect() == []


def test_segments_come_back_without_python(spark, tmp_path):
    packed = token_files.packed_matrices(documents(spark, [(1, "one two"), (2, None), (3, "three")]), PATH, capacity=8)
    token_files.write_matrices(packed, str(tmp_path / "ids"))
    rows = token_files.restored(spark.read.parquet(str(tmp_path / "ids"))).collect()
    assert {(r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4"))) for r in rows} == {
        (1, (*library_ids("one two", PATH), 50256)), (2, (50256,)), (3, (*library_ids("three", PATH), 50256))
    }
