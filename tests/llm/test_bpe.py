import hashlib
from functools import lru_cache

import numpy as np
from helpers import ODD, PATH, SMALL, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wayfare.llm import bpe, queries


@lru_cache
def library():
    return Tokenizer.from_file(PATH)


def expected(text):
    return library().encode(text or "", add_special_tokens=False).ids


def own(texts):
    encoder = bpe.encoder(PATH)
    encoder.learn(texts)
    return [np.frombuffer(encoder.ids(t), "<u4").tolist() for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'strevmld1a.é<|>😀\x1c\x85"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_ids_equal_the_library(texts):
    assert own(texts) == [expected(t) for t in texts]


def test_runs_of_equal_symbols_and_special_tokens():
    texts = ["a" * n for n in range(1, 40)] + ["<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "<|endoftext", " <|endoftext|> "]
    assert own(texts) == [expected(t) for t in texts]
    assert [bpe.library_ids(t, PATH).tolist() for t in texts] == [expected(t) for t in texts]


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 2)
    encoder = bpe.Encoder(PATH)
    for text in ("one two three four", "four five one two", "", "one"):
        encoder.learn([text])
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == expected(text)


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    rows = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(rows) == len(ODD) and rows[0].asDict().keys() >= set(docs.columns)
    for r in rows:
        assert r["ids"] == expected(r["text"]) and r["decoded"] == (r["text"] or "")


def test_lists_that_are_null_or_cut_amid_a_character(spark):
    ids = expected("😀")[:-1]
    frame = spark.createDataFrame([(1, None), (2, ids), (3, [])], "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(frame, PATH).collect()}
    assert found == {1: None, 2: library().decode(ids, skip_special_tokens=False), 3: ""}


def test_query_equals_the_library(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op2_bpe_round_trip(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = expected(texts[r["doc_id"]])
        decoded = library().decode(ids, skip_special_tokens=False)
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_empty_table(spark):
    assert bpe.digests(documents(spark, []), PATH).collect() == []
