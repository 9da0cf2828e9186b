import math
import re
from collections import Counter

import duckdb
import pytest
from helpers import ODD, SMALL, documents, prose
from pyspark.sql import functions as F

from wayfare.llm import queries, search

TERM = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    """Every document's score for every item."""
    counts = [(i, Counter(terms_of(t))) for i, t, *_ in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(t for t in terms_of(text) if t in df)
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc_id, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms)
            scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scores)[:top]) if r[0] < 0]
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, term string, item long")


def found(spark, docs, items, **options):
    got = search.search(search.build_index(documents(spark, docs)), items_of(spark, items), **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_query_equals_its_statement(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    df = queries.op12_ranked_search(spark, SMALL)
    listed = ", ".join(df.columns)
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(duck.execute(f"SELECT {listed} FROM ({search.SQL})").fetchall())
    assert [r[1] for r in got if r[0] == 0] == list(range(1, 11))


ITEMS = [
    (1, prose(12, 3)), (2, "ONE one"), (3, None), (4, ""), (5, "nowhere_to-be 0found"), (6, "été 日本語 x"), (7, prose(60, 9)), (7, "more terms of item seven: negative id"),
    (None, "text without an id"), (8, "a"),
]


@pytest.mark.parametrize("limits", [{}, {"PART_DOCS": 3, "BROADCAST_STRATA": 0, "BLOCK_TERMS": 20, "HELD_BYTES": 100}])
def test_brute_force_with_ties_and_odd_rows(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(search, name, value)
    docs = [*ODD, *((100 + i, prose(20 + i % 3, i % 7, 60)) for i in range(60)), *((200 + i, "a b c Ünï " * (1 + i % 4)) for i in range(40))]
    items = [*ITEMS, *((20 + i, prose(5, i, 60)) for i in range(10))]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, top=3) == brute(docs, items, 3)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == [] and found(spark, ODD, []) == [] and found(spark, [(1, ""), (2, None)], ITEMS) == []


def test_bounds_hold_and_spare_visits(spark, monkeypatch):
    docs = [(i, prose(30 + 40 * (i % 9), i, 300)) for i in range(200)] + [(900, prose(25, 77, 300))]
    rows = search.build_index(documents(spark, docs)).collect()
    wanted = sorted({search.HASHES[t] - (1 << 64) * (search.HASHES[t] >> 63) for t in search.terms_in(prose(25, 77, 300))})
    block = search.Block(search.np.array(wanted), search.np.array([0, len(wanted)]), search.np.arange(len(wanted)), search.np.full(len(wanted), 1000))
    kinds = ("doc_ids", "terms", "tfs", "counts", "members")
    parts = [search.Part({c: search.np.array(r[c]) for c in kinds} | {"m": r["m"]}, block) for r in rows]
    assert all(p.scores(block, 0).max() <= p.bounds[0] for p in parts)
    best = search.Best(1)
    order = sorted(parts, key=lambda p: -p.bounds[0])
    visited = 0
    for p in order:
        if p.bounds[0] < best.least:
            break
        best.offer(p.scores(block, 0), p.doc_ids)
        visited += 1
    assert best.ids[0] == 900 and visited < len(parts) / 2


def test_index_holds_every_posting(spark):
    index = search.build_index(documents(spark, ODD)).select("m", F.size("doc_ids").alias("docs"), F.size("members").alias("postings"), "n_terms").collect()
    counts = [Counter(terms_of(t)) for _, t in ODD]
    assert sum(r["docs"] for r in index) == sum(1 for c in counts if c)
    assert sum(r["postings"] for r in index) == sum(map(len, counts)) and sum(r["n_terms"] for r in index) == sum(c.total() for c in counts)
