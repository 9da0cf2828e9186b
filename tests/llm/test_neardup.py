import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from helpers import ODD, SMALL, documents, prose
from pyspark.sql import functions as F

from wayfare.llm import neardup, queries
from wayfare.llm.components import _state, components


def sets_of(texts, size=5):
    out = {}
    for doc_id, text in texts:
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        out[doc_id] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    return out


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(texts, percent=85):
    sets = sets_of(texts)
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]]
    top = roots(sets, links)
    return {k: (len(s), top[k], k == top[k]) for k, s in sets.items()}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert found(queries.op3_minhash_near_dedup(spark, SMALL)) == brute(texts)


def changed(text, k, seed):
    words = text.split()
    for i in np.random.default_rng(seed).choice(len(words), k, replace=False):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


def test_large_groups_whose_members_are_not_all_linked(spark):
    base = prose(200, 1)
    rows = [(i, changed(base, i % 9, i)) for i in range(1, 150)]  # near copies at many distances
    chain = prose(120, 2).split()
    rows += [(1000 + i, " ".join(chain[3 * i : 3 * i + 80])) for i in range(14)]  # each like the next only
    rows += [(2000 + i, base.upper() if i % 2 else base + "  \n") for i in range(40)]
    rows += [(3000 + i, prose(60, 100 + i)) for i in range(30)]
    for percent, bands in ((85, 5), (80, 4)):
        assert found(neardup.near_duplicates(documents(spark, rows), percent, rows=bands)) == brute(rows, percent)


def test_cross_pairs_are_all_that_may_be_linked(spark):
    base = prose(80, 5)
    rows = [(i, changed(base, i % 6, i)) for i in range(40)] + [(100 + i, prose(5 + i, 5)) for i in range(30)]
    members = spark.createDataFrame([(r[0], r[0]) for r in rows], "doc_id long, component long")
    pairs = {tuple(r) for r in neardup.across(members, documents(spark, rows).select("doc_id", "text"), 85, 5).collect()}
    sets = sets_of(rows)
    linked = {(a, b) for a, b in combinations(sorted(sets), 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert linked <= pairs and linked


def test_odd_rows(spark):
    rows = neardup.near_duplicates(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[None] == [(1, None, True)] * 2
    assert by_id[1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[6] == [(296, 5, False)] and len(by_id[5]) == 3
    assert neardup.near_duplicates(documents(spark, [])).collect() == []


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    generator = np.random.default_rng(0)
    a = generator.integers(0, 1 << 62, 300).astype(np.uint64)
    b = np.concatenate([a[:240], generator.integers(0, 1 << 62, 60).astype(np.uint64)])
    sketches = neardup.sketch([a, b, a[:1], a[:0], a[:3]], 150)
    assert (sketches[[0, 1, 2, 4]] != neardup.FULL).all() and (sketches[3] == neardup.FULL).all()
    assert abs((sketches[0] == sketches[1]).mean() - 240 / 360) < 0.15


def test_bands_bound_the_chance_of_a_miss():
    for percent, rows in ((85, 5), (80, 4)):
        assert (1 - (percent / 100) ** rows) ** neardup.bands_for(percent, rows) <= 1e-7


def test_components_of_paths_stars_and_pieces(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(5000, 1000 + i) for i in range(300)] + [(1001, 1001)]
    pieces = [(int(a), int(b)) for a, b in np.random.default_rng(3).integers(2000, 2200, (120, 2))]
    links = path + star + pieces
    nodes = {n for link in links for n in link if link[0] != link[1]}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots(nodes, [l for l in links if l[0] != l[1]])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_state_of_many_edges_does_not_overflow(spark):
    edges = spark.range(17_600_000).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    state = _state(edges)
    assert state[0] == 17_600_000 and state == _state(edges.repartition(3))
    assert state != _state(edges.withColumn("v", F.when(F.col("v") == 5, 4).otherwise(F.col("v"))))


def test_a_worker_holds_little_text_and_few_words_at_once():
    texts = [" ".join(f"w{k}x{n}" for n in range(6000)) for k in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(30), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    held, found = [], 0
    for out in neardup._sketch_batches(5, 4, 2)(iter([batch])):
        held.append(sum(len(texts[n]) for n in out.column("doc_id").to_pylist()))
        found += out.num_rows
        assert len(neardup.HASHES) <= 100_000
    assert found == 30 and max(held) < 600_000 and not neardup.HASHES
