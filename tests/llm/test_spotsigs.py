import hashlib
from itertools import combinations

from helpers import ODD, SMALL, documents, prose

from wayfare.llm import queries, spotsigs


def signs(print_):
    return {print_[i : i + 8] for i in range(0, len(print_), 8)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_query_edits_and_next_documents(spark):
    texts = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    rows = {r["doc_id"]: r for r in queries.op9_spot_signatures(spark, SMALL).collect()}
    assert len(rows) == len(texts)
    prints = {}
    for k, (doc_id, text) in enumerate(texts):
        r, (next_id, other) = rows[doc_id], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert abs(r["near_edited"] - jaccard(signs(r["fingerprint"]), signs(r["edited_fingerprint"]))) < 1e-12
        assert abs(r["near_next"] - jaccard(signs(r["fingerprint"]), signs(rows[next_id]["fingerprint"]))) < 1e-12
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    halves = [r["near_edited"] for r in rows.values() if r["n_chars"] > 500]
    assert sum(halves) / len(halves) > 0.25 > 5 * sum(r["near_next"] for r in rows.values()) / len(rows)


def test_ranges_follow_each_other_and_wrap(spark):
    for ids in (list(range(0, 3000, 7)), [0, 1, 2, 1 << 40, (1 << 60) + 1, -5], [9], [3, 3, 3]):
        docs = documents(spark, [(i, f"text {i}") for i in ids], 5).select("doc_id", "text")
        by_bucket = {}
        for r in spotsigs.in_order(docs, per_bucket=4).collect():
            by_bucket.setdefault(r["bucket"], []).append((r["copy"], r["doc_id"]))
        pairs = []
        for rows in by_bucket.values():
            rows.sort()
            assert [c for c, _ in rows][-1] and sum(not c for c, _ in rows) >= 1
            in_range = [i for c, i in rows if not c]
            pairs += list(zip(in_range, [*in_range[1:], rows[len(in_range)][1]]))
        ordered = sorted(ids)
        assert sorted(pairs) == sorted(zip(ordered, [*ordered[1:], ordered[0]]))


def test_anchors_are_the_commonest_short_words(spark):
    docs = documents(spark, [(1, "The the, THE of of longword longword"), (2, None), (3, "of a")])
    assert spotsigs.anchors_of(docs.select("doc_id", "text"), number=2) == ["of", "the"]


def test_signatures_follow_anchors():
    anchors = ("the", "of")
    one = set(spotsigs.signatures("the red fox of old hill runs far and wide over green land", anchors))
    again = set(spotsigs.signatures("some words, then THE, red! fox of: old hill runs on", anchors))
    assert len(one) == 2 and one == again
    assert len(spotsigs.signatures(None, anchors)) == len(spotsigs.signatures(" \n", anchors)) == 0
    assert len(spotsigs.signatures("lonely", anchors)) == 1 and len(spotsigs.signatures("the", anchors)) == 1


def test_odd_rows(spark):
    rows = spotsigs.fingerprints(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    by_text = {}
    for r in rows:
        assert by_text.setdefault((r["doc_id"], r["n_chars"]), r["fingerprint"]) == r["fingerprint"] and 0 <= r["near_next"] <= 1
    assert spotsigs.fingerprints(documents(spark, [])).collect() == []
    alone = spotsigs.fingerprints(documents(spark, [(1, "the only text of all")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_similar_pairs_equal_brute_force(spark):
    generator = [prose(n, 3, 400) for n in range(20, 60)] + [prose(30, k, 60) for k in range(30)]
    prints = [(k, spotsigs.spelled(spotsigs.signatures(t, ("w1", "w2", "w3", "w4", "w5")))) for k, t in enumerate(generator)] + [(500, ""), (501, "")]
    for threshold in (0.5, 0.8, 1.0):
        firsts = {}
        for k, p in sorted(prints):
            firsts.setdefault(p, k)
        expected = {(a, b) for (p, a), (q, b) in combinations(sorted(firsts.items(), key=lambda x: x[1]), 2) if p and q and jaccard(signs(p), signs(q)) >= threshold}
        got = spotsigs.similar(spark.createDataFrame(prints, "doc_id long, fingerprint string"), threshold).collect()
        assert {(r["a"], r["b"]) for r in got} == expected and len(got) == len(expected)


def test_half_copies_are_alike_on_both_sides_of_any_share_of_common_words():
    anchors = ("the", "of")
    for seed in range(5):
        table = prose(400, seed)  # no common word at all
        text = " ".join(f"{w} the" if i % 5 == 0 else w for i, w in enumerate(prose(400, 100 + seed).split()))
        own, changed = (spotsigs.signatures(t, anchors) for t in (table, spotsigs.edited(table, text)))
        assert len(own) > 40 and spotsigs.likeness(own, changed) > 0.25
        own, changed = (spotsigs.signatures(t, anchors) for t in (text, spotsigs.edited(text, table)))
        assert spotsigs.likeness(own, changed) > 0.25
