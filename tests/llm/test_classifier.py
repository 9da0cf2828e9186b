import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import ODD, documents, prose

from wayfare.llm import classifier, queries

HELD = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    """Fitted on labels of even ids only; judged on those of odd ids."""
    docs = spark.read.parquet(f"{HELD}/documents.parquet")
    labels = spark.read.parquet(f"{HELD}/labels.parquet")
    out = classifier.with_scores(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = out.select("quality", "score").collect()
    assert len(rows) > 100
    right = [(r["score"] >= classifier.KEEP_FROM) == (r["quality"] == 1) for r in rows]
    clean = [r["score"] >= classifier.KEEP_FROM for r in rows if r["quality"] == 1]
    assert np.mean(right) >= 0.95 and np.mean(clean) >= 0.97


def test_query_scores_every_document(spark):
    rows = queries.op6_co_trained_quality(spark, HELD).collect()
    assert len(rows) == pq.read_metadata(f"{HELD}/documents.parquet").num_rows
    assert all(0 <= r[c] <= 1 for r in rows for c in classifier.SCORES)


def two_views(n, generator):
    """Labels that either view alone can tell."""
    y = generator.integers(0, 2, n)
    return [y[:, None] * 2 - 1 + generator.normal(0, 0.7, (n, 6)) for _ in range(2)], y.astype(float)


def test_pseudo_labels_help_a_small_training_set():
    generator = np.random.default_rng(2)
    (a, b), y = two_views(8, generator)
    pool, _ = two_views(500, generator)
    held, held_y = two_views(200, generator)
    test, test_y = two_views(2000, generator)
    y[:2] = 0, 1
    accuracy = {}
    for rounds in (0, 3):
        model = classifier.co_train((a, b), y, tuple(pool), tuple(held), held_y, rounds, (3.0, 3.0))
        accuracy[rounds] = ((model.scores(tuple(test))[2] >= 0.5) == test_y).mean()
    assert accuracy[3] >= accuracy[0] - 0.005 and accuracy[3] > 0.97


def test_calibrated_scores_are_chances():
    generator = np.random.default_rng(5)
    views, y = two_views(30_000, generator)
    views = [v + generator.normal(0, 2, v.shape) for v in views]
    cut = [(v[:10_000], v[10_000:20_000], v[20_000:]) for v in views]
    model = classifier.co_train((cut[0][0], cut[1][0]), y[:10_000], (cut[0][1][:0], cut[1][1][:0]), (cut[0][1], cut[1][1]), y[10_000:20_000], penalties=(3.0, 3.0))
    for p in model.scores((cut[0][2], cut[1][2])):
        for low in (0.0, 0.25, 0.5, 0.75):
            inside = (p >= low) & (p < low + 0.25)
            assert abs(p[inside].mean() - y[20_000:][inside].mean()) < 0.1


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(i, 1) for i in range(100)], [(None, 0), (1, None)]])
def test_nothing_to_learn_keeps_all(spark, labels):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    out = classifier.with_scores(docs, labels)
    rows = out.collect()
    assert out.columns == [*docs.columns, *classifier.SCORES] and len(rows) == len(ODD) and all(r["score"] == 1.0 for r in rows)
    assert classifier.kept_documents(docs, labels).columns == docs.columns
    assert classifier.with_scores(documents(spark, []), labels).collect() == []


def test_odd_rows_with_a_model(spark):
    rows = [(1000 + i, prose(40, i) if i % 2 else "## " * 30) for i in range(80)]
    labels = spark.createDataFrame([(1000 + i, i % 2) for i in range(80)] + [(1001, 1)], "doc_id long, quality int")
    got = classifier.with_scores(documents(spark, [*rows, *ODD]), labels).collect()
    assert len(got) == len(rows) + len(ODD) and all(np.isfinite(r["score"]) for r in got)
    assert [r["score"] for r in got if r["doc_id"] is None][0] == [r["score"] for r in got if r["doc_id"] is None][1]


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{HELD}/documents.parquet").select("doc_id", "text", "source", "lang")
    return docs, spark.read.parquet(f"{HELD}/labels.parquet")


def test_every_unlabelled_document_is_in_the_pool(spark, given):
    """The table gives the same rows as plain sorting of all features in one place; copies count once."""
    docs, labels = given
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))
    model = classifier.fit(docs, labels, rounds=0)
    features = classifier.feature_table(docs)
    says = classifier.labels_of(labels)
    known = {r["doc_id"] for r in says.collect()}
    free = list({r["key"]: r for r in features.collect() if r["doc_id"] not in known}.values())
    free.sort(key=lambda r: r["key"])
    arrays = tuple(classifier._matrix([r[c] for r in free], k) for k, c in enumerate(("x", "m")))
    taken = [set(), set()]
    for _ in range(2):
        places = tuple({i for i, r in enumerate(free) if r["key"] in keys} for keys in taken)
        plain = classifier.ArrayPool(arrays).surest(model, (40, 200), places)
        table = classifier.TablePool(features, says.select("doc_id")).surest(model, (40, 200), tuple(taken))
        assert [[(r[0], free[r[1]]["key"]) for r in view] for view in plain] == [[r[:2] for r in view] for view in table]
        assert all(table)
        taken = [{r[1] for r in view[::2]} for view in table]


def test_both_views_tell_both_classes_and_the_exchange_does_no_harm(spark, given):
    docs, labels = given
    model = classifier.fit(docs, labels, rounds=0)
    pool = classifier.TablePool(classifier.feature_table(docs), classifier.labels_of(labels).select("doc_id"))
    for view in pool.surest(model, (50, 50), (set(), set())):
        assert {r[0] for r in view} == {0, 1}
    odd, even = labels.where("doc_id % 2 = 1"), labels.where("doc_id % 2 = 0")
    losses = []
    for rounds in (0, classifier.ROUNDS):
        model = classifier.fit(docs, even, rounds=rounds)
        rows = docs.join(odd, "doc_id").select("text", "source", "lang", "quality").collect()
        p, y = np.clip(model.scores(classifier._features(rows))[2], 1e-6, 1 - 1e-6), np.array([r["quality"] for r in rows])
        losses.append(float(-np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))))
    assert losses[1] <= losses[0] + 0.02


def test_scores_are_those_of_each_document_by_itself(spark, given):
    docs, labels = given
    model = classifier.fit(docs, labels)
    got = {r["doc_id"]: (r["content_score"], r["metadata_score"], r["score"]) for r in classifier.with_scores(docs, labels).collect()}
    for r in docs.collect():
        assert np.allclose(got[r["doc_id"]], [s[0] for s in model.scores(classifier._features([r]))], atol=1e-6)


def test_labels_of_one_class_are_not_given():
    assert classifier.shares((0, 500), (40, 260)) == (0, 0)
    assert classifier.shares((20, 500), (40, 260)) == (20, 130)
    assert classifier.shares((90, 900), (40, 260)) == (40, 260)
