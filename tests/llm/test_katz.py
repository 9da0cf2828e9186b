import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import ODD, SMALL, documents, prose
from pyspark.sql import functions as F

from wayfare.llm import katz, queries
from wayfare.llm.common import table

END = "</s>"


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Brute:
    """Katz's model by dictionaries, straight from its definition."""

    def __init__(self, texts, order):
        self.order, self.counts, self.after = order, defaultdict(Counter), defaultdict(dict)
        for text in texts:
            tokens = ["<s>"] * order + [*words(text), END]
            for i in range(order, len(tokens)):
                for k in range(1, order + 1):
                    self.counts[k][tuple(tokens[i - k + 1 : i + 1])] += 1
        for k in range(1, order + 1):
            for gram, c in self.counts[k].items():
                self.after[gram[:-1]][gram[-1]] = c
        self.discount = {k: self.discounts(Counter(self.counts[k].values())) for k in range(1, order + 1)}
        self.memory = {}

    @staticmethod
    def discounts(n):
        for most in (5, 4, 3, 2, 1):
            if any(not n[r] for r in range(1, most + 2)):
                continue
            a = (most + 1) * n[most + 1] / n[1]
            if a >= 1:
                continue
            d = {r: ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) for r in range(1, most + 1)}
            if all(0 < x < 1 for x in d.values()):
                return d
        return {r: (r - 0.5) / r for r in range(1, 6)}

    def history(self, h):
        """(divisor, what is left for unseen tokens, shared among the lower-order probability of these)"""
        if h not in self.memory:
            seen, d = self.after[h], self.discount[len(h) + 1]
            total = sum(seen.values())
            left = math.fsum((1 - d.get(c, 1)) * c for c in seen.values())
            divisor = total if left > 0 else total + 1
            rest = 1 - (math.fsum(self.p(w, h[1:]) for w in seen) if h else 0)
            self.memory[h] = divisor, (left or 1) / divisor / rest
        return self.memory[h]

    def p(self, w, h):
        below = lambda: self.p(w, h[1:]) if h else 1.0  # noqa: E731  the class of all unknown tokens
        if h not in self.after:
            return below()
        divisor, weight = self.history(h)
        c = self.after[h].get(w, 0)
        return self.discount[len(h) + 1].get(c, 1) * c / divisor if c else weight * below()

    def score(self, text):
        tokens = ["<s>"] * self.order + [*words(text), END]
        return math.fsum(math.log10(self.p(tokens[i], tuple(tokens[i - self.order + 1 : i]))) for i in range(self.order, len(tokens)))


def expected(rows, order):
    train = [t for i, t in rows if not held_out(i)]
    model = Brute(train, order)
    c, n = Counter(w for t in train for w in [*words(t), END]), sum(len(words(t)) + 1 for t in train)
    out = []
    for i, t in rows:
        tokens = [*words(t), END]
        base = math.fsum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in tokens)
        out.append((i, held_out(i), len(tokens), sum(c[w] > 0 for w in tokens), n, base, model.score(t) if train else 0.0))
    return model, out


def close(got, wanted):
    key = lambda r: (repr(r[0]), *r[1:5], round(r[5], 4))
    got, wanted = sorted(map(tuple, got), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    for g, w in zip(got, wanted):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


MIXED = [*ODD, *((100 + i, prose(30 + i, i, 40)) for i in range(80)), *((300 + i, "the same short text") for i in range(30)), *((400 + i, "x y z") for i in range(9))]


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("limits", [{}, {"BLOCK_TOKENS": 700, "BUCKETS": (5, 9), "BUCKET_TOKENS": 900}])
def test_brute_force(spark, monkeypatch, order, limits):
    for name, value in limits.items():
        monkeypatch.setattr(katz, name, value)
    got = katz.scored(documents(spark, MIXED), order=order)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    close(got.collect(), expected(MIXED, order)[1])


def test_query_equals_brute_force_and_beats_single_tokens(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    got = queries.op11_katz_scores(spark, SMALL).collect()
    close(got, expected(rows, katz.ORDER)[1])
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_after_every_history_add_up_to_one(spark):
    model, _ = expected(MIXED, 3)
    vocabulary = [g[0] for g in model.counts[1]]
    for h in [*list(model.after)[:: max(1, len(model.after) // 60)], ("<s>", "<s>"), ("nowhere", "the"), ("w1", "nowhere")]:
        assert math.fsum(model.p(w, h) for w in [*vocabulary, "unknown token"]) == pytest.approx(1, abs=1e-12)


def test_tables_hold_every_ngram_with_its_counts(spark, monkeypatch):
    monkeypatch.setattr(katz, "BUCKETS", (5, 9))
    model = katz.model_of(documents(spark, MIXED), katz.folds(F.col("doc_id")), 2)
    counts = Brute([t for i, t in MIXED if not held_out(i)], 2).counts
    for k, df in enumerate(model.tables, 1):
        rows = df.collect()
        stored = np.concatenate([katz.unpacked(bytes(r["counts"]), np.uint64) for r in rows])
        grams = np.concatenate([katz.unpacked(bytes(r["grams"]), np.uint64, model._gram_bytes(k)) for r in rows])
        assert len(np.unique(grams)) == len(grams) and Counter(stored.tolist()) == Counter(counts[k].values())
        assert all(katz.unpacked(bytes(r["sizes"]), np.uint32).sum() == len(katz.unpacked(bytes(r["counts"]), np.uint64)) for r in rows)


def test_frequent_histories_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(katz, "BUCKETS", (5, 9))
    docs = [(i, " ".join(f"the n{(i * 37 + k) % 900}" for k in range(60))) for i in range(60)]
    model = katz.model_of(documents(spark, docs), katz.folds(F.col("doc_id")), 2)
    assert model.levels[1].frequent.shares.max() > 1
    sizes = [len(katz.unpacked(bytes(r["counts"]), np.uint64)) for r in model.tables[1].collect()]
    assert max(sizes) < 0.6 * sum(sizes)
    close(model.scores().collect(), expected(docs, 2)[1])


def test_nothing_to_learn_from_and_empty_tables(spark):
    rows = [(1, "some words"), (2, None)]
    got = katz.scored(documents(spark, rows), F.lit(True)).collect()
    assert sorted(map(tuple, got)) == [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)]
    assert katz.scored(documents(spark, [])).collect() == []


def test_discounts():
    d = katz.Discounts.estimate([100, 40, 22, 14, 10, 7])
    assert len(d.factors) == katz.DISCOUNTED + 2 and all(0 < f < 1 for f in d.factors[1:6]) and d.of(np.array([9])) == 1
    assert katz.Discounts.estimate([0, 0, 0, 0, 0, 0]).factors[1] == 0.5
    few = katz.Discounts.estimate([100, 20, 10, 0, 0, 0]).factors  # nothing was seen four times: counts up to two are discounted
    assert few[1:4].tolist() == pytest.approx([(0.4 - 0.3) / 0.7, (0.75 - 0.3) / 0.7, 1])
