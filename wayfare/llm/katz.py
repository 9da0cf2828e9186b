"""Language-model scores of documents by Katz back-off with Good-Turing discounts.

Each order of the model is one exchange between blocks of text and buckets of n-grams:

1. Documents are cut into blocks of tokens, which are written once. A block asks, for each of its different n-grams,
   with how often it has them itself and the probability that the next lower order gives them.
2. Requests meet in the bucket of their history. The bucket adds up counts over all blocks, files the n-grams with their
   histories in a partitioned table, and answers each block in the order of its request, so answers carry no keys.
3. From the counts of counts come the discounts of this order; from a history's counts and the lower-order probabilities of what
   was seen after it comes its back-off weight. A block then has the probability of all its n-grams, and
   asks for the next order with them: the recursion of the model, one order at a time.

A history that many tokens follow (``the``; the empty history, which is that of order one) is dealt out over several buckets, each
of which reports its share of the history's counts. So no bucket grows with the most frequent word. Histories are told apart by
64-bit hashes; in the highest order, what follows in the same share of a history by 48 of its bits, as a share has some hundred
thousand n-grams at most.

Probabilities add up to one over the known tokens and one class of unknown ones, after every history.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import mix64, small_batches
from wayfare.llm.neardup import HASHES, words_in
from wayfare.session import scratch_dir

#: Order of the model, and the highest count that is discounted.
ORDER, DISCOUNTED = 2, 5
#: About so many tokens make a block, and so many are asked for in a bucket; buckets there are at least and at most.
BLOCK_TOKENS, BUCKET_TOKENS = 3_000_000, 2_000_000
BUCKETS = (64, 1_000_000)
#: Bytes of an n-gram's hash that are sent and filed: in the lower orders, whose n-grams are histories of the next, and in the highest.
GRAM_BYTES = (8, 6)
#: No words: the end of a text, which is a token, and what stands before its first word, which is none.
END, START = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" end", b" start"))


def packed(values: np.ndarray, width: int | None = None) -> bytes:
    """The values byte by byte (first the lowest bytes of all, ``width`` bytes of each), compressed."""
    return zstandard.compress(np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T[:width]).tobytes(), 3)


def unpacked(data: bytes, kind: type, width: int | None = None) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    planes = planes.reshape(width or size, len(planes) // (width or size))
    out = np.zeros((planes.shape[1], size), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view(kind).reshape(-1)


def coded(values: np.ndarray) -> bytes:
    """Numbers of which many are equal: the different ones, and for each its place among them."""
    different, places = np.unique(values, return_inverse=True)
    table = packed(different)
    return len(table).to_bytes(4, "little") + table + packed(places.astype(np.uint32))


def decoded(data: bytes) -> np.ndarray:
    end = 4 + int.from_bytes(data[:4], "little")
    return unpacked(data[4:end], np.float64)[unpacked(data[end:], np.uint32)]


BLOCK = "block long, doc_ids array<long>, sizes array<int>, held array<boolean>, words binary, tokens binary"


def _block(ids: list, sizes: list, held: list, tokens: list[np.ndarray]) -> dict:
    hashes = np.concatenate(tokens)
    words, places, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    by_count = np.argsort(-counts, kind="stable")  # small numbers for frequent words take fewer bytes
    rank = np.empty(len(words), np.uint32)
    rank[by_count] = np.arange(len(words), dtype=np.uint32)
    # Random, so that tasks need not agree on numbers; the blocks are written before they are used.
    return {"block": uuid4().int >> 65, "doc_ids": ids, "sizes": sizes, "held": held, "words": packed(words[by_count]), "tokens": packed(rank[places])}


def _block_batches(limit: int):
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary(), pa.binary()]
    schema = pa.schema([(c.split()[0], k) for c, k in zip(BLOCK.split(", "), kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, held, tokens, size = [], [], [], [], 0
        for batch in small_batches(batches, "text", 2_000_000):
            for doc_id, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held", "text"))):
                words = words_in(text)
                tokens.append(np.append(np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words)), END))
                ids.append(doc_id)
                held.append(out)
                sizes.append(len(words) + 1)
                size += len(words) + 1
                if size >= limit:
                    yield pa.RecordBatch.from_pylist([_block(ids, sizes, held, tokens)], schema=schema)
                    ids, sizes, held, tokens, size = [], [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([_block(ids, sizes, held, tokens)], schema=schema)

    return run


def chained(history: np.ndarray | np.uint64, word: np.ndarray | np.uint64) -> np.ndarray:
    """The hash of an n-gram from that of its history and its last word."""
    with np.errstate(over="ignore"):
        joined = np.atleast_1d(history) * np.uint64(0x9E3779B97F4A7C15)
        joined += np.atleast_1d(word)
        return mix64(joined)


@dataclass
class Frequent:
    """Histories that are dealt out over several buckets (sorted hashes), and over how many."""

    histories: np.ndarray
    shares: np.ndarray

    def place(self, histories: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the given are among them, and where."""
        at = np.minimum(np.searchsorted(self.histories, histories), max(len(self.histories) - 1, 0))
        return (self.histories[at] == histories if len(self.histories) else np.zeros(len(histories), bool)), at

    def dealt(self, histories: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """The histories, with a share of its n-grams each in place of a frequent one."""
        among, at = self.place(histories)
        out = histories.copy()
        with np.errstate(over="ignore"):
            out[among] = mix64(histories[among] + np.uint64(1) + grams[among] % self.shares[at[among]])
        return out

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """All shares (sorted), and the history that each is a share of."""
        owner = np.repeat(np.arange(len(self.histories)), self.shares.astype(np.int64))
        number = np.arange(len(owner)) - np.repeat(np.cumsum(self.shares.astype(np.int64)) - self.shares.astype(np.int64), self.shares.astype(np.int64))
        with np.errstate(over="ignore"):
            keys = mix64(self.histories[owner] + np.uint64(1) + number.astype(np.uint64))
        order = np.argsort(keys)
        return keys[order], owner[order]


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, inverse): an order that brings equal keys together, where each begins in it, and the group of each key."""
    order = np.argsort(keys).astype(np.int32)  # a block has some million keys
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    del ordered
    group = np.cumsum(new, dtype=np.int32)
    group -= 1
    inverse = np.empty(len(keys), np.int32)
    inverse[order] = group
    return order, np.flatnonzero(new), inverse


@dataclass
class Discounts:
    """What an order's counts of counts say: the factor of each count up to ``DISCOUNTED``, 1 beyond."""

    factors: np.ndarray

    @classmethod
    def estimate(cls, counts_of_counts: list[int]) -> Discounts:
        """Good-Turing estimates for the counts up to the highest for which all are between 0 and 1.

        ``counts_of_counts`` are the numbers of n-grams seen once, twice and so on, one more than ``DISCOUNTED``. Where they
        give no estimate at all, as in very small corpora, half an occurrence is taken from each n-gram up to ``DISCOUNTED``.
        """
        n = [0, *counts_of_counts]
        for most in range(DISCOUNTED, 1, -1):
            if not all(n[1 : most + 2]):
                continue
            rest = (most + 1) * n[most + 1] / n[1]
            if rest >= 1:
                continue
            factors = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) for r in range(1, most + 1)]
            if all(0 < f < 1 for f in factors):
                return cls(np.array([1.0, *factors, *[1.0] * (DISCOUNTED + 1 - most)]))
        return cls(np.array([1.0, *((r - 0.5) / r for r in range(1, DISCOUNTED + 1)), 1.0]))

    def of(self, counts: np.ndarray) -> np.ndarray:
        return self.factors[np.minimum(counts, DISCOUNTED + 1).astype(np.int64)]

    def weights(self, tallies: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(divisor, back-off weight) of histories.

        ``tallies`` has a history's tokens and its n-grams seen once, twice and so on; ``lower`` the sum of the lower-order probabilities
        of all that was seen after it. If no count is discounted, one unseen token is added to the tokens. After a history that never
        occurred the weight is 1.
        """
        tokens = tallies[0].astype(np.float64)
        left = sum((1 - self.factors[r]) * r * tallies[r] for r in range(1, DISCOUNTED + 1))
        none = left <= 0
        divisor = tokens + none
        weight = np.where(none, 1.0, left) / divisor / np.maximum(1 - lower, 1e-15)
        return divisor, np.where(tokens > 0, weight, 1.0)


@dataclass
class Level:
    """What blocks need to know of an order of the model."""

    frequent: Frequent
    discounts: Discounts
    tallies: np.ndarray
    lower: np.ndarray


class Text:
    """The tokens of a block, and its n-grams of one order after the other."""

    def __init__(self, row: dict):
        self.doc_ids, self.held = row["doc_ids"], np.array(row["held"], bool)
        self.sizes = np.array(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = unpacked(row["words"], np.uint64)[unpacked(row["tokens"], np.uint32)]
        self.training = np.repeat(~self.held, self.sizes)
        self.chance = np.zeros(0)  # of each token, by the highest order so far

    def next_order(self, order: int, frequent: Frequent, buckets: int) -> None:
        """Group the n-grams of the next order by bucket and history."""
        before = np.zeros(len(self.words), np.uint64)  # the empty history
        if order > 1:
            before[1:] = self.grams[:-1]
            before[self.starts] = self.start
            self.start = chained(self.start, START)[0]
        else:
            self.start = START
        self.grams = chained(before, self.words) if order > 1 else self.words
        by_gram, starts, inverse = grouped(self.grams)
        some = by_gram[starts]  # a token of each n-gram
        keys, history = self.grams[some], before[some]
        del by_gram, before
        dealt = frequent.dealt(history, keys)
        by_history = np.argsort(dealt, kind="stable").astype(np.int32)
        place = np.empty(len(by_history), np.int32)
        place[by_history] = np.arange(len(by_history), dtype=np.int32)
        self.inverse = place[inverse]
        self.some, self.keys, dealt = some[by_history], keys[by_history], dealt[by_history]
        new = np.flatnonzero(np.concatenate(([True], dealt[1:] != dealt[:-1])))
        self.histories, self.history_sizes = dealt[new], np.diff(np.append(new, len(dealt)))
        self.first_of_history = history[by_history[new]]
        bucket = ((self.histories >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.used = np.flatnonzero(np.bincount(bucket, minlength=buckets))
        self.cuts = np.append(np.searchsorted(bucket, self.used), len(bucket))
        self.gram_cuts = np.append(0, np.cumsum(self.history_sizes))[self.cuts]

    def requests(self, block: int, gram_bytes: int) -> pa.Table:
        counts = np.bincount(self.inverse[self.training], minlength=len(self.keys)).astype(np.uint32)
        others = np.bincount(self.inverse, minlength=len(self.keys)).astype(np.uint32) - counts
        lower = self.chance[self.some] if len(self.chance) else np.zeros(len(self.keys))
        rows = []
        for k, bucket in enumerate(self.used.tolist()):
            a, b, x, y = *self.cuts[k : k + 2], *self.gram_cuts[k : k + 2]
            listed = (
                packed(self.histories[a:b]), packed(self.history_sizes[a:b].astype(np.uint32)), packed(self.keys[x:y], gram_bytes),
                packed(counts[x:y]), packed(others[x:y]), coded(lower[x:y]),
            )
            rows.append({"bucket": bucket, "block": block} | dict(zip(REQUEST_PARTS, listed)))
        return pa.Table.from_pylist(rows, schema=REQUEST_SCHEMA)

    def learn(self, answers: list[dict], level: Level) -> np.ndarray:
        """Take the answers of all buckets, in their order: sets each token's probability, and gives each one's count."""
        counts = np.concatenate([unpacked(a["counts"], np.uint64) for a in answers])
        tallies = np.concatenate([unpacked(a["tallies"], np.uint64).reshape(DISCOUNTED + 1, -1) for a in answers], axis=1)
        lower = np.concatenate([decoded(a["lower"]) for a in answers])
        among, at = level.frequent.place(self.first_of_history)
        tallies[:, among], lower[among] = level.tallies[:, at[among]], level.lower[at[among]]
        divisor, weight = level.discounts.weights(tallies, lower)
        divisor, weight = np.repeat(divisor, self.history_sizes), np.repeat(weight, self.history_sizes)
        below = self.chance[self.some] if len(self.chance) else 1.0
        self.chance = np.where(counts > 0, level.discounts.of(counts) * counts / np.maximum(divisor, 1), weight * below)[self.inverse]
        return counts[self.inverse]


REQUEST_PARTS = ("histories", "sizes", "grams", "counts", "others", "lower")
REQUEST_SCHEMA = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), *((c, pa.binary()) for c in REQUEST_PARTS)])
REQUEST = "bucket long, block long, " + ", ".join(f"{c} binary" for c in REQUEST_PARTS)
#: Kinds of rows that a bucket returns: an answer for each block, its part of the table of n-grams, its counts of counts, its shares
#: of frequent histories, and its n-grams that are frequent histories of the next order.
RESULT_SCHEMA = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("block", pa.int64()), *((c, pa.binary()) for c in ("histories", "sizes", "grams", "counts", "tallies", "lower")), ("numbers", pa.list_(pa.int64()))])
RESULT = "kind string, bucket long, block long, histories binary, sizes binary, grams binary, counts binary, tallies binary, lower binary, numbers array<long>"


def _bucket_rows(frequent: Frequent, often: int, gram_bytes: int):
    """Adds up the requests of a bucket; below the highest order, n-grams of more than ``often`` occurrences are reported."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        asked = rows.to_pylist()
        grams = [unpacked(a["grams"], np.uint64, gram_bytes) for a in asked]
        histories = [unpacked(a["histories"], np.uint64) for a in asked]
        own = np.concatenate([np.repeat(h, unpacked(a["sizes"], np.uint32)) for h, a in zip(histories, asked)])
        every = np.concatenate(grams)
        order, starts, inverse = grouped(chained(own, every))
        some = order[starts]
        total = np.add.reduceat(np.concatenate([unpacked(a["counts"], np.uint32) for a in asked])[order].astype(np.uint64), starts)
        others = np.add.reduceat(np.concatenate([unpacked(a["others"], np.uint32) for a in asked])[order].astype(np.uint64), starts)
        lower = np.concatenate([decoded(a["lower"]) for a in asked])[some]
        every, own = every[some], own[some]
        by_history = np.argsort(own, kind="stable")
        known = own[by_history]
        first = np.flatnonzero(np.concatenate(([True], known[1:] != known[:-1])))
        known, counts = known[first], total[by_history]
        tallies = np.array([np.add.reduceat(counts, first), *(np.add.reduceat((counts == r).astype(np.uint64), first) for r in range(1, DISCOUNTED + 1))])
        sums = np.add.reduceat(np.where(counts > 0, lower[by_history], 0.0), first)

        out = []
        upto = np.append(0, np.cumsum([len(g) for g in grams]))
        for k, a in enumerate(asked):
            at = np.searchsorted(known, histories[k])
            out.append({"kind": "answer", "block": a["block"], "counts": packed(total[inverse[upto[k] : upto[k + 1]]]), "tallies": packed(tallies[:, at].reshape(-1)), "lower": coded(sums[at])})
        seen = counts > 0
        sizes = np.add.reduceat(seen.astype(np.uint32), first)
        out.append(
            {"kind": "table", "histories": packed(known[sizes > 0]), "sizes": packed(sizes[sizes > 0].astype(np.uint32)), "grams": packed(every[by_history][seen], gram_bytes), "counts": packed(counts[seen]), "tallies": packed(tallies[:, sizes > 0].reshape(-1)), "lower": coded(sums[sizes > 0])}
        )
        counted = np.bincount(np.minimum(total, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
        out.append({"kind": "counts", "numbers": [int(total.sum()), int((total > 0).sum()), *counted[1 : DISCOUNTED + 2].tolist()]})
        parts, owner = frequent.parts()
        at = np.searchsorted(known, parts)
        there = np.flatnonzero((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == parts))
        if len(there):
            out.append({"kind": "share", "histories": packed(owner[there].astype(np.uint64)), "tallies": packed(tallies[:, at[there]].reshape(-1)), "lower": packed(sums[at[there]])})
        common = np.flatnonzero(total + others > often)
        if len(common) and gram_bytes == 8:
            out.append({"kind": "frequent", "grams": packed(every[common]), "counts": packed((total + others)[common])})
        return pa.Table.from_pylist([r | {"bucket": bucket} for r in out], schema=RESULT_SCHEMA)

    return run


def _level(results: DataFrame, frequent: Frequent) -> tuple[Level, list[int]]:
    """What the buckets of an order say together, and (tokens, different n-grams). Reads a few numbers of each bucket."""
    n = DISCOUNTED + 3
    sums = results.where("kind = 'counts'").agg(*[F.coalesce(F.sum(F.get("numbers", F.lit(k))), F.lit(0)) for k in range(n)]).first()
    tallies, lower = np.zeros((DISCOUNTED + 1, len(frequent.histories)), np.uint64), np.zeros(len(frequent.histories))
    for r in results.where("kind = 'share'").select("histories", "tallies", "lower").orderBy("bucket").toLocalIterator():
        owner = unpacked(bytes(r["histories"]), np.uint64).astype(np.int64)
        np.add.at(tallies.T, owner, unpacked(bytes(r["tallies"]), np.uint64).reshape(DISCOUNTED + 1, -1).T)
        np.add.at(lower, owner, unpacked(bytes(r["lower"]), np.float64))
    return Level(frequent, Discounts.estimate(list(sums[2:])), tallies, lower), list(sums[:2])


def _next_frequent(results: DataFrame, often: int, order: int, documents: int) -> Frequent:
    """The frequent histories of the next order: its n-grams of this order with many occurrences (there are few), and the start of a text."""
    rows = results.where("kind = 'frequent'").select("grams", "counts").collect()
    start = START
    for _ in range(order - 1):
        start = chained(start, START)[0]
    keys = np.concatenate([*(unpacked(bytes(r["grams"]), np.uint64) for r in rows), np.array([start])])
    counts = np.concatenate([*(unpacked(bytes(r["counts"]), np.uint64) for r in rows), np.array([documents], np.uint64)])
    keys, counts = keys[counts > often], counts[counts > often]
    order_ = np.argsort(keys)
    return Frequent(keys[order_], (counts[order_] + np.uint64(often - 1)) // np.uint64(often))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class Model:
    """Exchanges between the blocks of a corpus and its buckets, order by order."""

    def __init__(self, blocks: DataFrame, tokens: int, documents: int, order: int):
        self.blocks, self.order = blocks, order
        self.buckets = min(BUCKETS[1], max(BUCKETS[0], math.ceil(tokens / BUCKET_TOKENS)))
        #: A history with more occurrences is dealt out: there are at most four such for each bucket.
        self.often = max(1, tokens // (4 * self.buckets))
        self.levels: list[Level] = []
        self.answers: list[DataFrame] = []
        self.tables: list[DataFrame] = []
        #: Training tokens and different ones.
        self.sizes = [0, 0]
        frequent = Frequent(np.zeros(1, np.uint64), np.array([self.buckets], np.uint64))
        for k in range(1, order + 1):
            results = self._exchange(self._requests(k, frequent), frequent, k)
            level, sizes = _level(results, frequent)
            if k == 1:
                self.sizes = sizes
            self.levels.append(level)
            self.answers.append(results.where("kind = 'answer'").select(F.lit(k).alias("order"), "bucket", "block", "counts", "tallies", "lower"))
            self.tables.append(results.where("kind = 'table'").select("bucket", "histories", "sizes", "grams", "counts", "tallies", "lower"))
            if k < order:
                frequent = _next_frequent(results, self.often, k, documents)

    def _gram_bytes(self, order: int) -> int:
        return GRAM_BYTES[order == self.order]

    def _exchange(self, requests: DataFrame, frequent: Frequent, order: int) -> DataFrame:
        path = scratch_dir(requests.sparkSession, f"ngrams-{order}")
        rows = requests.groupBy("bucket").applyInArrow(_bucket_rows(frequent, self.often, self._gram_bytes(order)), RESULT)
        rows.write.partitionBy("kind").parquet(path)
        return requests.sparkSession.read.schema(RESULT).parquet(path)

    def _with_answers(self, work, schema: str) -> DataFrame:
        """Run ``work(text, answers by order, block)`` on each block with all answers to it."""
        answers = self.answers[0]
        for more in self.answers[1:]:
            answers = answers.unionByName(more)

        def run(key: tuple, block: pa.Table, answered: pa.Table) -> pa.Table:
            by_order: dict[int, list] = {}
            for a in answered.sort_by([("order", "ascending"), ("bucket", "ascending")]).to_pylist():
                by_order.setdefault(a["order"], []).append(a)
            return work(Text(block.to_pylist()[0]), by_order, key[0].as_py())

        return self.blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)

    def _requests(self, order: int, frequent: Frequent) -> DataFrame:
        buckets, levels, gram_bytes = self.buckets, list(self.levels), self._gram_bytes(order)

        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    text = Text(row)
                    text.next_order(1, frequent, buckets)
                    yield from text.requests(row["block"], gram_bytes).to_batches()

        def later(text: Text, answers: dict, block: int) -> pa.Table:
            for k, level in enumerate(levels, 1):
                text.next_order(k, level.frequent, buckets)
                text.learn(answers[k], level)
            text.next_order(order, frequent, buckets)
            return text.requests(block, gram_bytes)

        return self.blocks.mapInArrow(first, REQUEST) if order == 1 else self._with_answers(later, REQUEST)

    def scores(self) -> DataFrame:
        """Every document's row: tokens, known ones, and the scores of the base and of this model."""
        buckets, levels, (n, v) = self.buckets, list(self.levels), self.sizes

        def work(text: Text, answers: dict, block: int) -> pa.Table:
            known = base = None
            for k, level in enumerate(levels, 1):
                text.next_order(k, level.frequent, buckets)
                counts = text.learn(answers[k], level)
                if k == 1:
                    known = np.add.reduceat((counts > 0).astype(np.int64), text.starts)
                    base = np.add.reduceat(np.log10((counts.astype(np.float64) + 1) / (n + 1 * (v + 1))), text.starts)
            score = np.add.reduceat(np.log10(text.chance), text.starts)
            columns = [pa.array(text.doc_ids, pa.int64()), pa.array(text.held), pa.array(text.sizes), pa.array(known), pa.array(np.full(len(known), n)), pa.array(base), pa.array(score)]
            return pa.table(columns, names=[c.split()[0] for c in SCORES.split(", ")])

        return self._with_answers(work, SCORES)


def model_of(docs: DataFrame, held_out: Column, order: int = ORDER) -> Model:
    """A model of the rows of ``doc_id``, ``text`` for which ``held_out`` is not true, ready to score all of them."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out, F.lit(False)).alias("held"), "text")
    # Filed by block number, so that answers come to the blocks and the blocks stay where they are.
    name = f"wayfare_blocks_{uuid4().hex}"
    cut = rows.mapInArrow(_block_batches(BLOCK_TOKENS), BLOCK)
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 10_000)
    cut.write.bucketBy(buckets, "block").option("path", scratch_dir(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)
    tokens, documents = blocks.agg(
        F.coalesce(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")), F.lit(0)), F.coalesce(F.sum(F.size("sizes")), F.lit(0))
    ).first()
    return Model(blocks, tokens, documents, order)


def folds(doc_id: Column, parts: int = 7, held: int = 2) -> Column:
    """Whether the checksum of a doc_id's text falls in the part that is held out (null: not)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == held


def scored(docs: DataFrame, held_out: Column | None = None, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``doc_id``, ``text``.

    Tokens are the words (A-Z lower-cased) and one end; null and empty texts have the end alone. ``base_score`` is that of single tokens with
    one added to each count, ``score`` the model's log10 probability of the text from its start to its end. Rows with a null doc_id are
    learnt from. Repeated rows are each learnt from and scored; ``held_out`` may be any condition on the rows, by default
    that of ``folds``. If nothing is learnt from, every token is unknown and both scores are 0. An empty table gives no rows;
    further columns are not looked at.
    """
    return model_of(docs, folds(F.col("doc_id")) if held_out is None else held_out, order).scores()
