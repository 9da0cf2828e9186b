"""Ranked lexical search over an index stratified by document length.

A document's score has a length normaliser ``m``, so documents with equal ``m`` make a stratum: in it, what a term
adds to a score depends on its occurrences ``tf`` alone. The index has one row for each part of a stratum (large strata are
dealt into parts of bounded size); its postings are sorted by term and ``tf``, and the impact of each
(term, tf) is computed once for all documents that share it.

A search deals the parts out to tasks. In a task, the largest ``tf`` of each query term bounds what any document of a part can
score; an item's parts are visited from the highest bound, until the bound is below the score of the
item's worst document so far. Tasks return their best documents, of which the best of all are taken.
Equal bounds are visited, so ties are broken by doc_id over the whole corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import small_batches, staged
from wayfare.llm.neardup import HASHES

# All ASCII characters but letters and digits lie between terms; A-Z are lower-cased.
FOLD = bytes((b | 32) if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: A part of a stratum has about so many documents, and so many terms, at most.
PART_DOCS, PART_TERMS = 4096, 2_000_000
#: Strata of up to this many different normalisers go to every executor; more are joined by a shuffle.
BROADCAST_STRATA = 100_000
#: Items are searched for in blocks of about so many (item, term) rows, which go to every task.
BLOCK_TERMS = 200_000
#: A task holds so many bytes of parts at once and visits these from the highest bound.
HELD_BYTES = 48_000_000
#: Stands for a null doc_id inside the index: it comes after all others.
NO_ID = (1 << 63) - 1


def terms_in(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats (null: none)."""
    return (text or "").encode().translate(FOLD).split()


def _ragged(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate([*parts, np.empty(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _vector_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = 0
    for batch in small_batches(batches, "text", 2_000_000):
        n, terms, tfs = [], [], []
        for text in batch.column("text").to_pylist():
            counts = Counter(terms_in(text))
            tf = np.fromiter(counts.values(), np.int64, len(counts))
            terms.append(np.fromiter(map(HASHES.__getitem__, counts), np.uint64, len(counts)).view(np.int64))
            tfs.append(tf)
            n.append(int(tf.sum()))
        salt = np.arange(row, row + len(n))
        row += len(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(salt, pa.int64()), pa.array(n, pa.int64()), _ragged(terms, pa.int64()), _ragged(tfs, pa.int32())], ["doc_id", "salt", "n", "terms", "tfs"]
        )


def _whole(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """All elements of an array column, one row after the other."""
    flat = pc.list_flatten(column)
    return (flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat).to_numpy(zero_copy_only=False)


def _stratum_part(key: tuple, rows: pa.Table) -> pa.Table:
    """One row of the index: postings sorted by term and tf; each posting names a document by its place in ``doc_ids``."""
    sizes = pc.list_value_length(rows.column("terms")).to_numpy()
    terms, tfs = _whole(rows.column("terms")), _whole(rows.column("tfs"))
    owner = np.repeat(np.arange(rows.num_rows), sizes)
    order = np.lexsort((tfs, terms))
    terms, tfs = terms[order], tfs[order]
    first = np.flatnonzero(np.concatenate(([True], (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1]))))
    counts = np.diff(np.append(first, len(terms)))
    listed = [np.asarray(rows.column("doc_id")), terms[first], tfs[first], counts, owner[order]]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    columns = [pa.array([x], pa.list_(k)) for x, k in zip(listed, kinds)]
    n_terms = int(pc.sum(rows.column("n")).as_py())
    return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([key[1].as_py()], pa.int64()), pa.array([n_terms], pa.int64()), *columns], names=["m", "part", "n_terms", "doc_ids", "terms", "tfs", "counts", "members"])


INDEX = "m long, part long, n_terms long, doc_ids array<long>, terms array<long>, tfs array<int>, counts array<int>, members array<int>"


def build_index(docs: DataFrame) -> DataFrame:
    """The index of all terms of every row of ``doc_id``, ``text``: one row for each part of a stratum.

    ``terms``, ``tfs`` and ``counts`` say how many documents have a term so many times; ``members`` are those documents, as places in
    ``doc_ids``. Terms are kept as 64-bit hashes. Texts without a term (null and empty ones too) are not in it. Rows without a
    doc_id have the largest long for it; repeated rows are documents of their own. An empty table gives no rows.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    vectors = rows.mapInArrow(_vector_batches, "doc_id long, salt long, n long, terms array<long>, tfs array<int>")
    vectors = staged(vectors, "term-vectors").where("n > 0")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
    # Wider than 64 bits in between: documents times terms may not fit.
    m = F.expr(f"10L + cast(90 * n as decimal(18, 0)) * cast({n_docs} as decimal(18, 0)) div cast({n_terms} as decimal(18, 0))")
    vectors = vectors.withColumn("m", m)
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / PART_DOCS), F.ceil(F.sum("n") / PART_TERMS)).alias("parts")
    strata = staged(vectors.groupBy("m").agg(parts), "strata")
    strata = F.broadcast(strata) if strata.count() <= BROADCAST_STRATA else strata
    dealt = vectors.join(strata, "m").withColumn("part", F.pmod(F.xxhash64("doc_id", "salt"), F.col("parts")))
    dealt = dealt.select("m", "part", "doc_id", "n", "terms", "tfs")
    return staged(dealt.groupBy("m", "part").applyInArrow(_stratum_part, INDEX), "search-index")


@dataclass
class Block:
    """Items that are searched for together: their terms, sorted by item, with weights."""

    terms: np.ndarray
    item_starts: np.ndarray
    term_of: np.ndarray
    weight_of: np.ndarray


def _frequencies(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column("terms"), batch.column("counts")):
                terms, upto = terms.values.to_numpy(), np.append(0, np.cumsum(counts.values.to_numpy()))
                df += upto[np.searchsorted(terms, wanted, "right")] - upto[np.searchsorted(terms, wanted, "left")]
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[there]), pa.array(df[there])], ["term", "df"])

    return run


class Best:
    """The best documents of an item so far, and the score that a further one must reach."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids, self.least = top, np.empty(0, np.int64), np.empty(0, np.int64), 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        able = scores >= self.least
        scores, ids = scores[able], ids[able]
        if len(scores) > self.top:  # all that share the score of the last place stay: their ids decide
            able = scores >= np.partition(scores, -self.top)[-self.top]
            scores, ids = scores[able], ids[able]
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        first = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.top:
            self.least = int(self.scores[-1])


class Part:
    """A row of the index as a block of items sees it."""

    def __init__(self, row: dict, block: Block):
        terms, tfs = row["terms"], row["tfs"].astype(np.int64)
        low, high = np.searchsorted(terms, block.terms, "left"), np.searchsorted(terms, block.terms, "right")
        impacts = 1_000_000_000 * tfs // (1000 * tfs + 8 * row["m"])
        upto = np.append(0, np.cumsum(row["counts"]))
        self.doc_ids, self.members = row["doc_ids"], row["members"]
        self.low, self.high = upto[low], upto[high]
        self.impacts = np.repeat(impacts, row["counts"])
        most = np.where(high > low, impacts[np.maximum(high, 1) - 1], 0)
        self.bounds = np.add.reduceat(most[block.term_of] * block.weight_of, block.item_starts[:-1])

    def scores(self, block: Block, item: int) -> np.ndarray:
        out = np.zeros(len(self.doc_ids), np.int64)
        for k in range(block.item_starts[item], block.item_starts[item + 1]):
            term = block.term_of[k]
            a, b = self.low[term], self.high[term]
            if b > a:  # a document is in the postings of a term once
                out[self.members[a:b]] += self.impacts[a:b] * block.weight_of[k]
        return out


def _visits(block: Block, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in range(len(block.item_starts) - 1)]

        def visit(parts: list[Part]) -> None:
            bounds = np.array([p.bounds for p in parts])
            order = np.argsort(-bounds, axis=0, kind="stable")
            for item, found in enumerate(best):
                for k in order[:, item]:
                    if bounds[k, item] < found.least:
                        break
                    found.offer(parts[k].scores(block, item), parts[k].doc_ids)

        held, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in ("doc_ids", "terms", "tfs", "counts", "members")}
                row = {c: v.values.to_numpy() for c, v in row.items()} | {"m": batch.column("m")[k].as_py()}
                held.append(Part(row, block))
                size += 24 * len(row["members"])
                if size >= HELD_BYTES:
                    visit(held)
                    held, size = [], 0
        if held:
            visit(held)
        sizes = [len(b.ids) for b in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), sizes), pa.int64()), *(pa.array(np.concatenate([np.empty(0, np.int64), *(getattr(b, c) for b in best)]), pa.int64()) for c in ("ids", "scores"))],
            ["item", "doc_id", "score"],
        )

    return run


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        found = [sorted({HASHES[t] for t in terms_in(text)}) for text in batch.column("text").to_pylist()]
        terms = np.array([t for f in found for t in f], np.uint64).view(np.int64)
        rows = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
        yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(rows)), pa.array(terms)], ["item_id", "term"])


def _searched(index: DataFrame, items: list, n_docs: int, top: int) -> DataFrame:
    """The best documents of a block of (item_id, [terms]), by its position in the block."""
    spark = index.sparkSession
    wanted = np.unique(np.array([t for _, terms in items for t in terms], np.int64))
    counted = index.select("terms", "counts").mapInArrow(_frequencies(wanted), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in counted.collect()}  # at most the block's terms
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) if t in df else 0 for t in wanted.tolist()], np.int64)
    place = {t: k for k, t in enumerate(wanted.tolist())}
    # A term that is nowhere, or has no weight, adds nothing; one such stays where an item has no other.
    kept = [[place[t] for t in terms if weight[place[t]] > 0] or [place[terms[0]]] for _, terms in items]
    term_of = np.array([k for terms in kept for k in terms])
    block = Block(wanted, np.cumsum([0, *map(len, kept)]), term_of, weight[term_of])
    found = index.select("m", "doc_ids", "terms", "tfs", "counts", "members").mapInArrow(_visits(block, top), "item long, doc_id long, score long")
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)


def search(index: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` highest-scoring documents for every item of ``item_id``, ``text``.

    Scores are above 0; equal ones are ranked by ascending doc_id, null ids last. Rows that share an item_id are one item with the terms of
    all of them, a null item_id too. Items without a term that the corpus has, and those of an empty corpus, get no rows. Items
    go to the tasks in blocks of about ``BLOCK_TERMS`` terms, each of which is searched for in the whole index.
    """
    spark = index.sparkSession
    queries = items.select("item_id", "text").mapInArrow(_item_batches, items.select("item_id").schema.add("term", T.LongType()))
    queries = staged(queries.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")), "query-terms")
    size = queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    n_docs = index.agg(F.coalesce(F.sum(F.size("doc_ids")), F.lit(0))).first()[0]
    out = items.select("item_id").schema.add("rank", T.IntegerType()).add("doc_id", T.LongType()).add("score", T.LongType())
    blocks = max(1, math.ceil(size / BLOCK_TERMS))
    results = []
    for k in range(blocks):
        chosen = queries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        block = [(r["item_id"], r["terms"]) for r in chosen.collect()]  # about BLOCK_TERMS terms
        if not block or not n_docs:
            continue
        names = spark.createDataFrame([(p, i) for p, (i, _) in enumerate(block)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = _searched(index, block, n_docs, top).join(F.broadcast(names), "item")
        doc_id = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
        results.append(staged(found.select("item_id", "rank", doc_id.alias("doc_id"), "score"), "search-results"))
    return reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], out)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(terms) AS term FROM d) GROUP BY r, doc_id, term),
sizes AS (SELECT r, len(terms) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
w AS (
  SELECT item_id, term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM q JOIN tf USING (term), total GROUP BY item_id, term),
m AS (SELECT r, 10 + (90 * n * docs) // total.terms AS m FROM sizes, total),
scores AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM w JOIN tf USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
