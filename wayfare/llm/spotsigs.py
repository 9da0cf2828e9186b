"""Document fingerprints by spot signatures.

Anchors are the commonest short words of the corpus. A signature is an anchor followed by a chain
of content words: the next words that are no anchors, at a fixed distance from each other. The set of
a text's signatures, hashed, is its fingerprint: lower-case hex, eight digits each, ascending.
Fingerprints are compared by the Jaccard similarity of their sets; sizes give an upper bound, so
sets whose sizes are too far apart are never compared.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import mix64, small_batches, staged
from wayfare.llm.neardup import HASHES

#: Anchors are words of at most this many letters; so many of the commonest are taken.
ANCHOR_LETTERS, ANCHORS = 4, 120
#: A word with no common word among so many on either side may be an anchor by its hash.
NEARBY = 8
#: Content words in a chain, and the distance between them in content words.
CHAIN, DISTANCE = 2, 2
EDGE = re.compile(rb"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+").sub


def anchors_of(docs: DataFrame, letters: int = ANCHOR_LETTERS, number: int = ANCHORS) -> list[str]:
    """The commonest words of at most ``letters`` characters over all whole texts; ties by the word.

    Words are lower-cased (A-Z) and cleared of ASCII punctuation. At most ``number`` words reach the driver.
    """
    plain = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+", "")
    words = docs.select(F.explode(F.split(plain, r"[\x20\x09-\x0D]+")).alias("word")).where((F.length("word") <= letters) & (F.col("word") != ""))
    top = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "word").limit(number)
    return [r["word"] for r in top.collect()]


@lru_cache(maxsize=4)
def _anchor_hashes(anchors: tuple[str, ...]) -> np.ndarray:
    return np.sort(np.array([HASHES[a.encode()] for a in anchors], np.uint64))


def signatures(text: str | None, anchors: tuple[str, ...], chain: int = CHAIN, distance: int = DISTANCE) -> np.ndarray:
    """The distinct signatures of a text as sorted 32-bit hashes (null and blank texts: none).

    A word whose hash is divisible by four is an anchor too if no common word is among the ``NEARBY`` words on either side of
    it, as in tables and lists. That depends on the words around it only, so texts that share a passage share its signatures.
    Chains that would run past the end take what is left, if it is one content word at least. A text with words but
    without any signature has one, of all its words.
    """
    words = EDGE(b"", (text or "").encode().lower()).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint32)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, n)
    table = _anchor_hashes(anchors)
    is_anchor = table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h if len(table) else np.zeros(n, bool)
    upto = np.concatenate(([0], np.cumsum(is_anchor)))
    place = np.arange(n)
    common = upto[np.minimum(place + NEARBY + 1, n)] - upto[np.maximum(place - NEARBY, 0)]
    is_anchor |= (common == 0) & (h % np.uint64(4) == 0)
    content = h[~is_anchor]
    at = np.flatnonzero(is_anchor)
    # The first content word after an anchor has as many content words before it as stand before the anchor.
    first = at - np.arange(len(at))
    at, first = at[first < len(content)], first[first < len(content)]
    total = h[at].copy()
    with np.errstate(over="ignore"):
        for k in range(chain):
            place = first + k * distance
            there = place < len(content)
            link = np.where(there, content[np.minimum(place, len(content) - 1)] if len(content) else 0, 0).astype(np.uint64)
            total = mix64(total ^ (link + np.uint64(k + 1)))
    if not len(total):
        with np.errstate(over="ignore"):
            total = mix64(np.array([(h * (np.arange(n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))).sum()], np.uint64))
    return np.unique((total >> np.uint64(32)).astype(np.uint32))


def spelled(signs: np.ndarray) -> str:
    return signs.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' sets; two empty ones are alike, an empty one is like no other."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, other: str) -> str:
    """``text`` with its last half replaced by as much of the other's beginning as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def in_order(docs: DataFrame, per_bucket: int = 64, most: int = 10_000) -> DataFrame:
    """Rows dealt into ranges of doc_id and sorted in them, each range followed by a copy of the next row.

    Bounds are quantiles, so ranges are even for any ids. The first row of each range is also sent to the range before
    it, that of the first range to the last, so every row has its successor in its own range.
    ``copy`` marks these rows. Null ids come first; equal ids are ordered by text.
    """
    spark = docs.sparkSession
    n, low = docs.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    ranges = max(1, min(most, n // per_bucket))
    bounds: list[int] = []
    if ranges > 1 and low is not None:
        shares = [k / ranges for k in range(1, ranges)]
        bounds = sorted(set(docs.select(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0]))
    table = np.array(bounds, np.int64)

    @F.pandas_udf("long")
    def range_of(ids: pd.Series) -> pd.Series:  # only ids go to Python, texts do not
        return pd.Series(np.searchsorted(table, ids.to_numpy(), side="right"))

    dealt = docs.select("doc_id", "text", range_of(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("bucket"))
    # One row per range: at most ``most``.
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("f")).orderBy("bucket").collect()
    before = {b["bucket"]: firsts[k - 1]["bucket"] for k, b in enumerate(firsts)}
    first_rows = spark.createDataFrame(
        pa.table({"first_id": pa.array([b["f"]["doc_id"] for b in firsts], pa.int64()), "to": pa.array([before[b["bucket"]] for b in firsts], pa.int64())})
    )
    copies = docs.join(F.broadcast(first_rows), F.col("doc_id").eqNullSafe(F.col("first_id")))
    both = dealt.select("doc_id", "bucket", "text", F.lit(False).alias("copy")).unionByName(
        copies.select("doc_id", F.col("to").alias("bucket"), "text", F.lit(True).alias("copy"))
    )
    return both.repartition("bucket").sortWithinPartitions("bucket", "copy", F.col("doc_id").asc_nulls_first(), "text")


def _fingerprint_batches(anchors: tuple[str, ...]):
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (bucket, doc_id, text, signatures, was a copy) of the row before
        for batch in small_batches(batches, "text", 2_000_000):
            rows = []
            for doc_id, bucket, text, copy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "bucket", "text", "copy"))):
                text = text or ""
                signs = signatures(text, anchors)
                if held is not None and held[0] == bucket and not held[4]:
                    _, own_id, own, own_signs, _ = held
                    changed = edited(own, text)
                    changed_signs = signatures(changed, anchors)
                    rows.append((own_id, len(own), hashlib.sha256(changed.encode()).hexdigest(), spelled(own_signs), spelled(changed_signs), likeness(own_signs, changed_signs), likeness(own_signs, signs)))
                held = (bucket, doc_id, text, signs, copy)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint, and how like it is to that of its edited text and of the next document.

    The next document is that with the next doc_id, after the last the first. Null texts are empty. Null ids come first;
    rows with equal ids follow each other by their text. One document is its own next one; an empty table
    gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    anchors = tuple(anchors_of(docs))
    return in_order(docs).mapInArrow(
        _fingerprint_batches(anchors), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def similar(prints: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, likeness) of equal or higher Jaccard similarity among distinct (doc_id, fingerprint) rows, a < b.

    Sets are dealt into partitions by length, each as wide as the threshold allows, so a set meets only its own and the
    next one; in them, sets that share one of their first signatures (from the rarest) are
    compared. Empty fingerprints are in no pair; equal fingerprints are first collapsed, and pairs are between the
    smallest ids of each.
    """
    distinct = staged(prints.where("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "prints")
    signs = F.transform(F.sequence(F.lit(0), (F.length("fingerprint") / 8 - 1).cast("int")), lambda i: F.substring(F.col("fingerprint"), i * 8 + 1, F.lit(8)))
    each = distinct.select("doc_id", F.explode(signs).alias("sign"))
    often = staged(each.groupBy("sign").agg(F.count(F.lit(1)).alias("df")), "sign-counts")
    ordered = staged(each.join(often, "sign").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "sign"))).alias("o")).select("doc_id", F.col("o.sign").alias("signs"), F.size("o").alias("n")), "ordered-signs")
    part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) if threshold < 1 else F.col("n"))
    prefix = F.slice("signs", 1, (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))
    x = (
        ordered.select(F.col("doc_id").alias("x"), F.col("n").alias("nx"), part.alias("p"), F.explode(prefix).alias("sign"))
        .select("x", "nx", "sign", F.explode(F.array("p", F.col("p") + 1)).alias("part"))
    )
    y = ordered.select(F.col("doc_id").alias("y"), F.col("n").alias("ny"), part.alias("part"), F.explode(prefix).alias("sign"))
    smaller = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    pairs = x.join(y, ["part", "sign"]).where(smaller & (F.col("nx") >= F.col("ny") * threshold - 1e-9)).select("x", "y").distinct()
    sets = ordered.select("doc_id", "signs", "n")
    full = pairs.join(sets.toDF("x", "sx", "nx"), "x").join(sets.toDF("y", "sy", "ny"), "y")
    both = F.size(F.array_intersect("sx", "sy"))
    return full.withColumn("likeness", both / (F.col("nx") + F.col("ny") - both)).where(F.col("likeness") >= threshold).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness"
    )
