"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

1. Each document's set of word shingles is sketched: in round ``i`` every element is hashed into
   one bin with a value between ``i`` and ``i + 1``, and a bin keeps its least value. After the
   last round of random bins, round ``t + j`` puts all elements into bin ``j``, so that every
   coordinate is filled; rounds end as soon as all are.
2. Documents with the same words are one; coordinates are joined into bands, and documents that
   share a band are in a bucket together.
3. In each bucket, every member is compared with the bucket's most central member (that which
   shares most bands with others): pairs grow with the members, not with their square.
   Links are confirmed on full sets, and components are formed.
4. A bucket whose members are then in one component needs nothing more. The members of the others are
   compared across components by an exact filter on their rarest shingles, so that no link
   between components is lost, however large the group is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import TABLES, free_names, may_be_in, mix64, parted, releasing, small_batches, staged
from wayfare.llm.components import components

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: What a Python worker holds at once: bytes of text, and words whose hashes it remembers. Two workers share an executor with the JVM.
BATCH, WORDS = 500_000, 100_000


class WordHashes(dict):
    """64-bit hashes of words; remembers a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORDS:
            self[word] = value
        return value


HASHES = WordHashes()
TABLES.append(HASHES)


def words_in(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased (null: none)."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """The distinct hashes of all runs of ``size`` words, sorted; of the whole, if it is shorter."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(HASHES.__getitem__, words), np.uint64, n)
    width = min(n, size)
    with np.errstate(over="ignore"):
        total = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            total = (total ^ hashes[k : n - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
            total ^= total >> np.uint64(29)
    return np.unique(mix64(total))


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """A row of ``t`` coordinates for each set; an empty set's are all ``FULL``."""
    out = np.full((len(sets), t), FULL)
    flat = out.reshape(-1)
    values = np.concatenate([*sets, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * t):
        if not len(values):
            break
        h = mix64(values ^ mix64(np.array([i + 1]))[0])
        low = np.uint64(i) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)
        bins = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, owner * t + bins, low)
        wanting = (out == FULL).any(axis=1)[owner]
        values, owner = values[wanting], owner[wanting]
    return out


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates."""
    m, t = sketches.shape
    parts = sketches.reshape(m, t // rows, rows)
    key = np.broadcast_to(mix64(np.arange(1, t // rows + 1)), (m, t // rows))
    for k in range(rows):
        key = mix64(key ^ parts[:, :, k])
    return key.view(np.int64)


def bands_for(percent: int, rows: int, miss: float = 1e-7) -> int:
    """Bands of ``rows`` coordinates that miss a pair at the threshold with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _sketch_batches(size: int, bands: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64()))])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH):
            words = [words_in(t) for t in batch.column("text").to_pylist()]
            sets = [shingles(w, size) for w in words]
            keys = band_keys(sketch(sets, bands * rows), rows)
            digests = [hashlib.md5(b" ".join(w)).digest() if w else None for w in words]
            found = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), found], schema=schema)

    return run


def _linked(percent: int, size: int):
    """Batches of pairs with both texts, cut to the pairs that are similar enough."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in small_batches(batches, "text_b", BATCH):
            keep = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if a != last:
                    last, last_set = a, shingles(words_in(x), size)
                other = shingles(words_in(y), size)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                if both and 100 * both >= percent * (len(last_set) + len(other) - both):
                    keep.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keep], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs ``a``, ``b`` of doc_ids whose full sets are similar enough."""
    wanted = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    texts = may_be_in(docs, "doc_id", wanted, "a")
    second = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_linked(percent, size), "a long, b long")


def _token_batches(size: int):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH):
            sets = [shingles(words_in(t), size).view(np.int64) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(s) for s in sets)])
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("component"), tokens], ["doc_id", "component", "tokens"])

    return run


def across(members: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Candidate pairs between members (``doc_id``, ``component``) of different components: all that can be linked.

    Shingles are ordered from the rarest. Of a pair, the smaller set ``x`` must share one of its
    first ``|x| - ceil(2p|x| / (1 + p)) + 1`` with the first ``|y| - ceil(p|y|) + 1`` of the larger
    one, and from the first shared one on, enough must follow in both.
    """
    texts = may_be_in(docs, "doc_id", members, "doc_id").join(members, "doc_id").select("doc_id", "component", "text")
    sets = staged(texts.mapInArrow(_token_batches(size), "doc_id long, component long, tokens array<long>"), "unsettled")
    each = sets.select("doc_id", "component", F.explode("tokens").alias("token"))
    # A shingle of one document only can lie before the others, but cannot be shared.
    often = staged(each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-shingles")
    shared = each.join(often, "token")
    ranked = shared.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("order"))
    n = F.size("tokens")
    alone = n - F.size("order")
    y_first = n - F.ceil(n * percent / F.lit(100.0) - 1e-6) + 1
    x_first = n - F.ceil(n * (2.0 * percent) / (100.0 + percent) - 1e-6) + 1
    prefix = staged(
        sets.join(ranked, "doc_id")
        .select("doc_id", "component", n.alias("n"), alone.alias("alone"), x_first.alias("x_first"), F.slice("order", 1, F.greatest(y_first - alone, F.lit(0)).cast("int")).alias("first"))
        .select("doc_id", "component", "n", "x_first", "alone", F.posexplode("first").alias("k", "entry"))
        .select("doc_id", "component", "n", "x_first", (F.col("k") + F.col("alone")).alias("place"), F.col("entry.token").alias("token")),
        "prefixes",
    )
    x = prefix.where("place < x_first").drop("x_first")
    x, y = (side.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "component", "n", "place")]) for side, s in ((x, "x"), (prefix, "y")))
    needed = (F.col("n_x") + F.col("n_y")) * (percent / (100.0 + percent)) - 1e-6
    possible = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    pairs = x.join(
        y,
        (x.token == y.token)
        & (F.col("component_x") != F.col("component_y"))
        & ((F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("doc_id_x") != F.col("doc_id_y"))))
        & (100 * F.col("n_x") >= percent * F.col("n_y"))
        & (possible >= needed),
    )
    return pairs.select(F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 5, rows: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``doc_id``, ``text``.

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of ``size``-word
    shingles; ``component_id`` is the smallest doc_id reachable over links. Null, empty and blank
    texts have no shingles, are linked with nothing and kept. Repeated rows are each returned, and
    a doc_id with several texts is in the component of each row's text. A null doc_id takes no part:
    null component, kept. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    bands = bands_for(percent, rows)
    all_docs = staged(docs.mapInArrow(_sketch_batches(size, bands, rows), "doc_id long, digest binary, n_shingles long, bands array<long>"), "sketches")
    named = docs.where("doc_id is not null")
    alike = all_docs.where("doc_id is not null and digest is not null")
    chosen = alike.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r"))
    reps = staged(chosen.select("digest", "r.*"), "representatives")

    keys = reps.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "value")).select("doc_id", "n_shingles", F.xxhash64("band", "value").alias("key"))
    shared = staged(keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
    members = staged(may_be_in(keys, "key", shared, "key").join(shared, "key"), "members")
    weight = staged(members.groupBy("doc_id").agg(F.sum("members").alias("weight")), "centrality")
    weighed = members.join(weight, "doc_id")
    leaders = staged(
        weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("first"), F.col("n_shingles").alias("n"))).alias("l")).select("key", (-F.col("l.first")).alias("leader"), F.col("l.n").alias("n")),
        "leaders",
    )
    smaller, larger = F.least("n", "n_shingles"), F.greatest("n", "n_shingles")
    stars = members.join(leaders, "key").where((F.col("doc_id") != F.col("leader")) & (100 * smaller >= percent * larger))
    star_pairs = staged(stars.select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct(), "star-pairs")
    links = staged(confirmed(star_pairs, named, percent, size), "star-links")
    first = staged(components(links), "first-components")

    placed = members.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    placed = staged(placed, "placed")
    open_keys = staged(placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key"), "open-buckets")
    unsettled = staged(placed.join(open_keys, "key").select("doc_id", "component").distinct(), "unsettled-members")
    more = staged(across(unsettled, named, percent, size), "cross-pairs")
    more_links = confirmed(more, named, percent, size)
    final = staged(components(links.unionByName(more_links)), "components")

    by_digest = reps.select("digest", "doc_id").join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    by_digest = staged(by_digest.select("digest", F.coalesce("component", "doc_id").alias("component")), "digest-components")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        all_docs.select("doc_id", "digest", "n_shingles")
        .join(by_digest, "digest", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_copies(docs: DataFrame, percent: int = 85, size: int = 5, rows: int = 5) -> DataFrame:
    """The rows of ``docs``, with all their columns, but only one of each component of near duplicates.

    That with the smallest doc_id stays (one with an id rather than one without; of several with the same id, that whose text has
    the smallest hash). Rows are told apart by id and text, so other rows with the id of a copy stay. Of rows equal in both, one
    stays. Null, empty and blank texts are copies of nothing and all stay.
    """
    key, row = free_names(docs, "row_key", "row")
    own = docs.select(F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias(key), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    texts = own.select(F.col(key).alias("doc_id"), F.col(f"{row}.text").alias("text"))
    found = near_duplicates(texts, percent, size, rows).where("n_shingles > 0")
    found = staged(found.groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("n")), "row-components")
    shared = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("keys")).where("keys > 1").select("component_id")
    members = staged(found.join(shared, "component_id").select("component_id", F.col("doc_id").alias("key")), "component-rows")
    ids = own.select(F.col(key).alias("key"), F.col(f"{row}.doc_id").cast("long").alias("id"))
    ids = may_be_in(ids, "key", members, "key").distinct()
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    stay = staged(members.join(ids, "key").groupBy("component_id").agg(first).select(F.col("first.key").alias("key")), "first-rows")
    gone = staged(members.join(stay, "key", "left_anti").select("key"), "copies")
    several = found.where("n > 1").select(F.col("doc_id").alias("key")).join(gone, "key", "left_anti")
    several = staged(several, "repeated-rows")
    judged = staged(gone.withColumn("one", F.lit(False)).unionByName(several.withColumn("one", F.lit(True))), "judged-rows")
    maybe, clean = parted(own, key, judged, "key")
    maybe = maybe.withColumnRenamed(key, "key")
    kept = maybe.join(judged, "key", "left_anti").select(row)
    one = maybe.join(judged.where("one").select("key"), "key").groupBy("key").agg(F.first(row).alias(row)).select(row)
    return clean.select(row).unionByName(kept).unionByName(one).select(*[F.col(f"{row}.`{c}`") for c in docs.columns])
