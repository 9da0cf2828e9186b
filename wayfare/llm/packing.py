"""Best-fit packing after a Martello-Toth reduction.

Only the number of pieces of each length decides a packing, and lengths are at most ``capacity``.
So the plan is made from a histogram of at most ``capacity`` counts, whatever the size of the
corpus, and says how many sequences hold which lengths. The reduction first fixes sets that hold a
largest remaining piece and provably dominate every other set with that piece; best fit places the
rest. Pieces are then numbered within their length by Spark, and number ``r`` of a length takes the
``r``-th place that the plan has for it. No piece passes through the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.bpe import library_ids
from wayfare.llm.common import small_batches, staged

#: Up to this many plan entries go to every executor; a longer plan is joined by a shuffle.
BROADCAST_ENTRIES = 200_000

Pattern = tuple[tuple[int, int], ...]  # (length, how many of it), in the order of places


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Fix dominating sets with the largest pieces; returns them and the counts that remain.

    A set with the largest piece ``w`` dominates when any other set with ``w`` can be exchanged for
    it without needing more sequences: each of the other's members fits, together with others or
    alone, where one of this set's members was. Decided are the cases that nothing else fits, that one
    piece fills the rest exactly, that at most one more piece fits, and that at most two more fit
    and the best pair or single piece is as large as all alternatives.
    """
    left = dict(counts)
    sizes = sorted(k for k, v in left.items() if v > 0)
    fixed: list[tuple[Pattern, int]] = []

    def fix(pattern: Pattern, times: int) -> None:
        fixed.append((pattern, times))
        for length, k in pattern:
            left[length] -= k * times
            if not left[length]:
                del sizes[bisect_left(sizes, length)]

    def smallest(n: int) -> int:
        """Sum of the n smallest pieces that remain; more than fits if there are not as many."""
        total = 0
        for s in sizes:
            take = min(n, left[s])
            total, n = total + take * s, n - take
            if not n:
                return total
        return capacity + 1

    for w in sorted(sizes, reverse=True):
        while left.get(w, 0):
            rest = capacity - w
            left[w] -= 1  # one copy is being placed
            usable = [s for s in sizes if s <= rest and left[s]]
            best, two, three = (usable[-1] if usable else 0), smallest(2), smallest(3)
            left[w] += 1
            if not usable:
                fix(((w, 1),), left[w])
                continue
            if best == w:
                exact = best == rest
                if exact:
                    if left[w] >= 2:
                        fix(((w, 2),), left[w] // 2)
                        continue
                break  # several of the largest fit together: left to best fit
            if best == rest or two > rest:
                fix(((w, 1), (best, 1)), min(left[w], left[best]) if best == rest else 1)
                continue
            if three > rest:
                room = rest - best
                second = [s for s in usable if s <= room and left[s] - (s == best)]
                pair = _largest_pair(usable, left, rest)
                if best >= pair:
                    fix(((w, 1), (best, 1)), 1)
                    continue
                # (best, s): pairs with both members above s must fit into best alone.
                s = second[-1] if second else 0
                above = [x for x in usable if x > s]
                if s and s < best and (not above or _smallest_pair(above, left) > rest):
                    fix(((w, 1), (best, 1), (s, 1)), 1)
                    continue
            break
    return fixed, {k: v for k, v in left.items() if v}


def _largest_pair(usable: list[int], left: dict[int, int], rest: int) -> int:
    """The largest sum of two pieces that is at most ``rest``."""
    most, i, j = 0, 0, len(usable) - 1
    while i <= j:
        total = usable[i] + usable[j]
        if total > rest or (i == j and left[usable[i]] < 2):
            j -= 1
        else:
            most, i = max(most, total), i + 1
    return most


def _smallest_pair(sizes: list[int], left: dict[int, int]) -> int:
    if left[sizes[0]] >= 2:
        return 2 * sizes[0]
    return sizes[0] + sizes[1] if len(sizes) > 1 else 1 << 62


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit of all pieces, longest first, over groups of equally filled sequences.

    Piece by piece, each goes to the fullest sequence that has room for it. A sequence that took one
    of a length is then the fullest for the next one, so it takes as many as fit before another does.
    """
    open_by_room: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, times: int) -> None:
        if not times:
            return
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((pattern, times))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            at = bisect_left(rooms, w)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room], rooms[at]
            else:
                room, pattern, times = capacity, (), -(-n // (capacity // w))
            fit = room // w
            whole = min(times, n // fit)
            put(room - fit * w, (*pattern, (w, fit)), whole)
            n -= whole * fit
            times -= whole
            if times and n:
                put(room - n * w, (*pattern, (w, n)), 1)
                n, times = 0, times - 1
            if pattern:
                put(room, pattern, times)
    return [entry for groups in open_by_room.values() for entry in groups]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Which lengths share a sequence and how often; pieces as long as a sequence are alone."""
    whole = counts.get(capacity, 0)
    fixed, rest = reduce_instance({k: v for k, v in counts.items() if 0 < k < capacity and v}, capacity)
    return [*([(((capacity, 1),), whole)] if whole else []), *fixed, *best_fit(rest, capacity)]


def plan_entries(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, copies in a sequence, first sequence, offset of the first copy)."""
    used: dict[int, int] = {}
    entries, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, k in pattern:
            first = used.get(length, 0)
            used[length] = first + k * times
            entries.append((length, first, used[length], k, sequence, offset))
            offset += k * length
        sequence += times
    return entries


def pack(pieces: DataFrame, capacity: int, key: tuple[str, ...] = ("doc_id", "piece"), length: str = "length") -> DataFrame:
    """All columns of the pieces, with ``sequence_id`` (from 0) and ``offset`` in the sequence.

    Pieces must have lengths from 1 to ``capacity`` (others: an error). The frame is read several times, so
    give one that is stored. Null keys, repeated rows and equal lengths are fine: each row gets its
    own place. No pieces give no rows.
    """
    spark = pieces.sparkSession
    # Equal lengths may be a third of all rows: they are numbered in buckets, by the row's key.
    total = pieces.count()
    buckets = min(65_536, max(64, total // 1_000_000))
    numbered = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)))
    sizes = numbered.groupBy(F.col(length).alias("_length"), F.col("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    # At most ``capacity`` rows, whatever the number of pieces.
    counts = {r["_length"]: r["n"] for r in sizes.groupBy("_length").agg(F.sum("_n").alias("n")).collect()}
    if any(not 1 <= k <= capacity for k in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    entries = plan_entries(plan(counts, capacity))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_length", "_bucket", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy(length, "_bucket").orderBy(*key))
    ranked = (
        numbered.withColumn("_row", within - 1)
        .join(starts.select(F.col("_length").alias(length), "_bucket", "_before"), [length, "_bucket"])
        .withColumn("_rank", F.col("_row") + F.col("_before"))
        .drop("_row", "_before", "_bucket")
    )
    places = spark.createDataFrame(
        pa.table(dict(zip(("_l", "_first", "_end", "_copies", "_sequence", "_offset"), map(lambda c: pa.array(c, pa.int64()), zip(*entries) if entries else [[]] * 6))))
    )
    if len(entries) <= BROADCAST_ENTRIES:
        places = F.broadcast(places)
    nth = F.col("_rank") - F.col("_first")
    return (
        ranked.join(places, (F.col(length) == F.col("_l")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
        .withColumn("sequence_id", F.col("_sequence") + F.floor(nth / F.col("_copies")))
        .withColumn("offset", F.col("_offset") + (nth % F.col("_copies")) * F.col(length))
        .drop("_rank", "_l", "_first", "_end", "_copies", "_sequence", "_offset")
    )


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the first may be shorter, all others are full."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def _piece_batches(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(library_ids(text or "", path).astype("<u4"), np.uint32(end_id))
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    row = (doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))
                    for values, value in zip(out.values(), row):
                        values.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    return run


def pieces_of(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Spans of every document's ids, each document ended by ``end_id``; a null text has that id only.

    Repeated rows give their pieces again; a null doc_id stays null.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _piece_batches(path, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Where each span of every document lies in sequences of at most ``capacity`` tokens."""
    pieces = staged(pieces_of(docs, path, capacity, end_id), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
