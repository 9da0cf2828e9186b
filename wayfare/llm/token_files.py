"""Packed id matrices: best-fit-decreasing with a segment tree over the rooms of open sequences.

Each task packs what it reads, in windows of a set number of tokens, so ids are never shuffled and
memory does not grow with the input; a window ends with a few sequences that are not full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.bpe import library_ids
from wayfare.llm.common import small_batches

#: Tokens that a task packs together. More fill better and need more memory (about 20 bytes each).
WINDOW_TOKENS = 8_000_000


class RoomTree:
    """Open sequences by room: finds the least room that suffices in logarithmic time.

    Leaf ``r`` counts the sequences with room ``r``; an inner node, those below it.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        at = self.leaves + room
        while at:
            self.counts[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """A sequence with the least room of at least ``least``, which is taken out; None if none has it."""
        at = self.leaves + least
        while not self.counts[at]:  # climb until a subtree to the right has one
            while at & 1:
                at >>= 1
                if at <= 1:
                    return None
            if at <= 1:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.counts[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            self.counts[at] -= 1
            at >>= 1
        return room, self.open[room].pop()


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit, longest first: for each sequence, the numbers of the pieces in it, in order."""
    tree, sequences = RoomTree(capacity), []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[k])
        if found is None:
            found = (capacity, len(sequences))
            sequences.append([])
        room, sequence = found
        sequences[sequence].append(k)
        if room > lengths[k]:
            tree.add(room - lengths[k], sequence)
    return sequences


SCHEMA = "doc_ids array<bigint>, starts array<bigint>, cu_seqlens array<int>, input_ids binary, position_ids binary, n_tokens int"


def _pack_batches(path: str, capacity: int, end_id: int, pad_id: int, window: int):
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())), ("input_ids", pa.binary()), ("position_ids", pa.binary()), ("n_tokens", pa.int32())])

    def flush(held: list[tuple[int | None, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sequences = pack_lengths([len(ids) for _, _, ids in held], capacity)
        for first in range(0, len(sequences), 512):
            rows = []
            for members in sequences[first : first + 512]:
                parts = [held[k] for k in members]
                ends = np.cumsum([0, *(len(ids) for _, _, ids in parts)])
                ids = np.full(capacity, pad_id, "<u4")
                places = np.zeros(capacity, "<u4")
                ids[: ends[-1]] = np.concatenate([p for _, _, p in parts])
                places[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
                rows.append(([d for d, _, _ in parts], [s for _, s, _ in parts], ends.tolist(), ids.tobytes(), places.tobytes(), int(ends[-1])))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0
        for batch in small_batches(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(library_ids(text or "", path), np.uint32(end_id))
                held.extend((doc_id, s, ids[s : s + capacity]) for s in range(0, len(ids), capacity))
                tokens += len(ids)
            if tokens >= window:
                yield from flush(held)
                held, tokens = [], 0
        if held:
            yield from flush(held)

    return run


def packed_matrices(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 50256, pad_id: int = 50256, window: int = WINDOW_TOKENS) -> DataFrame:
    """One row per sequence: a row of the id matrix, a row of positions, and the segments' bounds.

    ``input_ids`` and ``position_ids`` hold ``capacity`` unsigned 32-bit little-endian numbers, unused
    places ``pad_id`` and 0. Segment ``k`` is ``cu_seqlens[k]`` to ``cu_seqlens[k + 1]``, holds the ids
    of ``doc_ids[k]`` from its ``starts[k]``, and its positions start from 0. Documents that are longer than a
    sequence are cut losslessly. ``n_tokens`` counts without padding. A document's ids end
    with ``end_id``, so a null or empty text is one token. Null doc_ids stay null, repeated rows are
    packed again, an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack_batches(path, capacity, end_id, pad_id, window), SCHEMA)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Store the matrices as Parquet with fixed-width binary rows, on any store that Spark reaches."""
    packed.write.mode("overwrite").parquet(path)


def restored(packed: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every segment, read back from the matrices without Python."""
    segments = packed.select("input_ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "starts")).alias("k", "segment"))
    first, end = F.col("cu_seqlens")[F.col("k")], F.col("cu_seqlens")[F.col("k") + 1]
    return segments.select(
        F.col("segment.doc_ids").alias("doc_id"),
        F.col("segment.starts").alias("start"),
        F.substring(F.col("input_ids"), first * 4 + 1, (end - first) * 4).alias("ids"),
    )
