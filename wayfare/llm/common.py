"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import reduce, wraps
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import configure, scratch_dir

# ASCII white space; all else belongs to words.
WHITE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (the folder may be on any store Spark reaches)."""
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that further columns with any names cannot clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores in front as it takes to differ from all columns of the frame."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


#: Word tables of the Python workers; see ``releasing``.
TABLES: list[dict] = []


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """Let a worker give back its word tables and buffers when a task ends, as it waits for the next one beside the JVM."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for table in TABLES:
                table.clear()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every system has it
            if trim is not None:
                trim(0)

    return task


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(c: Column) -> Column:
    """The words of a text as an array; null and blank texts have none.

    Texts whose only white space are spaces are split at that character, which is much cheaper than
    by the pattern.
    """
    c = F.coalesce(c, F.lit(""))
    other = reduce(or_, [F.contains(c, F.lit(white)) for white in "\t\n\x0b\x0c\r"])
    return F.array_remove(F.when(other, F.split(c, WHITE)).otherwise(F.split(c, " ")), "")


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 6_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of text (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()])
        group = np.cumsum(sizes) // limit
        starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


#: Words of the bitmap below: 2**18 longs, so what is broadcast has the same size for any input.
BITMAP_WORDS = 1 << 18


def _bit(key: Column) -> tuple[Column, Column]:
    place = F.pmod(key, F.lit(BITMAP_WORDS * 64))
    return F.shiftright(place, 6), place % 64


def _bitmap(wanted: DataFrame, key: str) -> DataFrame:
    word, bit = _bit(F.xxhash64(F.col(key)))
    return (
        wanted.select(word.alias("_word"), bit.cast("int").alias("_b"))
        .groupBy("_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _b)")).alias("_bits"))
    )


def may_be_in(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """Rows whose key may be among the wanted ones: loses none of them and most of the others.

    Keys are hashed into a bitmap of fixed size, which is broadcast. It saves a shuffle of what
    cannot match; if very many keys are wanted, it lets more rows pass, and the join that
    follows is right all the same.
    """
    word, bit = _bit(F.xxhash64(F.col(key)))
    return (
        df.withColumns({"_word": word, "_b": bit.cast("int")})
        .join(F.broadcast(_bitmap(wanted, wanted_key)), "_word")
        .where(F.expr("shiftrightunsigned(_bits, _b) & 1L") == 1)
        .drop("_word", "_b", "_bits")
    )


def parted(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among the wanted ones, rows whose key is not): by the same bitmap; null keys are not."""
    word, bit = _bit(F.xxhash64(F.col(key)))
    marked = df.withColumns({"_word": word, "_b": bit.cast("int")}).join(F.broadcast(_bitmap(wanted, wanted_key)), "_word", "left")
    hit = F.coalesce(F.expr("shiftrightunsigned(_bits, _b) & 1L") == 1, F.lit(False)) & F.col(key).isNotNull()
    return tuple(marked.where(side).drop("_word", "_b", "_bits") for side in (hit, ~hit))
