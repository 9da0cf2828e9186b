"""Keyed tables in hash buckets: an upsert reads and writes only the buckets that its keys fall into."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.keyed import UNORDERED, latest_by
from wayfare.operators.rows import union_all
from wayfare.sinks import files

BUCKET = "bucket"


@dataclass(frozen=True)
class KeyedTable:
    """A table with one row per key, its newest version, below ``path`` in ``bucket=<n>`` folders.

    The number of buckets is that of the table for good; a bucket should be what a task can sort, some hundred megabytes.
    Newest is what ``latest_by`` takes: the greatest ``version`` columns, ties by the remaining columns.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    version: tuple[str, ...]
    buckets: int = 64

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rank(self, row: str = "") -> Column:
        others = [f.name for f in self.schema if f.name not in (*self.keys, *self.version) and not isinstance(f.dataType, UNORDERED)]
        return F.struct(*[F.col(f"{row}{name}") for name in (*self.version, *others)])

    def _read(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame:
        """Rows with their bucket; if some buckets are named, only their folders are read.

        Buckets that an upsert has made and not yet put in place are read where they are.
        """
        full = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        fresh = {name: f"{self.run_folder(run)}/buckets" for run in self._pending(spark) for name in self._buckets_in(spark, f"{self.run_folder(run)}/buckets")}
        placed = [name for name in self._buckets_in(spark, self.path) if name not in fresh]
        parts = []
        for base in dict.fromkeys([self.path, *fresh.values()]):
            names = placed if base == self.path else [name for name in fresh if fresh[name] == base]
            if names:
                rows = spark.read.schema(full).parquet(base)
                # The planner prunes the folders; without anything pending, all that are there count.
                parts.append(rows.where(F.col(BUCKET).isin([int(name.partition("=")[2]) for name in names])) if fresh else rows)
        found = union_all(*parts) if parts else spark.createDataFrame([], full)
        return found if only is None else found.where(F.col(BUCKET).isin(list(only)))

    def _buckets_in(self, spark: SparkSession, folder: str) -> list[str]:
        return [name for name in files.names_in(spark, folder) if name.startswith(f"{BUCKET}=")]

    def _pending(self, spark: SparkSession) -> list[str]:
        """Runs that are putting buckets in place, or broke off doing so; one at most."""
        return files.names_in(spark, f"{self.path.rstrip('/')}.pending")

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read(spark).select(*self.columns)

    def run_folder(self, run: str) -> str:
        return f"{self.path.rstrip('/')}.runs/{run}"

    def upsert(self, new: DataFrame, run: str) -> DataFrame:
        """Fold new versions into the table and return what changed: ``before`` (null for a new key) and ``after``, as structs.

        The run's name makes the upsert repeatable: each step whose result is complete is not done again, so that a
        run that broke off anywhere goes on there, and one that is through changes nothing any more. New versions are reduced to one
        per key first, each task by itself, so a hot key costs one row per task.
        """
        spark, base = new.sparkSession, self.run_folder(run)
        for other in self._pending(spark):  # broke off: its buckets go in place before another run builds on them
            self._finish(spark, other)
        changes, fresh = f"{base}/changes", f"{base}/buckets"
        if not files.is_complete(spark, changes):
            self._find_changes(new, f"{base}/newest", changes)
        found = self.changes(spark, run)
        if not files.is_complete(spark, f"{base}/merged"):
            if not files.is_complete(spark, fresh):
                self._merge(found, fresh)
            files.make(spark, f"{self.path.rstrip('/')}.pending/{run}")
            self._finish(spark, run)
        return found

    def _finish(self, spark: SparkSession, run: str) -> None:
        """Put the run's buckets in place; whatever was done of it already is left."""
        base = self.run_folder(run)
        self._replace(spark, f"{base}/buckets")
        spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("overwrite").parquet(f"{base}/merged")
        files.remove(spark, f"{self.path.rstrip('/')}.pending/{run}")

    def changes(self, spark: SparkSession, run: str) -> DataFrame:
        """What a run changed, read back: bucket, before, after."""
        row = T.StructType(self.schema.fields)
        kept = T.StructType([T.StructField(BUCKET, T.IntegerType()), T.StructField("before", row), T.StructField("after", row)])
        return spark.read.schema(kept).parquet(f"{self.run_folder(run)}/changes")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the rows fall into: at most as many numbers as the table has buckets."""
        return sorted(r[BUCKET] for r in rows.select(BUCKET).distinct().collect())

    def _find_changes(self, new: DataFrame, newest: str, changes: str) -> None:
        spark = new.sparkSession
        first = latest_by(new.select(*self.columns), list(self.keys), list(self.version))
        first.select("*", self.bucket().alias(BUCKET)).write.mode("overwrite").parquet(newest)
        incoming = spark.read.parquet(newest)
        old = self._read(spark, self.touched(incoming)).select(
            *[F.col(k).alias(f"_k{n}") for n, k in enumerate(self.keys)], F.col(BUCKET).alias("_b"), F.struct(*self.columns).alias("before")
        )
        same = F.col(BUCKET) == F.col("_b")
        for n, key in enumerate(self.keys):
            same = same & F.col(key).eqNullSafe(F.col(f"_k{n}"))
        wins = F.col("before").isNull() | (self._rank() > self._rank("before."))
        found = incoming.join(old, same, "left").where(wins)
        found.select(BUCKET, "before", F.struct(*self.columns).alias("after")).write.mode("overwrite").parquet(changes)

    def _merge(self, changes: DataFrame, fresh: str) -> None:
        spark = changes.sparkSession
        old = self._read(spark, self.touched(changes))
        gone = changes.where("before is not null").select(F.col(BUCKET).alias("_b"), *[F.col(f"after.{k}").alias(f"_k{n}") for n, k in enumerate(self.keys)])
        same = F.col(BUCKET) == F.col("_b")
        for n, key in enumerate(self.keys):
            same = same & F.col(key).eqNullSafe(F.col(f"_k{n}"))
        stays = old.join(gone, same, "left_anti")
        merged = stays.unionByName(changes.select("after.*", BUCKET))
        merged.repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys).write.mode("overwrite").partitionBy(BUCKET).parquet(fresh)

    def _replace(self, spark: SparkSession, fresh: str) -> None:
        """Put the fresh buckets in the place of the old ones, one after the other; can be done again from anywhere."""
        for name in self._buckets_in(spark, fresh):
            files.remove(spark, f"{self.path.rstrip('/')}/{name}")
            files.move(spark, f"{fresh}/{name}", f"{self.path.rstrip('/')}/{name}")
