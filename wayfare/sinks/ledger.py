"""Which loads a consumer has taken in: nothing lost, nothing twice, whatever the rows' own times say.

A high-water mark skips rows that arrive late or with a time equal to the mark. The ledger asks for the loads that it has no
entry for instead. A run is entered with its loads before it begins and closed when all its results are
written; a run that broke off is taken up again with the same name and the same loads, so that
results filed under the name replace themselves.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sinks import files

ENTRIES = "run string, opened_at timestamp, load_day date, load_id string"


@dataclass(frozen=True)
class Run:
    """A run's name and its loads."""

    name: str
    loads: DataFrame


class Ledger:
    """The ledger of one consumer, as small Parquet folders below ``path``; one run at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self, state: str = "closed") -> DataFrame:
        """The loads of all runs that are ``opened`` or ``closed``."""
        reader = self.spark.read.schema(ENTRIES).option("recursiveFileLookup", True)
        try:
            return reader.parquet(f"{self.path}/{state}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRIES)

    def outstanding(self, published: DataFrame) -> DataFrame:
        """Published loads that no closed run has taken in."""
        return published.join(self.entries().select("load_id"), "load_id", "left_anti").select("load_day", "load_id")

    def open(self, published: DataFrame) -> Run | None:
        """The run that broke off, else a new one with all outstanding loads; None if there are none."""
        closed = set(files.names_in(self.spark, f"{self.path}/closed"))
        for name in files.names_in(self.spark, f"{self.path}/opened"):
            folder = f"{self.path}/opened/{name}"
            if name not in closed and files.is_complete(self.spark, folder):
                return Run(name, self.spark.read.schema(ENTRIES).parquet(folder))
        outstanding = self.outstanding(published)
        if outstanding.isEmpty():
            return None
        name = uuid.uuid4().hex
        folder = f"{self.path}/opened/{name}"
        entered = outstanding.distinct().select(F.lit(name).alias("run"), F.current_timestamp().alias("opened_at"), "load_day", "load_id")
        entered.coalesce(1).write.parquet(folder)
        return Run(name, self.spark.read.schema(ENTRIES).parquet(folder))

    def close(self, run: Run) -> None:
        """Enter that all results of the run are written."""
        run.loads.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/closed/{run.name}")
