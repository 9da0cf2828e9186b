"""Raw tables filed load by load: below the day of the load, sorted by key inside.

A load is one delivery: an ingestion run, a batch of a stream. It becomes visible as a whole when
it is published, and is filed only once. Readers that ask for some days or some loads read only the
folders of these, as both are partition columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from wayfare.sinks import files

PUBLISHED = "load_day date, load_id string, rows long"
_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def write_load(df: DataFrame, path: str, load_id: str, load_day: date | str, keys: Sequence[str] = ()) -> bool:
    """File a load and publish it; returns whether there was anything to do.

    A load that is published already stays as it is, whatever ``df`` holds. One whose filing broke off is
    filed again from the start; until then, none of its rows can be read.
    """
    if not _SAFE.fullmatch(load_id):
        raise ValueError(f"{load_id!r} is no load id: letters, digits, dots, dashes and underscores")
    spark, base = df.sparkSession, path.rstrip("/")
    mark = f"{base}.published/{load_id}"
    if files.is_complete(spark, mark):
        return False
    folder = f"{base}/load_day={load_day}/load_id={load_id}"
    (df.sortWithinPartitions(*keys) if keys else df).write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder).count()
    published = spark.createDataFrame([(date.fromisoformat(str(load_day)), load_id, rows)], PUBLISHED)
    published.coalesce(1).write.mode("overwrite").parquet(mark)
    return True


def published_loads(spark: SparkSession, path: str) -> DataFrame:
    """One row per published load: its day, its id and how many rows it has."""
    reader = spark.read.schema(PUBLISHED).option("recursiveFileLookup", True)
    try:
        return reader.parquet(f"{path.rstrip('/')}.published")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED)


def read_loads(spark: SparkSession, path: str, schema: str, loads: DataFrame | None = None) -> DataFrame:
    """Rows of the given loads (all published ones if not stated), with ``load_day`` and ``load_id``.

    The loads prune the folders that are read while the query runs.
    """
    loads = published_loads(spark, path) if loads is None else loads
    full = f"{schema}, load_day date, load_id string"
    try:
        found = spark.read.schema(full).option("basePath", path).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    return found.join(loads.select("load_day", "load_id"), ["load_day", "load_id"], "left_semi").select(*found.columns)
