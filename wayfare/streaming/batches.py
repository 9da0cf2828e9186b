"""What the streaming queries share: starting, retrying, reading back."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

LONGEST_WAIT = 30  # seconds
ATTEMPTS = 6


def with_backoff(
    action: Callable[[], None],
    attempts: int = ATTEMPTS,
    longest: float = LONGEST_WAIT,
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Run a write, waiting 2, 4, 8 ... seconds between attempts; the last failure is raised.

    A raised failure ends the query without committing the batch, so a restart repeats it.
    """
    for attempt in range(1, attempts + 1):
        try:
            action()
            return
        except Exception:
            if attempt == attempts:
                raise
            pause = min(2**attempt, longest)
            log.warning("write failed (attempt %d), next try in %ss", attempt, pause, exc_info=True)
            sleep(pause)


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, str], None],
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    mode: str | None = None,
) -> StreamingQuery:
    """Start a query that hands each micro-batch and its name to ``handle``; progress is kept in ``checkpoint``.

    The name joins the id that the checkpoint gives the query and the number of the batch. A
    repeated batch has the same name; a query with a fresh checkpoint, whose numbers start
    again, has other names and so cannot replace what is stored.
    """

    def named(batch: DataFrame, number: int) -> None:
        handle(batch, f"{query_id(batch.sparkSession, checkpoint)}-{number}")

    writer = stream.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint)
    if mode:
        writer = writer.outputMode(mode)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a started query has stored in its checkpoint."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"]
    return json.loads(text)["id"]


def read_batches(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All rows the micro-batches have written below a path, with their ``batch_id``.

    With a schema, a table that nothing was written to yet is empty.
    """
    reader = spark.read.schema(f"{schema}, batch_id string") if schema else spark.read
    try:
        found = reader.parquet(path)
    except AnalysisException as missing:
        if schema is None or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch_id string")
    return found.withColumn("batch_id", F.col("batch_id").cast("string"))


COUNTERS = "query string, received long, processed long, failed long, dlq long"


def counter_row(spark: SparkSession, query: str, counts: Mapping[str, int]) -> DataFrame:
    """The counters of one batch as a row; what was not counted is 0, as of a batch without rows."""
    names = ("received", "processed", "failed", "dlq")
    return spark.createDataFrame([(query, *(counts.get(name, 0) for name in names))], COUNTERS).coalesce(1)
