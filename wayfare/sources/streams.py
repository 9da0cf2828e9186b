"""Stream sources. ``file`` needs nothing else; ``kafka`` needs the connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sources.schemas import EVENT_AVRO

REGISTRY_HEADER = 5  # bytes before the Avro body: a marker and the schema id


def stream_source(spark: SparkSession, kind: str, **options: str) -> DataFrame:
    """A streaming DataFrame with the message text in ``value``.

    ``kind='file'``: JSON lines below ``path``. ``kind='kafka'``: messages of ``subscribe`` from
    the earliest offset, as JSON text, or as registry-framed Avro with ``encoding='avro'``.
    Other options go to the reader.
    """
    if kind == "file":
        path = options.pop("path")
        return spark.readStream.format("text").options(**options).load(path).select("value")
    if kind == "kafka":
        encoding = options.pop("encoding", "json")
        source = (
            spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**options).load()
        )
        return source.select(_message_text(encoding).alias("value"))
    raise ValueError(f"unknown stream source {kind!r}")


def _message_text(encoding: str):
    if encoding == "json":
        return F.col("value").cast("string")
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring(value, {REGISTRY_HEADER + 1})")
    # An undecodable message becomes an empty object, which validation refuses.
    return F.to_json(from_avro(body, EVENT_AVRO, {"mode": "PERMISSIVE"}))
