"""Reading declared tables by name, and JSON landing files under a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sources import schemas


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table in declared order and type; a missing column is an error."""
    declared = schemas.schema(name)
    missing = [field.name for field in declared if field.name not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A declared table from Parquet below ``root``, or from the session catalog."""
    source = spark.read.parquet(f"{root.rstrip('/')}/{name}") if root else spark.table(name)
    return conform(source, name)


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines (or JSON arrays, one file per response) under a fixed schema; nothing inferred."""
    return spark.read.schema(schema).option("allowNonNumericNumbers", False).json(path)
