"""Writing tables as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.sources.schemas import SORT_KEYS

SIMPLE = ("string", "bigint", "int", "double", "date", "timestamp", "timestamp_ntz", "boolean")


def write_append(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> bool:
    """Append a batch; a batch without rows writes nothing. Returns whether rows were written."""
    if df.isEmpty():
        return False
    rows = df.select(*columns) if columns else df
    rows.write.mode("append").parquet(path)
    return True


def write_full_refresh(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Replace a table by the rows of ``df``, which may itself read the table.

    The rows are written beside the table first and swapped in when they are complete.
    """
    mark = uuid.uuid4().hex
    fresh, stale = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    write_sorted(df, fresh, keys) if keys else df.write.parquet(fresh)
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, new, old = (hadoop.Path(name) for name in (path.rstrip("/"), fresh, stale))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    existed = files.exists(target)
    if existed and not files.rename(target, old):
        raise OSError(f"cannot move {path} aside; its rows are still there, the new ones are in {fresh}")
    if not files.rename(new, target):
        back = not existed or files.rename(old, target)
        where = path if back else stale
        raise OSError(f"cannot move the new rows from {fresh} to {path}; the rows before are in {where}")
    if existed:
        files.delete(old, True)


def write_sorted(
    df: DataFrame, path: str, keys: Sequence[str], mode: str = "errorifexists", ranges: bool = False
) -> None:
    """Write a table in its stored sort order, so that row-group statistics prune on the keys.

    Each task sorts its own rows; a table just ranked per key is in that order already and is not
    shuffled again. ``ranges`` also cuts the files by key range, at the price of a shuffle. The
    other columns take part in that cut, so a hot key is spread over several files.
    """
    if ranges:
        spread = [name for name, kind in df.dtypes if name not in keys and kind in SIMPLE]
        df = df.repartitionByRange(*[F.col(name) for name in [*keys, *spread]])
    df.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def write_table(df: DataFrame, name: str, root: str) -> str:
    """Full refresh of a declared table below ``root`` in its stored sort order."""
    path = f"{root.rstrip('/')}/{name}"
    write_full_refresh(df, path, SORT_KEYS[name])
    return path


def write_batch(df: DataFrame, path: str, batch_id: str | int) -> None:
    """Write a micro-batch under its name. Doing it again after a failure replaces it.

    Names must differ between queries, and between a query and the same one after its checkpoint
    was lost: see ``streaming.batches.start``.
    """
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
