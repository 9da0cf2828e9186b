"""Loading only what is new, and folding new versions into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.keyed import latest_by

EPOCH = "1970-01-01 00:00:00"


def after_high_water(source: DataFrame, target: DataFrame, column: str = "loaded_at", inclusive: bool = False) -> DataFrame:
    """Rows of ``source`` newer than anything in ``target``; all of them if it is empty.

    ``inclusive`` also takes rows as new as the mark and rows without a time, for targets into which a row may be folded twice.
    Rows that arrive late, with an older time, are never taken: where that happens, ask a ``Ledger`` for new loads instead.
    The mark is a scalar subquery, so it is evaluated once and pushed into the source scan.
    """
    epoch = F.lit(EPOCH).cast(source.schema[column].dataType)
    mark = target.agg(F.coalesce(F.max(column), epoch)).scalar()
    return source.where(F.col(column).isNull() | (F.col(column) >= mark)) if inclusive else source.where(F.col(column) > mark)


def upsert_latest(
    target: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """The keyed table after the new versions came in: per key, the newest of both sides."""
    return latest_by(target.unionByName(new.select(*target.columns)), keys, version)
