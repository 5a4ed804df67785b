"""Running totals and dense indexes over a total order, without one big partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cohortkit.operators.sizing import within_broadcast
from cohortkit.session import SINGLE_TASK_ROWS, materialize


def running_totals(
    df: DataFrame,
    order_by: str | Sequence[str],
    totals: dict[str, str],
    within: Sequence[str] = (),
    descending: bool = False,
    n_rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``{new: running sum of old}`` along ``order_by`` inside each ``within`` group.

    ``(within, order_by)`` must be unique, but for rows that add nothing; ``n_rows`` saves counting. A table counted to be small is done
    with one window. A larger one is range partitioned and written, so that each
    row carries the number of its range; the sums of whole ranges (one row per
    range) are added to the running sums inside each range.
    """
    columns = [order_by] if isinstance(order_by, str) else order_by
    order = [F.desc(c) if descending else F.asc(c) for c in columns]
    n_rows = df.count() if n_rows is None else n_rows
    if n_rows <= single_task_rows:
        window = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({new: F.sum(old).over(window) for new, old in totals.items()})

    keys = [F.asc(c) for c in within]
    n_ranges = -(-n_rows // single_task_rows)
    ranged = df.repartitionByRange(n_ranges, *keys, *order).withColumn("__range", F.spark_partition_id())
    ranged = materialize(ranged)
    per_range = ranged.groupBy("__range", *within).agg(
        *[F.sum(old).alias(f"__{new}") for new, old in totals.items()]
    )
    before = Window.partitionBy(*within).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "__range",
        *within,
        *[F.coalesce(F.sum(f"__{new}").over(before), F.lit(0)).alias(f"__{new}") for new in totals],
    )
    inner = Window.partitionBy("__range", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per range, or per range and group that meets in it.
    few = not within and within_broadcast(n_ranges, 64 * n_ranges)
    joined = ranged.join(F.broadcast(offsets) if few else offsets, ["__range", *within])
    summed = joined.withColumns({
        new: F.sum(old).over(inner) + F.col(f"__{new}") for new, old in totals.items()
    })
    return summed.drop("__range", *[f"__{new}" for new in totals])
