"""Measurements in time to one row per stay."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.constants import MINUTES_PER_HOUR, STAY, WINDOW_HOURS
from cohortkit.functions.names import col
from cohortkit.functions.numeric import inside, is_number, outside, present
from cohortkit.operators.running import running_totals
from cohortkit.operators.sizing import small_side
from cohortkit.session import materialize

WIDE_STATS = ("mean", "std", "slope")
# The rows of a key with more are merged by draw before they are brought together.
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000
BY_NAME = "__by_name"


def in_window(df: DataFrame, offset: str, hours: int = WINDOW_HOURS) -> DataFrame:
    """Rows from admission up to ``hours`` later, both ends included."""
    return df.where(inside(col(offset), 0, hours * MINUTES_PER_HOUR))


def usable_ranges(df: DataFrame, ranges: Mapping[str, Sequence[float]]) -> tuple[dict, list[str]]:
    """The ranges that apply to this table, and the names that were skipped."""
    good = {
        c: (r[0], r[1])
        for c, r in ranges.items()
        if c in df.columns and isinstance(r, (list, tuple)) and len(r) == 2
    }
    return good, [c for c in ranges if c not in good]


def blank_outliers(df: DataFrame, ranges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Values strictly outside their range become missing; rows stay."""
    good, _ = usable_ranges(df, ranges)
    return df.withColumns({c: F.when(~outside(col(c), *r), col(c)) for c, r in good.items()}) if good else df


def count_outliers(df: DataFrame, ranges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(column, n_outliers) for every range that applies; one pass."""
    good, _ = usable_ranges(df, ranges)
    if not good:
        return df.sparkSession.createDataFrame([], "column STRING, n_outliers LONG")
    counts = df.agg(*[F.count_if(outside(col(c), *r)).alias(c) for c, r in good.items()])
    return counts.unpivot([], [col(c) for c in good], "column", "n_outliers")


def measurement_columns(
    df: DataFrame, key: str, time: str, value_cols: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> list[str]:
    """The given columns, or every numeric one except key and time."""
    if value_cols is not None:
        return list(value_cols)
    skip = {key, time, *exclude}
    return [f.name for f in df.schema.fields if f.name not in skip and is_number(f.dataType)]


def slope(value: Column, time: Column) -> Column:
    """Aggregate: change per minute from the first to the last present value.

    Equal first times take the smallest value, equal last times the largest, so
    the result does not depend on row order. The state per key is two (time, value)
    pairs, however many rows a key has; pairs do not fit a hash aggregate, so Spark sorts
    the rows of a task by key before it merges them. That was measured to take half the
    time of merging by (key, time) first, which moves nearly every row.
    """
    point = F.when(value.isNotNull() & time.isNotNull(), F.struct(time.alias("t"), value.alias("v")))
    first, last = F.min(point), F.max(point)
    return F.try_divide(last["v"] - first["v"], (last["t"] - first["t"]).cast("double"))


def _statistics(name: str, stats: Sequence[str], time: str) -> list[Column]:
    value = present(col(name))
    build = {
        "mean": lambda: F.avg(value),
        "std": lambda: F.stddev_samp(value),
        "slope": lambda: slope(value, col(time)),
    }
    return [build[s]().alias(f"{name}_{s}") for s in stats]


def aggregate_wide(
    df: DataFrame,
    key: str = STAY,
    time: str = "observationoffset",
    value_cols: Sequence[str] | None = None,
    stats: Sequence[str] = WIDE_STATS,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """One row per key with the statistics of every measurement column.

    One shuffle on the key for all columns, after a partial aggregate.
    """
    columns = measurement_columns(df, key, time, value_cols, exclude)
    if not columns:
        return df.select(key).where(col(key).isNotNull()).distinct()
    aggregates = [a for c in columns for a in _statistics(c, stats, time)]
    return df.where(col(key).isNotNull()).groupBy(key).agg(*aggregates)


def mean_per_draw(
    df: DataFrame,
    key: str = STAY,
    name: str = "labname",
    value: str = "labresult",
    time: str = "labresultoffset",
) -> DataFrame:
    """Repeated results of one draw averaged to one value."""
    there = [col(c).isNotNull() for c in (key, name, time)]
    rows = df.where(there[0] & there[1] & there[2] & present(col(value)).isNotNull())
    return rows.groupBy(key, time, name).agg(F.avg(value).alias("value"))


def aggregate_long(
    df: DataFrame,
    key: str = STAY,
    name: str = "labname",
    value: str = "labresult",
    time: str = "labresultoffset",
) -> DataFrame:
    """(key, name, mean, std) over the per-draw means, still long."""
    draws = mean_per_draw(df, key, name, value, time)
    return draws.groupBy(key, name).agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )


def statistics_by_key(
    df: DataFrame,
    key: str = STAY,
    name: str = "labname",
    value: str = "labresult",
    time: str = "labresultoffset",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(key, BY_NAME): the statistics of :func:`aggregate_long` as one map a key.

    The rows are brought together by key once; draws, statistics and map are then made
    where they are, and a join on the key needs no further shuffle of this side. Keys with
    more than ``hot_rows`` rows are counted first; their rows are merged by draw before
    they move, so that no task gets all rows of a key.
    """
    there = [col(c).isNotNull() for c in (key, name, time)]
    rows = df.where(there[0] & there[1] & there[2] & present(col(value)).isNotNull()).select(
        col(key), col(time).alias("__time"), col(name).alias("__name"), present(col(value)).alias("__sum"), F.lit(1).cast("long").alias("__n"))
    hot = rows.groupBy(col(key)).agg(F.sum("__n").alias("__rows")).where(F.col("__rows") > hot_rows).select(col(key))
    # At most one in hot_rows rows; usually there is none.
    found = hot.limit(HOT_KEYS + 1).collect()
    if found:
        few = len(found) <= HOT_KEYS
        side = F.broadcast(df.sparkSession.createDataFrame(found, hot.schema)) if few else small_side(materialize(hot))
        merged = rows.join(side, key, "left_semi").groupBy(col(key), "__time", "__name").agg(
            F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
        rows = rows.join(side, key, "left_anti").unionByName(merged)
    draws = rows.repartition(col(key)).groupBy(col(key), "__time", "__name").agg(
        (F.sum("__sum") / F.sum("__n")).alias("value"))
    long = draws.groupBy(col(key), "__name").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    entry = F.struct("__name", F.struct("mean", "std"))
    return long.groupBy(col(key)).agg(F.map_from_entries(F.collect_list(entry)).alias(BY_NAME))


def spread_statistics(df: DataFrame, prefix: str = "lab_") -> DataFrame:
    """The map of :func:`statistics_by_key` as columns ``{prefix}{name}_{mean,std}``, by name.

    ``df`` is read twice: pass a written table.
    """
    names = attribute_names(df.select(F.explode(F.map_keys(BY_NAME)).alias("name")), "name")
    others = [col(c) for c in df.columns if c != BY_NAME]
    return df.select(*others, *[F.col(BY_NAME)[n][s].alias(f"{prefix}{n}_{s}") for n in names for s in ("mean", "std")])


def attribute_names(long: DataFrame, name: str = "labname") -> list[str]:
    """Sorted distinct names. They become columns; data with too many names for that stays
    long (``aggregate_long``), or the caller gives ``pivot_statistics`` the names wanted."""
    names = [r[0] for r in long.select(name).distinct().collect()]
    if long.sparkSession.conf.get("spark.sql.caseSensitive") != "true":
        times = Counter(n.lower() for n in names)
        clash = sorted(n for n in names if times[n.lower()] > 1)
        if clash:
            raise ValueError(f"names differ only in case, set spark.sql.caseSensitive: {clash}")
    return sorted(names)


def pivot_statistics(
    long: DataFrame,
    names: Sequence[str],
    key: str = STAY,
    name: str = "labname",
    prefix: str = "lab_",
) -> DataFrame:
    """Long statistics to one row per key: ``lab_{name}_{mean,std}``, by name.

    The narrow rows are brought together by key first; there is at most one per name,
    so no key is hot. A pivot before that would send a row as wide as all names for
    every key a task saw. The names of a key are then looked up in a small map, which
    takes half the time of comparing each row with each name.
    """
    entry = F.struct(col(name), F.struct("mean", "std"))
    maps = long.repartition(col(key)).groupBy(key).agg(
        F.map_from_entries(F.collect_list(entry)).alias("__by_name")
    )
    return maps.select(col(key), *[
        F.col("__by_name")[n][s].alias(f"{prefix}{n}_{s}") for n in names for s in ("mean", "std")
    ])


def sparse_statistics(
    long: DataFrame, key: str = STAY, name: str = "labname", prefix: str = "lab"
) -> tuple[DataFrame, DataFrame]:
    """Long statistics as lists instead of columns, for any number of names.

    First (name, index), the names numbered from 0 in code point order; then one row a key:
    ``{prefix}_indices`` (ascending), ``{prefix}_means`` and ``{prefix}_stds`` of the names it has. The
    names stay on the executors; a small table of them is broadcast.
    """
    long = materialize(long)
    names = materialize(long.select(col(name)).distinct().withColumn("__one", F.lit(1).cast("long")))
    dictionary = materialize(running_totals(names, name, {"__upto": "__one"}).select(
        col(name), (F.col("__upto") - 1).cast("int").alias("index")))
    entry = F.sort_array(F.collect_list(F.struct("index", "mean", "std")))
    lists = long.join(small_side(dictionary), name).groupBy(col(key)).agg(entry.alias("__held"))
    return dictionary, lists.select(col(key), *[
        F.col("__held")[part].alias(f"{prefix}_{out}") for part, out in (("index", "indices"), ("mean", "means"), ("std", "stds"))])


def aggregate_and_pivot(
    df: DataFrame,
    key: str = STAY,
    name: str = "labname",
    value: str = "labresult",
    time: str = "labresultoffset",
    within: DataFrame | None = None,
    prefix: str = "lab_",
) -> DataFrame:
    """Long measurements to one wide row per key; names are found first.

    ``within`` keeps only keys of that table. The restriction is on the grouping
    key, so it is made on the reduced rows rather than on the raw ones.
    """
    long = aggregate_long(df, key, name, value, time)
    if within is not None:
        long = long.join(within.select(key).distinct(), key, "left_semi")
    long = materialize(long)
    names = attribute_names(long, name)
    if not names:
        return long.select(key).distinct()
    return pivot_statistics(long, names, key, name, prefix)


def join_features(
    wide: DataFrame, pivoted: DataFrame, key: str = STAY, how: str = "left"
) -> DataFrame:
    """Wide and pivoted features side by side.

    ``left`` keeps keys that have wide measurements, ``full`` keeps all keys.
    """
    if how not in ("left", "full"):
        raise ValueError(f"unknown feature join: {how}")
    return wide.join(pivoted, key, how)
