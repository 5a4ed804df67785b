"""Exact quantiles of whole columns without gathering a column in one task.

A small column is read exactly at once. A large one is first narrowed: a quantile
sketch names a value a little below and a little above the wanted rank, one
counting pass over all values says how many lie before the two, and the search
goes on between them. Each round leaves about a hundredth of the values, so a
billion values need two rounds. Only the last bracket, whose size was counted, is
sorted. The sketch decides only how fast the search is; the counts are exact.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from cohortkit.functions.names import col
from cohortkit.functions.numeric import present

# A bracket of at most this many values is sorted as it is.
BRACKET_ROWS = 1_000_000
_SKETCH_SIZE = 2_000
_SLACK = 0.004
# Sketches of many input partitions are merged in this many tasks, then in one.
_MERGE_TASKS = 256


@dataclass
class _Search:
    """Where one rank of one column is still to be found: low < value < high."""

    column: str
    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def range_key(self) -> tuple:
        return (self.column, self.low, self.high, self.below)

    def place(self, a: float, b: float, lt_a: int, le_a: int, lt_b: int, le_b: int) -> None:
        """Use the counts of values below (and up to) the bounds a and b."""
        if lt_a <= self.rank < le_a:
            self.answer = a
        elif lt_b <= self.rank < le_b:
            self.answer = b
        elif le_a <= self.rank < lt_b:
            self.low, self.high, self.below, self.inside = a, b, le_a, lt_b - le_a
        elif self.rank < lt_a:
            # The bounds missed the rank: keep the part before them.
            self.high, self.inside = a, lt_a - self.below
        else:
            self.inside = self.below + self.inside - le_b
            self.low, self.below = b, le_b

    def open_range(self) -> Column:
        value = present(col(self.column))
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value > F.lit(self.low))
        if self.high is not None:
            test = test & (value < F.lit(self.high))
        return test


def _shared_brackets(searches: Sequence[_Search]) -> list[list[_Search]]:
    """Searches of close ranks in the same open range; they use the same two bounds."""
    shared: list[list[_Search]] = []
    for s in sorted(searches, key=lambda s: (s.column, s.below, s.rank)):
        first = shared[-1][0] if shared else None
        if first and first.range_key() == s.range_key() and s.rank - first.rank <= _SLACK * s.inside:
            shared[-1].append(s)
        else:
            shared.append([s])
    return shared


def _sketched_bounds(df: DataFrame, brackets: Sequence[Sequence[_Search]]) -> list[tuple[float, float]]:
    """A value a little below and a little above the ranks of each bracket; one pass."""
    ranges = {group[0].range_key(): group[0] for group in brackets}
    names = {key: f"k{i}" for i, key in enumerate(ranges)}
    sketches = [
        F.kll_sketch_agg_double(
            F.when(s.open_range(), present(col(s.column))), F.lit(_SKETCH_SIZE)
        ).alias(names[key])
        for key, s in ranges.items()
    ]
    points = []
    for group in brackets:
        low, high = ((s.rank - s.below + 0.5) / s.inside for s in (group[0], group[-1]))
        around = F.array(F.lit(max(0.0, low - _SLACK)), F.lit(min(1.0, high + _SLACK)))
        points.append(F.kll_sketch_get_quantile_double(names[group[0].range_key()], around))
    per_task = df.groupBy((F.spark_partition_id() % _MERGE_TASKS).alias("task")).agg(*sketches)
    merged = per_task.agg(*[F.kll_merge_agg_double(n).alias(n) for n in names.values()])
    row = merged.select(*[p.alias(f"b{i}") for i, p in enumerate(points)]).first()
    return [tuple(row[f"b{i}"]) for i in range(len(brackets))]


def _narrow(df: DataFrame, searches: Sequence[_Search]) -> None:
    """One round for all open searches: a sketch pass, then a counting pass."""
    brackets = _shared_brackets(searches)
    bounds = _sketched_bounds(df, brackets)
    counts = []
    for i, (group, (a, b)) in enumerate(zip(brackets, bounds)):
        value = present(col(group[0].column))
        for name, test in (
            ("lt_a", value < F.lit(a)), ("le_a", value <= F.lit(a)),
            ("lt_b", value < F.lit(b)), ("le_b", value <= F.lit(b)),
        ):
            counts.append(F.count_if(test).alias(f"{name}{i}"))
    seen = df.agg(*counts).first()
    for i, (group, (a, b)) in enumerate(zip(brackets, bounds)):
        for s in group:
            s.place(a, b, *(seen[f"{n}{i}"] for n in ("lt_a", "le_a", "lt_b", "le_b")))


def _finish(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Read the ranks from the remaining brackets, one sort per bracket."""
    brackets: dict[tuple, list[_Search]] = {}
    for s in searches:
        brackets.setdefault(s.range_key(), []).append(s)
    groups = list(brackets.values())
    entries = [
        F.struct(
            F.lit(g).alias("bracket"),
            F.when(group[0].open_range(), present(col(group[0].column))).alias("value"),
        )
        for g, group in enumerate(groups)
    ]
    values = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())
    counted = values.groupBy("bracket", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("bracket").orderBy("value"))
    # The wanted ranks, a few of each bracket, are part of the plan.
    wanted = F.create_map(*[
        x for g, group in enumerate(groups)
        for x in (F.lit(g), F.array(*[F.lit(r).cast("long") for r in sorted({s.rank - s.below for s in group})]))])
    covered = F.filter(wanted[F.col("bracket")], lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    hits = counted.withColumn("upto", upto).select("bracket", "value", F.explode(covered).alias("rank"))
    found = {(r["bracket"], r["rank"]): r["value"] for r in hits.select("bracket", "rank", "value").collect()}
    for g, group in enumerate(groups):
        for s in group:
            s.answer = found[(g, s.rank - s.below)]


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int],
    bracket_rows: int = BRACKET_ROWS,
) -> dict[tuple[str, int], float]:
    """{(column, rank): value}, rank 0 the smallest present value.

    ``counts`` holds the number of present values of each column.
    """
    searches = [
        _Search(column, rank, 0, counts[column]) for column, rs in ranks.items() for rank in sorted(set(rs))
    ]
    if not searches:
        return {}
    while open_ := [s for s in searches if s.answer is None and s.inside > bracket_rows]:
        _narrow(df, open_)
    rest = [s for s in searches if s.answer is None]
    if rest:
        _finish(df, rest)
    return {(s.column, s.rank): s.answer for s in searches}


def order_statistic(df: DataFrame, column: str, rank: int, count: int, ends: tuple | None = None) -> int | float:
    """The value of one rank, exact for LONG too. A DOUBLE holds whole numbers of 53 bits: where
    the smallest and the largest value (``ends``) are no further apart, distances from the
    smallest are searched; else the upper and the lower 32 bits one after the other."""
    if not isinstance(df.schema[column].dataType, T.IntegralType):
        return order_statistics(df, {column: [rank]}, {column: count})[(column, rank)]
    value = col(column).cast("long")
    if ends and ends[1] - ends[0] < 1 << 53:
        apart = df.select((value - F.lit(ends[0])).cast("double").alias("apart"))
        return ends[0] + int(order_statistics(apart, {"apart": [rank]}, {"apart": count})[("apart", rank)])
    halves = df.select(F.shiftright(value, 32).alias("high"), value.bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"))
    high = int(order_statistics(halves, {"high": [rank]}, {"high": count})[("high", rank)])
    seen = halves.agg(F.count_if(F.col("high") < high).alias("below"), F.count_if(F.col("high") == high).alias("n")).first()
    rank -= seen["below"]
    low = order_statistics(halves.where(F.col("high") == high), {"low": [rank]}, {"low": seen["n"]})[("low", rank)]
    return (high << 32) + int(low)


def present_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    if not columns:
        return {}
    row = df.agg(*[F.count(present(col(c))).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"c{i}"] for i, c in enumerate(columns)}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    counts: Mapping[str, int] | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[str, dict[float, float | None]]:
    """{column: {p: value}} with linear interpolation; missing values are left out.

    ``df`` is read several times: pass a written table when it is costly to make.
    """
    counts = counts if counts is not None else present_counts(df, columns)
    places = {
        c: {p: p * (counts[c] - 1) for p in probabilities} for c in columns if counts[c] > 0
    }
    ranks = {
        c: sorted({r for place in by_p.values() for r in (math.floor(place), math.ceil(place))})
        for c, by_p in places.items()
    }
    found = order_statistics(df, ranks, counts, bracket_rows)
    result: dict[str, dict[float, float | None]] = {c: dict.fromkeys(probabilities) for c in columns}
    for c, by_p in places.items():
        for p, place in by_p.items():
            low, high = found[(c, math.floor(place))], found[(c, math.ceil(place))]
            result[c][p] = low + (high - low) * (place - math.floor(place))
    return result
