"""Mutual information of a number and a class by nearest neighbours, without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortkit.functions.names import col
from cohortkit.functions.numeric import digamma, known, present
from cohortkit.operators.running import running_totals
from cohortkit.operators.sizing import small_side
from cohortkit.session import SINGLE_TASK_ROWS, materialize

_LINE = ["place", "class", "range"]


def _in_ranges(points: DataFrame, range_rows: int) -> tuple[DataFrame, bool]:
    """Points with the number of their range along (place, x), and whether there are several."""
    n_ranges = -(-points.count() // range_rows)
    if n_ranges <= 1:
        return points.withColumn("range", F.lit(0)), False
    ranged = points.repartitionByRange(n_ranges, "place", "x").withColumn("range", F.spark_partition_id())
    return materialize(ranged), True


def _carried(ranged: DataFrame, k: int) -> DataFrame:
    """For each range the k nearest points of the same class before and after it.

    Only the first and last k points of a range can be those, so 2 k rows a range and
    class are moved, however many points there are.
    """
    def ends(order: Column) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*_LINE).orderBy(order))
        few = ranged.withColumn("nth", nth).where(F.col("nth") <= k)
        return few.groupBy(*_LINE).agg(F.collect_list(F.struct("x", "n", "size")).alias("ends"))

    # Each of the k ranges before has at least one point of the class.
    line = Window.partitionBy("place", "class").orderBy("range")
    before = ends(F.desc("x")).withColumn("ends", F.flatten(F.collect_list("ends").over(line.rowsBetween(-k, -1))))
    after = ends(F.asc("x")).withColumn("ends", F.flatten(F.collect_list("ends").over(line.rowsBetween(1, k))))
    near = before.withColumn("ends", F.slice(F.sort_array("ends", False), 1, k)).unionByName(
        after.withColumn("ends", F.slice(F.sort_array("ends"), 1, k)))
    return near.select(*_LINE, F.inline("ends"))


def _radii(ranged: DataFrame, several: bool, k: int) -> DataFrame:
    """Points with the distance of their k-th neighbour of the same class."""
    points = ranged.withColumn("carried", F.lit(False))
    if several:
        points = points.unionByName(_carried(ranged, k).withColumn("carried", F.lit(True)))
    near = F.collect_list(F.struct("x", "n")).over(Window.partitionBy(*_LINE).orderBy("x").rowsBetween(-k, k))
    points = points.withColumn("near", near).where(~F.col("carried"))
    distances = F.array_sort(F.transform("near", lambda p: F.struct(
        F.abs(p["x"] - F.col("x")).alias("d"), (p["n"] - (p["x"] == F.col("x")).cast("long")).alias("n"))))
    wanted = F.least(F.lit(k).cast("long"), F.col("size") - 1)
    none = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("d"))
    radius = F.aggregate(
        distances, none,
        lambda a, p: F.when(a["seen"] >= wanted, a).otherwise(F.struct((a["seen"] + p["n"]).alias("seen"), p["d"].alias("d"))),
        lambda a: a["d"])
    rows = points.select("place", "class", "x", "n", "size", radius.alias("r"), wanted.alias("wanted"))
    # Without distance the neighbours are the points of the same value, however many.
    return rows.withColumn("k", F.when(F.col("r") > 0, F.col("wanted")).otherwise(F.col("n"))).drop("wanted")


def neighbour_information(
    train: DataFrame, columns: Sequence[str], label: str, neighbours: int = 3, range_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """(place, feature, mutual_info) in nats, estimated from nearest neighbours.

    For a row of a class with N_c rows, r is the distance to its ``neighbours``-th nearest row of
    the class (at most N_c - 1) and m the number of rows of any class nearer than r, itself
    included: the estimate is digamma(N) + mean(digamma(k) - digamma(N_c) - digamma(m)),
    not below 0. Where r is 0, k and m count the rows of the same value instead, in the class and in
    all; no noise is added to tell equal values apart. Rows without value or class and
    classes of one row are left out; a column without others has NULL.

    Equal points are merged first. Neighbours are found in ranges of at most about
    ``range_rows`` points, with the nearest points of other ranges carried over the edges; rows
    within the radius are differences of running counts over ranges.
    """
    class_ = known(train, label)
    entries = [F.struct(F.lit(i).alias("place"), (present(col(c)) + F.lit(0.0)).alias("x")) for i, c in enumerate(columns)]
    long = train.where(class_.isNotNull()).select(class_.alias("class"), F.inline(F.array(*entries))).where(F.col("x").isNotNull())
    merged = materialize(long.groupBy("place", "class", "x").agg(F.count(F.lit(1)).alias("n")))
    sizes = merged.groupBy("place", "class").agg(F.sum("n").alias("size")).where(F.col("size") > 1)
    points = merged.join(small_side(sizes), ["place", "class"])
    ranged, several = _in_ranges(points, range_rows)
    found = materialize(_radii(ranged, several, neighbours))

    def event(pos: Column, kind: Column, weight: Column, sign: int) -> Column:
        return F.struct(pos.alias("pos"), kind.alias("kind"), weight.cast("long").alias("weight"), F.lit(sign).alias("sign"))

    # At one position the order is: counts of what is before it, rows, counts up to it.
    far = F.col("r") > 0
    events = found.select("place", "class", "x", "n", "size", "k", F.inline(F.array(
        event(F.col("x"), F.lit(1), F.col("n"), 0),
        event(F.col("x") + F.col("r"), F.when(far, 0).otherwise(2), F.lit(0), 1),
        event(F.col("x") - F.col("r"), F.when(far, 2).otherwise(0), F.lit(0), -1),
    )))
    counted = running_totals(
        events, ["pos", "kind"], {"upto": "weight"}, within=["place"], n_rows=3 * found.count(), single_task_rows=range_rows)
    within = counted.groupBy("place", "class", "x", "n", "size", "k").agg(F.sum(F.col("upto") * F.col("sign")).alias("m"))
    psi = {c: digamma(F.col(c).cast("double")) for c in ("k", "size", "m")}
    sums = within.groupBy("place").agg(
        F.sum("n").cast("double").alias("rows"), F.sum(F.col("n") * (psi["k"] - psi["size"] - psi["m"])).alias("terms"))
    value = F.greatest(digamma(F.col("rows")) + F.col("terms") / F.col("rows"), F.lit(0.0))
    names = train.sparkSession.createDataFrame(list(enumerate(columns)), "place INT, feature STRING")
    return names.join(sums.select("place", value.alias("mutual_info")), "place", "left")
