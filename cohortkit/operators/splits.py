"""Train/val/test membership by entity, by time or by site.

Members are drawn in the order of ``md5(key|seed)``. Instead of ranking all rows,
the row at the cut is looked up: counts per hash prefix (at most 4,096 per class)
lead to the prefix that holds it, and only the rows under that prefix are ranked.
Membership is then one comparison with the row at the cut, in a projection.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from cohortkit.constants import DEFAULT_SEED, LABEL
from cohortkit.functions.names import col
from cohortkit.functions.numeric import known, ordinal
from cohortkit.functions.text import joined_key
from cohortkit.operators.quantiles import order_statistic
from cohortkit.operators.running import running_totals
from cohortkit.operators.sizing import small_side
from cohortkit.session import materialize
from cohortkit.sources.readers import require_columns
from cohortkit.sources.unique import require_unique

_PREFIX = 3
# A prefix with at most this many rows is ranked in one task.
PREFIX_ROWS = 1_000_000
# Prefix weights of at most this many rows come to the driver, and cuts of at most so many
# classes are written into the plan; more classes are cut by tables on the executors.
DRIVER_ROWS = 300_000
PLAN_CLASSES = 64

Cut = tuple[str, str]


def draw_hash(key: Column, seed: int) -> Column:
    """The draw order of a key: the same on every engine that has md5."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def held_out(counts: Mapping, fraction: float) -> dict:
    """How many of each class are held out.

    In total ``ceil(n * fraction)``. Classes keep their share: whole parts first,
    the rest to the largest remainders of the kept part, ties by class.
    """
    n = sum(counts.values())
    n_out = math.ceil(n * fraction)
    n_kept = n - n_out
    if min(counts.values(), default=0) < 2:
        raise ValueError(f"every class needs at least 2 members: {dict(counts)}")
    if n_out < len(counts) or n_kept < len(counts):
        raise ValueError(f"{n_kept} kept and {n_out} held out cannot cover {len(counts)} classes")
    shares = {c: counts[c] / n * n_kept for c in counts}
    kept = {c: math.floor(s) for c, s in shares.items()}
    extra = n_kept - sum(kept.values())
    for c in sorted(counts, key=lambda c: (kept[c] - shares[c], c))[:extra]:
        kept[c] += 1
    return {c: counts[c] - kept[c] for c in counts}


def _by_prefix(rows: DataFrame, depth: int) -> DataFrame:
    extra = [F.max("n_rows").alias("n_rows")] if "n_rows" in rows.columns else []
    return rows.groupBy("stratum", F.substring("hash", 1, depth).alias("prefix")).agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"), *extra)


def prefix_weights(rows: DataFrame, depth: int = _PREFIX, most: int | None = None) -> list[Row] | None:
    """(stratum, prefix, weight, n) in draw order: at most 4,096 rows per class and level.

    None if there are more than ``most`` of them.
    """
    weights = _by_prefix(rows, depth)
    found = weights.collect() if most is None else weights.limit(most + 1).collect()
    if most is not None and len(found) > most:
        return None
    keyless = sum(r["n"] for r in found if r["prefix"] is None)
    if keyless:
        raise ValueError(f"{keyless} members have no key to draw by")
    return sorted(found, key=lambda r: r["prefix"])


def class_totals(weights: Sequence[Row]) -> dict:
    totals: dict = {}
    for r in weights:
        totals[r["stratum"]] = totals.get(r["stratum"], 0) + r["weight"]
    if None in totals:
        raise ValueError(f"{totals[None]} members have no label to stratify on")
    return totals


@dataclass
class _Place:
    """A place of a class, and the hash prefix that holds it."""

    stratum: object
    place: int
    prefix: str = ""
    before: int = 0
    n: int = 0

    def descend(self, weights: Sequence[Row]) -> bool:
        """Move to the longer prefix that holds the place."""
        for r in weights:
            if r["stratum"] == self.stratum and r["prefix"].startswith(self.prefix):
                if self.before + r["weight"] >= self.place:
                    self.prefix, self.n = r["prefix"], r["n"]
                    return True
                self.before += r["weight"]
        return False


def find_cuts(
    rows: DataFrame,
    places: Mapping[object, Sequence[int]],
    weights: Sequence[Row] | None = None,
    prefix_rows: int = PREFIX_ROWS,
) -> dict[object, dict[int, Cut]]:
    """{class: {place: (hash, key)}}, the row whose running weight covers each place.

    ``rows`` has (stratum, hash, key, weight) with one row per key. Place 1 is the
    first unit of weight in draw order. ``weights`` are the first prefix weights
    when they are known already.
    """
    cuts: dict[object, dict[int, Cut]] = {c: {} for c in places}
    wanted = [_Place(c, p) for c, ps in places.items() for p in set(ps) if p > 0]
    if not wanted:
        return cuts
    type_ = rows.schema["stratum"].dataType.simpleString()
    depth, here = _PREFIX, rows
    weights = weights if weights is not None else prefix_weights(rows)

    def at_places(rows: DataFrame, depth: int) -> DataFrame:
        """The rows under a wanted prefix, one for each place that is wanted there."""
        if len(wanted) <= 2 * PLAN_CLASSES:
            held = F.array(*[
                F.struct(F.lit(w.stratum).cast(type_).alias("w_stratum"), F.lit(w.prefix).alias("w_prefix"),
                         F.lit(w.place).cast("long").alias("place"), F.lit(w.place - w.before).cast("long").alias("rest"))
                for w in wanted])
            prefix = F.substring("hash", 1, depth)
            here = F.filter(held, lambda w: w["w_stratum"].eqNullSafe(F.col("stratum")) & (w["w_prefix"] == prefix))
            few = rows.where(prefix.isin(sorted({w.prefix for w in wanted})))
            return few.select("*", F.inline(here))
        table = rows.sparkSession.createDataFrame(
            [(w.stratum, w.prefix, w.place, w.place - w.before) for w in wanted],
            f"w_stratum {type_}, w_prefix STRING, place LONG, rest LONG")
        same = F.col("stratum").eqNullSafe(F.col("w_stratum")) & (F.substring("hash", 1, depth) == F.col("w_prefix"))
        return rows.join(F.broadcast(table), same)

    while True:
        wanted = [w for w in wanted if w.descend(weights)]
        if not wanted:
            return cuts
        if max(w.n for w in wanted) <= prefix_rows or depth >= 30:
            break
        here = at_places(here, depth).select(*here.columns).distinct()
        depth += _PREFIX
        weights = prefix_weights(here, depth)

    within = Window.partitionBy("w_stratum", "place").orderBy("hash", "key")
    upto = F.sum("weight").over(within.rowsBetween(Window.unboundedPreceding, 0))
    ranked = at_places(here, depth).withColumn("upto", upto)
    covers = (F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("weight") < F.col("rest"))
    for r in ranked.where(covers).select("stratum", "place", "hash", "key").collect():
        cuts[r["stratum"]][r["place"]] = (r["hash"], r["key"])
    return cuts


def find_cut_table(rows: DataFrame, places: DataFrame, prefix_rows: int = PREFIX_ROWS) -> DataFrame:
    """(stratum, place, hash, key) of :func:`find_cuts` for any number of classes.

    ``places`` has (stratum, place). Every round narrows the prefix of each place by a join;
    the driver sees only whether another round is needed. The running weights of a class
    go over at most 4,096 prefixes a round.
    """
    depth, here = _PREFIX, rows
    held = places.where(F.col("place") > 0).select("stratum", "place", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"))
    while True:
        order = Window.partitionBy("stratum", "place").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        weights = _by_prefix(here, depth).withColumn("above", F.expr(f"substring(prefix, 1, {depth - _PREFIX})"))
        wanted = held.withColumnRenamed("prefix", "above")
        upto = F.col("before") + F.sum("weight").over(order)
        each = weights.join(wanted, ["stratum", "above"]).withColumn("upto", upto)
        covers = (F.col("upto") >= F.col("place")) & (F.col("upto") - F.col("weight") < F.col("place"))
        held = materialize(each.where(covers).select(
            "stratum", "place", "prefix", (F.col("upto") - F.col("weight")).alias("before"), "n"))
        largest = held.agg(F.max("n")).first()[0]
        if largest is None or largest <= prefix_rows or depth >= 30:
            break
        under = held.select("stratum", F.col("prefix").alias("__prefix")).distinct()
        near = here.withColumn("__prefix", F.substring("hash", 1, depth)).join(under, ["stratum", "__prefix"], "left_semi")
        here = materialize(near.select(*rows.columns))
        depth += _PREFIX
        held = held.drop("n")
    order = Window.partitionBy("stratum", "place").orderBy("hash", "key").rowsBetween(Window.unboundedPreceding, 0)
    members = here.withColumn("prefix", F.substring("hash", 1, depth))
    ranked = members.join(held.drop("n"), ["stratum", "prefix"]).withColumn("upto", F.col("before") + F.sum("weight").over(order))
    covers = (F.col("upto") >= F.col("place")) & (F.col("upto") - F.col("weight") < F.col("place"))
    return ranked.where(covers).select("stratum", "place", "hash", "key")


def held_out_table(counts: DataFrame, fraction: float) -> DataFrame:
    """(stratum, c, q) of (stratum, c): the numbers of :func:`held_out` for any number of classes."""
    row = counts.agg(F.sum("c").alias("n"), F.min("c").alias("least"), F.count(F.lit(1)).alias("classes"),
                     F.sum(F.when(F.col("stratum").isNull(), F.col("c"))).alias("unlabelled")).first()
    if row["unlabelled"]:
        raise ValueError(f"{row['unlabelled']} members have no label to stratify on")
    n, classes = row["n"] or 0, row["classes"]
    n_out = math.ceil(n * fraction)
    n_kept = n - n_out
    if classes and row["least"] < 2:
        few = [tuple(r) for r in counts.where(F.col("c") < 2).orderBy("stratum").limit(20).collect()]
        raise ValueError(f"every class needs at least 2 members: {few}")
    if n_out < classes or n_kept < classes:
        raise ValueError(f"{n_kept} kept and {n_out} held out cannot cover {classes} classes")
    share = F.col("c") / F.lit(float(n)) * F.lit(float(n_kept))
    shares = materialize(counts.select(
        "stratum", "c", F.floor(share).alias("kept"), (F.floor(share) - share).alias("lost"), F.lit(1).cast("long").alias("one")))
    extra = n_kept - (shares.agg(F.sum("kept")).first()[0] or 0)
    placed = running_totals(shares, ["lost", "stratum"], {"nth": "one"}, n_rows=classes)
    return placed.select("stratum", "c", (F.col("c") - F.col("kept") - (F.col("nth") <= extra).cast("long")).alias("q"))


def _upto(cut: Column | None, hash_: Column, key: Column) -> Column:
    """At or before the cut row in draw order; no cut means nothing is."""
    return F.coalesce(F.struct(hash_.alias("hash"), key.alias("key")) <= cut, F.lit(False))


PAIR = "STRUCT<hash: STRING, key: STRING>"


def _split_of(test: Column, val: Column, hash_: Column, key: Column) -> Column:
    return F.when(_upto(test, hash_, key), "test").when(_upto(val, hash_, key), "val").otherwise("train")


def _draw(rows: DataFrame, cuts: Mapping[object, Mapping[str, Cut | None]] | DataFrame, stratum: str, hash_: Column, key: Column) -> DataFrame:
    """Add ``split`` by comparing each row with the cuts of its class.

    Cuts of few classes are part of the plan; a table of cuts (__stratum, __test, __val) is
    joined, broadcast if it was measured to be small.
    """
    value = known(rows, stratum)
    if isinstance(cuts, DataFrame):
        joined = rows.join(small_side(cuts), value == F.col("__stratum"), "left")
        return joined.withColumn("split", _split_of(F.col("__test"), F.col("__val"), hash_, key)).drop("__stratum", "__test", "__val")

    def cut_of(name: str) -> Column:
        found = F.lit(None).cast(PAIR)
        for c, named in cuts.items():
            if named.get(name):
                pair = F.struct(F.lit(named[name][0]).alias("hash"), F.lit(named[name][1]).alias("key"))
                found = F.when(value == F.lit(c), pair).otherwise(found)
        return found

    return rows.withColumn("split", _split_of(cut_of("test"), cut_of("val"), hash_, key))


def _cuts_of(members: DataFrame, counts: DataFrame, test: DataFrame | None, val: DataFrame | None) -> DataFrame:
    """(__stratum, __test, __val) from the numbers (stratum, q) held out for test and then val."""
    none = counts.select("stratum", F.lit(0).cast("long").alias("q"))
    both = counts.select("stratum").join((test if test is not None else none).select("stratum", F.col("q").alias("t")), "stratum").join(
        (val if val is not None else none).select("stratum", F.col("q").alias("v")), "stratum")
    both = materialize(both.select("stratum", "t", (F.col("t") + F.col("v")).alias("tv")))
    places = both.select("stratum", F.explode(F.array("t", "tv")).alias("place")).distinct()
    cuts = materialize(find_cut_table(members, places)).select("stratum", "place", F.struct("hash", "key").alias("pair"))
    first, second = cuts.withColumnsRenamed({"place": "t", "pair": "__test"}), cuts.withColumnsRenamed({"place": "tv", "pair": "__val"})
    return materialize(both.join(first, ["stratum", "t"], "left").join(second, ["stratum", "tv"], "left").select(
        F.col("stratum").alias("__stratum"), "__test", "__val"))


def _class_sizes(members: DataFrame) -> DataFrame:
    keyless = members.where(F.col("key").isNull()).count()
    if keyless:
        raise ValueError(f"{keyless} members have no key to draw by")
    return materialize(members.groupBy("stratum").agg(F.sum("weight").alias("c")))


def collapse_groups(
    df: DataFrame,
    group_cols: Sequence[str],
    label: str,
    order_key: str | None = None,
    time_col: str | None = None,
) -> DataFrame:
    """One row per group: (group_key, label, n_rows[, time]).

    The label is the first present one by ``order_key``, the time the earliest.
    """
    require_columns(df, [*group_cols, label])
    key = joined_key(*[col(c) for c in group_cols])
    label_ = known(df, label)
    present = label_.isNotNull()
    first = F.min_by(label_, F.when(present, col(order_key))) if order_key else F.min(label_)
    aggregates = [first.alias("label"), F.count(F.lit(1)).alias("n_rows")]
    if time_col:
        aggregates.append(F.min(col(time_col)).alias("time"))
    return df.groupBy(key.alias("group_key")).agg(*aggregates)


def _members(groups: DataFrame, seed: int) -> DataFrame:
    return groups.select(
        "n_rows",
        F.col("label").alias("stratum"),
        draw_hash(F.col("group_key"), seed).alias("hash"),
        F.col("group_key").alias("key"),
        F.lit(1).cast("long").alias("weight"),
    )


def _to_rows(df: DataFrame, groups: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Carry the split of each group to its rows."""
    keyed = df.withColumn("__group", joined_key(*[col(c) for c in group_cols]))
    side = groups.select(F.col("group_key").alias("__group"), "split")
    return keyed.join(side, "__group").drop("__group")


@dataclass
class Split:
    """Rows with ``split``; ``joined`` says that groups were joined to the rows."""

    rows: DataFrame
    cutoff: object = None
    joined: bool = False


def entity_split(
    df: DataFrame,
    train_size: float = 0.7,
    val_size: float = 0.1,
    test_size: float = 0.2,
    stratify_col: str = LABEL,
    group_cols: Sequence[str] = ("patient_id", "site_id"),
    seed: int = DEFAULT_SEED,
    order_key: str | None = None,
) -> Split:
    """Add ``split``: groups stay whole, classes keep their share.

    When every group is one row the split is computed on the rows themselves and
    nothing is joined.
    """
    if abs(train_size + val_size + test_size - 1.0) >= 1e-6:
        raise ValueError("split sizes must sum to 1")
    # Only (key, label, size) of each group is written, not the table.
    groups = materialize(collapse_groups(df, group_cols, stratify_col, order_key))
    members = _members(groups, seed)
    val_share = val_size / (train_size + val_size)
    weights = prefix_weights(members, most=DRIVER_ROWS)
    counts = {} if weights is None else class_totals(weights)
    if weights is None or len(counts) > PLAN_CLASSES:
        sizes = _class_sizes(members)
        test_table = materialize(held_out_table(sizes, test_size))
        rest = test_table.select("stratum", (F.col("c") - F.col("q")).alias("c"))
        val_table = held_out_table(rest, val_share) if val_size > 0 else None
        named = _cuts_of(members.drop("n_rows"), sizes, test_table, val_table)
        most = groups.agg(F.max("n_rows")).first()[0]
    else:
        test = held_out(counts, test_size)
        rest = {c: counts[c] - test[c] for c in counts}
        val = held_out(rest, val_share) if val_size > 0 else dict.fromkeys(counts, 0)
        cuts = find_cuts(members, {c: [test[c], test[c] + val[c]] for c in counts}, weights)
        named = {
            c: {"test": cuts[c].get(test[c]), "val": cuts[c].get(test[c] + val[c])} for c in counts
        }
        most = max((r["n_rows"] for r in weights), default=0)
    if not most or most == 1:
        key = joined_key(*[col(c) for c in group_cols])
        return Split(_draw(df, named, stratify_col, draw_hash(key, seed), key))
    key = F.col("group_key")
    drawn = _draw(groups, named, "label", draw_hash(key, seed), key)
    return Split(_to_rows(df, drawn, group_cols), joined=True)


def split_by_entity(df: DataFrame, *args, **options) -> DataFrame:
    """The rows of :func:`entity_split`."""
    return entity_split(df, *args, **options).rows


def split_by_time(
    df: DataFrame,
    time_col: str = "admission_time",
    test_size: float = 0.2,
    val_size: float = 0.2,
    stratify_col: str = LABEL,
    group_cols: Sequence[str] = ("patient_id", "site_id"),
    seed: int = DEFAULT_SEED,
    order_key: str | None = None,
) -> Split:
    """The latest groups are the test split; the rest is drawn by class.

    The time at the cut is found as an order statistic of the times. Groups with
    exactly that time go in draw order. A group without a time counts as latest.
    """
    require_columns(df, [time_col])
    if dict(df.dtypes)[time_col] == "string":
        df = df.withColumn(time_col, F.to_timestamp(col(time_col)))
    collapsed = collapse_groups(df, group_cols, stratify_col, order_key, time_col)
    dtype = collapsed.schema["time"].dataType
    groups = materialize(collapsed.withColumn("at", ordinal(F.col("time"), dtype)))

    sizes = groups.agg(
        F.count(F.lit(1)).alias("n"), F.count("at").alias("timed"), F.min("at").alias("low"), F.max("at").alias("high")).first()
    cut = int(sizes["n"] * (1 - test_size))
    is_test = F.lit(False)
    cutoff_at = cutoff = None
    if cut < sizes["n"]:
        if cut < sizes["timed"]:
            cutoff_at = order_statistic(groups, "at", cut, sizes["timed"], (sizes["low"], sizes["high"]))
        tied = F.col("at").eqNullSafe(F.lit(cutoff_at).cast(groups.schema["at"].dataType))
        if cutoff_at is None:
            earlier = F.col("at").isNotNull()
        else:
            earlier = F.coalesce(F.col("at") < F.lit(cutoff_at), F.lit(False))
        # The time at the cut is the earliest of the test groups.
        seen = groups.agg(F.count_if(earlier).alias("before"), F.min(F.when(tied, F.col("time"))).alias("time")).first()
        cutoff = seen["time"]
        # These groups share the time at the cut; the first of them stay earlier.
        ties = groups.where(tied).select(
            F.lit(0).alias("stratum"),
            draw_hash(F.col("group_key"), seed).alias("hash"),
            F.col("group_key").alias("key"),
            F.lit(1).cast("long").alias("weight"),
        )
        stay = cut - seen["before"]
        found = find_cuts(ties, {0: [stay]})[0].get(stay) if stay > 0 else None
        kept_tie = F.lit(False)
        if found:
            limit = F.struct(F.lit(found[0]).alias("hash"), F.lit(found[1]).alias("key"))
            key = F.col("group_key")
            kept_tie = tied & _upto(limit, draw_hash(key, seed), key)
        is_test = ~(earlier | kept_tie)
    placed = groups.withColumn("is_test", is_test)
    drawn = _draw_rest(placed, "label", F.col("group_key"), val_size, seed)
    return Split(_to_rows(df, drawn, group_cols), cutoff, joined=True)


def _draw_rest(placed: DataFrame, stratum: str, key: Column, val_size: float, seed: int) -> DataFrame:
    """Rows not in test are drawn into train and val by class."""
    members = placed.where(~F.col("is_test")).select(
        known(placed, stratum).alias("stratum"),
        draw_hash(key, seed).alias("hash"),
        key.alias("key"),
        F.lit(1).cast("long").alias("weight"),
    )
    weights = prefix_weights(members, most=DRIVER_ROWS)
    counts = {} if weights is None else class_totals(weights)
    named: dict | DataFrame = {}
    if weights is None or len(counts) > PLAN_CLASSES:
        sizes = _class_sizes(members)
        named = _cuts_of(members, sizes, None, held_out_table(sizes, val_size) if val_size > 0 else None)
    elif counts and val_size > 0:
        val = held_out(counts, val_size)
        cuts = find_cuts(members, {c: [val[c]] for c in counts}, weights)
        named = {c: {"val": cuts[c].get(val[c])} for c in counts}
    drawn = _draw(placed, named, stratum, draw_hash(key, seed), key)
    split = F.when(F.col("is_test"), "test").otherwise(F.col("split"))
    return drawn.withColumn("split", split).drop("is_test")


def _sites(df: DataFrame, site_col: str) -> DataFrame:
    site = known(df, site_col)
    return df.where(site.isNotNull()).groupBy(site.alias("site")).agg(F.count(F.lit(1)).alias("n_rows"))


def site_counts(df: DataFrame, site_col: str = "site_id") -> DataFrame:
    """(site, n_rows), largest first."""
    return _sites(df, site_col).orderBy(F.desc("n_rows"), "site")


def _site_test(sites: DataFrame, n_rows: int, test_size: float, seed: int, site: Column) -> Column:
    """True for sites drawn into the test split.

    Sites are taken in draw order while those before hold less than the wanted
    number of rows, at least one. That is again one cut, in rows instead of keys.
    """
    key = F.col("site").cast("string")
    members = sites.select(
        F.lit(0).alias("stratum"), draw_hash(key, seed).alias("hash"), key.alias("key"),
        F.col("n_rows").alias("weight"),
    )
    place = max(1, math.ceil(n_rows * test_size))
    found = find_cuts(members, {0: [place]})[0].get(place)
    if found is None:
        # Rows without a site count towards the goal, so all sites may be needed.
        return site.isNotNull()
    limit = F.struct(F.lit(found[0]).alias("hash"), F.lit(found[1]).alias("key"))
    return _upto(limit, draw_hash(site, seed), site.cast("string"))


def select_test_sites(
    df: DataFrame, site_col: str = "site_id", test_size: float = 0.2, seed: int = DEFAULT_SEED
) -> DataFrame:
    """(site, n_rows) of the sites that form the test split."""
    sites = materialize(_sites(df, site_col))
    chosen = _site_test(sites, df.count(), test_size, seed, F.col("site"))
    return sites.where(chosen)


def split_by_site(
    df: DataFrame,
    site_col: str = "site_id",
    test_size: float = 0.2,
    val_size: float = 0.2,
    stratify_col: str = LABEL,
    row_key: str = "patient_id",
    test_sites: Sequence | None = None,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Whole sites form the test split; the other rows are drawn by class.

    ``row_key`` must be unique, which is checked. A row without a site is never in the test split.
    """
    require_columns(df, [site_col, stratify_col, row_key])
    require_unique(df, row_key)
    if test_sites is not None:
        chosen = col(site_col).isin(list(test_sites))
    else:
        sites = materialize(_sites(df, site_col))
        chosen = _site_test(sites, df.count(), test_size, seed, col(site_col))
    placed = df.withColumn("is_test", F.coalesce(chosen, F.lit(False)))
    return _draw_rest(placed, stratify_col, col(row_key).cast("string"), val_size, seed)


def split_statistics(
    rows: DataFrame, label: str = LABEL, site_col: str | None = None
) -> DataFrame:
    """(split, n_rows, share, label_mean[, n_sites]) of each split."""
    aggregates = [F.count(F.lit(1)).alias("n_rows"), F.avg(col(label)).alias("label_mean")]
    if site_col:
        aggregates.append(F.count_distinct(col(site_col)).alias("n_sites"))
    sizes = rows.groupBy("split").agg(*aggregates)
    # At most three rows meet here.
    share = F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy())
    return sizes.withColumn("share", share)
