"""Dictionaries fitted on training rows: label indexes, target means, one-hot levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.constants import MISSING_TEXT, UNKNOWN_LEVEL
from cohortkit.functions.names import col
from cohortkit.functions.numeric import known, present
from cohortkit.operators.running import running_totals
from cohortkit.operators.sizing import within_broadcast
from cohortkit.session import keep, materialize

UNSEEN = ("first", "unk", "error")
# A dictionary of at most this many entries, none longer than so many bytes, is made on the
# driver, from where it is broadcast.
DRIVER_LEVELS = 10_000
LEVEL_BYTES = 512
_MARK = "\0"

Sizes = dict[str, tuple[int, int]]


def _level(df: DataFrame, column: str, missing: str | None = None) -> Column:
    """A value as text; NaN counts as missing."""
    text = known(df, column).cast("string")
    return text if missing is None else F.coalesce(text, F.lit(missing))


def as_levels(df: DataFrame, columns: Sequence[str], missing: str) -> DataFrame:
    """(feature, value) for every row and column, missing spelled out."""
    text = df.select(*[_level(df, c, missing).alias(f"c{i}") for i, c in enumerate(columns)])
    slots = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(f"c{i}"), F.lit(c))])
    return text.unpivot([], text.columns, "slot", "value").select(
        slots[F.col("slot")].alias("feature"), "value"
    )


def _few(df: DataFrame, most: int) -> list[tuple] | None:
    """All rows, or None if there are more than ``most`` or a long value; those stay where they are."""
    short = F.octet_length("value") <= LEVEL_BYTES
    rows = df.withColumns({"value": F.when(short, F.col("value")), "__short": short}).limit(most + 1).collect()
    return [tuple(r)[:-1] for r in rows] if len(rows) <= most and all(r["__short"] for r in rows) else None


def _sizes_of(rows: Sequence) -> Sizes:
    sizes: Sizes = {}
    for r in rows:
        n, b = sizes.get(r[0], (0, 0))
        sizes[r[0]] = n + 1, b + len(r[1].encode()) + 32
    return sizes


def fit_labels(train: DataFrame, columns: Sequence[str], missing: str = UNKNOWN_LEVEL) -> tuple[DataFrame, Sizes]:
    """:func:`fit_label_dictionary`, and the sizes that ``encode_labels`` needs."""
    spark, schema = train.sparkSession, "feature STRING, value STRING, index INT"
    if not columns:
        return spark.createDataFrame([], schema), {}
    distinct = as_levels(train, columns, missing).distinct()
    found = _few(distinct, DRIVER_LEVELS)
    if found is not None:
        place = {}
        rows = [(f, v, place.setdefault(f, iter(range(len(found)))).__next__()) for f, v in sorted(found)]
        return spark.createDataFrame(rows, schema), _sizes_of(rows)
    levels = materialize(distinct.withColumn("one", F.lit(1).cast("long")))
    sizes = dictionary_sizes(levels)
    n, size = sum(n for n, _ in sizes.values()), sum(b for _, b in sizes.values())
    numbered = running_totals(levels, "value", {"upto": "one"}, within=["feature"], n_rows=n)
    fitted = numbered.select("feature", "value", (F.col("upto") - 1).cast("int").alias("index"))
    return keep(fitted) if within_broadcast(n, size) else materialize(fitted), sizes


def fit_label_dictionary(
    train: DataFrame, columns: Sequence[str], missing: str = UNKNOWN_LEVEL
) -> DataFrame:
    """(feature, value, index): levels of each column numbered from 0 in code point order."""
    return fit_labels(train, columns, missing)[0]


def dictionary_sizes(dictionary: DataFrame) -> Sizes:
    """{feature: (entries, bytes)}, measured once for all features."""
    width = F.sum(F.octet_length("value") + F.lit(32))
    sizes = dictionary.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), width.alias("b"))
    return {r["feature"]: (r["n"], r["b"]) for r in sizes.collect()}


def _look_up(
    df: DataFrame, dictionary: DataFrame, values: Mapping[str, Column], payload: str, sizes: Sizes
) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with the entries of all columns, and where the entry of each column is.

    The dictionaries that are small together are one broadcast table, which every column
    is joined to by (feature, value). Of the others a single one is joined to the rows; of
    several, narrow (row, feature, value) rows are joined and brought together again, so
    that the wide rows are shuffled once and not once a column.
    """
    dtype = dictionary.schema[payload].dataType
    small, large, n, size = [], [], 0, 0
    for c in sorted(values, key=lambda c: sizes.get(c, (0, 0))):
        one = sizes.get(c, (0, 0))
        if within_broadcast(n + one[0], size + one[1]):
            small.append(c)
            n, size = n + one[0], size + one[1]
        else:
            large.append(c)
    found: dict[str, Column] = {}
    if len(large) > 1:
        rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()))
        long = rows.select("__row", F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), values[c].alias("value")) for c in large])))
        entries = dictionary.where(F.col("feature").isin(large)).select("feature", "value", payload)
        held = F.collect_list(F.struct("feature", payload))
        regrouped = long.join(entries, ["feature", "value"]).groupBy("__row").agg(F.map_from_entries(held).alias("__found"))
        df = rows.join(regrouped, "__row", "left").drop("__row")
        found = {c: F.col("__found")[c] for c in large}
    else:
        for c in large:
            entries = dictionary.where(F.col("feature") == c).select(F.col("value").alias("__value"), F.col(payload).alias("__one"))
            df = df.withColumn("__key", values[c]).join(entries, F.col("__key") == F.col("__value"), "left").drop("__key", "__value")
            found[c] = F.col("__one")
    # The same table for every column, so that it is sent once.
    all_of = dictionary.where(F.col("feature").isin(small)) if large else dictionary
    table = all_of.select(F.concat("feature", F.lit(_MARK), "value").alias("__entry"), F.col(payload).alias("__payload"))
    for i, c in enumerate(small):
        if sizes.get(c, (0, 0))[0] == 0:
            found[c] = F.lit(None).cast(dtype)
            continue
        side = F.broadcast(table).withColumnRenamed("__payload", f"__p{i}").withColumnRenamed("__entry", f"__e{i}")
        df = df.join(side, F.concat(F.lit(c + _MARK), values[c]) == F.col(f"__e{i}"), "left").drop(f"__e{i}")
        found[c] = F.col(f"__p{i}")
    return df, found


def unseen_levels(
    df: DataFrame, dictionary: DataFrame, columns: Sequence[str], missing: str = UNKNOWN_LEVEL
) -> DataFrame:
    """(feature, value) pairs that the dictionary does not hold."""
    return as_levels(df, columns, missing).distinct().join(
        dictionary, ["feature", "value"], "left_anti"
    )


def encode_labels(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str],
    unseen: str = "first",
    missing: str = UNKNOWN_LEVEL,
    sizes: Sizes | None = None,
) -> DataFrame:
    """Replace levels by their index.

    A level not seen in training becomes index 0, an index of its own after the
    last (``unk``), or an error. ``sizes`` of the dictionary save measuring it.
    """
    if unseen not in UNSEEN:
        raise ValueError(f"unknown unseen rule: {unseen}")
    if unseen == "error":
        new = unseen_levels(df, dictionary, columns, missing).limit(20).collect()
        if new:
            raise ValueError(f"levels not seen in training: {[tuple(r) for r in new]}")
    sizes = dictionary_sizes(dictionary) if sizes is None else sizes
    rows, found = _look_up(df, dictionary, {c: _level(df, c, missing) for c in columns}, "index", sizes)
    other = {c: F.lit(sizes.get(c, (0, 0))[0] if unseen == "unk" else 0) for c in columns}
    return rows.select(*[F.coalesce(found[c], other[c]).cast("int").alias(c) if c in found else col(c) for c in df.columns])


def fit_target_means(train: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, value, n, mean): training label mean of each level; missing left out."""
    pairs = train.select(
        present(col(label)).alias("y"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), _level(train, c).alias("value")) for c in columns
        ])).alias("e"),
    )
    rows = pairs.select("e.feature", "e.value", "y").where(F.col("value").isNotNull())
    means = rows.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"))
    found = _few(means, DRIVER_LEVELS)
    return materialize(means) if found is None else train.sparkSession.createDataFrame(found, means.schema)


def encode_target(
    df: DataFrame,
    means: DataFrame,
    columns: Sequence[str],
    default: str = "levels",
    label_mean: float | None = None,
) -> DataFrame:
    """Replace levels by their training label mean.

    Unseen levels take the unweighted mean over the levels, or with
    ``default='global'`` the training label mean.
    """
    if default not in ("levels", "global"):
        raise ValueError(f"unknown default: {default}")
    width = F.sum(F.octet_length("value") + F.lit(32))
    measured = means.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), width.alias("b"), F.avg("mean").alias("m")).collect()
    sizes = {r["feature"]: (r["n"], r["b"]) for r in measured}
    fill = {r["feature"]: r["m"] for r in measured} if default == "levels" else dict.fromkeys(columns, label_mean)
    rows, found = _look_up(df, means, {c: _level(df, c) for c in columns}, "mean", sizes)
    other = {c: F.lit(fill.get(c)).cast("double") for c in columns}
    return rows.select(*[F.coalesce(found[c], other[c]).alias(c) if c in found else col(c) for c in df.columns])


def fit_one_hot_levels(
    train: DataFrame, columns: Sequence[str]
) -> dict[str, list[str]]:
    """Sorted training levels of each column. They become columns; a column with too many
    for that is better label encoded, or ``encode_one_hot`` is given the levels wanted."""
    rows = as_levels(train, columns, MISSING_TEXT).distinct().collect()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        levels[r["feature"]].append(r["value"])
    # Missing is a level of its own and comes last.
    return {c: sorted(v, key=lambda x: (x == MISSING_TEXT, x)) for c, v in levels.items()}


def encode_one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """``{column}_{level}`` flags after the other columns; an unseen level is all zeros."""
    flags = [
        (_level(df, c, MISSING_TEXT) == F.lit(v)).cast("double").alias(f"{c}_{v}")
        for c, vs in levels.items()
        for v in vs
    ]
    return df.select(*[col(c) for c in df.columns if c not in levels], *flags)


def fit_one_hot_slots(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, index): the slot of every training level, columns in their order and
    levels as :func:`fit_one_hot_levels` has them (missing last); never on the driver whole."""
    place = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    levels = as_levels(train, columns, MISSING_TEXT).distinct().withColumns({
        "place": place[F.col("feature")], "last": F.col("value") == MISSING_TEXT, "one": F.lit(1).cast("long")})
    numbered = running_totals(materialize(levels), ["place", "last", "value"], {"upto": "one"})
    return materialize(numbered.select("feature", "value", (F.col("upto") - 1).cast("int").alias("index")))


def encode_one_hot_sparse(df: DataFrame, slots: DataFrame, columns: Sequence[str], name: str = "one_hot") -> DataFrame:
    """The other columns, then ``{name}_indices`` (ascending) and ``{name}_values``: the slots of
    the row's levels, each 1.0. An unseen level has no slot.

    However many levels there are, a row holds one entry a column.
    """
    rows, found = _look_up(df, slots, {c: _level(df, c, MISSING_TEXT) for c in columns}, "index", dictionary_sizes(slots))
    # Slots of later columns are larger, so column order is slot order.
    held = F.array_compact(F.array(*[found[c] for c in columns]))
    return rows.select(
        *[col(c) for c in df.columns if c not in columns],
        held.alias(f"{name}_indices"), F.transform(held, lambda _: F.lit(1.0)).alias(f"{name}_values"))


def encode_categorical(
    df: DataFrame, train: DataFrame, columns: Sequence[str], method: str = "onehot"
) -> DataFrame:
    """Fit on ``train`` and encode ``df`` by ``onehot`` or strict ``label``."""
    if method == "onehot":
        return encode_one_hot(df, fit_one_hot_levels(train, columns))
    if method == "label":
        dictionary, sizes = fit_labels(train, columns, MISSING_TEXT)
        return encode_labels(df, dictionary, columns, "error", MISSING_TEXT, sizes)
    raise ValueError(f"unknown encoding method: {method}")
