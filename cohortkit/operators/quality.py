"""Reports about a table: granularity, leakage, duplicates, gaps, cardinality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from cohortkit.constants import (
    HIGH_CARDINALITY,
    HIGH_CORRELATION,
    ID_COLUMN_NAMES,
    STATIC_ROWS_PER_ENTITY,
    SUSPICIOUS_WORDS,
    TIME_WORDS,
)
from cohortkit.functions.names import col
from cohortkit.functions.numeric import FLOATS, is_number, known, present
from cohortkit.operators.columns import level_counts, missing_counts, missing_rows, present_counts, short_level
from cohortkit.operators.quantiles import exact_quantiles
from cohortkit.operators.sizing import small_side
from cohortkit.operators.transforms import moments
from cohortkit.session import materialize


def find_id_column(df: DataFrame) -> str:
    """A usual id name, else the first name with ``id`` in it, else the first column."""
    for name in ID_COLUMN_NAMES:
        if name in df.columns:
            return name
    return next((c for c in df.columns if "id" in c.lower()), df.columns[0])


def time_columns(df: DataFrame, words: Sequence[str] = TIME_WORDS) -> list[str]:
    """Columns whose name speaks of time."""
    return [c for c in df.columns if any(w in c.lower() for w in words)]


def suspicious_names(
    df: DataFrame, target: str, words: Sequence[str] = SUSPICIOUS_WORDS
) -> list[tuple[str, str]]:
    """(column, first matching word) of names that may give the outcome away."""
    found = []
    for c in df.columns:
        word = next((w for w in words if w in c.lower()), None)
        if c != target and word:
            found.append((c, word))
    return found


def id_structure(df: DataFrame, id_col: str, tolerance: float = STATIC_ROWS_PER_ENTITY) -> DataFrame:
    """(total_rows, unique_ids, rows_per_id, data_type): one row per id or several."""
    return structure_of(entity_sizes(df, id_col), tolerance)


def entity_sizes(df: DataFrame, id_col: str) -> DataFrame:
    """(id, n_rows) of every entity; rows without an id are one more."""
    return df.groupBy(col(id_col)).agg(F.count(F.lit(1)).alias("n_rows"))


def structure_of(entities: DataFrame, tolerance: float = STATIC_ROWS_PER_ENTITY) -> DataFrame:
    """:func:`id_structure` from the rows of :func:`entity_sizes`."""
    sizes = entities.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"), F.count(col(entities.columns[0])).alias("unique_ids"))
    ratio = F.try_divide(F.col("total_rows").cast("double"), F.col("unique_ids").cast("double"))
    return sizes.withColumn("rows_per_id", ratio).withColumn(
        "data_type", F.when(F.col("rows_per_id") <= tolerance, "STATIC").otherwise("DYNAMIC")
    )


_COUNTED = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


class ValueCounts:
    """How often each value of several columns and each whole row occurs, from one scan.

    Every row gives a (slot, value) pair for each of ``columns`` and one with its hash;
    pairs are counted where they are read and spread by value. Reports on entities, the
    target, levels and duplicates then read the counts, not the table.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], text: Sequence[str]):
        self.df, self.columns = df, list(dict.fromkeys([*columns, *text]))
        none, no_hash = F.lit(None).cast("string"), F.lit(None).cast("long")
        pairs = [
            F.struct(F.lit(i).alias("slot"), (short_level(self._text(c)) if c in text else self._text(c)).alias("value"),
                     no_hash.alias("h1"), no_hash.alias("h2"))
            for i, c in enumerate(self.columns)]
        whole = F.struct(F.lit(-1).alias("slot"), none.alias("value"), *[
            F.xxhash64(F.lit(seed), *[col(c) for c in df.columns]).alias(f"h{seed}") for seed in (1, 2)])
        rows = df.select(F.inline(F.array(whole, *pairs)))
        self.counts = materialize(rows.groupBy("slot", "value", "h1", "h2").agg(F.count(F.lit(1)).alias("n_rows")))

    def _text(self, column: str) -> Column:
        value = known(self.df, column)
        # Adding zero makes -0.0 and 0.0 one value.
        return (value + F.lit(0.0) if isinstance(self.df.schema[column].dataType, FLOATS) else value).cast("string")

    @staticmethod
    def holds(df: DataFrame, column: str) -> bool:
        """Values of this type can be counted as text and read back from it."""
        return isinstance(df.schema[column].dataType, _COUNTED)

    def of(self, column: str) -> DataFrame:
        """(column, n_rows) of each value of a column, missing among them."""
        rows = self.counts.where(F.col("slot") == self.columns.index(column))
        return rows.select(F.col("value").cast(self.df.schema[column].dataType).alias(column), "n_rows")

    def distribution(self, column: str, total: int) -> DataFrame:
        """:func:`value_distribution` of a column of a table with ``total`` rows."""
        counts = self.of(column).where(col(column).isNotNull()).withColumnRenamed(column, "value")
        return counts.withColumn("percent", F.col("n_rows") * 100.0 / F.lit(total))

    def levels(self, columns: Sequence[str]) -> DataFrame:
        """(column, n_levels) of the present values."""
        if not columns:
            return self.df.sparkSession.createDataFrame([], "column STRING, n_levels LONG")
        names = F.create_map(*[x for i, c in enumerate(self.columns) for x in (F.lit(i), F.lit(c))])
        rows = self.counts.where(F.col("slot").isin([self.columns.index(c) for c in columns]))
        return rows.groupBy("slot").agg(F.count("value").alias("n_levels")).select(names[F.col("slot")].alias("column"), "n_levels")

    def duplicates(self) -> DataFrame:
        """:func:`duplicate_rows`: the table is read again only if a row's hash repeats."""
        row = self.counts.where(F.col("slot") == -1).agg(
            F.sum("n_rows").alias("n_rows"), F.max("n_rows").alias("most")).first()
        if (row["most"] or 0) > 1:
            return duplicate_rows(self.df)
        return self.df.sparkSession.createDataFrame(
            [(row["n_rows"] or 0, 0, 0.0)], "n_rows LONG, n_duplicates LONG, percent DOUBLE")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_number(f.dataType) and f.name not in set(exclude)]


def target_correlations(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """(column, r): Pearson correlation with the target over rows where both are present.

    One pass for all columns. A column without spread has no correlation and is
    left out; a target that is no number has none with any.
    """
    columns = _correlated(df, target, exclude)
    return _correlation_rows(df.agg(*_correlation_sums(columns, target)) if columns else df, columns)


def _correlated(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> list[str]:
    if target not in df.columns or not is_number(df.schema[target].dataType):
        return []
    return numeric_columns(df, (target, *exclude))


def _correlation_sums(columns: Sequence[str], target: str) -> list[Column]:
    target_ = present(col(target))
    aggregates = []
    for i, c in enumerate(columns):
        x = F.when(target_.isNotNull(), present(col(c)))
        y = F.when(present(col(c)).isNotNull(), target_)
        aggregates += [
            F.covar_pop(x, y).alias(f"xy{i}"), F.stddev_pop(x).alias(f"x{i}"), F.stddev_pop(y).alias(f"y{i}"),
        ]
    return aggregates


def _correlation_rows(sums: DataFrame, columns: Sequence[str]) -> DataFrame:
    if not columns:
        return sums.sparkSession.createDataFrame([], "column STRING, r DOUBLE")
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.try_divide(F.col(f"xy{i}"), F.col(f"x{i}") * F.col(f"y{i}")).alias("r"),
        )
        for i, c in enumerate(columns)
    ]
    return sums.select(F.inline(F.array(*entries))).where(F.col("r").isNotNull())


def profile(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """:func:`target_correlations` and :func:`missing_counts` from one scan of the table."""
    columns = _correlated(df, target)
    sums = df.agg(*present_counts(df, df.columns), *_correlation_sums(columns, target))
    # One row with a few numbers a column: later reports read it, not the table.
    sums = df.sparkSession.createDataFrame([sums.first()], sums.schema)
    return _correlation_rows(sums, columns), missing_rows(sums, df.columns)


def overview(df: DataFrame, n_rows: int) -> DataFrame:
    """(n_rows, n_columns, n_numeric, n_categorical); the table is not read."""
    numbers = len(numeric_columns(df))
    return df.sparkSession.createDataFrame(
        [(n_rows, len(df.columns), numbers, len(df.columns) - numbers)],
        "n_rows LONG, n_columns INT, n_numeric INT, n_categorical INT")


def high_correlations(
    df: DataFrame, target: str, limit: float = HIGH_CORRELATION, exclude: Sequence[str] = ()
) -> DataFrame:
    """Columns correlated so strongly with the target that they may leak it."""
    return high_of(target_correlations(df, target, exclude), limit)


def high_of(correlations: DataFrame, limit: float = HIGH_CORRELATION) -> DataFrame:
    return correlations.where(F.abs("r") > limit)


def top_correlations(df: DataFrame, target: str, n: int = 5, exclude: Sequence[str] = ()) -> DataFrame:
    """The n strongest correlations, strongest first."""
    return top_of(target_correlations(df, target, exclude), n)


def top_of(correlations: DataFrame, n: int = 5) -> DataFrame:
    return correlations.orderBy(F.desc(F.abs("r")), "column").limit(n)


def _copies(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))


def _suspects(df: DataFrame) -> DataFrame:
    """Rows whose hash occurs more than once; a superset of all rows with a copy."""
    hashes = {
        f"__h{seed}": F.xxhash64(F.lit(seed), *[col(c) for c in df.columns]) for seed in (1, 2)
    }
    hashed = df.withColumns(hashes)
    repeated = materialize(
        _copies(hashed, [F.col(h) for h in hashes]).where(F.col("__copies") > 1).select(*hashes)
    )
    return hashed.join(small_side(repeated), list(hashes), "left_semi").drop(*hashes)


def duplicate_rows(df: DataFrame, wide: int = 16) -> DataFrame:
    """(n_rows, n_duplicates, percent): rows equal in all columns to another, but the first.

    Equal rows are merged before the shuffle, so many copies of one row cost one.
    Of a table with more than ``wide`` columns only row hashes are shuffled first;
    whole rows are compared only where a hash occurs again.
    """
    is_wide = len(df.columns) > wide
    copies = _copies(_suspects(df) if is_wide else df, [col(c) for c in df.columns])
    n_rows = df.agg(F.count(F.lit(1))).scalar() if is_wide else F.sum("__copies")
    extra = F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0))
    totals = copies.agg(extra.alias("n_duplicates"), F.coalesce(n_rows, F.lit(0)).alias("n_rows"))
    totals = totals.select("n_rows", "n_duplicates")
    share = F.try_divide(F.col("n_duplicates") * F.lit(100.0), F.col("n_rows").cast("double"))
    return totals.withColumn("percent", F.coalesce(share, F.lit(0.0)))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, n_rows, percent) of the present values; percent of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    value = known(df, column)
    counts = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("percent", F.col("n_rows") * 100.0 / total.scalar())


def top_missing(df: DataFrame, n: int = 5) -> DataFrame:
    """The n columns with most gaps, (column, n_missing, percent); complete ones never show."""
    return top_gaps(missing_counts(df), n)


def top_gaps(gaps: DataFrame, n: int = 5) -> DataFrame:
    return (
        gaps.where(F.col("n_missing") > 0)
        .select("column", "n_missing", (F.col("missing_ratio") * 100).alias("percent"))
        .orderBy(F.desc("n_missing"), "column")
        .limit(n)
    )


def largest_entity(df: DataFrame, id_col: str) -> DataFrame:
    """(id, n_rows) of the entity with most rows; a tie takes the smallest id."""
    return largest_of(entity_sizes(df, id_col))


def largest_of(entities: DataFrame) -> DataFrame:
    id_col = entities.columns[0]
    return entities.where(col(id_col).isNotNull()).orderBy(F.desc("n_rows"), col(id_col)).limit(1)


def largest_entity_sample(
    df: DataFrame, id_col: str, n: int = 5, time_cols: Sequence[str] | None = None, others: int = 5,
    entities: DataFrame | None = None,
) -> DataFrame:
    """The first n rows in time of the entity with most rows: id, times, a few others.

    The entity is looked up first (in ``entities``, if its sizes are known), so that the second read is a filter on a
    constant, which reaches the file scan, and a top-n without a full sort.
    """
    times = list(time_cols if time_cols is not None else time_columns(df))
    times = [c for c in times if c != id_col]
    rest = [c for c in df.columns if c != id_col and c not in times]
    shown = [id_col, *times, *rest[:others]] if times else df.columns[:8]
    top = largest_of(entity_sizes(df, id_col) if entities is None else entities).first()
    if top is None:
        return df.select(*[col(c) for c in shown]).limit(0)
    rows = df.where(col(id_col) == F.lit(top[0])).select(*[col(c) for c in shown])
    order = [*times, *[c for c in shown if c not in times]]
    return rows.orderBy(*[col(c) for c in order]).limit(n)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, std, min, q25, median, q75, max), quartiles exact."""
    columns = list(columns if columns is not None else numeric_columns(df))
    found = moments(df, columns)
    quantiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], {c: found[c].present for c in columns})
    rows = []
    for c in columns:
        m, q = found[c], quantiles[c]
        spread = (m.var * m.present / (m.present - 1)) ** 0.5 if m.present > 1 else None
        rows.append((c, m.present, m.mean, spread, m.low, q[0.25], q[0.5], q[0.75], m.high))
    return df.sparkSession.createDataFrame(
        rows,
        "column STRING, count LONG, mean DOUBLE, std DOUBLE, min DOUBLE, q25 DOUBLE,"
        " median DOUBLE, q75 DOUBLE, max DOUBLE",
    )


def overall_missing(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns, missing_rate) over all cells."""
    cells = missing_counts(df).agg(
        F.max("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_columns"),
        F.sum("n_missing").alias("gaps"),
    )
    rate = F.try_divide(F.col("gaps").cast("double"), (F.col("n_rows") * F.col("n_columns")).cast("double"))
    return cells.select("n_rows", "n_columns", rate.alias("missing_rate"))


def _estimated_levels(df: DataFrame, columns: Sequence[str], deviation: float) -> DataFrame:
    if not columns:
        return df.sparkSession.createDataFrame([], "column STRING, n_levels LONG")
    row = df.agg(*[F.approx_count_distinct(col(c), deviation).alias(f"c{i}") for i, c in enumerate(columns)])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_levels")) for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*entries)))


def cardinality(
    df: DataFrame, exclude: Sequence[str] = (), limit: int = HIGH_CARDINALITY, deviation: float | None = None,
    counts: ValueCounts | None = None,
) -> DataFrame:
    """(column, kind, n_levels, too_many): levels of text columns; numbers are only named.

    Exact by default. With a relative ``deviation`` the levels are estimated in one
    pass without a shuffle of values. ``counts`` that are known save the scan.
    """
    names = [f.name for f in df.schema.fields if f.name not in set(exclude)]
    numbers = set(numeric_columns(df))
    text = [c for c in names if c not in numbers]
    if counts is not None:
        counted = counts.levels(text)
    else:
        counted = level_counts(df, text) if deviation is None else _estimated_levels(df, text, deviation)
    levels = counted.select(
        "column", F.lit("categorical").alias("kind"), "n_levels", (F.col("n_levels") > limit).alias("too_many")
    )
    named = df.sparkSession.createDataFrame(
        [(c, "numeric", None, False) for c in names if c in numbers],
        "column STRING, kind STRING, n_levels LONG, too_many BOOLEAN",
    )
    return levels.unionByName(named)
