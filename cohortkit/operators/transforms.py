"""Transforms whose every number is measured on training rows only."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from cohortkit.constants import DEVIATION_EPSILON
from cohortkit.functions.names import col
from cohortkit.functions.numeric import inside, is_number, known, present
from cohortkit.operators import dictionary as D
from cohortkit.operators.neighbours import neighbour_information
from cohortkit.operators.quantiles import exact_quantiles

IMPUTE = ("median", "mean", "most_frequent", "constant")
SCALE = ("standard", "minmax", "robust")
SELECT = ("f_classif", "mutual_info", "mutual_info_knn")


@dataclass
class Moments:
    """What one pass says about a numeric column."""

    rows: int
    present: int
    mean: float | None
    var: float | None
    low: float | None
    high: float | None


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, Moments]:
    """Counts, mean, population variance and range of every column in one pass."""
    if not columns:
        return {}
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = present(col(c))
        aggregates += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"),
            F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
    row = df.agg(*aggregates).first()
    return {
        c: Moments(row["rows"], row[f"n{i}"], row[f"m{i}"], row[f"v{i}"], row[f"l{i}"], row[f"h{i}"])
        for i, c in enumerate(columns)
    }


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str | float | None]:
    """Most frequent present value of each column; a tie takes the smallest. NaN is missing.

    Values are counted as (column, value) pairs spread over the cluster, so a
    column with very many values does not meet in one task. Whole numbers are counted as
    such, since a DOUBLE does not hold all of them.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds = {c: "bigint" if isinstance(types[c], T.IntegralType) else "double" if is_number(types[c]) else "string" for c in columns}
    result: dict[str, str | float | None] = dict.fromkeys(columns)
    for kind in ("bigint", "double", "string"):
        group = [c for c in columns if kinds[c] == kind]
        if not group:
            continue
        values = df.select(*[known(df, c).cast(kind).alias(f"c{i}") for i, c in enumerate(group)])
        counted = (
            values.unpivot([], values.columns, "slot", "value")
            .where(F.col("value").isNotNull())
            .groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
        )
        best = counted.groupBy("slot").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("top"))
        for r in best.collect():
            result[group[int(r["slot"][1:])]] = r["top"]["value"]
    return result


def fit_impute(
    train: DataFrame,
    columns: Sequence[str],
    strategy: str = "median",
    constant: float = 0.0,
    found: Mapping[str, Moments] | None = None,
) -> dict[str, float | None]:
    """The value that fills the gaps of each numeric column."""
    if strategy not in IMPUTE:
        raise ValueError(f"unknown impute strategy: {strategy}")
    if strategy == "constant":
        return dict.fromkeys(columns, constant)
    if strategy == "most_frequent":
        return most_frequent(train, columns)
    found = found if found is not None else moments(train, columns)
    if strategy == "mean":
        return {c: found[c].mean for c in columns}
    quantiles = exact_quantiles(train, columns, [0.5], {c: found[c].present for c in columns})
    return {c: quantiles[c][0.5] for c in columns}


def impute(df: DataFrame, fills: Mapping[str, float | str | None]) -> DataFrame:
    """Fill gaps; numbers become DOUBLE, text stays text."""

    def filled(c: str, v) -> Column:
        if isinstance(v, str):
            return F.coalesce(known(df, c).cast("string"), F.lit(v))
        return F.coalesce(present(col(c)), F.lit(v).cast("double"))

    return df.withColumns({c: filled(c, v) for c, v in fills.items()}) if fills else df


def after_fill(found: Moments, fill: float | None) -> Moments:
    """The moments of a column once its gaps hold ``fill``, without another pass."""
    gaps = found.rows - found.present
    if fill is None or gaps == 0:
        return found
    if found.present == 0:
        return Moments(found.rows, found.rows, fill, 0.0, fill, fill)
    mean = (found.mean * found.present + fill * gaps) / found.rows
    spread = found.present * (found.var + (found.mean - mean) ** 2) + gaps * (fill - mean) ** 2
    return Moments(
        found.rows, found.rows, mean, spread / found.rows, min(found.low, fill), max(found.high, fill)
    )


def fit_scale(
    train: DataFrame,
    columns: Sequence[str],
    method: str = "standard",
    found: Mapping[str, Moments] | None = None,
) -> dict[str, tuple[float, float]]:
    """{column: (centre, divisor)}; a column without spread is divided by 1.

    ``standard`` uses mean and population deviation, ``minmax`` the range,
    ``robust`` the median and the quartile distance. ``robust`` reads ``train``,
    the others only ``found`` when it is given.
    """
    if method not in SCALE:
        raise ValueError(f"unknown scaling method: {method}")
    if method == "robust":
        quantiles = exact_quantiles(train, columns, [0.25, 0.5, 0.75])
        pairs = {
            c: (q[0.5], None if q[0.5] is None else q[0.75] - q[0.25]) for c, q in quantiles.items()
        }
    else:
        found = found if found is not None else moments(train, columns)
        if method == "standard":
            # Equal ends mean no spread, whatever rounding left in the variance.
            pairs = {c: (m.mean, 0.0 if m.low == m.high else math.sqrt(m.var)) for c, m in found.items()}
        else:
            pairs = {c: (m.low, None if m.low is None else m.high - m.low) for c, m in found.items()}
    return {c: (centre if centre is not None else 0.0, width or 1.0) for c, (centre, width) in pairs.items()}


def scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({
        c: (col(c).cast("double") - F.lit(centre)) / F.lit(width) for c, (centre, width) in fitted.items()
    }) if fitted else df


def f_scores(train: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, f_score): between-class over within-class variance of each column.

    One grouped pass gives count, mean and spread of each class; the rest works
    on (classes x features) rows.
    """
    label_ = known(train, label)
    stats = train.where(label_.isNotNull()).groupBy(label_.alias("class")).agg(*[
        F.struct(F.count(x), F.avg(x), F.var_pop(x)).alias(f"s{i}")
        for i, x in enumerate(present(col(c)) for c in columns)
    ])
    entries = [
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("feature"), F.col(f"s{i}").alias("s"))
        for i, c in enumerate(columns)
    ]
    long = stats.select(F.inline(F.array(*entries))).select(
        "place", "feature",
        F.col("s.col1").alias("n"), F.col("s.col2").alias("mean"), F.col("s.col3").alias("var"),
    ).where(F.col("n") > 0)
    # From here on: classes x features rows.
    feature = Window.partitionBy("place")
    grand = F.sum(F.col("n") * F.col("mean")).over(feature) / F.sum("n").over(feature)
    per_feature = long.withColumn("grand", grand).groupBy("place", "feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("mean") - F.col("grand")) ** 2).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
    )
    upper = F.try_divide(F.col("between"), (F.col("k") - 1).cast("double"))
    lower = F.try_divide(F.col("within"), (F.col("n") - F.col("k")).cast("double"))
    score = (
        F.when((F.col("k") < 2) | (F.col("n") <= F.col("k")), F.lit(None).cast("double"))
        .when((lower == 0) & (upper == 0), F.lit(None).cast("double"))
        .when(lower == 0, F.lit(math.inf))
        .otherwise(F.try_divide(upper, lower))
    )
    return per_feature.select("place", "feature", score.alias("f_score"))


def mutual_information(
    train: DataFrame, columns: Sequence[str], label: str, bins: int = 10
) -> DataFrame:
    """(feature, mutual_info) in nats between the binned column and the label.

    An approximation: columns are cut at their exact quantiles into ``bins``
    parts, and the contingency table of (bin, class) gives the information. The estimate
    from nearest neighbours is ``neighbour_information`` (``mutual_info_knn``).
    """
    cuts = exact_quantiles(train, columns, [i / bins for i in range(1, bins)])
    entries = []
    for i, c in enumerate(columns):
        x = present(col(c))
        edges = sorted({v for v in cuts[c].values() if v is not None})
        part = sum((F.when(x > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
        entries.append(F.struct(
            F.lit(i).alias("place"), F.lit(c).alias("feature"), F.when(x.isNotNull(), part).alias("bin")
        ))
    label_ = known(train, label)
    rows = train.where(label_.isNotNull()).select(
        label_.alias("class"), F.inline(F.array(*entries))
    ).where(F.col("bin").isNotNull())
    cells = rows.groupBy("place", "feature", "bin", "class").agg(F.count(F.lit(1)).alias("n"))
    # From here on: features x bins x classes rows.
    def total(*keys: str) -> Column:
        return F.sum("n").over(Window.partitionBy("place", *keys)).cast("double")

    share = F.col("n") / total()
    ratio = (F.col("n") * total()) / (total("bin") * total("class"))
    terms = cells.select("place", "feature", (share * F.log(ratio)).alias("term"))
    return terms.groupBy("place", "feature").agg(F.sum("term").alias("mutual_info"))


def select_best(scores: DataFrame, score: str, k: int | None) -> list[str]:
    """The k highest scores in column order; no score ranks last, a tie keeps the later column."""
    rows = scores.collect()
    ranked = sorted(rows, key=lambda r: (-math.inf if r[score] is None else r[score], r["place"]))
    kept = ranked[-k:] if k else ranked
    return [r["feature"] for r in sorted(kept, key=lambda r: r["place"])]


def check_complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Raise, naming the columns, when a value is missing."""
    columns = list(columns if columns is not None else df.columns)
    row = df.agg(*[F.count_if(known(df, c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    left = {c: row[f"c{i}"] for i, c in enumerate(columns) if row[f"c{i}"]}
    if left:
        raise ValueError(f"missing values remain: {left}")
    return df


def refuse_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail, naming the column, when a missing value is met; no pass of its own."""

    def guarded(c: str) -> Column:
        message = F.lit(f"missing values remain in column {c}")
        return F.coalesce(known(df, c), F.raise_error(message).cast(df.schema[c].dataType))

    return df.withColumns({c: guarded(c) for c in columns})


@dataclass
class FittedPreprocessor:
    """Everything measured on the training rows; ``transform`` measures nothing."""

    numeric: list[str]
    categorical: list[str]
    fills: dict[str, float | str | None]
    target_means: DataFrame | None = None
    target_columns: list[str] = field(default_factory=list)
    target_default: str = "levels"
    label_mean: float | None = None
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)
    selected: list[str] | None = None

    @property
    def feature_names(self) -> list[str]:
        return (self.selected if self.selected else self.numeric) + self.categorical

    def transform(self, df: DataFrame, keep: Sequence[str] = (), check: bool = True) -> DataFrame:
        """``keep`` columns, then the features. One projection plus small joins."""
        rows = impute(df, {c: v for c, v in self.fills.items() if c in df.columns})
        if self.target_means is not None:
            present = [c for c in self.target_columns if c in df.columns]
            rows = D.encode_target(rows, self.target_means, present, self.target_default, self.label_mean)
        rows = scale(rows, self.scales)
        result = rows.select(*[col(c) for c in keep], *[col(c) for c in self.feature_names])
        return refuse_missing(result, self.feature_names) if check else result

    def save(self, path: str, spark) -> None:
        """Write the fit: plain numbers as JSON, target means as a table."""
        plain = {k: v for k, v in vars(self).items() if k != "target_means"}
        spark.createDataFrame([(json.dumps(plain),)], "value STRING").write.mode("overwrite").text(f"{path}/values")
        if self.target_means is not None:
            self.target_means.write.mode("overwrite").parquet(f"{path}/target_means")

    @classmethod
    def load(cls, path: str, spark) -> FittedPreprocessor:
        plain = json.loads(spark.read.text(f"{path}/values").first()[0])
        plain["scales"] = {c: tuple(v) for c, v in plain["scales"].items()}
        fitted = cls(**plain)
        if fitted.target_columns:
            fitted.target_means = spark.read.parquet(f"{path}/target_means")
        return fitted

    def parameters(self, spark) -> DataFrame:
        """(feature, fill, centre, divisor, selected): the fit as a table."""
        rows = [
            (
                c,
                None if self.fills.get(c) is None else str(self.fills[c]),
                *self.scales.get(c, (None, None)),
                c in self.feature_names,
            )
            for c in (*self.numeric, *self.categorical)
        ]
        return spark.createDataFrame(
            rows, "feature STRING, fill STRING, centre DOUBLE, divisor DOUBLE, selected BOOLEAN"
        )


@dataclass
class Preprocessor:
    """Impute, target-encode, scale and select, in this order.

    ``fit`` sees training rows only and returns the object that transforms, so
    there is no way to transform before fitting.
    """

    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    impute_strategy: str = "median"
    scale_method: str | None = "standard"
    target_encode: Sequence[str] = ()
    label: str | None = None
    feature_selection: str | None = None
    n_features: int | None = None
    fill_value: float = 0.0
    unseen_target: str = "levels"

    def fit_transform(self, train: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return self.fit(train).transform(train, keep)

    def fit(self, train: DataFrame) -> FittedPreprocessor:
        if self.scale_method and self.scale_method not in SCALE:
            raise ValueError(f"unknown scaling method: {self.scale_method}")
        if self.feature_selection and self.feature_selection not in SELECT:
            raise ValueError(f"unknown feature selection method: {self.feature_selection}")
        numeric, categorical = list(self.numeric), list(self.categorical)
        found = moments(train, numeric)
        empty = [c for c in numeric if found[c].present == 0 and self.impute_strategy != "constant"]
        if empty:
            raise ValueError(f"columns without any training value: {empty}")
        fills: dict = dict(fit_impute(train, numeric, self.impute_strategy, self.fill_value, found))
        fills.update(most_frequent(train, categorical) if categorical else {})
        fitted = FittedPreprocessor(numeric, categorical, fills, target_default=self.unseen_target)
        filled = impute(train, fills)
        if self.label and self.target_encode:
            fitted.target_columns = [c for c in self.target_encode if c in train.columns]
            fitted.target_means = D.fit_target_means(filled, fitted.target_columns, self.label)
            if self.unseen_target == "global":
                fitted.label_mean = train.agg(F.avg(present(col(self.label)))).first()[0]
        if self.scale_method:
            full = {c: after_fill(found[c], fills[c]) for c in numeric}
            fitted.scales = fit_scale(filled, numeric, self.scale_method, full)
        if self.feature_selection and self.label:
            scaled = scale(filled, fitted.scales)
            if self.feature_selection == "f_classif":
                fitted.selected = select_best(f_scores(scaled, numeric, self.label), "f_score", self.n_features)
            else:
                by = mutual_information if self.feature_selection == "mutual_info" else neighbour_information
                scores = by(scaled, numeric, self.label)
                fitted.selected = select_best(scores, "mutual_info", self.n_features)
        return fitted


TRAIN_STATS = ("mean", "std", "median", "q25", "q75", "min", "max")


def fit_train_stats(train: DataFrame, columns: Sequence[str] | None = None) -> dict[str, dict[str, float | None]]:
    """Mean, sample deviation, quartiles and range of each numeric column."""
    if columns is None:
        columns = [f.name for f in train.schema.fields if is_number(f.dataType)]
    found = moments(train, columns)
    quantiles = exact_quantiles(train, columns, [0.25, 0.5, 0.75], {c: found[c].present for c in columns})
    stats = {}
    for c in columns:
        m, q = found[c], quantiles[c]
        spread = math.sqrt(m.var * m.present / (m.present - 1)) if m.present > 1 else None
        stats[c] = dict(zip(TRAIN_STATS, (m.mean, spread, q[0.5], q[0.25], q[0.75], m.low, m.high)))
    return stats


def add_train_features(df: DataFrame, stats: Mapping[str, Mapping[str, float | None]]) -> DataFrame:
    """Deviation from the training mean and a flag for lying between the quartiles."""
    new = {}
    for c, s in stats.items():
        if c not in df.columns:
            continue
        x = present(col(c))
        spread = F.lit(s["std"]).cast("double") + F.lit(DEVIATION_EPSILON)
        new[f"{c}_deviation_from_train_mean"] = (x - F.lit(s["mean"]).cast("double")) / spread
        between = inside(x, *(s["q25"], s["q75"])) if s["q25"] is not None else F.lit(False)
        new[f"{c}_within_train_iqr"] = F.coalesce(between, F.lit(False)).cast("int")
    return df.withColumns(new) if new else df
