"""Raw tables to one row per stay of the cohort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortkit.constants import (
    CODE_PREFIXES,
    KEYWORDS,
    MISSING_THRESHOLD,
    RANGES_DEFAULT,
    STAY,
    WINDOW_HOURS,
)
from cohortkit.operators.cohort import (
    labelled_cohort,
    rename_site,
    select_cohort,
    static_columns,
)
from cohortkit.operators.columns import SparseReport, check_cleaned, drop_sparse
from cohortkit.operators.features import (
    aggregate_wide,
    blank_outliers,
    in_window,
    join_features,
    spread_statistics,
    statistics_by_key,
)
from cohortkit.operators.keyfilter import keep_possible, key_bitmap
from cohortkit.operators.sizing import measured_small
from cohortkit.session import materialize
from cohortkit.sources.readers import nan_to_null


@dataclass
class CleanResult:
    cleaned: DataFrame
    report: SparseReport


def cohort_features(
    keys: DataFrame,
    vital: DataFrame,
    lab: DataFrame,
    window_hours: int = WINDOW_HOURS,
    ranges: Mapping[str, Sequence[float]] = RANGES_DEFAULT,
    feature_join: str = "left",
    value_cols: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """One row per stay of ``keys`` that has measurements in the window; the statistics of
    labs are a map, which ``spread_statistics`` makes columns.

    The restriction to the cohort is on the grouping key, so it is written after the
    aggregates, where it meets one row per stay instead of all raw rows. A small cohort is
    broadcast, and the optimizer moves it down to the raw rows by itself. For a larger one
    a bitmap of its keys is tested on the raw rows, so that few foreign rows are
    aggregated and shuffled. ``keys`` should be a written table.
    """
    vital = blank_outliers(in_window(vital, "observationoffset", window_hours), ranges)
    lab = in_window(lab, "labresultoffset", window_hours)
    if measured_small(keys):
        keys = F.broadcast(keys)
    else:
        bitmap = key_bitmap(keys, STAY, keys.count())
        vital, lab = keep_possible(vital, STAY, bitmap, keys), keep_possible(lab, STAY, bitmap, keys)
    wide = aggregate_wide(vital, value_cols=value_cols, exclude=exclude).join(keys, STAY, "left_semi")
    return join_features(wide, statistics_by_key(lab).join(keys, STAY, "left_semi"), how=feature_join)


def clean(
    patient: DataFrame,
    diagnosis: DataFrame,
    vital: DataFrame,
    lab: DataFrame,
    window_hours: int = WINDOW_HOURS,
    missing_threshold: float = MISSING_THRESHOLD,
    ranges: Mapping[str, Sequence[float]] = RANGES_DEFAULT,
    prefixes: Sequence[str] = CODE_PREFIXES,
    keywords: Sequence[str] = KEYWORDS,
    split_codes: bool = False,
    whole_word: bool = False,
    null_label: str = "zero",
    feature_join: str = "left",
    extra_static: Sequence[str] = (),
    value_cols: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
) -> CleanResult:
    """Cohort, window, outliers, features, label, sparse columns, checks.

    All steps on labs and the joins share one shuffle by stay. The joined table is written
    once with the labs as a map, which tells their names, and once as columns: counting
    gaps and reading the kept columns are then two column scans.
    """
    patient, vital, lab = nan_to_null(patient), nan_to_null(vital), nan_to_null(lab)
    cohort = select_cohort(
        rename_site(patient), diagnosis, prefixes=prefixes, keywords=keywords,
        split_codes=split_codes, whole_word=whole_word,
    )
    static = materialize(static_columns(labelled_cohort(cohort, null_label), extra=extra_static))
    features = cohort_features(
        static.select(STAY), vital, lab, window_hours, ranges, feature_join, value_cols, exclude
    )
    merged = materialize(spread_statistics(materialize(static.join(features, STAY, "left"))))
    measured = [c for c in merged.columns if c != STAY]
    cleaned, report = drop_sparse(merged, missing_threshold, measured)
    return CleanResult(check_cleaned(cleaned), report)
