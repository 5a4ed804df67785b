"""Picking the cohort, its label and its static columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.constants import (
    CODE_PREFIXES,
    KEYWORDS,
    LABEL,
    LEAKAGE_COLUMNS,
    STATIC_COLUMNS,
    STATUS,
    STAY,
)
from cohortkit.functions.names import col
from cohortkit.functions.text import code_matches, died, text_matches
from cohortkit.operators.keyfilter import within_keys
from cohortkit.session import materialize


def rename_site(patient: DataFrame, source: str = "hospitalid", target: str = "site_id") -> DataFrame:
    """Name the site column; a table without one cannot be used."""
    if source not in patient.columns:
        raise ValueError(f"no '{source}' column in the patient table")
    return patient.withColumnRenamed(source, target)


def diagnosis_condition(
    diagnosis: DataFrame,
    prefixes: Sequence[str] = CODE_PREFIXES,
    keywords: Sequence[str] = KEYWORDS,
    code_col: str = "icd9code",
    text_col: str = "diagnosisstring",
    split_codes: bool = False,
    whole_word: bool = False,
) -> Column:
    """Code prefix or keyword; an absent column counts as no match."""
    found = [c for c in (code_col, text_col) if c in diagnosis.columns]
    if not found:
        raise KeyError(f"diagnosis needs '{code_col}' or '{text_col}'")
    condition = F.lit(False)
    if code_col in found:
        condition = condition | code_matches(col(code_col), prefixes, split_codes)
    if text_col in found:
        condition = condition | text_matches(col(text_col), keywords, whole_word)
    return condition


def matching_keys(diagnosis: DataFrame, key: str = STAY, **options) -> DataFrame:
    """Distinct keys with a matching diagnosis.

    Duplicates go before the shuffle, so one key with very many rows costs one row.
    """
    matches = diagnosis.where(diagnosis_condition(diagnosis, **options))
    return matches.where(col(key).isNotNull()).select(key).distinct()


def select_cohort(patient: DataFrame, diagnosis: DataFrame, key: str = STAY, **options) -> DataFrame:
    """Patients with a matching diagnosis."""
    return patient.join(matching_keys(diagnosis, key, **options), key, "left_semi")


def restrict_to(df: DataFrame, keys: DataFrame, key: str = STAY) -> DataFrame:
    """Rows whose key is in ``keys``: broadcast when small, else a shuffled semi join of the
    rows that pass a bitmap of the keys."""
    return within_keys(df, materialize(keys.select(key).distinct()), key)


def add_label(
    patient: DataFrame, status: str = STATUS, label: str = LABEL, null_label: str = "zero"
) -> DataFrame:
    """Add the 0/1 outcome. A missing status is 0, or drops the row with ``'drop'``."""
    if status not in patient.columns:
        raise ValueError(f"no '{status}' column to build the label from")
    if null_label not in ("zero", "drop"):
        raise ValueError(f"unknown null_label: {null_label}")
    rows = patient.where(col(status).isNotNull()) if null_label == "drop" else patient
    return rows.withColumn(label, died(col(status)))


def drop_leakage(df: DataFrame, columns: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    """Drop columns that tell the outcome; absent ones are ignored."""
    return df.drop(*columns)


def labelled_cohort(patient: DataFrame, null_label: str = "zero") -> DataFrame:
    return drop_leakage(add_label(patient, null_label=null_label))


def static_columns(
    patient: DataFrame, key: str = STAY, columns: Sequence[str] = STATIC_COLUMNS, extra: Sequence[str] = ()
) -> DataFrame:
    """Key plus those static columns that exist."""
    wanted = [c for c in (*columns, *extra) if c in patient.columns]
    return patient.select(col(key), *[col(c) for c in wanted])
