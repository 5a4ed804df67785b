"""The cleaned table to packs for training: split, fit on train, apply to all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortkit.constants import DEFAULT_SEED, LABEL, PROTOCOLS
from cohortkit.functions.names import col
from cohortkit.operators.columns import feature_roles
from cohortkit.operators.dictionary import encode_labels, fit_labels
from cohortkit.operators.splits import Split, entity_split, split_by_site, split_by_time
from cohortkit.operators.transforms import after_fill, fit_impute, fit_scale, impute, moments, scale
from cohortkit.session import materialize
from cohortkit.sources.published import publish
from cohortkit.sources.readers import with_identifiers
from cohortkit.sources.writers import write_membership, write_packs


@dataclass
class TrainReady:
    """``packs`` and ``membership`` hold all splits, told apart by ``split``."""

    protocol: str
    packs: DataFrame
    membership: DataFrame
    cutoff: object = None


def dual_tower(
    rows: DataFrame,
    label: str = LABEL,
    categorical: Sequence[str] | None = None,
    impute_strategy: str = "median",
    scale_method: str = "standard",
    unseen: str = "first",
    on_all_null: str = "error",
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Index the categories, fill and scale the numbers, fitted where split is train.

    Result: patient_id, split, label, categories, numbers.
    """
    names = {} if categorical is None else {"categorical": categorical}
    cats, numbers = feature_roles(rows, **names)
    numbers = [c for c in numbers if c not in set(exclude)]
    train = rows.where(F.col("split") == "train")

    found = moments(train, numbers)
    empty = [c for c in numbers if found[c].present == 0]
    if empty and on_all_null == "error":
        raise ValueError(f"columns without any training value: {empty}")
    numbers = [c for c in numbers if c not in empty]

    fills = fit_impute(train, numbers, impute_strategy, found=found)
    filled = {c: after_fill(found[c], fills[c]) for c in numbers}
    scales = fit_scale(impute(train, fills), numbers, scale_method, filled)
    dictionary, sizes = fit_labels(train, cats)

    scaled = scale(impute(rows, fills), scales)
    encoded = encode_labels(scaled, dictionary, cats, unseen, sizes=sizes)
    return encoded.select(
        "patient_id", "split", col(label), *[col(c) for c in cats], *[col(c) for c in numbers]
    )


def assign_protocol(df: DataFrame, protocol: str, seed: int = DEFAULT_SEED, **options) -> Split:
    """Rows with their ``split``, and the time cutoff if the protocol has one."""
    if protocol == "patient_level":
        return entity_split(df, seed=seed, **options)
    if protocol == "site":
        return Split(split_by_site(df, seed=seed, **options))
    if protocol == "temporal":
        return split_by_time(df, seed=seed, **options)
    raise ValueError(f"unknown protocol: {protocol}")


def run_protocol(
    df: DataFrame,
    protocol: str = "patient_level",
    seed: int = DEFAULT_SEED,
    path: str | None = None,
    fmt: str = "parquet",
    split_options: dict | None = None,
    versions: bool = False,
    **tower_options,
) -> TrainReady | None:
    """Split, fit and apply one protocol; written below ``path`` when it is given.

    With ``versions`` packs and membership are published side by side with earlier ones
    (``read_published(spark, f"{path}/packs", protocol)`` reads the latest); else they take
    their place. ``df`` is read several times: pass a table from storage.

    The temporal protocol is skipped (None) when there is no time column.
    """
    if protocol not in PROTOCOLS:
        raise ValueError(f"unknown protocol: {protocol}")
    options = dict(split_options or {})
    if protocol == "temporal" and options.get("time_col", "admission_time") not in df.columns:
        return None
    split = assign_protocol(df, protocol, seed, **options)
    # A split that is a projection is cheaper to compute again than to write.
    rows = materialize(split.rows) if split.joined else split.rows
    membership = rows.select("patient_id", "split")
    # Columns that only tell groups or times apart are no features.
    helpers = {*options.get("group_cols", ()), options.get("time_col"), *tower_options.pop("exclude", ())}
    packs = dual_tower(rows, exclude=helpers, **tower_options)
    name = PROTOCOLS[protocol]
    if path and versions:
        publish(membership, f"{path}/splits", name, fmt=fmt)
        publish(packs, f"{path}/packs", name, fmt=fmt)
    elif path:
        write_membership(membership, f"{path}/splits", name, fmt=fmt)
        write_packs(packs, f"{path}/packs", name, fmt=fmt)
    return TrainReady(name, packs, membership, split.cutoff)


def train_ready(
    cleaned: DataFrame, protocols: Sequence[str] = ("patient_level",), **options
) -> dict[str, TrainReady]:
    """Run protocols on a cleaned table."""
    df = with_identifiers(cleaned)
    results = {p: run_protocol(df, p, **options) for p in protocols}
    return {p: r for p, r in results.items() if r is not None}
