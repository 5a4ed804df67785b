"""All quality reports of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortkit.operators import quality as Q
from cohortkit.session import materialize


def health(df: DataFrame, target: str, id_col: str | None = None) -> dict[str, object]:
    """Report name to table (or list of names). Tables are lazy where they can be.

    ``df`` is scanned once for gaps and correlations and once for the counts of values (of the
    id, the target, the text columns and whole rows). Only if the hash of a row
    repeats, whole rows are compared in further scans; a sample of the largest entity is a
    filtered scan when it is read.
    """
    id_col = id_col or Q.find_id_column(df)
    has_target = target in df.columns
    text = [c for c in df.columns if c not in {id_col, target, *Q.numeric_columns(df)}]
    whole = [c for c in ([id_col, target] if has_target else [id_col]) if Q.ValueCounts.holds(df, c)]
    counts = Q.ValueCounts(df, whole, text)
    entities = counts.of(id_col) if id_col in whole else materialize(Q.entity_sizes(df, id_col))
    # One row each: later reports read it, not the table.
    structure = Q.structure_of(entities)
    structure = df.sparkSession.createDataFrame(structure.collect(), structure.schema)
    found = structure.first()
    duplicates = counts.duplicates()
    duplicates = df.sparkSession.createDataFrame(duplicates.collect(), duplicates.schema)
    correlations, gaps = Q.profile(df, target)
    high = Q.high_of(correlations)
    names = Q.suspicious_names(df, target)
    issues = high.count() + len(names) + (1 if duplicates.first()["n_duplicates"] > 0 else 0)
    return {
        "id_column": id_col,
        "overview": Q.overview(df, found["total_rows"]),
        "structure": structure,
        "high_correlations": high,
        "top_correlations": Q.top_of(correlations),
        "suspicious_names": names,
        "duplicates": duplicates,
        "n_issues": issues,
        "sample": Q.largest_entity_sample(df, id_col, entities=entities) if found["data_type"] == "DYNAMIC" else None,
        "target": None if not has_target else (
            counts.distribution(target, found["total_rows"]) if target in whole else Q.value_distribution(df, target)),
        "missing": Q.top_gaps(gaps),
        "cardinality": Q.cardinality(df, exclude=(id_col, target), counts=counts),
    }
