"""Reading raw tables and writing results."""

from cohortkit.sources.published import commits, publish, read_published, recover, replace_folder, vacuum
from cohortkit.sources.readers import (
    SCHEMAS,
    nan_to_null,
    normalize_missing,
    read_cleaned,
    read_or_report,
    read_raw,
    read_table,
    require_columns,
)
from cohortkit.sources.writers import (
    append_manifest,
    feature_catalog,
    manifest,
    metrics_summary,
    write_feature_catalog,
    write_membership,
    write_packs,
    write_predictions,
    write_table,
)

__all__ = [
    "SCHEMAS", "nan_to_null", "normalize_missing", "read_cleaned", "read_or_report", "read_raw",
    "read_table", "require_columns", "append_manifest", "feature_catalog", "manifest",
    "metrics_summary", "write_feature_catalog", "write_membership", "write_packs",
    "write_predictions", "write_table", "commits", "publish", "read_published", "recover", "replace_folder", "vacuum",
]
