"""Reading extracts and links, writing and reading Parquet layers."""

from parcelflow.sources.delimited import (
    read_checked_extracts,
    read_delimited,
    read_extracts,
    union_years,
)
from parcelflow.sources.layers import new_version, read_layer, write_layer, write_settings, write_table
from parcelflow.sources.links import extract_links, latest_per_key
from parcelflow.sources.staging import (
    Staged,
    discard,
    fresh_dir,
    keep,
    measure,
    release,
    scope,
    shared_dir,
    stage,
    within_scope,
)

__all__ = [
    "Staged",
    "discard",
    "extract_links",
    "fresh_dir",
    "keep",
    "latest_per_key",
    "measure",
    "new_version",
    "read_checked_extracts",
    "read_delimited",
    "read_extracts",
    "read_layer",
    "release",
    "scope",
    "shared_dir",
    "stage",
    "union_years",
    "within_scope",
    "write_layer",
    "write_settings",
    "write_table",
]
