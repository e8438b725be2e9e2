"""Where datasets live: ``{root}/{stage}/{source}/{table}`` with one directory per load."""

from __future__ import annotations

DEFAULT_TEMPLATE = "{stage}/{source}/{table}"

#: Source folder of each layer that holds derived datasets (fixed values).
DERIVED_SOURCE = {"silver": "refined", "gold": "metrics"}


def layer_path(
    root: str, stage: str, source: str, table: str, template: str = DEFAULT_TEMPLATE
) -> str:
    """Directory of a dataset."""
    tail = template.format(stage=stage, source=source, table=table)
    return f"{root.rstrip('/')}/{tail.removesuffix('.parquet')}"


def load_path(dataset: str, load_id: int) -> str:
    """Directory of one load of a dataset."""
    return f"{dataset.rstrip('/')}/load_id={load_id}"


def raw_table_path(base: str, table: str, pattern: str | None = None) -> str:
    """Path of a raw extract: ``{base}/{table in lower case}/{pattern}``.

    A pattern that is a full object-store URI is used as it is; the default pattern is
    ``{table}.parquet``.
    """
    if pattern is None:
        pattern = f"{table}.parquet"
    if pattern.startswith(("abfss://", "s3://")):
        return pattern
    return f"{base.rstrip('/')}/{table.lower()}/{pattern}"
