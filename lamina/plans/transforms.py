"""User transformations over named inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from lamina.operators.linkage import LinkageSettings

Inputs = Mapping[str, DataFrame]
Function = Callable[[SparkSession, Inputs], "DataFrame | str"]


@dataclass(frozen=True)
class Input:
    """A named input: a dataset of a stage (``source/dataset``), or any path without a stage."""

    alias: str
    path: str
    stage: str | None = "bronze"

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> "Input":
        return cls(config["alias"], config.get("source_path", ""), config.get("stage", "bronze"))

    def dataset(self) -> tuple[str, str]:
        source, _, name = self.path.removesuffix(".parquet").rpartition("/")
        return source, name


@dataclass(frozen=True)
class Transform:
    """One dataset to build: from a function or from SQL over the input names.

    ``parameters`` are bound to ``:name`` markers of the SQL text. ``incremental`` promises that
    the transformation treats each row of its one input by itself: then only loads that came in
    since the last run are read, and their rows are added to what is there. With ``keys``, a row
    added later replaces the one of the same key: whoever reads the dataset gets its current rows.
    """

    name: str
    inputs: Sequence[Input] = ()
    function: Function | None = None
    sql: str | None = None
    parameters: Mapping[str, Any] = field(default_factory=dict)
    checks: Sequence[str] = ()
    linkage: LinkageSettings | None = None
    newest_by: Sequence[str] = ()
    incremental: bool = False
    keys: Sequence[str] = ()

    def __post_init__(self):
        if self.incremental and (len(self.inputs) != 1 or self.linkage is not None):
            raise ValueError(f"{self.name}: an incremental transformation has one input and no linkage")

    @classmethod
    def from_config(
        cls, config: Mapping[str, Any], functions: Mapping[str, Function], sql_folder: str | None = None
    ) -> "Transform":
        kind, name = config.get("type", "python"), config["name"]
        common = dict(
            name=name,
            inputs=[Input.from_config(i) for i in config.get("inputs", [])],
            checks=config.get("quality_checks", ()),
            linkage=LinkageSettings.from_config(config["linkage"]) if config.get("linkage") else None,
            newest_by=config.get("newest_by", ()),
            incremental=config.get("incremental", False),
            keys=config.get("keys", ()),
        )
        if kind == "python":
            if name not in functions:
                raise KeyError(f"no function for transformation {name}")
            return cls(function=functions[name], **common)
        if kind in ("sql", "model"):
            text = config.get("sql")
            if text is None:
                file = Path(sql_folder or ".") / f"{config.get('model', name)}.sql"
                text = file.read_text(encoding="utf-8")
            return cls(sql=text, parameters=config.get("parameters", {}), **common)
        raise ValueError(f"Unknown transformation type {kind}")


def run_transform(spark: SparkSession, transform: Transform, inputs: Inputs) -> DataFrame:
    """The transformation's result, not yet computed."""
    for alias, df in inputs.items():
        df.createOrReplaceTempView(alias)
    if transform.sql is not None:
        return spark.sql(transform.sql, args=dict(transform.parameters) or None)
    if transform.function is None:
        raise ValueError(f"{transform.name} has neither SQL nor a function")
    result = transform.function(spark, inputs)
    if isinstance(result, str):
        return spark.sql(result)
    if isinstance(result, DataFrame):
        return result
    raise TypeError(f"{transform.name} must return a DataFrame or SQL text, got {type(result)}")


def map_batches(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Row-wise pandas logic, applied to Arrow batches where the rows are."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(each, schema)
