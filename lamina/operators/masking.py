"""Column-level masking: drop, pseudonymize or keep columns by rule."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lamina.functions.hashing import pseudonym


@dataclass(frozen=True)
class MaskingRule:
    """What happens to the columns of one table.

    ``drop`` wins over ``hash``, which wins over ``keep``. An empty ``keep`` keeps everything
    that is neither dropped nor hashed.
    """

    drop: frozenset[str] = frozenset()
    hash: frozenset[str] = frozenset()
    keep: frozenset[str] = frozenset()
    keep_all: bool = False
    algorithm: str = "sha256"
    empty_as_null: bool = False

    @classmethod
    def of(
        cls,
        drop: Iterable[str] = (),
        hash: Iterable[str] = (),
        keep: Iterable[str] = (),
        **options,
    ) -> "MaskingRule":
        return cls(frozenset(drop), frozenset(hash), frozenset(keep), **options)

    @classmethod
    def from_config(cls, config: dict) -> "MaskingRule":
        """Rule from a plain mapping with the keys used in table configurations."""
        return cls.of(
            drop=config.get("exclude_columns", ()),
            hash=config.get("pseudonymize", ()),
            keep=config.get("retain", ()),
            keep_all=config.get("retain_all", False),
            algorithm=config.get("hash_algorithm", "sha256"),
        )


def apply_masking(df: DataFrame, rule: MaskingRule | None) -> DataFrame:
    """``df`` with ``rule`` applied, columns in source order; hashed columns get ``_Hash``."""
    if rule is None or rule.keep_all:
        return df
    chosen = []
    for name in df.columns:
        if name in rule.drop:
            continue
        column = F.col(f"`{name}`")
        if name in rule.hash:
            chosen.append(
                pseudonym(column, rule.algorithm, rule.empty_as_null).alias(f"{name}_Hash")
            )
        elif not rule.keep or name in rule.keep:
            chosen.append(column)
    if not chosen:
        raise ValueError("No columns to select after applying the masking rule")
    return df.select(*chosen)


def present_columns(df: DataFrame, forbidden: Iterable[str]) -> list[str]:
    """The forbidden (personal) columns that ``df`` still carries, in schema order."""
    names = set(forbidden)
    return [c for c in df.columns if c in names]


def column_catalogue(df: DataFrame) -> DataFrame:
    """``df``'s schema as rows (column_name, column_type, position)."""
    spark: SparkSession = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, column_type string, position int")
