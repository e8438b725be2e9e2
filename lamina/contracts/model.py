"""Data contracts as plain dataclasses."""

from __future__ import annotations

import functools
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from lamina.contracts.types import to_spark_type

REQUIRED = (
    "version", "dataset", "stage", "owner", "description",
    "schema", "quality_rules", "sla", "evolution",
)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    description: str = ""
    unique: bool = False
    not_null: bool = False
    min_value: Any = None
    max_value: Any = None
    allowed_values: tuple | None = None
    pattern: str | None = None
    deprecated: bool = False
    deprecation_date: str | None = None
    replacement: str | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> "ColumnSpec":
        limits: dict[str, Any] = {}
        for part in raw.get("constraints") or []:
            limits.update(part)
        allowed = limits.get("allowed_values")
        return cls(
            name=raw["name"],
            type=raw["type"],
            nullable=raw.get("nullable", True),
            description=raw.get("description", ""),
            unique=bool(limits.get("unique")),
            not_null=bool(limits.get("not_null")),
            min_value=limits.get("min_value"),
            max_value=limits.get("max_value"),
            allowed_values=None if allowed is None else tuple(allowed),
            pattern=limits.get("pattern"),
            deprecated=bool(raw.get("deprecated", False)),
            deprecation_date=raw.get("deprecation_date"),
            replacement=raw.get("replacement"),
        )

    def constraints(self) -> list[dict[str, Any]]:
        out: list[dict[str, Any]] = []
        if self.unique:
            out.append({"unique": True})
        if self.not_null:
            out.append({"not_null": True})
        for name in ("min_value", "max_value", "pattern"):
            if getattr(self, name) is not None:
                out.append({name: getattr(self, name)})
        if self.allowed_values is not None:
            out.append({"allowed_values": list(self.allowed_values)})
        return out

    def to_dict(self) -> dict[str, Any]:
        out: dict[str, Any] = {"name": self.name, "type": self.type, "nullable": self.nullable}
        if self.description:
            out["description"] = self.description
        if self.constraints():
            out["constraints"] = self.constraints()
        if self.deprecated:
            out["deprecated"] = True
            out["deprecation_date"] = self.deprecation_date
            out["replacement"] = self.replacement
        return out


@dataclass(frozen=True)
class Rule:
    """A quality rule.

    Types: ``uniqueness``, ``not_null`` (both need ``column``), ``volume`` (``min_rows``),
    ``custom_sql`` (``query``, compared with ``expected``), and three native forms of common
    queries: ``violations`` (no row may satisfy ``where``), ``pattern`` (``column``, ``pattern``)
    and ``absent_columns`` (``columns``).
    """

    name: str
    type: str
    severity: str = "error"
    column: str | None = None
    query: str | None = None
    expected: Any = None
    min_rows: int | None = None
    where: str | None = None
    pattern: str | None = None
    columns: tuple[str, ...] = ()
    run_on: str | None = None
    skip_if: str | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> "Rule":
        known = {k: raw[k] for k in cls.__dataclass_fields__ if k in raw}
        if "columns" in known:
            known["columns"] = tuple(known["columns"])
        return cls(**known)

    def to_dict(self) -> dict[str, Any]:
        values = {k: getattr(self, k) for k in self.__dataclass_fields__}
        if not self.columns:
            values.pop("columns")
        else:
            values["columns"] = list(self.columns)
        return {k: v for k, v in values.items() if v is not None}

    def applies(self, load_mode: str) -> bool:
        """Whether the rule runs on this kind of load (``full_load`` or ``incremental``)."""
        if self.run_on is not None and self.run_on != load_mode:
            return False
        return self.skip_if is None or self.skip_if != load_mode


@dataclass(frozen=True)
class Contract:
    version: str
    dataset: str
    stage: str
    owner: str
    description: str
    columns: tuple[ColumnSpec, ...]
    rules: tuple[Rule, ...] = ()
    sla: Mapping[str, Any] = field(default_factory=dict)
    evolution: Mapping[str, Any] = field(default_factory=dict)
    privacy: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> "Contract":
        if not raw:
            raise ValueError("Contract is empty")
        missing = [name for name in REQUIRED if name not in raw]
        if missing:
            raise ValueError(f"Contract missing required fields: {missing}")
        return cls(
            version=str(raw["version"]),
            dataset=raw["dataset"],
            stage=raw["stage"],
            owner=raw["owner"],
            description=raw["description"],
            columns=tuple(ColumnSpec.from_dict(c) for c in raw["schema"].get("columns", [])),
            rules=tuple(Rule.from_dict(r) for r in raw["quality_rules"] or []),
            sla=raw["sla"] or {},
            evolution=raw["evolution"] or {},
            privacy=raw.get("privacy") or {},
        )

    def to_dict(self) -> dict[str, Any]:
        out = {
            "version": self.version, "dataset": self.dataset, "stage": self.stage,
            "owner": self.owner, "description": self.description,
            "schema": {"columns": [c.to_dict() for c in self.columns]},
            "quality_rules": [r.to_dict() for r in self.rules],
            "sla": dict(self.sla), "evolution": dict(self.evolution),
        }
        if self.privacy:
            out["privacy"] = dict(self.privacy)
        return out

    def column(self, name: str) -> ColumnSpec | None:
        return next((c for c in self.columns if c.name == name), None)

    def struct(self) -> T.StructType:
        """The contract's schema as a Spark schema."""
        return T.StructType(
            [
                T.StructField(
                    c.name, to_spark_type(c.type), c.nullable,
                    {"comment": c.description} if c.description else {},
                )
                for c in self.columns
            ]
        )

    def absent_personal_columns(self) -> tuple[str, ...]:
        """Columns the privacy block says must not be in the data."""
        names: list[str] = []
        for entry in self.privacy.get("excluded_pii_fields") or []:
            names += [n.strip() for n in str(entry).split(":", 1)[0].split(",")]
        hashed = self.privacy.get("pseudonymized_fields") or []
        names += [h["field"] for h in hashed if h.get("output_field") and h["output_field"] != h["field"]]
        return tuple(dict.fromkeys(n for n in names if n))


@functools.lru_cache(maxsize=256)
def _parse(path: str, changed: float) -> Contract:
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return Contract.from_dict(json.loads(text))
    try:
        import yaml
    except ImportError as missing:  # pragma: no cover - depends on the installation
        raise RuntimeError("YAML contracts need the PyYAML package; use JSON instead") from missing
    return Contract.from_dict(yaml.safe_load(text))


class ContractStore:
    """Contracts by name: those given as objects first, then files ``<name>.yml`` / ``.json``."""

    def __init__(self, folder: str | None = None, contracts: Mapping[str, Contract] | None = None):
        self.folder = Path(folder) if folder else None
        self.contracts = dict(contracts or {})

    def load(self, name: str) -> Contract:
        name = name.strip()
        name = name[:-4] if name.endswith(".yml") else name
        if name in self.contracts:
            return self.contracts[name]
        for suffix in (".yml", ".yaml", ".json"):
            path = self.folder / f"{name}{suffix}" if self.folder else None
            if path is not None and path.exists():
                return _parse(str(path), path.stat().st_mtime)
        raise FileNotFoundError(f"Contract not found: {name}")

    def names(self) -> list[str]:
        found = set(self.contracts)
        if self.folder and self.folder.exists():
            found |= {p.stem for p in self.folder.iterdir() if p.suffix in (".yml", ".yaml", ".json")}
        return sorted(found)
