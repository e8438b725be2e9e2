"""The quality gate in front of publishing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from lamina.contracts.checks import Outcome, evaluate
from lamina.contracts.model import Contract, ContractStore


class ContractViolation(RuntimeError):
    """Raised when a dataset may not be published."""


@dataclass(frozen=True)
class Refusal:
    """A dataset that was built but not published, and why."""

    stage: str
    dataset: str
    reason: str


class DatasetsRefused(ContractViolation):
    """Raised once for all datasets that may not be published; the others are."""

    def __init__(self, refusals: Sequence[Refusal]):
        self.refusals = tuple(refusals)
        super().__init__("; ".join(f"{r.stage}/{r.dataset}: {r.reason}" for r in refusals))


@dataclass(frozen=True)
class GateResult:
    check: str
    passed: bool
    message: str = ""


def require(df: DataFrame, contract: Contract, **options: Any) -> Outcome:
    """Validate and raise on failure; returns the outcome otherwise."""
    outcome = evaluate(df, contract, **options)
    if not outcome.passed:
        raise ContractViolation(f"{outcome.summary()}: {'; '.join(outcome.errors)}")
    return outcome


def _contract_result(label: str, df: DataFrame, contract: Contract, options: Mapping) -> GateResult:
    outcome = evaluate(df, contract, **options)
    if outcome.passed:
        return GateResult(label, True, f"{len(outcome.rows)} checks passed")
    return GateResult(label, False, "; ".join(outcome.errors))


def _function_result(name: str, check: Callable, df: DataFrame) -> GateResult:
    try:
        answer = check(df)
    except Exception as wrong:  # a user function may fail in any way; that is a failed check
        return GateResult(name, False, f"Error running check: {wrong}")
    if isinstance(answer, bool):
        return GateResult(name, answer)
    if isinstance(answer, tuple) and len(answer) == 2:
        return GateResult(name, bool(answer[0]), str(answer[1]))
    return GateResult(name, False, f"Check must return bool or (bool, str), got {type(answer)}")


def run_gate(
    df: DataFrame,
    checks: Sequence[str],
    store: ContractStore | None = None,
    functions: Mapping[str, Callable] | None = None,
    **options: Any,
) -> list[GateResult]:
    """Results of all ``checks``: ``contract:<name>`` or the name of a check function."""
    results = []
    for check in checks:
        if check.startswith("contract:"):
            name = check.removeprefix("contract:").strip().removesuffix(".yml")
            label = f"contract:{name}"
            if store is None:
                results.append(GateResult(label, False, "no contracts configured"))
                continue
            try:
                contract = store.load(name)
            except (FileNotFoundError, ValueError) as wrong:
                results.append(GateResult(label, False, f"Error validating contract: {wrong}"))
                continue
            results.append(_contract_result(label, df, contract, options))
        elif functions and check in functions:
            results.append(_function_result(check, functions[check], df))
        else:
            results.append(GateResult(check, False, f"Quality check not found: {check}"))
    return results


def enforce(dataset: str, df: DataFrame, checks: Sequence[str], **options: Any) -> list[GateResult]:
    """Run the gate and raise if any check fails."""
    results = run_gate(df, checks, **options)
    failed = [r for r in results if not r.passed]
    if failed:
        text = "; ".join(f"{r.check}: {r.message}" for r in failed)
        raise ContractViolation(
            f"Quality checks failed for {dataset}: {len(failed)} of {len(results)} checks failed: {text}"
        )
    return results
