"""The medallion job: land, refine, aggregate.

Silver and gold datasets are written to their own load directory, checked there, and become
visible by a row in the commit log only when all checks pass. A rejected load stays on disk for
inspection and is never read. Where the keys of a dataset are known, reading it gives the newest
version of each key over all its loads; ``compact`` folds them into one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession

from lamina.contracts.gate import ContractViolation, DatasetsRefused, Refusal, enforce
from lamina.contracts.model import ContractStore
from lamina.operators.linkage import deduplicate
from lamina.plans import gold, silver
from lamina.plans.transforms import Function, Input, Transform, run_transform
from lamina.sources import catalogue, files
from lamina.sources.commitlog import Commit, CommitLog
from lamina.sources.landing import Source, compact, current_rows, land_all, read_loads
from lamina.session import cut_lineage, drop_steps, step_copies
from lamina.sources.layout import DERIVED_SOURCE, layer_path, load_path

STAGES = ("bronze", "silver", "gold")


def execution_order(start: str | None = None) -> list[str]:
    """The start stage and all later ones; ``None`` or ``all`` for every stage."""
    if not start or start == "all":
        return list(STAGES)
    if start.lower() not in STAGES:
        raise ValueError(f"Unknown stage {start}")
    return list(STAGES[STAGES.index(start.lower()) :])


@dataclass
class Pipeline:
    spark: SparkSession
    root: str
    sources: Sequence[Source] = ()
    silver: Sequence[Transform] = ()
    gold: Sequence[Transform] = ()
    contracts: ContractStore | None = None
    checks: Mapping[str, Callable] = field(default_factory=dict)
    parallel: int = 4

    def __post_init__(self):
        self._naming = Lock()
        self._refused: list[Refusal] = []
        self._done: dict[str, list[Commit]] = {}
        self.log = CommitLog(self.spark, f"{self.root.rstrip('/')}/_commits")

    # ------------------------------------------------------------ inputs and outputs

    def _versions(self, stage: str, source: str, name: str) -> tuple[list[str], list[str]]:
        """Keys of a dataset whose later loads replace rows of earlier ones, and what orders them."""
        if stage == "bronze":
            tables = [t for s in self.sources if s.name == source for t in s.tables if t["name"] == name]
            found = tables[0] if tables else {}
            column = found.get("incremental_column")
            return list(found.get("keys", ())), [column] if column else []
        made = [t for t in (self.silver if stage == "silver" else self.gold) if t.name == name]
        return (list(made[0].keys), list(made[0].newest_by)) if made else ([], [])

    def _rows(self, stage: str, source: str, name: str, loads: Sequence[Row]) -> DataFrame:
        keys, newest_by = self._versions(stage, source, name)
        if keys and len(loads) > 1:
            return current_rows(self.spark, self.root, loads, keys, newest_by)
        return read_loads(self.spark, self.root, loads)

    def dataset(self, stage: str, name: str, source: str | None = None) -> DataFrame:
        """Committed rows of a dataset: of rows with one key the newest, where keys are known."""
        source = source or DERIVED_SOURCE[stage]
        return self._rows(stage, source, name, self.log.live(stage, source, name))

    def compact(self, stage: str, name: str, source: str | None = None) -> Commit:
        """Replace the loads of a dataset with known keys by one load of its current rows."""
        source = source or DERIVED_SOURCE[stage]
        keys, newest_by = self._versions(stage, source, name)
        if not keys:
            raise ValueError(f"{stage}/{source}/{name} has no keys")
        return compact(self.spark, self.root, self.log, source, name, keys, newest_by, stage)

    def _input(self, item: Input, after: int = 0) -> tuple[DataFrame | None, int | None, list[int]]:
        """Rows, row count and loads of an input; only loads behind ``after`` if any are wanted."""
        if item.stage not in STAGES:
            return files.read_parquet(self.spark, item.path), None, []
        source, name = item.dataset()
        source = source or DERIVED_SOURCE.get(item.stage, "")
        live = self.log.live(item.stage, source, name)
        if not live:
            raise ContractViolation(f"its input {item.stage}/{source}/{name} is not published")
        loads = [r for r in live if r["load_id"] > after]
        if after and not loads:
            return None, 0, []
        frame = self._rows(item.stage, source, name, loads)
        return frame, sum(r["rows_out"] or 0 for r in loads), [r["load_id"] for r in loads]

    def publish(
        self,
        stage: str,
        name: str,
        df: DataFrame,
        checks: Sequence[str] = (),
        rows_in: int | None = None,
        mode: str = "full",
        consumed: int | None = None,
        **options: Any,
    ) -> Commit:
        """Write, check what was written, then commit.

        ``mode="incremental"`` adds the rows to the dataset, ``"full"`` replaces it. ``consumed``
        is the newest input load the rows come from.
        """
        source = DERIVED_SOURCE[stage]
        last = self.log.latest(stage, source, name)
        load_id = 1 if last is None else last["load_id"] + 1
        path = load_path(layer_path(self.root, stage, source, name), load_id)
        files.write_parquet(df, path)
        written = files.read_parquet(self.spark, path)
        if checks:
            full = mode == "full"
            # An increment joins what is published, unless its rows replace those of the same keys.
            before = [] if full else self.log.live(stage, source, name)
            adds = before and not self._versions(stage, source, name)[0]
            enforce(
                name, written, checks, store=self.contracts, functions=self.checks, path=path,
                previous_rows=last["rows_out"] if full and last is not None else None,
                load_mode="full_load" if full else "incremental",
                published=read_loads(self.spark, self.root, before) if adds else None,
                published_rows=sum(r["rows_out"] or 0 for r in before), **options,
            )
        commit = Commit(
            stage, source, name, load_id, mode,
            None if consumed is None else "load_id", None if consumed is None else str(consumed),
            None if consumed is None else "bigint", rows_in, written.count(), written.schema.json(),
        )
        self.log.append(commit)
        return commit

    # ------------------------------------------------------------ stages

    def run_bronze(self) -> list[Commit]:
        return land_all(self.spark, self.sources, self.root, self.log, self.parallel)

    def _build(self, stage: str, transform: Transform) -> Commit | None:
        mode, after = "full", 0
        if transform.incremental:
            mode, after = self._progress(stage, transform)
        with self._naming:  # input names are views of the session; one transformation at a time
            found = {i.alias: self._input(i, after) for i in transform.inputs}
            frames = {alias: df for alias, (df, _, _) in found.items()}
            if any(df is None for df in frames.values()):
                return None  # nothing new
            result = run_transform(self.spark, transform, frames)
        if transform.linkage is not None:
            result = deduplicate(result, transform.linkage, transform.newest_by)
        known = [n for _, n, _ in found.values() if n is not None]
        loads = [n for _, _, ids in found.values() for n in ids]
        return self.publish(
            stage, transform.name, result, transform.checks, sum(known) if known else None, mode,
            max(loads) if transform.incremental and loads else None,
        )

    def _progress(self, stage: str, transform: Transform) -> tuple[str, int]:
        """How to go on with an incremental dataset: the mode and the last input load it holds."""
        item = transform.inputs[0]
        last = self.log.latest(stage, DERIVED_SOURCE[stage], transform.name)
        if item.stage not in STAGES or last is None or last["watermark_column"] != "load_id":
            return "full", 0
        consumed = int(last["watermark_value"])
        source, name = item.dataset()
        live = self.log.live(item.stage, source or DERIVED_SOURCE.get(item.stage, ""), name)
        # A newer full load replaces rows this dataset was built from.
        replaced = any(r["mode"] == "full" and r["load_id"] > consumed for r in live)
        return ("full", 0) if replaced else ("incremental", consumed)

    def _run(self, stage: str, transforms: Sequence[Transform]) -> list[Commit]:
        """Datasets of one stage do not depend on each other, so several are built at a time, and a refused
        one does not keep the others from being published."""

        def build(transform: Transform) -> Commit | None:
            try:
                return self._build(stage, transform)
            except ContractViolation as wrong:
                self._refused.append(Refusal(stage, transform.name, str(wrong)))
                return None

        with ThreadPoolExecutor(max_workers=max(1, self.parallel)) as pool:
            return [commit for commit in pool.map(build, transforms) if commit is not None]

    def run(self, start: str | None = None, keep_going: bool = False) -> dict[str, list[Commit]]:
        """Run a stage and all later ones.

        Raises ``DatasetsRefused`` once, with all refusals: after the first stage that has any, or
        after the last stage with ``keep_going``, when later stages work on what is published.
        """
        steps = {
            "bronze": self.run_bronze,
            "silver": lambda: self._run("silver", self.silver),
            "gold": lambda: self._run("gold", self.gold),
        }
        before, done = step_copies(), {}
        self._refused = []
        try:
            for stage in execution_order(start):
                done[stage] = steps[stage]()
                if self._refused and not keep_going:
                    break
        finally:
            drop_steps(self.spark, before)  # copies made on the way; what is published stays
        self._done = done
        if self._refused:
            raise DatasetsRefused(sorted(self._refused, key=lambda r: (STAGES.index(r.stage), r.dataset)))
        return done

    def verdicts(self) -> DataFrame:
        """(stage, dataset, published, rows_out, reason): every dataset the last run came to."""
        rows = [(stage, c.dataset, True, c.rows_out, None) for stage, found in self._done.items() for c in found]
        rows += [(r.stage, r.dataset, False, None, r.reason) for r in self._refused]
        return self.spark.createDataFrame(rows, "stage string, dataset string, published boolean, rows_out long, reason string")

    def metrics(self) -> DataFrame:
        """Rows in and out of every committed load."""
        return self.log.history()


def pipeline_from_config(
    spark: SparkSession,
    root: str,
    config: Mapping[str, Any],
    functions: Mapping[str, Function] | None = None,
    contracts: ContractStore | None = None,
    checks: Mapping[str, Callable] | None = None,
    sql_folder: str | None = None,
) -> Pipeline:
    """A pipeline from a plain mapping with ``sources``, ``silver`` and ``gold`` lists.

    Reading the mapping from YAML, and filling in secrets, is left to the caller.
    """
    def transforms(stage: str) -> list[Transform]:
        return [Transform.from_config(t, functions or {}, sql_folder) for t in config.get(stage, [])]

    return Pipeline(
        spark, root,
        [Source.from_config(s) for s in config.get("sources", [])],
        transforms("silver"), transforms("gold"), contracts, dict(checks or {}),
    )


# ---------------------------------------------------------------- the delivered datasets


def _bronze(source: str, *tables: str) -> list[Input]:
    return [Input(f"bronze_{t.lower()}", f"{source}/{t}") for t in tables]


def _refined(**names: str) -> list[Input]:
    return [Input(alias, f"refined/{name}", "silver") for alias, name in names.items()]


def delivered_silver(erp: str, crm: str | None = None) -> list[Transform]:
    """Silver transformations over the tables of an ERP source and, if given, a CRM source."""
    out = []
    if crm:
        out.append(
            Transform(
                "gdpr_customers", [Input("bronze_customers", f"{crm}/customers")],
                lambda _, t: silver.customers(t["bronze_customers"]), checks=["contract:gdpr_customers"],
            )
        )
    masters = {"OCRD": silver.partners, "OPRJ": silver.projects, "OSLP": silver.employees}
    for table, build in masters.items():
        name = f"sap_{table.lower()}_silver"
        alias = f"bronze_{table.lower()}"
        out.append(
            Transform(
                name, _bronze(erp, table),
                lambda _, t, a=alias, b=build: b(t[a]), checks=[f"contract:{name}"],
            )
        )
    for table in ("OINV", "INV1", "PCH1"):
        alias = f"bronze_{table.lower()}"
        out.append(
            Transform(
                f"silver_{table.lower()}", _bronze(erp, table),
                lambda _, t, a=alias: silver.pass_through(t[a]), incremental=True,
                keys=catalogue.KEYS[table], newest_by=[catalogue.STRATEGIES[table].delta_column],
            )
        )
    return out


def _staged(df: DataFrame) -> DataFrame:
    return cut_lineage(df, compression="zstd")


def delivered_gold(as_of: Any = None) -> list[Transform]:
    """Gold transformations over the delivered silver datasets."""
    return [
        Transform(
            "sap_revenue_metrics_gold",
            _refined(oinv="silver_oinv", inv1="silver_inv1", ocrd="sap_ocrd_silver", oprj="sap_oprj_silver"),
            lambda _, t: gold.revenue_metrics(t["oinv"], t["inv1"], t["ocrd"], t["oprj"], stage=_staged),
            checks=["contract:sap_revenue_metrics_gold"],
        ),
        Transform(
            "sap_customer_analytics_gold",
            _refined(ocrd="sap_ocrd_silver", oinv="silver_oinv"),
            lambda _, t: gold.customer_analytics(t["ocrd"], t["oinv"], as_of),
            checks=["contract:sap_customer_analytics_gold"],
        ),
        Transform(
            "sap_project_profitability_gold",
            _refined(oprj="sap_oprj_silver", inv1="silver_inv1", pch1="silver_pch1"),
            lambda _, t: gold.project_profitability(t["oprj"], t["inv1"], t["pch1"], as_of),
            checks=["contract:sap_project_profitability_gold"],
        ),
    ]
