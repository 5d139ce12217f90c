"""The layers on storage, and one run that brings all of them up to date."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts.domains import CONTRACTS
from tidemark.contracts.model import Contract, Rule
from tidemark.plans import gold
from tidemark.plans import users as user_plan
from tidemark.plans.medallion import stamp
from tidemark.sources.files import empty, file_stream, frames_by_schema, parquet_stream, write_clustered
from tidemark.sources.storage import child_names, delete, exists, make_folder, matching, written
from tidemark.sources.topics import source_stream
from tidemark.streaming.flows import QUARANTINE, arrived_type, bronze_stream, read_bronze, read_route, rule_metrics, settle_bronze, silver_stream
from tidemark.streaming.buckets import KeyedState, ValueIndex

# The two domains fused into one table instead of getting a silver table each.
FUSED = ("users_mongo", "users_mssql")
USERS_TYPE = T.StructType([*user_plan.SHAPE.fields, T.StructField("_merged_at", T.TimestampType())])

# Gold table -> how to compute it, the silver tables it reads, its clustering column.
GOLD: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], str]] = {
    "payments_by_status": (gold.payments_by_status, ("payments",), "status"),
    "payment_funnel": (gold.payment_funnel, ("payment_events",), "event_name"),
    "payment_lifecycle": (gold.payment_lifecycle, ("payment_events",), "payment_id"),
    "driver_performance": (gold.driver_performance, ("driver_shifts", "drivers", "orders"), "driver_id"),
    "revenue_per_restaurant": (
        gold.revenue_per_restaurant,
        ("order_items", "orders", "restaurants"),
        "restaurant_cnpj",
    ),
    "user_behavior": (gold.user_behavior, ("search_events", "recommendations", "users"), "user_id"),
}


@dataclass(frozen=True)
class Warehouse:
    """All tables of one pipeline below ``base``. A full refresh is a new ``version``."""

    spark: SparkSession
    base: str
    version: int = 0
    contracts: Mapping[str, Contract] = field(default_factory=lambda: CONTRACTS)
    tie_break: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @staticmethod
    def open(spark: SparkSession, base: str, full_refresh: bool = False, **options) -> Warehouse:
        """The newest version below ``base``, or the next one, with empty checkpoints, to refresh."""
        known = [int(n[1:]) for n in child_names(spark, base) if n[:1] == "v" and n[1:].isdigit()]
        newest = max(known, default=0)
        return Warehouse(spark, base, newest + 1 if full_refresh and known else newest, **options)

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/v{self.version}/{layer}/{name}"

    def _checkpoint(self, layer: str, name: str) -> str:
        return self.path("checkpoints", f"{layer}/{name}")

    @property
    def silver_contracts(self) -> list[Contract]:
        return [c for c in self.contracts.values() if "silver" in c.layers and c.name not in FUSED]

    def _arrived_type(self, contract: Contract) -> T.StructType:
        """What bronze holds by now; silver and quarantine carry the columns beyond the contract along."""
        return arrived_type(self.spark, contract, self.path("bronze_counts", contract.name))

    def state(self, contract: Contract) -> KeyedState:
        return KeyedState(
            self.spark,
            self.path("silver", contract.name),
            self._arrived_type(contract),
            contract.keys,
            tie_break=self.tie_break.get(contract.name),
            compression=contract.compression,
        )

    def value_index(self, contract: Contract, rule: Rule) -> ValueIndex:
        """Which keys have carried each value of a column that a ``unique`` rule is about."""
        path = self.path("unique", f"{contract.name}/{rule.field}")
        return ValueIndex.over(self.spark, path, contract.record_type, rule.field, contract.keys, compression=contract.compression)

    def _unique_rules(self, contract: Contract) -> list[Rule]:
        return [r for r in contract.rules_for("silver") if r.check == "unique"]

    def clashes(self, name: str) -> DataFrame:
        """The current rows of a domain, with a column for each of its unique rules: whether the row's value has been
        carried by another key, as of the last run."""
        rows, contract = self.silver(name), self.contracts[name]
        for rule in self._unique_rules(contract):
            rows = self.value_index(contract, rule).flagged(rows, rule.name)
        return rows

    def bronze(self, name: str) -> DataFrame:
        """A domain's records, with the columns that arrived beyond its contract, as text."""
        return read_bronze(self.spark, self.contracts[name], *self._bronze_paths(name))

    def _bronze_paths(self, name: str) -> list[str]:
        return [self.path(layer, name) for layer in ("bronze", "bronze_counts", "bronze_settled")]

    def settle(self, names: Iterable[str] | None = None) -> None:
        """Rewrite bronze batches in large files by key, between two runs; see :func:`settle_bronze`."""
        for name in names or self.contracts:
            settle_bronze(self.spark, self.contracts[name], *self._bronze_paths(name))

    def silver(self, name: str) -> DataFrame:
        if name != "users":
            return self.state(self.contracts[name]).read()
        return self._refreshed("silver", "users") if self._runs("silver", "users") else empty(self.spark, USERS_TYPE)

    def quarantine(self, name: str) -> DataFrame:
        if name == "users":
            return self._refreshed("quarantine", "users")
        folder = self.path("quarantine", name)
        return read_route(self.spark, folder, self._arrived_type(self.contracts[name]), QUARANTINE)

    def rule_metrics(self, name: str) -> DataFrame:
        """Counts per batch and rule of both scopes; a failure of a reject rule is a row dropped from bronze."""
        layers = (("bronze", "bronze_counts"), ("silver", "quarantine"))
        parts = [rule_metrics(self.spark, self.path(layer, name)).withColumn("scope", F.lit(s)) for s, layer in layers]
        return parts[0].unionByName(parts[1])

    def gold(self, name: str) -> DataFrame:
        return self._refreshed("gold", name)

    def _runs(self, layer: str, name: str) -> list[str]:
        """Folders of the finished refreshes of a table, oldest first."""
        return [p.removesuffix("/_SUCCESS") for p in matching(self.spark, f"{self.path(layer, name)}/run=*/_SUCCESS")]

    def _refreshed(self, layer: str, name: str) -> DataFrame:
        runs = self._runs(layer, name)
        return self.spark.read.parquet(runs[-1] if runs else self.path(layer, name))

    def _refresh(self, df: DataFrame, layer: str, name: str, key: str) -> None:
        """Write a table anew beside what is there. Readers see the finished run before it until this one is done,
        and a failed one never; the run before stays for readers at work, older ones go."""
        runs = self._runs(layer, name)
        number = int(runs[-1].rsplit("=", 1)[1]) + 1 if runs else 0
        write_clustered(df, f"{self.path(layer, name)}/run={number:09d}", [key])
        for old in runs[:-1]:
            delete(self.spark, old)

    def run_bronze(
        self,
        source: Callable[[Contract], DataFrame | None],
        as_of=None,
        frames: Callable[[DataFrame], Sequence[DataFrame]] | None = None,
    ) -> None:
        """Ingest every domain, all streams side by side; ``frames`` opens batches whose schema may drift.

        A domain whose source is not there, None, gets an empty table.
        """
        sources = {name: source(c) for name, c in self.contracts.items()}
        for name in sources:
            make_folder(self.spark, self.path("bronze", name))
        _finish(
            bronze_stream(
                df, self.contracts[name], self.path("bronze", name), self.path("bronze_counts", name),
                self._checkpoint("bronze", name), as_of, frames,
            )
            for name, df in sources.items()
            if df is not None
        )

    def run_silver(self, as_of=None) -> None:
        _finish(
            silver_stream(
                parquet_stream(self.spark, self.path("bronze", c.name), self._arrived_type(c), nested=True),
                c,
                self.state(c),
                self.path("quarantine", c.name),
                self._checkpoint("silver", c.name),
                as_of,
                {r.name: self.value_index(c, r) for r in self._unique_rules(c)},
            )
            for c in self.silver_contracts
        )

    def run_users(self, as_of=None) -> None:
        """Fuse the registries once; tagging and splitting read what was written."""
        sources = [self.bronze(name).select(*self.contracts[name].field_names) for name in FUSED]
        ties = self.tie_break.get("users")
        tagged = user_plan.candidates(*sources, ties, lambda fused: written(fused, self.path("work", "users_fused")))
        good, bad = user_plan.split_users(written(tagged, self.path("work", "users_tagged")), as_of)
        self._refresh(good, "silver", "users", "cpf")
        self._refresh(bad, "quarantine", "users", "cpf")

    def run_gold(self, names: Iterable[str] = tuple(GOLD), as_of=None) -> None:
        """Recompute gold tables, side by side: none reads another, and one's last tasks leave room."""

        def compute(name: str) -> None:
            build, inputs, key = GOLD[name]
            result = stamp(build(*[self.silver(i) for i in inputs]), "_computed_at", as_of)
            self._refresh(result, "gold", name, key)

        names = list(names)
        with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
            list(pool.map(compute, names))

    def run(self, mode: str, conf: Mapping[str, str], as_of=None) -> None:
        """All layers in order; ``mode`` and ``conf`` choose the source of the change records.

        Exported files are opened by their own schemas, which must keep to each contract's evolution policy.
        """
        if mode == "volume":
            files = int(conf["files_per_trigger"]) if "files_per_trigger" in conf else None
            size = conf.get("bytes_per_trigger")

            def exported(c: Contract) -> DataFrame | None:
                path = f"{conf['base']}/{c.name}"
                return file_stream(self.spark, path, files, size) if exists(self.spark, path) else None

            self.run_bronze(exported, as_of, frames_by_schema)
        else:
            self.run_bronze(lambda c: source_stream(self.spark, c, mode, conf), as_of)
        self.run_silver(as_of)
        self.run_users(as_of)
        self.run_gold(as_of=as_of)


def _finish(queries: Iterable) -> None:
    """Start all, then wait for all; the first failure surfaces after none is left running."""
    running = list(queries)
    failures = []
    for query in running:
        try:
            query.awaitTermination()
        except Exception as failure:  # noqa: BLE001 - re-raised below once every query has ended
            failures.append(failure)
    if failures:
        raise failures[0]
