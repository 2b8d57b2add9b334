"""Layers of versioned tables, and building them up to a wanted state."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.checks import REPORT, Check, run_checks
from siltbed.operators.merge import union_all
from siltbed.sources.tables import VersionedTable

LAYERS = ["raw", "staging", "curated", "trusted"]


INPUT_LABEL = "input-version:"


@dataclass(frozen=True)
class Model:
    """A table of a layer, built from the tables it names as inputs.

    ``row_wise`` says that every input row gives its output rows on its own, so
    that new input rows can be added without building all others again. A model
    whose table is not replaced but carried on, as a history is, says by
    ``store`` how its table takes the inputs in.
    """

    layer: str
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    checks: tuple[Check, ...] = field(default=())
    partition_by: tuple[str, ...] = field(default=())
    row_wise: bool = False
    store: Callable[..., int] | None = None

    @property
    def key(self) -> str:
        return f"{self.layer}.{self.name}"


@dataclass(frozen=True)
class Layers:
    """All tables under one root folder, named ``<layer>.<table>``."""

    spark: SparkSession
    root: str

    def table(self, key: str) -> VersionedTable:
        layer, name = key.split(".")
        return VersionedTable(self.spark, f"{self.root}/{layer}/{name}")

    def read(self, key: str) -> DataFrame:
        return self.table(key).read()

    def build(self, model: Model) -> int:
        """Build a model from its inputs' newest versions and replace its table, or carry it on."""
        entries = [self.table(name).entry() for name in model.inputs]
        frames = [self.table(name).read_entry(entry) for name, entry in zip(model.inputs, entries)]
        if model.store is not None:
            return model.store(self.table(model.key), model.build(*frames))
        return self.table(model.key).overwrite(
            model.build(*frames), partition_by=list(model.partition_by), **_input_versions(model, entries)
        )

    def extend(self, model: Model) -> int:
        """Bring a row-wise model of one input up to date by its new input rows only.

        The last build noted which input version it read. If rows of that
        version were replaced or deleted since, the model is built anew.
        """
        table, source = self.table(model.key), self.table(model.inputs[0])
        built = table.newest()
        seen = built and built["summary"].get(INPUT_LABEL + model.inputs[0])
        if not model.row_wise or len(model.inputs) != 1 or not seen:
            return self.build(model)
        entry = source.entry()
        if entry["version"] == int(seen):
            return built["version"]
        added = source.added_since(int(seen))
        if added is None:
            return self.build(model)
        return table.append(model.build(added), **_input_versions(model, [entry]))

    def build_to(self, models: list[Model], layer: str | None, rebuild: bool = True) -> None:
        """Bring the layers to a state: built up to a layer, empty beyond it.

        ``None`` empties all. Tables beyond the layer are emptied from the last
        layer back, before anything is built, so no table outlives the data it
        came from. Models of one layer do not depend on each other and are
        built at the same time. With ``rebuild=False`` tables that hold rows
        already are left as they are.
        """
        wanted = LAYERS[: LAYERS.index(layer) + 1] if layer else []
        filled = dict(zip(models, self._totals(models)))
        for name in reversed(LAYERS):
            if name not in wanted:
                _at_once(self._empty, [m for m in models if m.layer == name and filled[m] > 0])
        for name in wanted:
            _at_once(self.build, [m for m in models if m.layer == name and (rebuild or filled[m] == 0)])

    def _empty(self, model: Model) -> None:
        table = self.table(model.key)
        table.recreate(table.schema(), list(model.partition_by))

    def _totals(self, models: list[Model]) -> list[int]:
        entries = _at_once(lambda model: self.table(model.key).newest(), models)
        return [int(entry["summary"]["total-records"]) if entry else 0 for entry in entries]

    def row_counts(self, models: list[Model]) -> DataFrame:
        """Rows per table, 0 for one that was never built."""
        counts = [(m.layer, m.name, total) for m, total in zip(models, self._totals(models))]
        return self.spark.createDataFrame(counts, "layer string, table_name string, row_count bigint")

    def test(self, models: list[Model]) -> DataFrame:
        """All declared checks of the models' tables as one report."""
        frames = dict(zip([m.key for m in models], _at_once(self.read, [m.key for m in models])))
        tested = [m for m in models if m.checks]
        if not tested:
            return self.spark.createDataFrame([], f"layer string, table_name string, {REPORT}")
        reports = _at_once(lambda m: run_checks(frames[m.key], list(m.checks), frames), tested)
        return union_all(
            [
                report.select(F.lit(m.layer).alias("layer"), F.lit(m.name).alias("table_name"), "*")
                for m, report in zip(tested, reports)
            ]
        )

    def inventory(self, keys: list[str]) -> DataFrame:
        """Rows, data files, size and versions of every table."""
        frames = []
        for key in keys:
            entry = self.table(key).entry()
            frames.append(
                self.table(key)
                .files(entry["version"])
                .agg(
                    F.coalesce(F.sum("record_count"), F.lit(0)).alias("row_count"),
                    F.count(F.lit(1)).alias("file_count"),
                    F.round(F.coalesce(F.sum("file_size_in_bytes"), F.lit(0)) / 1024.0, 1).alias("size_kb"),
                )
                .select(
                    F.lit(key).alias("table_name"),
                    "*",
                    F.lit(entry["version"]).cast("bigint").alias("version_count"),
                )
            )
        return union_all(frames)


def _input_versions(model: Model, entries: list[dict]) -> dict[str, str]:
    return {INPUT_LABEL + name: str(entry["version"]) for name, entry in zip(model.inputs, entries)}


def _at_once(action: Callable, items: Iterable) -> list:
    """Run an action that starts Spark jobs for several items, a few at a time."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return list(pool.map(action, items))
