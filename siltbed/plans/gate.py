"""Quality gate: promote a validated table version, or leave the target alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.operators.expectations import Expectation, statistics, validate
from siltbed.sources.tables import VersionedTable

Outcome = Literal["promoted", "blocked", "error"]
EXIT_CODES: dict[Outcome, int] = {"promoted": 0, "blocked": 1, "error": 2}


@dataclass(frozen=True)
class GateResult:
    outcome: Outcome
    results: DataFrame | None
    validated_version: int | None
    target_version: int | None
    message: str = ""

    @property
    def exit_code(self) -> int:
        return EXIT_CODES[self.outcome]


def promote(
    source: VersionedTable,
    target: VersionedTable,
    suite: list[Expectation],
    model: Callable[[DataFrame], DataFrame] = lambda df: df,
    refresh: Callable[[], object] | None = None,
    store: VersionedTable | None = None,
    run_name: str = "",
) -> GateResult:
    """Refresh the source, validate it, and write the target only if all is green.

    The version that was validated is the version that gets promoted, whatever
    is written to the source in between. Without ``refresh`` the source is
    judged as it stands. Results are kept in ``store`` under ``run_name``.
    """
    try:
        if refresh is not None:
            refresh()
        version = source.entry()["version"]
        validated = source.read(version)
        verdict = validate(validated, suite)
        # One row per expectation; pinned so that storing and judging scan once.
        results = source.spark.createDataFrame(verdict.collect(), verdict.schema)
        if store is not None:
            store.append(
                results.select(F.lit(run_name).alias("run_name"), F.lit(version).alias("validated_version"), "*")
            )
        green = statistics(results).first()["success"]
    except Exception as error:  # a broken refresh or scan is no verdict on the data
        return GateResult("error", None, None, None, str(error))
    if not green:
        return GateResult("blocked", results, version, None)
    try:
        return GateResult("promoted", results, version, target.overwrite(model(validated)))
    except Exception as error:  # the target keeps its version, as a commit shows only once complete
        return GateResult("error", results, version, None, str(error))
