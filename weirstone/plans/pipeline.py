"""The whole run: bronze gate, silver, gate, gold, gate."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from weirstone.layout import GOLD_TABLES, SILVER_TABLES, Lake
from weirstone.operators.quality import gate
from weirstone.plans.gold import GOLD
from weirstone.plans.rules import CHECKS
from weirstone.plans.silver import SILVER, Build
from weirstone.session import side_by_side
from weirstone.sources.tables import record_metrics, replace_table

log = logging.getLogger(__name__)

BUILDS: dict[str, dict[str, Build]] = {"silver": SILVER, "gold": GOLD}


class GateFailed(RuntimeError):
    """A layer did not pass its quality gate."""


@dataclass
class Outcome:
    rows: dict[tuple[str, str], int] = field(default_factory=dict)
    gates: dict[str, bool] = field(default_factory=dict)


def build_table(
    spark: SparkSession, lake: Lake, layer: str, table: str, metrics: list[tuple] | None = None
) -> int:
    """Read a table's inputs from the lake, build it and replace it; returns the rows written."""
    build = BUILDS[layer][table]
    inputs = [lake.read(spark, *source) for source in build.inputs]
    return replace_table(spark, lake, build.function(*inputs), layer, table, metrics)


def waves(layer: str) -> Iterator[list[str]]:
    """Tables of a layer grouped so that each group needs only earlier groups of the layer."""
    pending = list({"silver": SILVER_TABLES, "gold": GOLD_TABLES}[layer])
    while pending:
        ready = [
            table
            for table in pending
            if not any(source == layer and name in pending for source, name in BUILDS[layer][table].inputs)
        ]
        yield ready
        pending = [table for table in pending if table not in ready]


def build_layer(spark: SparkSession, lake: Lake, layer: str, parallel: int = 4) -> dict[tuple[str, str], int]:
    """Build every table of a layer; independent tables are submitted side by side.

    Several jobs at once keep the executors busy while small tables finish
    their last tasks.
    """
    rows: dict[tuple[str, str], int] = {}
    metrics: list[tuple] = []
    try:
        for group in waves(layer):
            counts = side_by_side(
                spark, lambda table: build_table(spark, lake, layer, table, metrics), group, parallel
            )
            rows |= {(layer, table): count for table, count in zip(group, counts)}
    finally:
        record_metrics(spark, lake, metrics)
    return rows


def run(spark: SparkSession, lake: Lake, enforce_gates: bool = True, parallel: int = 4) -> Outcome:
    """Bronze must be in place. A failed gate stops the run unless told to carry on."""
    outcome = Outcome()
    for layer in ("bronze", "silver", "gold"):
        if layer in BUILDS:
            outcome.rows |= build_layer(spark, lake, layer, parallel)
        outcome.gates[layer] = gate(spark, lake, layer, CHECKS[layer](), parallel)
        if enforce_gates and not outcome.gates[layer]:
            raise GateFailed(f"{layer} did not pass its quality gate")
    return outcome
