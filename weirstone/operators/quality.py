"""Rule-based quality gate: one aggregation per table, one log per layer."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    NumberFormatException,
    PySparkException,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.layout import Lake
from weirstone.session import side_by_side
from weirstone.sources.tables import append_log, few_rows

log = logging.getLogger(__name__)

# Names of the built-in checks, share of rows that may break a rule.
READABLE = "readable"
NON_EMPTY = "non_empty"
NOT_NULL = "pk_not_null_"
NO_DUPLICATES = "no_duplicates"
TOLERATED_PERCENT = 5.0

LOG_SCHEMA = (
    "layer STRING, table_name STRING, check_name STRING, passed BOOLEAN, detail STRING, checked_at STRING"
)


@dataclass(frozen=True)
class Check:
    """What one table has to satisfy."""

    keys: tuple[str, ...] = ()
    rules: Mapping[str, Column] = field(default_factory=dict)
    row_filter: Column | None = None
    unique: bool = True


@dataclass(frozen=True)
class Result:
    table: str
    check: str
    passed: bool
    detail: str


def _violations(rule: Column) -> Column:
    """A row breaks a rule when the rule is false or undecided."""
    return F.count_if(~F.coalesce(rule, F.lit(False)))


def _resolvable(df: DataFrame, rule: Column) -> bool:
    try:
        df.select(rule).schema  # noqa: B018 - analysis is what is asked for
        return True
    except AnalysisException:
        return False


#: Error classes of Spark's own that say nothing about a rule: the job was lost, stopped or ran out of something.
CLUSTER_ERRORS = ("INTERNAL_ERROR", "JOB_CANCELLED", "SCHEDULER", "EXECUTOR", "OUT_OF_MEMORY", "FAILED_READ_FILE", "STAGE", "TASK", "FETCH")


def _blames_rule(problem: Exception) -> bool:
    """Whether a failure is the rule's: an error that evaluating an expression raised.

    A lost executor, an unreadable file or a cancelled job has no error class or one of the
    cluster's; that is not a finding about the data and must stop the check.
    """
    if isinstance(problem, (ArithmeticException, NumberFormatException, DateTimeException, ArrayIndexOutOfBoundsException)):
        return True
    condition = problem.getCondition() if isinstance(problem, PySparkException) else None
    return bool(condition) and not condition.startswith(CLUSTER_ERRORS)


def _measure(df: DataFrame, check: Check, rules: Mapping[str, Column]) -> dict[str, int]:
    """All counts of a table in a single pass (and a single shuffle, on the key).

    Distinct keys are counted as structs so that a key holding NULL counts
    like any other value.
    """
    counts = [F.count(F.lit(1)).alias("total")]
    counts += [F.count_if(F.col(key).isNull()).alias(f"null {key}".replace(".", "/")) for key in check.keys]
    counts += [_violations(rule).alias(f"rule {name}") for name, rule in rules.items()]
    if check.unique and check.keys:
        counts.append(F.count_distinct(F.struct(*check.keys)).alias("distinct"))
    return df.agg(*counts).first().asDict()


def _measure_resilient(df: DataFrame, check: Check, rules: Mapping[str, Column]) -> dict[str, int]:
    """If a rule fails while running (not only while resolving), find it and go on without it."""
    try:
        return _measure(df, check, rules)
    except Exception as problem:
        if not rules or not _blames_rule(problem):
            raise
    measured = _measure(df, check, {})
    for name, rule in rules.items():
        try:
            measured[f"rule {name}"] = df.agg(_violations(rule).alias("n")).first()["n"]
        except Exception as problem:
            if not _blames_rule(problem):
                raise
            log.warning("rule %r cannot be evaluated", name)
    return measured


def _percent(part: int, whole: int) -> float:
    return part / whole * 100


def measured_counts(df: DataFrame, check: Check) -> dict[str, int]:
    """Counts of a table without the distinct keys; a rule that cannot be evaluated is left out. They add up over parts."""
    rules = {name: rule for name, rule in check.rules.items() if _resolvable(df, rule)}
    return _measure_resilient(df, replace(check, unique=False), rules)


def results_of(table: str, check: Check, seen: Mapping[str, int]) -> list[Result]:
    """Results from the counts of a table. Keys tolerate no NULL and no duplicate, a rule up to 5 % violations."""
    total = seen["total"]
    if total == 0:
        return [Result(table, NON_EMPTY, False, "0 records")]
    results = []
    for key in check.keys:
        nulls = seen[f"null {key}".replace(".", "/")]
        results.append(Result(table, NOT_NULL + key, nulls == 0, f"{nulls}/{total} nulls"))
    if "distinct" in seen:
        extra = total - seen["distinct"]
        results.append(Result(table, NO_DUPLICATES, extra == 0, f"{extra} duplicates"))
    for name in check.rules:
        broken = seen.get(f"rule {name}", -1)
        share = 100.0 if broken < 0 else _percent(broken, total)
        results.append(Result(table, name, share <= TOLERATED_PERCENT, f"{broken}/{total} ({share:.1f}%)"))
    return results


def validate(table: str, df: DataFrame, check: Check) -> list[Result]:
    """Check one table."""
    if check.row_filter is not None:
        df = df.where(check.row_filter)
    rules = {name: rule for name, rule in check.rules.items() if _resolvable(df, rule)}
    return results_of(table, check, _measure_resilient(df, check, rules))


def validate_stored(spark: SparkSession, lake: Lake, table: str, path: str, check: Check) -> list[Result]:
    """As :func:`validate` for a stored table; one that cannot be read fails the ``readable`` check."""
    try:
        df = lake.load(spark, path)
    except Exception as problem:
        return [Result(table, READABLE, False, str(problem))]
    return validate(table, df, check)


def passed(results: Sequence[Result]) -> bool:
    return all(result.passed for result in results)


def result_rows(spark: SparkSession, layer: str, results: Sequence[Result]) -> DataFrame:
    """Results as log rows; there are a few per table, whatever the tables hold."""
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    rows = [(layer, r.table, r.check, r.passed, r.detail, now) for r in results]
    return few_rows(spark, rows, LOG_SCHEMA)


def log_results(spark: SparkSession, lake: Lake, layer: str, results: Sequence[Result]) -> None:
    """Append to the quality log; a broken log must not break the gate."""
    try:
        append_log(lake, result_rows(spark, layer, results), lake.quality_log_path)
    except Exception:
        log.warning("quality log of %s not written", layer, exc_info=True)


def gate(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    checks: Mapping[str, Check],
    parallel: int = 4,
    verdicts: dict[str, bool] | None = None,
) -> bool:
    """Validate every table of a layer, log all results, and say whether the layer may be used.

    ``verdicts`` takes that of each table that could be read.
    """

    def one(table: str) -> list[Result]:
        return validate_stored(spark, lake, table, lake.path(layer, table), checks[table])

    found = dict(zip(checks, side_by_side(spark, one, checks, parallel), strict=True))
    results = [result for of_table in found.values() for result in of_table]
    if verdicts is not None:
        read = {t: of_table for t, of_table in found.items() if not any(r.check == READABLE for r in of_table)}
        verdicts.update({table: passed(of_table) for table, of_table in read.items()})
    log_results(spark, lake, layer, results)
    log.info("quality of %s: %d checks, %s", layer, len(results), "passed" if passed(results) else "FAILED")
    return passed(results)
