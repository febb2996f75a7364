"""Parameterised access: named templates with filters, ad-hoc SELECTs, JSON-ready output."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date, datetime
from inspect import signature

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.plans.reports import TEMPLATES, Gold

MAX_ROWS = 1000  # the largest page that may be asked for

# Request suffix -> comparison.
COMPARISONS: dict[str, Callable[[Column, object], Column]] = {
    "from": lambda c, v: c >= v,
    "gte": lambda c, v: c >= v,
    "to": lambda c, v: c <= v,
    "lte": lambda c, v: c <= v,
    "gt": lambda c, v: c > v,
    "lt": lambda c, v: c < v,
    "like": lambda c, v: c.contains(v),
    "in": lambda c, v: c.isin(v),
}


def page(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows; all rows if no limit is given. A page beyond MAX_ROWS is refused, not cut."""
    if limit is None:
        return df
    if type(limit) is not int or not 0 < limit <= MAX_ROWS:
        raise ValueError(f"a page has 1 to {MAX_ROWS} rows, not {limit!r}; leave the limit out for all rows")
    return df.limit(limit)


# -- filters ------------------------------------------------------------------


def _literal(value: object, kind: T.DataType) -> Column:
    """The value in the column's own type; a value that does not convert matches nothing."""
    if isinstance(value, (date, datetime)):
        return F.lit(value)
    return F.lit(str(value).strip() if not isinstance(kind, T.StringType) else str(value)).try_cast(kind)


def _condition(df: DataFrame, name: str, value: object) -> Column:
    """One request parameter -> one predicate.

    A parameter that names a column is an exact match even if it ends in a
    suffix (``marketing_opt_in``); otherwise the last suffix is the comparison.
    """
    kinds = {field.name: field.dataType for field in df.schema}
    if name in kinds:
        return F.col(name) == _literal(value, kinds[name])
    column, _, suffix = name.rpartition("_")
    if suffix not in COMPARISONS or column not in kinds:
        raise ValueError(f"no filter {name!r}: columns are {', '.join(kinds)}")
    target = F.col(column)
    if suffix == "like":
        return COMPARISONS[suffix](target.cast("string"), str(value))
    if suffix == "in":
        wanted = [item.strip() for item in str(value).split(",")]
        return COMPARISONS[suffix](target, [_literal(item, kinds[column]) for item in wanted])
    return COMPARISONS[suffix](target, _literal(value, kinds[column]))


def apply_filters(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """All given filters, ANDed; parameters without a value are skipped."""
    for name, value in (filters or {}).items():
        if value is not None and value != "":
            df = df.where(_condition(df, name, value))
    return df


# -- templates ----------------------------------------------------------------


def template(gold: Gold, name: str) -> DataFrame:
    """The whole report, without the top-k that its own page shows."""
    if name not in TEMPLATES:
        raise KeyError(f"no report template named {name}")
    report = TEMPLATES[name]
    return report(gold, k=None) if "k" in signature(report).parameters else report(gold)


def run_template(
    gold: Gold, name: str, filters: Mapping[str, object] | None = None, limit: int | None = None
) -> DataFrame:
    """A whole report, narrowed by filters on its output columns and in its order; then a page of it, if asked for."""
    return page(apply_filters(template(gold, name), filters), limit)


def template_columns(gold: Gold, name: str) -> DataFrame:
    """(position, name, type, example) of a report's columns, the example from its first row, NULL if it has none."""
    report = template(gold, name)
    spark = report.sparkSession
    fields = [(p, f.name, f.dataType.simpleString()) for p, f in enumerate(report.schema, start=1)]
    known = spark.createDataFrame(fields, "position int, name string, type string")
    examples = F.array(*[F.col(f.name).cast("string") for f in report.schema])
    first = report.limit(1).select(F.posexplode(examples).alias("at", "example"))
    return known.join(first, F.col("position") == F.col("at") + 1, "left").drop("at")


# -- ad-hoc SELECT ------------------------------------------------------------

# What the parser may have made of a query: nodes that only read.
QUERY_NODES = {
    "Aggregate", "Deduplicate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join",
    "LateralJoin", "LocalLimit", "Offset", "OneRowRelation", "Pivot", "Project", "Sort", "SubqueryAlias", "Union",
    "UnresolvedHaving", "UnresolvedInlineTable", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases",
    "UnresolvedTableValuedFunction", "UnresolvedTVFAliases", "UnresolvedWith", "Unpivot", "Window", "WithWindowDefinition",
}
SUBQUERIES = {"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"}
TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack"}
JVM_CALLS = {"reflect", "java_method", "try_reflect"}
FILE_FORMATS = {"parquet", "orc", "json", "csv", "text", "xml", "avro", "delta", "iceberg", "binaryfile", "jdbc"}


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _names(node) -> list[str]:
    """Parts of the name that an unresolved relation or function has."""
    kind = node.getClass().getSimpleName()
    parts = node.multipartIdentifier() if kind == "UnresolvedRelation" else node.name() if "TableValued" in kind else node.nameParts()
    return [str(part).lower() for part in _items(parts)]


def _objections(node, is_plan: bool = True) -> Iterator[str]:
    """What in a parsed statement may not run, from the node down through expressions, subqueries and WITH."""
    kind = node.getClass().getSimpleName()
    if kind == "UnresolvedFunction":
        if _names(node)[-1] in JVM_CALLS:
            yield f"the function {_names(node)[-1]} is not allowed"
    elif "UnresolvedIdentifier" in kind:  # IDENTIFIER(...): a name that is computed
        yield "names are written out, not computed with IDENTIFIER"
    elif kind == "UnresolvedTableValuedFunction":
        if _names(node)[-1] not in TABLE_FUNCTIONS:
            yield f"the table function {_names(node)[-1]} is not allowed"
    elif kind == "UnresolvedRelation":
        names = _names(node)
        if any(mark in names[-1] for mark in "/:") or len(names) > 1 and names[0] in FILE_FORMATS:
            yield "files are not read, only tables"
    elif is_plan and kind not in QUERY_NODES:
        yield f"only queries are allowed, not {kind}"
    for child in _items(node.children()):
        yield from _objections(child, is_plan)
    if is_plan:
        for expression in _items(node.expressions()):
            yield from _objections(expression, False)
        for relation in _items(node.cteRelations()) if kind == "UnresolvedWith" else ():
            yield from _objections(relation.productElement(1))
    elif kind in SUBQUERIES:
        yield from _objections(node.plan())


# Expressions of an analysed query that run code from outside the query.
FOREIGN_CALLS = {"CallMethodViaReflection", "ScalaUDF", "PythonUDF", "HiveGenericUDF", "HiveSimpleUDF", "HiveGenericUDTF"}


def _foreign(node, is_plan: bool = True) -> Iterator[str]:
    """What the parsed names turned out to be: calls of foreign code anywhere in an analysed plan."""
    kind = node.getClass().getSimpleName()
    if kind in FOREIGN_CALLS:
        yield f"{kind} is not allowed"
    for child in _items(node.children()):
        yield from _foreign(child, is_plan)
    if is_plan:
        for expression in _items(node.expressions()):
            yield from _foreign(expression, False)
    elif hasattr(node, "plan") and kind in SUBQUERIES:
        yield from _foreign(node.plan())


def objection(spark: SparkSession, sql: object) -> str | None:
    """Why a statement may not run, or None. Judged on what Spark's parser makes of it, never on its words."""
    if not isinstance(sql, str):
        return "a statement is a text"
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as problem:  # the parser's own refusal, whichever class it has
        return f"this cannot be parsed: {str(problem).splitlines()[0]}"
    return next(_objections(parsed), None)


def run_select(spark: SparkSession, sql: str, limit: int | None = None) -> DataFrame:
    """The rows of one read-only query, or a page of them.

    Judged twice: as parsed, and, whatever its names stand for, as analysed. Both look at the plans of a
    classic session, so this does not run over Spark Connect.
    """
    reason = objection(spark, sql)
    if reason:
        raise ValueError(reason)
    rows = spark.sql(sql)
    reason = next(_foreign(rows._jdf.queryExecution().analyzed()), None)
    if reason:
        raise ValueError(reason)
    return page(rows, limit)


# -- output -------------------------------------------------------------------


def iso_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, fractions of a second only where there are any."""

    def shaped(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
            fraction = F.date_format(column, ".SSSSSS")
            return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction)).alias(field.name)
        return column

    return df.select(*[shaped(field) for field in df.schema])


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULL fields kept, dates as ISO text."""
    return iso_text(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
