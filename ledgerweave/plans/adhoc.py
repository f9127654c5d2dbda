"""Query texts supplied by users or models, run read-only with a row cap."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerweave.functions.jsontext import json_object
from ledgerweave.plans.resume import FETCHED

# Functions that reach code or files outside the query language.
_FORBIDDEN = {"java_method", "reflect", "try_reflect", "input_file_name", "input_file_block_start",
              "input_file_block_length", "assert_true", "raise_error"}
# Leaves of an analysed plan that read nothing.
_SOURCELESS = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef"}


class Refused(Exception):
    """Why a query text may not run."""


@dataclass(frozen=True)
class QueryResult:
    """Either rows or an error text; the text is empty where there are rows."""
    rows: DataFrame | None
    error: str


def _items(seq) -> Iterator:
    """The elements of a Scala sequence."""
    at = seq.iterator()
    while at.hasNext():
        yield at.next()


def _nodes(plan) -> Iterator:
    """The nodes of a logical plan with those of its subqueries and common table expressions."""
    yield plan
    for group in (plan.children(), plan.innerChildren(), plan.subqueries()):
        for child in _items(group):
            yield from _nodes(child)


def _expressions(node) -> Iterator:
    found = list(_items(node.expressions()))
    while found:
        one = found.pop()
        yield one
        found += _items(one.children())


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _check_parsed(spark: SparkSession, text: str, names: set[str]) -> None:
    """Refuses other tables, files, functions of the session, and names made up at run time.

    This looks at the parsed text, before Spark looks up or opens anything it names.
    """
    jvm = spark._jvm.org.apache.spark.sql.catalyst
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    builtin = jvm.analysis.FunctionRegistry.builtin()
    nodes = list(_nodes(plan))
    defined = {alias._1().lower() for n in nodes if _kind(n) == "UnresolvedWith"
               for alias in _items(n.cteRelations())}
    for node in nodes:
        if "UnresolvedIdentifier" in _kind(node):
            raise Refused("IDENTIFIER is not allowed")
        if _kind(node) == "UnresolvedRelation":
            parts = list(_items(node.multipartIdentifier()))
            if len(parts) > 1 or parts[0].lower() not in names | defined:
                raise Refused(f"table {'.'.join(parts)} is not given")
        for e in _expressions(node):
            if "UnresolvedIdentifier" in _kind(e):
                raise Refused("IDENTIFIER is not allowed")
            if _kind(e) == "UnresolvedFunction":
                parts = [p.lower() for p in _items(e.nameParts())]
                known = builtin.functionExists(jvm.FunctionIdentifier(parts[-1]))
                if len(parts) > 1 or parts[0] in _FORBIDDEN or not known:
                    raise Refused(f"function {'.'.join(parts)} is not allowed")


def _check_analysed(plan, views: set[str]) -> None:
    """Refuses a plan in which anything but the given views reads something."""
    if _kind(plan) == "View":
        if plan.desc().identifier().table() not in views:
            raise Refused(f"table {plan.desc().identifier().table()} is not given")
        return
    below = [c for group in (plan.children(), plan.innerChildren(), plan.subqueries())
             for c in _items(group)]
    if not below and _kind(plan) not in _SOURCELESS:
        raise Refused(f"{_kind(plan)} is not given")
    for child in below:
        _check_analysed(child, views)


def run_query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame],
              cap: int = FETCHED) -> QueryResult:
    """The first ``cap`` rows of a query over the given tables.

    The text runs as a subquery, so statements that define or change anything do not
    parse.  Its plan may read the given tables and call Spark's own functions, nothing
    else.  Session settings and the caller's views stay as they are.  Whatever is wrong
    with the text comes back as ``SQL error: ...``.
    """
    text = sql.strip().rstrip(";").strip()
    if not text:
        return QueryResult(None, "no SQL given")
    views = {name: f"given_{uuid.uuid4().hex}" for name in tables}
    given = ",\n".join(f"`{name}` AS (SELECT * FROM `{view}`)" for name, view in views.items())
    inside = f"SELECT * FROM (\n{text}\n)"
    try:
        _check_parsed(spark, inside, {name.lower() for name in tables})
        for name, df in tables.items():
            df.createTempView(views[name])
        rows = spark.sql(f"WITH {given}\n{inside}" if given else inside)
        _check_analysed(rows._jdf.queryExecution().analyzed(), set(views.values()))
        return QueryResult(rows.limit(cap), "")
    except Exception as problem:  # noqa: BLE001 - any failure is a result here
        return QueryResult(None, f"SQL error: {str(problem).splitlines()[0]}")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def fetch_rows(result: QueryResult) -> tuple[list[str], str]:
    """The capped rows as JSON objects; failures while running become a text too."""
    if result.rows is None:
        return [], result.error
    try:
        rows = result.rows.select(json_object(result.rows.schema).alias("row"))
        return [r["row"] for r in rows.collect()], ""
    except Exception as problem:  # noqa: BLE001
        return [], f"SQL error: {str(problem).splitlines()[0]}"
