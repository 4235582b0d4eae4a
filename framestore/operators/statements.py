"""UPDATE and DELETE statements for many parameter sets, read by Spark's own parser, as one change on keys.

What can be said about all sets at once: the condition compares columns with parameters, and the new
values come from parameters and constants. Then the sets are rows with a key, and the last set of a key counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from framestore.errors import InvalidInputError
from framestore.functions.project import ident

_QUOTED_OR_BIND = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|:(\w+)""")


@dataclass(frozen=True)
class KeyedStatement:
    """`keys` maps key columns to parameters, `values` the columns to set to SQL in which parameters are columns."""

    table: str
    keys: dict[str, str]
    values: dict[str, str]
    is_delete: bool

    def rows(self, params: DataFrame, *more: str) -> DataFrame:
        """The parameter sets as rows of key columns, new values and the columns `more`."""
        keys = [F.expr(ident(bind)).alias(column) for column, bind in self.keys.items()]
        return params.select(*keys, *[F.expr(sql).alias(column) for column, sql in self.values.items()], *more)


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _column(node) -> str:
    parts = node.nameParts()
    return parts.apply(parts.size() - 1)


def _equalities(condition, sql: str) -> dict[str, str]:
    if _kind(condition) == "And":
        left, right = _equalities(condition.left(), sql), _equalities(condition.right(), sql)
        if not left.keys() & right.keys():
            return left | right
    if _kind(condition) == "EqualTo":
        sides = {_kind(side): side for side in (condition.left(), condition.right())}
        if sides.keys() == {"UnresolvedAttribute", "NamedParameter"}:
            return {_column(sides["UnresolvedAttribute"]): sides["NamedParameter"].name()}
    raise InvalidInputError("With many parameter sets the condition must be column = :parameter, joined by AND", data=sql)


def _has_column(node) -> bool:
    children = node.children()
    return _kind(node).startswith("Unresolved") and "Function" not in _kind(node) or any(
        _has_column(children.apply(i)) for i in range(children.size())
    )


def _value(node, sql: str) -> str:
    """The text of an expression, with its parameters as columns."""
    if _has_column(node):
        raise InvalidInputError("With many parameter sets the new values must come from parameters and constants", data=sql)
    origin = node.origin()
    text = sql[origin.startIndex().get() : origin.stopIndex().get() + 1]
    return _QUOTED_OR_BIND.sub(lambda m: ident(m[1]) if m[1] else m[0], text)


def keyed_statement(spark: SparkSession, sql: str) -> KeyedStatement | None:
    """The parts of an UPDATE or DELETE statement; None for another one."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    if _kind(plan) not in ("UpdateTable", "DeleteFromTable"):
        return None
    is_delete = _kind(plan) == "DeleteFromTable"
    relation = plan.table()
    while _kind(relation) == "SubqueryAlias":
        relation = relation.child()
    parts = relation.multipartIdentifier()
    condition = plan.condition() if is_delete else (plan.condition().get() if plan.condition().isDefined() else None)
    keys = _equalities(condition, sql) if condition is not None else {}
    if not keys:
        raise InvalidInputError("With many parameter sets the statement needs a condition", data=sql)
    values: dict[str, str] = {}
    if not is_delete:
        assignments = plan.assignments()
        for i in range(assignments.size()):
            values[_column(assignments.apply(i).key())] = _value(assignments.apply(i).value(), sql)
        if values.keys() & keys.keys():
            raise InvalidInputError("With many parameter sets a column of the condition cannot be set", data=sql)
    return KeyedStatement(".".join(parts.apply(i) for i in range(parts.size())), keys, values, is_delete)
