"""Integrity checks: primary key, unique, foreign key, NOT NULL and CHECK rules.

Spark tables do not enforce these. Each check returns the violations as a
DataFrame; `enforce` counts them before anything is published and raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from framestore.errors import InvalidInputError, TableStoreError
from framestore.functions.project import pick
from framestore.operators.keyed import any_null, quoted
from framestore.validation import as_list, check_columns

SAMPLE_ROWS = 20


@dataclass(frozen=True)
class ForeignKey:
    """`columns` must hold a row of `parent_columns` of table `parent`, or a NULL."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(as_list(self.columns)))
        object.__setattr__(self, "parent_columns", tuple(as_list(self.parent_columns)))
        if len(self.columns) != len(self.parent_columns):
            raise InvalidInputError("A foreign key needs as many columns as it references", data=self.columns)


@dataclass(frozen=True)
class Constraints:
    """The rules of one table. `checks` maps a name to a SQL predicate."""

    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "primary_key", tuple(as_list(self.primary_key)))
        object.__setattr__(self, "unique", tuple(tuple(as_list(u)) for u in self.unique))
        object.__setattr__(self, "not_null", tuple(as_list(self.not_null)))

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.not_null + self.primary_key))

    @property
    def key_sets(self) -> dict[str, tuple[str, ...]]:
        named = {f"UNIQUE({', '.join(u)})": u for u in self.unique}
        if self.primary_key:
            named[f"PRIMARY KEY({', '.join(self.primary_key)})"] = self.primary_key
        return named

    @property
    def row_rules(self) -> dict[str, Column]:
        """Rules that look at one row only, as conditions that are true for a bad row."""
        rules = {f"NOT NULL({c})": quoted(c).isNull() for c in self.required}
        for name, predicate in self.checks.items():
            # A CHECK that is NULL is fulfilled.
            rules[f"CHECK({name})"] = ~F.coalesce(F.expr(predicate), F.lit(True))
        return rules


def row_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that break a rule, once per broken rule, with the rule name in `constraint`.

    One pass over the rows whatever the number of rules.
    """
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    any_broken = reduce(lambda a, b: a | b, rules.values())
    return df.where(any_broken).select(F.explode(broken).alias("constraint"), *[quoted(c) for c in df.columns])


def not_null_violations(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Rows with a NULL in one of `columns`."""
    names = check_columns(as_list(columns), df.columns)
    return row_violations(df, {f"NOT NULL({c})": quoted(c).isNull() for c in names})


def check_violations(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Rows for which a named SQL predicate is false. NULL counts as fulfilled."""
    return row_violations(df, Constraints(checks=checks).row_rules)


def unique_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows in `n_rows`.

    Counted with partial aggregation; keys with a NULL are never equal.
    """
    names = check_columns(as_list(keys), df.columns)
    return (
        df.where(~any_null(names))
        .groupBy(*[quoted(k) for k in names])
        .agg(F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )


def existing_key_violations(df: DataFrame, existing: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys of `df` that the table `existing` holds already."""
    names = check_columns(as_list(keys), df.columns)
    new_keys = df.select(*[quoted(k) for k in names]).where(~any_null(names)).distinct()
    # Only keys of the table that are among the new ones are made distinct.
    known = pick(existing, names).where(~any_null(names)).join(new_keys, names, "left_semi").distinct()
    return known.select(*[quoted(k) for k in names])


def repeated_keys(changed: DataFrame, after: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys of `changed` rows that `after`, all rows after the change, holds more than once, with `n_rows`.

    Only rows with such a key are counted: a semi join, which Spark guards by a Bloom filter where it pays.
    """
    names = check_columns(as_list(keys), after.columns)
    wanted = changed.select(*[quoted(k) for k in names]).where(~any_null(names)).distinct()
    return unique_violations(pick(after, names).join(wanted, names, "left_semi"), names)


def foreign_key_violations(
    child: DataFrame,
    columns: str | Sequence[str],
    parent: DataFrame,
    parent_columns: str | Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose reference is not NULL and not in the parent."""
    names = check_columns(as_list(columns), child.columns)
    parent_names = check_columns(as_list(parent_columns) or names, parent.columns, "parent")
    references = parent.select(*[quoted(p).alias(c) for p, c in zip(parent_names, names)]).distinct()
    referring = child.where(~any_null(names))
    return referring.join(references, names, "left_anti").select(*[quoted(c) for c in child.columns])


def orphan_keys(
    child: DataFrame,
    columns: str | Sequence[str],
    parent: DataFrame,
    parent_columns: str | Sequence[str] | None = None,
) -> DataFrame:
    """References without a parent, each once, with the number of child rows in `n_rows`.

    The child is counted per reference first, so the join sees each value once.
    """
    names = check_columns(as_list(columns), child.columns)
    parent_names = check_columns(as_list(parent_columns) or names, parent.columns, "parent")
    references = parent.select(*[quoted(p).alias(c) for p, c in zip(parent_names, names)]).distinct()
    counted = child.where(~any_null(names)).groupBy(*[quoted(c) for c in names]).agg(F.count("*").alias("n_rows"))
    return counted.join(references, names, "left_anti")


def referenced_keys_gone(
    child: DataFrame,
    columns: str | Sequence[str],
    removed: DataFrame,
    after: DataFrame | None,
    parent_columns: str | Sequence[str] | None = None,
) -> DataFrame:
    """References of `child` to `removed` rows of its parent, each once, with the number of child rows in `n_rows`.

    `after` are the rows of the parent after the change (None: none); a key that one of them still has is not gone. The child is counted per reference, so
    a hot one is one row, and only its references to removed keys are looked for among the rows that stay.
    """
    names = check_columns(as_list(columns), child.columns)
    parent_names = check_columns(as_list(parent_columns) or names, removed.columns, "parent")
    keys = [quoted(p).alias(c) for p, c in zip(parent_names, names)]
    gone = removed.select(*keys).where(~any_null(names)).distinct()
    counted = child.where(~any_null(names)).groupBy(*[quoted(c) for c in names]).agg(F.count("*").alias("n_rows"))
    found = counted.join(gone, names, "left_semi")
    return found if after is None else found.join(after.select(*keys).distinct(), names, "left_anti")


def enforce(
    df: DataFrame,
    constraints: Constraints,
    parents: dict[str, DataFrame] | None = None,
    existing: DataFrame | None = None,
    foreign_keys: bool = True,
    error: type[TableStoreError] = TableStoreError,
    more: dict[str, DataFrame] | None = None,
) -> None:
    """Raise `error` if rows of `df` break a rule.

    `existing` are the rows already in the table when `df` is appended to it; `more` are violations of further rules by name. One query
    counts the violations of all rules; only a broken one costs another. The
    error carries the number of violations and up to 20 sample rows per rule.
    """
    for name in constraints.required:
        check_columns([name], df.columns)
    rules = constraints.row_rules
    queries = {name: unique_violations(df, keys) for name, keys in constraints.key_sets.items()}
    if existing is not None:
        for name, keys in constraints.key_sets.items():
            queries[f"{name} with existing rows"] = existing_key_violations(df, existing, keys)
    if foreign_keys:
        for fk in constraints.foreign_keys:
            parent = (parents or {})[fk.parent]
            name = f"FOREIGN KEY({', '.join(fk.columns)}) REFERENCES {fk.parent}"
            queries[name] = orphan_keys(df, fk.columns, parent, fk.parent_columns)
    queries |= more or {}
    counts = []
    if rules:
        each = [F.struct(F.lit(n).alias("rule"), F.count_if(bad).alias("n")) for n, bad in rules.items()]
        counts.append(df.agg(F.array(*each).alias("counts")).select(F.explode("counts").alias("c")).select("c.rule", "c.n"))
    counts += [q.agg(F.count("*").alias("n")).select(F.lit(n).alias("rule"), "n") for n, q in queries.items()]
    if not counts:
        return
    found: dict[str, tuple[int, list[dict]]] = {}
    broken = {r["rule"]: r["n"] for r in reduce(lambda a, b: a.unionByName(b), counts).collect() if r["n"]}
    for name, n in broken.items():
        query = df.where(rules[name]) if name in rules else queries[name]
        found[name] = (n, [r.asDict(True) for r in query.limit(SAMPLE_ROWS).collect()])
    if found:
        summary = {name: n for name, (n, _) in found.items()}
        raise error(f"Constraint violations: {summary}", data=found)
