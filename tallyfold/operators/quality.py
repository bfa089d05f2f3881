"""Declared rules of a table as jobs that return the rows breaking them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.schemas import Table


class ConstraintError(ValueError):
    """Rows break a declared rule."""


def unique_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that occur more than once, with their count; NULLs never clash."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(known).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def check_violations(df: DataFrame, check: str) -> DataFrame:
    """Rows for which the condition is false; NULL passes."""
    return df.where(~F.expr(check))


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.length(c) > n for c, n in limits.items()]))


def range_violations(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Rows with a number that does not fit the declared type."""
    return df.where(reduce(lambda a, b: a | b, [_overflows(c, t) for c, t in types.items()]))


def _overflows(column: str, type_name: str) -> Column:
    return F.col(column).isNotNull() & F.col(column).try_cast(type_name).isNull()


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference is set but has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti").select(*child.columns)


def breach(table: Table, df: DataFrame) -> Column:
    """Name of the first row rule that a row breaks, NULL when it breaks none."""
    return F.coalesce(*breaches(table, df))


def breaches(table: Table, df: DataFrame) -> list[Column]:
    """For each row rule its name where a row breaks it, else NULL.

    Covers required columns, text lengths, number ranges and checks, all in
    one pass; key columns that are yet to be generated are not looked at.
    """
    return [F.when(test, F.lit(reason)) for test, reason in _row_rules(table, set(df.columns))]


def _row_rules(table: Table, present: set[str]) -> list[tuple[Column, str]]:
    """The row rules over the columns that are present: what breaks the rule, and its name."""
    found = []
    for c in table.columns:
        if c.name not in present:
            continue
        if c.required:
            found.append((F.col(c.name).isNull(), f"{c.name} is null"))
        if c.max_length:
            found.append((F.length(c.name) > c.max_length, f"{c.name} is too long"))
        if c.type.typeName() == "decimal":
            found.append((_overflows(c.name, c.type.simpleString()), f"{c.name} is out of range"))
    for name, check in table.checks.items():
        found.append((~F.expr(check), f"{name} fails"))
    return found


def row_violations(table: Table, df: DataFrame) -> DataFrame:
    """Rows that break a row rule, with the rule as `breach`."""
    return df.withColumn("breach", breach(table, df)).where(F.col("breach").isNotNull())


def violations(table: Table, df: DataFrame, parents: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One frame of offending rows per declared rule group of a table, with whole rows; `audit` judges all at once."""
    found = {"rows": row_violations(table, df)}
    for columns in [table.key, *table.unique]:
        found[f"unique {columns}"] = unique_violations(df, [columns])
    for ref in table.references:
        found[f"reference {ref.column}"] = fk_violations(df, ref.column, parents[ref.parent], ref.parent_column)
    return found


_ENTRY = "struct<domain:int,value:string,slot:int>"
_OWN = -1


@dataclass
class _Domain:
    """A column whose values rows own and refer to, or a row rule, of which the keys of the rows that break it."""

    source: str
    repeated: str | None
    looks: list[tuple[str, str]]  # (table, rule) of whatever refers to the values; its place is the slot of an entry


def _domains(tables: dict[str, Table], rows: dict[str, DataFrame]) -> tuple[list[_Domain], dict[str, list[Column]]]:
    """All domains, and for each table what one of its rows says about values: (domain, value, slot), NULL for nothing."""
    owned = {(t, c): None for t in rows for c in (tables[t].key, *tables[t].unique)}
    places = {at: place for place, at in enumerate(owned)}
    domains = [_Domain(t, f"{c} is repeated", []) for t, c in owned]
    entries = {}
    for name, df in rows.items():
        table, made = tables[name], []

        def entry(when: Column, domain: int, value: str, slot: int) -> Column:
            text = F.col(value).cast("string")
            return F.when(when, F.struct(F.lit(domain), text, F.lit(slot)).cast(_ENTRY))

        for column in dict.fromkeys((table.key, *table.unique)):
            made.append(entry(F.col(column).isNotNull(), places[name, column], column, _OWN))
        for ref in table.references:
            if ref.parent in rows:
                at = (ref.parent, ref.parent_column)
                if at not in places:
                    places[at] = len(domains)
                    domains.append(_Domain(ref.parent, None, []))
                looks = domains[places[at]].looks
                made.append(entry(F.col(ref.column).isNotNull(), places[at], ref.column, len(looks)))
                looks.append((name, f"{ref.column} refers to no row"))
        for test, rule in _row_rules(table, set(df.columns)):
            made.append(entry(test, len(domains), table.key, 0))
            domains.append(_Domain(name, None, [(name, rule)]))
        entries[name] = made
    return domains, entries


def audit(tables: dict[str, Table], rows: dict[str, DataFrame]) -> DataFrame:
    """Everything that breaks a declared rule: (table_name, rule, value, n).

    For a row rule `value` is the key of the row; for a unique column the value that occurs more than once; for a
    reference the value that no row of the parent has. `n` counts the rows. Keys count as unique columns; a NULL is
    never repeated and refers to nothing.

    All rules of all tables are judged by one aggregate over what the rows own and refer to, which is added up in each
    task before it is shuffled, once; each table is scanned once, and no rows are gathered for a hot parent. An entry
    names its column and rule by small numbers. Only what was found is shuffled again, into tasks of even size.
    References to tables that are not among `rows` are not looked at.
    """
    domains, entries = _domains(tables, rows)
    union = None
    for name, df in rows.items():
        said = df.select(F.inline(F.filter(F.array(*entries[name]), lambda e: e.isNotNull())))
        union = said if union is None else union.unionByName(said)
    slots = range(max(len(d.looks) for d in domains))
    counted = union.groupBy("domain", "value").agg(
        F.count_if(F.col("slot") == _OWN).alias("own"), *(F.count_if(F.col("slot") == s).alias(f"n{s}") for s in slots)
    )

    def of_domain(text) -> Column:
        return F.get(F.array(*(F.lit(text(d)).cast("string") for d in domains)), F.col("domain"))

    def found(when: Column, source: Column, rule: Column, n: Column) -> Column:
        return F.when(when, F.struct(source.alias("source"), rule.alias("rule"), n.alias("n")))

    own = F.col("own")
    parts = [found(own > 1, of_domain(lambda d: d.source), of_domain(lambda d: d.repeated), own)]
    for s in slots:
        table, rule = (of_domain(lambda d, i=i: d.looks[s][i] if s < len(d.looks) else None) for i in (0, 1))
        parts.append(found((own == 0) & (F.col(f"n{s}") > 0), table, rule, F.col(f"n{s}")))
    judged = counted.select("value", F.inline(F.filter(F.array(*parts), lambda e: e.isNotNull())))
    return judged.select(F.col("source").alias("table_name"), "rule", "value", "n").hint("rebalance")


def enforce(offending: DataFrame, message: str) -> None:
    """Raise when there is any offending row."""
    row = offending.first()
    if row is not None:
        raise ConstraintError(f"{message}: {row.asDict()}")
