"""Insert, update and delete, as expressions and on stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.calendar import stamp
from tallyfold.operators import quality, totals
from tallyfold.operators.keys import assign_keys, assign_keys_by_range
from tallyfold.operators.merge import known_rows
from tallyfold.schemas import NO_DEFAULT, NOW, TODAY, Reference, Table
from tallyfold.session import scratch, stage
from tallyfold.sources.store import Transaction

# So many keys are broadcast: 32 MB, some 200 MB as a hash table.
FEW_KEYS = 1 << 22

# -- expressions ------------------------------------------------------------


def with_defaults(df: DataFrame, table: Table, now, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add the columns that are absent, with their defaults or NULL.

    A NULL that is given stays NULL. The key, when absent, is left out.
    Other columns go, except those to `keep`.
    """
    columns = [F.col(c) for c in keep]
    for c in table.columns:
        if c.name in df.columns:
            columns.append(F.col(c.name))
        elif c.name != table.key:
            columns.append(_default(c.default, now).cast(c.type).alias(c.name))
    return df.select(*columns)


def _default(default, now) -> Column:
    if default is NO_DEFAULT:
        return F.lit(None)
    if default is NOW:
        return stamp(now)
    if default is TODAY:
        return stamp(now).cast("date")
    return F.lit(default)


def update_where(df: DataFrame, where: Column, assignments: dict[str, Column], now=None) -> DataFrame:
    """Set columns on the rows that match; `updated_at`, if there is one, is
    touched on each of them even when no value changes."""
    changes = {c: v if isinstance(v, Column) else F.lit(v) for c, v in assignments.items()}
    if "updated_at" in df.columns:
        changes["updated_at"] = stamp(now)
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        *(
            F.when(where, changes[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in df.columns
        )
    )


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """Rows that stay; a condition that is NULL for a row keeps it."""
    return df.where(~F.coalesce(where, F.lit(False)))


def without_children(child: DataFrame, column: str, deleted_keys: DataFrame) -> DataFrame:
    """Child rows that stay after the rows they refer to were deleted."""
    keys = deleted_keys.toDF(column).distinct()
    return child.join(keys, column, "left_anti").select(*child.columns)


def restrict_blockers(parents: DataFrame, parent_key: str, child: DataFrame, column: str) -> DataFrame:
    """Parent rows that some child row refers to, so that they cannot be deleted.

    Keys are made distinct in each task: the join sorts as many as there are parents, however many children these have.
    """
    keys = child.select(F.col(column).alias(parent_key)).distinct()
    return parents.join(keys, parent_key, "left_semi").select(*parents.columns)


# -- stored tables ----------------------------------------------------------


def _children(tables: dict[str, Table], parent: str) -> list[tuple[str, Reference]]:
    return [(t.name, r) for t in tables.values() for r in t.references if r.parent == parent]


def _referring(tx: Transaction, child: str, ref: Reference, keys: DataFrame) -> DataFrame:
    """Rows of `child` that refer to the parent keys; only their blocks are opened where the child lies by this key."""
    wanted = keys.select(F.col(ref.parent_column).alias(ref.column))
    blocks = tx.blocks_of(child, wanted) if tx.table(child).block_by == ref.column else None
    return known_rows(tx.read(child, blocks), wanted, ref.column)


def insert(tx: Transaction, name: str, rows: DataFrame, now, order: str | None = None, check: bool = True) -> None:
    """Append rows to a stored table, with defaults, generated ids and rules enforced.

    Ids follow the long column `order` when one is named (it is not stored),
    else the order of all given values.
    """
    with scratch(tx.spark):
        _insert(tx, name, rows, now, order, check)


def _insert(tx: Transaction, name: str, rows: DataFrame, now, order: str | None, check: bool) -> None:
    table = tx.table(name)
    given = [c for c in rows.columns if c != order]
    full = with_defaults(rows, table, now, (order,) if order else ())
    if check:
        # Staged, so that the planner knows how small the rows are when it
        # joins them to tables that are not.
        full = stage(full, "rows")
        _enforce_rules(tx, table, full)
    if table.key in full.columns:
        last = full.agg(F.max(table.key)).first()[0] or 0
        full = tx.gather_blocks(name, full)
    elif order:
        full, last = assign_keys(full, order, tx.high_key(name), table.key, gather=True)
    else:
        full, last = assign_keys_by_range(full, given, tx.high_key(name), table.key)
    tx.raise_high_key(name, last)
    totals.add(tx, name, tx.append(name, full.select(*(F.col(c.name).cast(c.type) for c in table.columns))))


def _enforce_rules(tx: Transaction, table: Table, rows: DataFrame) -> None:
    quality.enforce(quality.row_violations(table, rows), table.name)
    for column in (*table.unique, *([table.key] if table.key in rows.columns else [])):
        others = tx.ids_of(table.name, rows) if column == table.natural_key else tx.read(table.name)
        _enforce_unique(table, rows, column, others)
    for ref in table.references:
        _enforce_reference(tx, table, rows, ref)


def _enforce_unique(table: Table, rows: DataFrame, column: str, others: DataFrame) -> None:
    quality.enforce(quality.unique_violations(rows, [column]), f"{table.name}: {column} is repeated")
    quality.enforce(known_rows(others.select(column), rows, column), f"{table.name}: {column} exists")


def _enforce_reference(tx: Transaction, table: Table, rows: DataFrame, ref: Reference) -> None:
    keys = tx.read(ref.parent).select(F.col(ref.parent_column).alias(ref.column))
    found = known_rows(keys, rows, ref.column)
    dangling = quality.fk_violations(rows, ref.column, found, ref.column)
    quality.enforce(dangling, f"{table.name}: {ref.column} refers to no row")


def update(tx: Transaction, name: str, where: Column, assignments: dict[str, Column], now) -> None:
    """Update a stored table; only blocks with matching rows are rewritten.

    The rules are checked on the new rows; the key, unique columns and references only when they are assigned. A key
    that rows of another table name may not go.
    """
    table = tx.table(name)
    with scratch(tx.spark):
        blocks = tx.blocks_of(name, tx.read(name).where(where))
        if not blocks:
            return
        before = tx.read(name, blocks)
        old = stage(before.where(where), "outdated")
        new = stage(update_where(old, F.lit(True), assignments, now), "updated")
        quality.enforce(quality.row_violations(table, new), name)
        for column in {*table.unique, table.key} & set(assignments):
            others = tx.read(name).join(old.select(table.key), table.key, "left_anti")
            _enforce_unique(table, new, column, others)
        if table.key in assignments:
            _keep_named_keys(tx, name, old, new)
            tx.raise_high_key(name, new.agg(F.max(table.key)).first()[0] or 0)
        for ref in table.references:
            if ref.column in assignments:
                _enforce_reference(tx, table, new, ref)
        keys_change = bool({table.key, table.natural_key} & set(assignments))
        tx.rewrite_blocks(name, update_where(before, where, assignments, now), blocks, keys_change)
        totals.replace(tx, name, old, new)


def _keep_named_keys(tx: Transaction, name: str, old: DataFrame, new: DataFrame) -> None:
    """Raise when a key that no row has any more is still named by a child."""
    key = tx.table(name).key
    gone = old.select(key).join(new.select(key), key, "left_anti")
    for child, ref in _children(tx.store.tables, name):
        if ref.parent_column == key:
            left = known_rows(tx.read(child), gone.toDF(ref.column), ref.column)
            quality.enforce(left, f"{name}: {key} is still referred to by {child}")


def delete(tx: Transaction, name: str, where: Column) -> None:
    """Delete rows, and whatever refers to them, as the references declare.

    A `restrict` reference from a row that itself stays makes the whole
    statement fail; nothing is changed then.
    """
    with scratch(tx.spark):
        _delete(tx, name, where)


def _delete(tx: Transaction, name: str, where: Column) -> None:
    doomed: dict[str, DataFrame] = {}
    plan: list[tuple[str, DataFrame]] = []
    _collect(tx, name, tx.read(name).where(where), plan)
    for table, keys in plan:
        doomed[table] = doomed[table].union(keys).distinct() if table in doomed else keys
    for table, keys in plan:
        for child, ref in _children(tx.store.tables, table):
            if ref.on_delete != "restrict":
                continue
            left = _referring(tx, child, ref, keys)
            if child in doomed:
                left = left.join(doomed[child], tx.table(child).key, "left_anti")
            quality.enforce(left, f"{table}: still referred to by {child}")
    changes = []
    for table, keys in doomed.items():
        key = tx.table(table).key
        blocks = tx.blocks_of(table, keys)
        if blocks:
            rows = tx.read(table, blocks)
            kept, in_place = _without(tx, name, table, rows, doomed)
            changes.append((table, kept, known_rows(rows, keys, key), blocks, in_place))
    for table, kept, gone, blocks, in_place in changes:
        # Rows that a join has scattered are gathered: else each of its tasks would write a file for each block.
        kept = kept if in_place else tx.gather_blocks(table, kept)
        tx.rewrite_blocks(table, kept, blocks, keys_change=True, in_place=in_place)
        totals.remove(tx, table, gone)


def _without(
    tx: Transaction, root: str, table: str, rows: DataFrame, doomed: dict[str, DataFrame]
) -> tuple[DataFrame, bool]:
    """Rows that a delete of `root` rows leaves, and whether they lie as they did.

    Its own keys are looked up, or, if these are not few by count, those of the doomed parents, which are fewer: below
    the root a row is doomed if it names one. Few keys are broadcast, so that nothing is shuffled.
    """
    own = [(tx.table(table).key, doomed[table].select(tx.table(table).key))]
    by_parent = [
        (ref.column, keys.select(F.col(ref.parent_column).alias(ref.column)))
        for parent, keys in doomed.items()
        for child, ref in _children(tx.store.tables, parent)
        if child == table and ref.on_delete == "cascade" and ref.parent_column in keys.columns
    ]
    for lookups in (own, by_parent):
        if lookups and (table != root or lookups is own) and sum(k.count() for _, k in lookups) <= FEW_KEYS:
            for column, keys in lookups:
                rows = rows.join(F.broadcast(keys), column, "left_anti")
            return rows, True
    return rows.join(doomed[table].select(tx.table(table).key), tx.table(table).key, "left_anti"), False


def _collect(tx: Transaction, name: str, gone: DataFrame, plan: list[tuple[str, DataFrame]]) -> None:
    """Keys of the deleted rows of a table, with what tells their blocks, and below it of every table that
    cascades. They are staged, so that few keys are known to be few."""
    table = tx.table(name)
    keys = stage(gone.select(*dict.fromkeys((table.key, table.block_by))), "gone")
    plan.append((name, keys))
    for child, ref in _children(tx.store.tables, name):
        if ref.on_delete == "cascade":
            _collect(tx, child, _referring(tx, child, ref, keys), plan)
