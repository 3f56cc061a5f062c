"""Row changes as DataFrames.

A table is a *base* (one row per key) plus *changes*: rows carrying the key, the
columns, ``_op`` (I, U or D) and ``_version``. A commit holds at most one change per key,
so no key can have more changes than there are commits and no group can run hot.

Every function takes frames and returns a frame; nothing is executed here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VERSION = "_version"
OP = "_op"
INSERT, UPDATE, DELETE = "I", "U", "D"


def latest_changes(changes: DataFrame, keys: Sequence[str], commits: int | None = None) -> DataFrame:
    """The newest change of each key, with its ``_op``.

    The changes of a single commit are that already, as ``commits=1`` says.
    """
    rest = [c for c in changes.columns if c not in keys and c != VERSION]
    if commits == 1:
        return changes.select(*keys, *rest)
    return first_per_key(changes, keys, [VERSION]).select(*keys, *rest)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is highest in ``order``.

    Spark cuts each task's rows down to one per key before the shuffle. Measured against ``max_by`` over
    a struct, which sorts as well and carries its buffers along: 1.2 s to 1.9 s on 4 million rows.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order)))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def _changed_keys(changes: DataFrame, keys: Sequence[str], commits: int | None) -> DataFrame:
    found = changes.select(*keys)
    return found if commits == 1 else found.distinct()


def as_of(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], commits: int | None = None, buckets: int | None = None
) -> DataFrame:
    """The table after ``changes`` (made by so many ``commits``, where known).

    The base is only anti-joined with the changed keys: while these are few, Spark
    broadcasts them and the base is read without a shuffle. If the base lies in hash ``buckets`` of its
    keys, the changes are dealt into the same ones, so that it is not shuffled beyond a broadcast either.
    Filters on any column reach the scan of the base, filters on keys reach both scans.
    """
    if buckets:
        changes = changes.repartition(buckets, *keys)
    untouched = base.join(_changed_keys(changes, keys, commits), list(keys), "left_anti")
    current = latest_changes(changes, keys, commits).where(F.col(OP) != DELETE)
    return untouched.select(*base.columns).unionByName(current.select(*base.columns))


def inserted(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.lit(INSERT).alias(OP))


def updated(state: DataFrame, predicate: Column | str, assignments: dict[str, Column | str]) -> DataFrame:
    """Changes of ``UPDATE ... SET ... WHERE``. A NULL predicate leaves the row alone."""
    columns = []
    for field in state.schema.fields:
        value = assignments.get(field.name, F.col(field.name))
        value = F.expr(value) if isinstance(value, str) else value
        columns.append(value.cast(field.dataType).alias(field.name))
    return state.where(predicate).select(*columns, F.lit(UPDATE).alias(OP))


def _without_values(df: DataFrame, like: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [
        F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name)
        for f in like.schema.fields
    ]


def deleted(state: DataFrame, predicate: Column | str, keys: Sequence[str]) -> DataFrame:
    """Changes of ``DELETE ... WHERE``: keys only. A NULL predicate keeps the row."""
    gone = state.where(predicate)
    return gone.select(*_without_values(gone, state, keys), F.lit(DELETE).alias(OP))


@dataclass(frozen=True)
class Clause:
    """One WHEN clause of a merge.

    ``condition`` is SQL text over the aliases ``t`` (target) and ``s`` (source).
    ``values`` maps target columns to SQL text over the same aliases; without it the
    source columns that carry a target column's name are taken and others are ignored.
    """

    matched: bool
    action: str  # "update", "delete" or "insert"
    condition: str | None = None
    values: dict[str, str] | None = None


def when_matched_update(condition: str | None = None, values: dict[str, str] | None = None) -> Clause:
    return Clause(True, "update", condition, values)


def when_matched_delete(condition: str | None = None) -> Clause:
    return Clause(True, "delete", condition)


def when_not_matched_insert(condition: str | None = None, values: dict[str, str] | None = None) -> Clause:
    return Clause(False, "insert", condition, values)


def merged(state: DataFrame, source: DataFrame, keys: Sequence[str], clauses: Sequence[Clause]) -> DataFrame:
    """Changes of ``MERGE``: for each source row the first clause that holds decides.

    Target rows without a source row cannot change, so the target is first cut down to
    the source's keys (a broadcast while the source is small) and the rest is a left join
    from the source, which Spark may split where a source key runs hot.

    Two changes for one key come out as two rows; the commit refuses them.
    """
    fields = state.schema.fields
    touched = state.join(source.select(*keys).distinct(), list(keys), "left_semi")
    target = touched.select("*", F.lit(True).alias("_present")).alias("t")
    on = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    pairs = source.alias("s").join(target, on, "left")

    present = F.coalesce(F.col("t._present"), F.lit(False))
    fires = F.lit(None).cast("int")
    for i, clause in reversed(list(enumerate(clauses))):
        holds = present if clause.matched else ~present
        if clause.condition:
            holds = holds & F.coalesce(F.expr(clause.condition), F.lit(False))
        fires = F.when(holds, F.lit(i)).otherwise(fires)

    chosen = pairs.withColumn("_clause", fires).where(F.col("_clause").isNotNull())

    def value(field, clause: Clause) -> Column:
        missing = F.lit(None).cast(field.dataType)
        if field.name in keys:
            return F.col(f"s.{field.name}").cast(field.dataType)
        if clause.action == "delete":
            return missing
        if clause.values is not None:
            kept = F.col(f"t.{field.name}") if clause.matched else missing
            given = clause.values.get(field.name)
            return F.expr(given).cast(field.dataType) if given is not None else kept
        if field.name in source.columns:
            return F.col(f"s.{field.name}").cast(field.dataType)
        return F.col(f"t.{field.name}") if clause.matched else missing

    def pick(make) -> Column:
        out = F.when(F.col("_clause") == 0, make(clauses[0]))
        for i, clause in enumerate(clauses[1:], start=1):
            out = out.when(F.col("_clause") == i, make(clause))
        return out

    letters = {"update": UPDATE, "delete": DELETE, "insert": INSERT}
    return chosen.select(
        *[pick(lambda c, f=f: value(f, c)).alias(f.name) for f in fields],
        pick(lambda c: F.lit(letters[c.action])).alias(OP),
    )


GONE = "_gone"


def marked(feed: DataFrame, deletes: Column | str | None, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A feed's rows as states of their keys, with ``_gone`` where a row deletes.

    Such a row is a tombstone: it keeps its key and its place in ``order`` and nothing else. Kept in the
    table like any row, it stands against older rows that arrive later. A NULL condition deletes nothing.
    """
    if deletes is None:
        gone = F.lit(False)
    else:
        gone = F.coalesce(F.expr(deletes) if isinstance(deletes, str) else deletes, F.lit(False))
    kept = {*keys, *order}
    values = [F.col(c) if c in kept else F.when(~gone, F.col(c)).alias(c) for c in feed.columns]
    return feed.select(*values, gone.alias(GONE))


def live(state: DataFrame) -> DataFrame:
    """The rows that exist: without tombstones and their mark."""
    return state.where(~F.col(GONE)).drop(GONE)


def overtaken(state: DataFrame, feed: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Changes by which a feed (one row per key) replaces what is not newer; equal ``order`` goes to the feed.

    The state is cut down to the feed's keys and narrowed to keys, order and the columns that the feed lacks,
    which stay as they are, so nothing else of the table is read. Columns that the table lacks are ignored.
    A NULL in ``order`` counts as older than any value.
    """
    given = feed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in state.schema.fields if f.name in feed.columns])
    absent = [c for c in state.columns if c not in feed.columns]
    known = state.join(given.select(*keys), list(keys), "left_semi")
    known = known.select(*keys, F.struct(*order).alias("_held"), *absent)
    pairs = given.join(known, list(keys), "left")
    fresh = F.col("_held").isNull()
    kept = pairs.where(fresh | (F.struct(*order) >= F.col("_held")))
    return kept.select(*state.columns, F.when(fresh, INSERT).otherwise(UPDATE).alias(OP))


def restored(
    changes_since: DataFrame, then: DataFrame, keys: Sequence[str], commits: int | None = None
) -> DataFrame:
    """Changes that bring the table back to the state ``then``.

    ``changes_since`` are the changes after that state; no other key can differ, so the
    work grows with them and not with the table.
    """
    values = [c for c in then.columns if c not in keys]
    now = latest_changes(changes_since, keys, commits).select(
        *keys, F.col(OP).alias("_now_op"), F.struct(*values).alias("_now")
    )
    was = then.join(_changed_keys(changes_since, keys, commits), list(keys), "left_semi").select(
        *keys, F.struct(*values).alias("_was")
    )
    both = now.join(was, list(keys), "left")
    existed = F.col("_was").isNotNull()
    exists = F.col("_now_op") != DELETE
    op = (
        F.when(~existed & exists, DELETE)
        .when(existed & ~exists, INSERT)
        .when(existed & ~F.col("_was").eqNullSafe(F.col("_now")), UPDATE)
    )
    return both.withColumn(OP, op).where(F.col(OP).isNotNull()).select(*keys, "_was.*", OP).select(
        *then.columns, OP
    )


def change_counts(changes: DataFrame) -> DataFrame:
    """Inserted, updated and deleted rows per version; reads the ``_op`` column only."""
    return changes.groupBy(VERSION).agg(
        F.count_if(F.col(OP) == INSERT).alias("inserted"),
        F.count_if(F.col(OP) == UPDATE).alias("updated"),
        F.count_if(F.col(OP) == DELETE).alias("deleted"),
    )
