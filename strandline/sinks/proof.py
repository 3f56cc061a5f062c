"""Whether two datasets hold the same rows, and which rows differ, found by descending ranges of a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A range is cut into so many; ranges are told apart down to so many rows, and at most so many at a time.
FANOUT = 16
SMALL_ROWS = 1_000_000
MOST_RANGES = 64
_LOW_BITS = (1 << 22) - 1


def row_digest(columns: list[str]) -> list[Column]:
    """Aggregates that two sets of rows have in common if they hold the same rows, as often, in any order.

    The sum of a part of each row's hash is there for rows that occur an even number of times, which the
    exclusive or does not see. It fits a bigint up to 2 * 10^12 rows.
    """
    h = F.xxhash64(*columns)
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.bitwiseAND(F.lit(_LOW_BITS))).alias("s")]


def _order(df: DataFrame, key: str) -> Column:
    """What ranges are made of: a number or time itself, whose ranges let the scan skip files; else a hash."""
    kind = df.schema[key].dataType
    plain = isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
    return F.col(key) if plain else F.xxhash64(key)


def _inside(value: Column, low: object, high: object, kind: T.DataType) -> Column:
    """low <= value < high, where None has no limit; NULL belongs to the first range."""
    parts = []
    if low is not None:
        parts.append(value >= F.lit(low).cast(kind))
    if high is not None:
        below = value < F.lit(high).cast(kind)
        parts.append(below | value.isNull() if low is None else below)
    return reduce(Column.__and__, parts) if parts else F.lit(True)


def _any(value: Column, ranges: list[tuple], kind: T.DataType) -> Column:
    return reduce(Column.__or__, (_inside(value, low, high, kind) for low, high in ranges))


def _digests(df: DataFrame, key: str, ranges: list[tuple], columns: list[str]) -> dict[int, tuple]:
    """Number of rows and digest of each range; only rows in these ranges are read."""
    value, kind = _order(df, key), df.select(_order(df, key).alias("v")).schema["v"].dataType
    number = F.coalesce(*(F.when(_inside(value, low, high, kind), F.lit(i)) for i, (low, high) in enumerate(ranges)))
    rows = df.where(_any(value, ranges, kind)).groupBy(number.alias("i")).agg(*row_digest(columns))
    return {r.i: (r.n, r.x, r.s) for r in rows.collect()}  # one row per range


def _cut(df: DataFrame, key: str, low: object, high: object) -> list[tuple]:
    """A range in FANOUT parts of about as many rows; fewer where values repeat."""
    value, kind = _order(df, key), df.select(_order(df, key).alias("v")).schema["v"].dataType
    places = [i / FANOUT for i in range(1, FANOUT)]
    found = df.where(_inside(value, low, high, kind)).agg(F.percentile_approx(_numbered(value, kind), places, 1000)).first()[0]
    limits = sorted({x for x in found or [] if x is not None and x != low})
    ends = [low, *limits, high]
    return list(zip(ends[:-1], ends[1:]))


def _numbered(value: Column, kind: T.DataType) -> Column:
    return value.cast("timestamp") if isinstance(kind, T.TimestampNTZType) else value


def differing_ranges(source: DataFrame, copy: DataFrame, key: str) -> list[tuple]:
    """Ranges [low, high) of the key, None without a limit, that hold all differences; empty if there are none.

    A tree of digests is descended from the whole: only ranges whose digests differ are cut further. So a copy that is
    right costs one pass over both, and one that is wrong in a few places little more.
    """
    columns = source.columns
    open_, done = [(None, None)], []
    while open_:
        here, there = (_digests(df, key, open_, columns) for df in (source, copy))
        differ = [(r, max(here.get(i, (0,))[0], there.get(i, (0,))[0])) for i, r in enumerate(open_) if here.get(i) != there.get(i)]
        done += [r for r, n in differ if n <= SMALL_ROWS]
        large = [r for r, n in differ if n > SMALL_ROWS]
        if len(done) + len(large) > MOST_RANGES:  # they differ throughout: what follows compares rows in any case
            return done + large
        open_ = []
        for low, high in large:
            parts = _cut(source, key, low, high)
            if len(parts) < 2:  # one value, or only in the copy
                done.append((low, high))
            else:
                open_ += parts
    return done


def differences(source: DataFrame, copy: DataFrame, key: str) -> DataFrame:
    """Rows that the two do not hold equally often: all columns, ``n_source`` and ``n_copy``. Empty if the copy is right.

    ``key`` is any column that both are roughly laid out by; it may repeat and hold NULL. Columns must be the same
    and of kinds that can be grouped. Rows are compared exactly, digests only say where.
    """
    if set(source.columns) != set(copy.columns):
        raise ValueError(f"columns differ: {sorted(set(source.columns) ^ set(copy.columns))}")
    copy = copy.select(*source.columns)
    if [f.dataType for f in copy.schema] != [f.dataType for f in source.schema]:
        raise ValueError("types of columns differ")
    ranges = differing_ranges(source, copy, key)
    value, kind = _order(source, key), source.select(_order(source, key).alias("v")).schema["v"].dataType
    wanted = _any(value, ranges, kind) if ranges else F.lit(False)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = source.where(wanted).select("*", one.alias("n_source"), none.alias("n_copy")).unionAll(
        copy.where(wanted).select("*", none.alias("n_source"), one.alias("n_copy"))
    )
    counted = both.groupBy(*source.columns).agg(F.sum("n_source").alias("n_source"), F.sum("n_copy").alias("n_copy"))
    return counted.where("n_source != n_copy")
