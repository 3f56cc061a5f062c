from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First and last second that a Spark timestamp can print with a four-digit year.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def apply_hints(df: DataFrame, hints: dict[str, str]) -> DataFrame:
    """Give hinted columns their type; a value that does not fit becomes NULL instead of an error."""
    return df.select(
        *[F.col(c).try_cast(hints[c]).alias(c) if c in hints else F.col(c) for c in df.columns]
    )


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Epoch seconds to timestamp, sub-seconds dropped.

    NaN, infinite and out-of-range values become NULL, so that one bad reading
    cannot stop a stream under ANSI casts.
    """
    seconds = _col(seconds)
    usable = seconds.between(_FIRST_SECOND, _LAST_SECOND)
    return F.when(usable, F.timestamp_seconds(seconds.try_cast("bigint")))


def day_of(ts: Column | str) -> Column:
    return F.date_trunc("DD", _col(ts))


def clean_identifier(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "[^a-zA-Z0-9]", "_")


def user_identifier() -> Column:
    """The current user as part of a table or database name."""
    return clean_identifier(F.current_user())


def local_part(address: Column | str) -> Column:
    """Text before the first ``@``, dots turned to underscores."""
    return F.replace(F.split_part(_col(address), F.lit("@"), F.lit(1)), F.lit("."), F.lit("_"))


def two_digits(number: Column | str) -> Column:
    """Zero-padded to two digits; longer numbers stay whole (``lpad`` alone would cut them)."""
    text = _col(number).cast("string")
    return F.when(F.length(text) >= 2, text).otherwise(F.lpad(text, 2, "0"))


def next_file_number(name: Column | str) -> Column:
    """Aggregate: one more than the highest leading number of names such as ``03.json``; 1 if none."""
    number = F.split_part(_col(name), F.lit("."), F.lit(1)).try_cast("int")
    return F.coalesce(F.max(number), F.lit(0)) + 1


# Amounts below this are told apart to the hundredth by a double.
_LARGEST_AMOUNT = 9e13


def cents(amount: Column | str) -> Column:
    """An amount as a whole number of hundredths; NULL if it is none, as with finer fractions or NaN."""
    amount = _col(amount)
    whole = F.rint(amount * 100)
    return F.when((F.abs(amount) < _LARGEST_AMOUNT) & (whole / 100 == amount), whole.cast("bigint"))


def wide_sum(whole: Column | str) -> Column:
    """Sum of whole numbers whose total may not fit a bigint."""
    return F.sum(_col(whole).cast("decimal(20,0)"))


# A whole number is added in two halves, of the bits above and below this one.
_HALF = 20


class Total:
    """A sum of amounts, possibly made in steps, that is exact wherever it can be and never rounds a row.

    ``whole`` is the amount as a whole number of ``1 / unit``, NULL where it is none. As long as all amounts
    of a group are whole, whole numbers are added, so the sum does not depend on the order of the
    rows, hence not on partitioning. Otherwise, finer fractions or NaN among them, it is the plain sum.

    The halves of the whole numbers are added as bigints, which stay inside generated code; the total may be a
    million times what a bigint holds. A group beyond that, or of more than 8 * 10^12 rows, gets the plain sum.
    """

    def __init__(self, name: str):
        self.high, self.low, self.plain, self.odd = (f"_{name}_{part}" for part in ("high", "low", "plain", "odd"))

    def start(self, amount: Column | str, whole: Column) -> list[Column]:
        """Aggregates of the first step."""
        amount = _col(amount)
        return [
            F.try_sum(F.shiftright(whole, _HALF)).alias(self.high),
            F.try_sum(whole.bitwiseAND(F.lit((1 << _HALF) - 1))).alias(self.low),
            F.sum(amount).alias(self.plain),
            F.count_if(amount.isNotNull() & whole.isNull()).alias(self.odd),
        ]

    def again(self) -> list[Column]:
        """Aggregates of a further step over the outcome of the one before."""
        # A half that did not fit is NULL, which a sum would pass over: it makes the group an odd one instead.
        lost = F.col(self.plain).isNotNull() & (F.col(self.odd) == 0) & (F.col(self.high).isNull() | F.col(self.low).isNull())
        odd = F.sum(F.when(lost, 1).otherwise(F.col(self.odd))).alias(self.odd)
        return [*(F.try_sum(c).alias(c) for c in (self.high, self.low)), F.sum(self.plain).alias(self.plain), odd]

    def value(self, unit: int = 100) -> Column:
        """The sum, from the columns of the last step."""
        whole = F.col(self.high).cast("decimal(20,0)") * (1 << _HALF) + F.col(self.low)
        exact = (F.col(self.odd) == 0) & F.col(self.high).isNotNull() & F.col(self.low).isNotNull()
        return F.when(exact, whole.cast("double") / unit).otherwise(F.col(self.plain))
