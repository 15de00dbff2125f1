"""Small column helpers shared by all operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.config import MICROS_PER_DAY, MICROS_PER_SECOND

MINOR = 10_000  # money is added up in whole ten-thousandths, so sums do not depend on task order


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, low, high) -> Column:
    """Bound ``c``; a missing value stays missing (``greatest`` alone would replace it)."""
    c = col(c)
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(c.isNotNull(), F.greatest(F.least(c, high), low))


def ratio(a, b) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(col(a), col(b))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def minor(c) -> Column:
    return F.round(col(c) * MINOR).cast("long")


def major(c) -> Column:
    return col(c) / F.lit(float(MINOR))


def exact_sum(c) -> Column:
    """Sum of a money column, the same on every run whatever the order of the rows."""
    return major(F.sum(minor(c)))


def exact_avg(c) -> Column:
    return exact_sum(c) / F.count(col(c))


def micros(ts) -> Column:
    return F.unix_micros(col(ts))


def day_number(us) -> Column:
    """Days since the epoch of a time in microseconds; right for times before it too."""
    return F.floor(col(us) / F.lit(MICROS_PER_DAY))


def hour_number(us) -> Column:
    return F.floor(col(us) / F.lit(3600 * MICROS_PER_SECOND))


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def fixed(c, places: int) -> Column:
    """A number as text with fixed places, rounded on its exact binary value (``format_string`` rounds the
    shortest decimal text instead, and halves up)."""
    return F.call_function("format_number", col(c), F.lit("0." + "0" * places if places else "0"))


def keyed_hash(key: str, seed: int) -> Column:
    """52 bits of the MD5 of a key and a seed: the same in every engine that has MD5."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def py_round(c, places: int) -> Column:
    """Round on the exact binary value, exact ties to even."""
    return fixed(c, places).cast("double")
