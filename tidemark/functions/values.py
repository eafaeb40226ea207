"""Conditional, null, ratio, object and hashing expressions."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def iff(condition: Column, then, otherwise) -> Column:
    """Two-way choice; a null condition takes the ``otherwise`` side."""
    return F.when(condition, then).otherwise(otherwise)


def zero_if_null(c: Column | str) -> Column:
    return F.zeroifnull(c)


def whole_units(c: Column | str, per_one: int | None = 100) -> Column:
    """An amount in whole minor units (cents for 100), so that sums are exact in any order.

    Only for amounts that have no finer part; ``None`` leaves the amount as it is.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c if per_one is None else F.rint(c * F.lit(per_one)).cast("long")


def from_units(c: Column, per_one: int | None = 100) -> Column:
    """The amount behind a sum of ``whole_units``."""
    return c.cast("double") if per_one is None else c / F.lit(per_one)


def row_object() -> Column:
    """The whole row as one struct value."""
    return F.struct("*")


def row_json() -> Column:
    """The whole row as a JSON object; null fields are left out."""
    return F.to_json(F.struct("*"))


def ratio_to_report(
    df: DataFrame, value: str, by: Sequence[str] = (), alias: str = "ratio", scale: float = 1.0
) -> DataFrame:
    """Add each row's share of the total of ``value``, overall or within ``by``.

    The overall total is a scalar subquery, so no row has to travel to a
    single-partition window.  Within groups a window is used; feed it grouped rows.
    """
    if by:
        total = F.sum(value).over(Window.partitionBy(*by))
    else:
        total = df.agg(F.sum(value)).scalar()
    share = F.col(value).cast("double") / F.nullif(total, F.lit(0)).cast("double")
    return df.withColumn(alias, share * F.lit(float(scale)))


def hash_below(keys: Sequence[str], seed: int, fraction: float) -> Column:
    """True for about ``fraction`` of all keys; the answer for a key depends on it and the seed only.

    Built on MD5 so that any engine can recompute the same split; it does not depend on
    partitioning, task order or re-execution, unlike a random sample.  The first 32 bits are
    compared as fixed-width hex text, which orders like the number.
    """
    if fraction >= 1:
        return F.lit(True)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.substring(F.md5(text), 1, 8) < F.lit(f"{math.ceil(fraction * 2**32):08x}")


#: Hexadecimal digits of a hash that make one draw: 52 bits, which a double holds exactly.
_DRAW_DIGITS = 13


def uniform(seed: int, *keys: Column | str, draw: int = 0) -> Column:
    """A number in [0, 1) that depends on the seed, the keys and the number of the draw only.

    Counter-based: there is no state that advances, so a row gets the same number in any partitioning, in
    any order and on a repeated task.  Built on MD5, which other engines can recompute.  Null keys draw like
    empty texts.
    """
    parts = [F.lit(f"{seed}|{draw}"), *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]]
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, _DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**_DRAW_DIGITS))


def uniform_value(seed: int, *keys, draw: int = 0) -> float:
    """``uniform`` for one row, worked out here."""
    text = "|".join([f"{seed}|{draw}", *("" if k is None else str(k) for k in keys)])
    return int(hashlib.md5(text.encode()).hexdigest()[:_DRAW_DIGITS], 16) / 16.0**_DRAW_DIGITS


def random_days(seed: int, low: dt.date, high: dt.date, *keys: Column | str) -> Column:
    """Two random days from ``low`` to ``high``, the earlier one first, as a struct (start_day, end_day)."""
    span = (high - low).days + 1
    days = [F.date_add(F.lit(low), F.floor(uniform(seed, *keys, draw=i) * span).cast("int")) for i in (0, 1)]
    return F.struct(F.least(*days).alias("start_day"), F.greatest(*days).alias("end_day"))


def random_day_range(seed: int, low: dt.date, high: dt.date, *keys) -> tuple[dt.date, dt.date]:
    """``random_days`` for one request, worked out here: bounds that reach a file scan as literals."""
    span = (high - low).days + 1
    start, end = sorted(low + dt.timedelta(days=math.floor(uniform_value(seed, *keys, draw=i) * span)) for i in (0, 1))
    return start, end
