"""Scalar expressions shared by the layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_AMOUNT = T.DecimalType(28, 6)


def salted_hash(field: str, salt: str, preserve_null: bool = False) -> Column:
    """SHA-256 hex of `value|salt`.

    `concat_ws` skips NULL, so a NULL value hashes to the salt alone unless
    `preserve_null` asks for NULL.
    """
    digest = F.sha2(F.concat_ws("|", F.col(field), F.lit(salt)), 256)
    return F.when(F.col(field).isNotNull(), digest) if preserve_null else digest


def surrogate_key(field: str) -> Column:
    """MD5 hex of a natural key; the same on the fact and the dimension side."""
    return F.md5(F.col(field))


_IS_HEX, _IS_TEXT = b"\x01", b"\x00"


def packed(field: str) -> Column:
    """A text as bytes; keys and hashes, which are hexadecimal digits, take half their space.

    Different texts give different bytes, so rows may meet on them; `unpacked` gives the text back.
    """
    text, number = F.col(field), F.unhex(F.col(field))
    plain = F.concat(F.lit(_IS_TEXT), text.cast("binary"))
    return F.when(F.lower(F.hex(number)) == text, F.concat(F.lit(_IS_HEX), number)).otherwise(plain)


def unpacked(field: str) -> Column:
    """The text of `packed` bytes."""
    kind, body = F.substr(F.col(field), F.lit(1), F.lit(1)), F.substr(F.col(field), F.lit(2))
    return F.when(kind == F.lit(_IS_HEX), F.lower(F.hex(body))).otherwise(body.cast("string"))


def date_key(field: str) -> Column:
    """A date as the integer yyyymmdd.

    Integer arithmetic stays in generated code; formatting and parsing a
    string per fact row would not be cheaper.
    """
    day = F.col(field)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_key_of(day: dt.date) -> int:
    """`date_key` of a driver-side date, for filters on the stored key."""
    return day.year * 10000 + day.month * 100 + day.day


def timestamp_or_now(run_ts: dt.datetime | None) -> Column:
    """The pinned run timestamp, or the query's own clock.

    The literal is parsed as text in the session zone: a naive Python
    datetime would be shifted by the zone of the driver machine.
    """
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(T.TimestampType())


def date_or_today(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def discount_rate(billed: str, allowed: str) -> Column:
    """Share of the bill not allowed, 4 decimals; NULL unless billed > 0."""
    rate = F.round(1 - F.col(allowed) / F.col(billed), 4)
    return F.when(F.col(billed) > 0, rate)


def exact_sum(field: str) -> Column:
    """Sum of a double amount as a decimal.

    Decimal addition is associative, so the total does not depend on how rows
    were partitioned or on tasks being recomputed after a lost executor.
    Amounts count to 6 decimals; `inexact_sum` has those that do not fit.
    """
    return F.sum(F.col(field).try_cast(_AMOUNT))


def inexact_sum(field: str) -> Column:
    """Sum of the amounts no decimal holds (NaN, infinite, 1e22 or more), else NULL."""
    amount = F.col(field)
    return F.sum(F.when(amount.isNotNull() & amount.try_cast(_AMOUNT).isNull(), amount))


def to_cents(total: Column, inexact: Column) -> Column:
    """A decimal total rounded half-up to 2 places, as double.

    Where amounts exist that no decimal holds, they show in the total: it is NaN,
    infinite, or a plain floating-point sum.
    """
    cents = total.cast(T.DecimalType(38, 2)).cast(T.DoubleType())
    return F.when(inexact.isNull(), cents).otherwise(inexact + F.coalesce(cents, F.lit(0.0)))
