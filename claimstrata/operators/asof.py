"""Versions of members and providers as they were at a time.

Versions of a key become spans that do not overlap, so a row meets at most one.  Rows
meet them by key and are moved once; adaptive execution splits a key that holds a third
of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FROM, _UNTIL, _STATE, _KEY, _SOUGHT = "__from", "__until", "__state", "__key", "__sought"


def version_spans(
    versions: DataFrame,
    key: str,
    attributes: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str | None = "valid_to",
    newest: Sequence[str] = (),
) -> DataFrame:
    """Key, attributes and the times `__from` to before `__until` of the versions in force.

    Of several that start together the one counts that is largest by `newest`, then by
    its attributes.  It ends where the next one starts, or before `valid_to`; `__until`
    is NULL if neither is known.  Versions without key or start never count.
    """
    ends = F.lit(None).cast(versions.schema[valid_from].dataType) if valid_to is None else F.col(valid_to)
    last = F.max(F.struct(*newest, *attributes, ends.alias("__ends")))
    starts = (
        versions.where(F.col(valid_from).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, F.col(valid_from).alias(_FROM))
        .agg(last.alias(_STATE))
    )
    following = F.lead(_FROM).over(Window.partitionBy(key).orderBy(_FROM))
    return starts.withColumn(_UNTIL, F.least(following, F.col(f"{_STATE}.__ends"))).select(
        key, _FROM, _UNTIL, *[F.col(f"{_STATE}.{a}").alias(a) for a in attributes]
    )


def as_of_join(rows: DataFrame, versions: DataFrame, key: str, at: str, attributes: Sequence[str], **choices) -> DataFrame:
    """Every row of `rows` with the attributes in force for its key at its date.

    Choices and cases as in `version_spans`; before the first version, after `valid_to`
    and without key or date attributes are NULL.
    """
    spans = version_spans(versions, key, attributes, **choices).withColumnRenamed(key, _KEY)
    inside = (F.col(at) >= F.col(_FROM)) & (F.col(_UNTIL).isNull() | (F.col(at) < F.col(_UNTIL)))
    others = [c for c in rows.columns if c not in (key, at)]
    # Always the key itself.  A key that is one constant would else leave the join no equality.
    sought = F.when(F.monotonically_increasing_id() >= 0, F.col(key))
    # Merged, not sent to all tasks: a size guessed from the files of keys says little of their versions.
    met = rows.withColumn(_SOUGHT, sought).join(spans.hint("merge"), (F.col(_SOUGHT) == F.col(_KEY)) & inside, "left")
    return met.select(key, at, *others, *attributes)


def versions_at(moments: DataFrame, versions: DataFrame, key: str, at: str, attributes: Sequence[str], **choices) -> DataFrame:
    """`attributes` for each distinct (key, at) of `moments`; a NULL key or date is not in the result."""
    return as_of_join(moments.select(key, at).dropna().distinct(), versions, key, at, attributes, **choices)
