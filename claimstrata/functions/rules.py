"""Business rules of a claim, and how they combine.

A rule is TRUE when the row breaks it and NULL when the row does not say.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimstrata.functions.columns import date_or_today
from claimstrata.schemas import CLAIM_STATUSES, CLAIM_TYPES

# Fixed value: flag columns are the rule names with this prefix.
FLAG_PREFIX = "_v_"


def claim_rules(as_of: dt.date | None = None, members_hashed: bool = False) -> dict[str, Column]:
    """Rule name -> violation, in reporting order.

    With `members_hashed` the rules are stated on rows whose `member_id` will
    be (or was) hashed without keeping NULLs: a hash is never NULL, so that
    rule cannot fire.
    """
    member_missing = F.lit(False) if members_hashed else F.col("member_id").isNull()
    # Rule names and their order.
    return {
        "claim_id_null": F.col("claim_id").isNull(),
        "member_id_null": member_missing,
        "invalid_claim_type": ~F.col("claim_type").isin(*CLAIM_TYPES),
        "invalid_status": ~F.col("claim_status").isin(*CLAIM_STATUSES),
        "negative_amount": F.col("billed_amount") < 0,
        "future_date": F.col("service_date") > date_or_today(as_of),
        "paid_exceeds_billed": F.col("paid_amount") > F.col("billed_amount"),
    }


def any_broken(rules: dict[str, Column]) -> Column:
    """Three-valued OR of all rules."""
    return reduce(or_, rules.values())


def flag_columns(rules: dict[str, Column]) -> dict[str, Column]:
    """One boolean column per rule."""
    return {FLAG_PREFIX + name: broken for name, broken in rules.items()}


def broken_rule_names(names: list[str]) -> Column:
    """Names of the TRUE flags, comma separated, from stored flag columns."""
    return F.concat_ws(", ", *[F.when(F.col(FLAG_PREFIX + name), F.lit(name)) for name in names])
