"""Schema contract of an incoming feed."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimstrata.schemas import CLAIMS_SCHEMA, relaxed, required_fields

VIOLATIONS = "_contract_violations"


def validate_schema(df: DataFrame, required: Iterable[str] | None = None) -> bool:
    """Raise `ValueError` naming the required columns that are missing.

    Looks at column names only, so it runs no job.  Extra columns are fine.
    """
    wanted = required_fields(CLAIMS_SCHEMA) if required is None else list(required)
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return True


def conform(df: DataFrame, schema: T.StructType = CLAIMS_SCHEMA) -> DataFrame:
    """The schema's fields in order and of its types, keeping NULLs.

    Safe widening (int to double) is applied, any other type is an error.
    Columns outside the schema are kept after it: they widen Bronze later.
    """
    validate_schema(df, required_fields(schema))
    typed = relaxed(schema)
    extra = [c for c in df.columns if c not in typed.fieldNames()]
    return df.to(T.StructType(typed.fields + [df.schema[c] for c in extra]))


def enforce_not_null(df: DataFrame, schema: T.StructType = CLAIMS_SCHEMA) -> DataFrame:
    """Fail the job at the first row with a NULL in a NOT NULL field."""
    checked = {
        name: F.when(F.col(name).isNotNull(), F.col(name)).otherwise(
            F.raise_error(F.lit(f"NULL in required field {name}")).cast(schema[name].dataType)
        )
        for name in required_fields(schema)
    }
    return df.withColumns(checked)


def split_not_null(
    df: DataFrame, schema: T.StructType = CLAIMS_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the NOT NULL contract, and the others with the reasons."""
    names = required_fields(schema)
    broken = reduce(or_, [F.col(name).isNull() for name in names])
    reasons = F.concat_ws(", ", *[F.when(F.col(n).isNull(), F.lit(n)) for n in names])
    return df.where(~broken), df.where(broken).withColumn(VIOLATIONS, reasons)
