"""Column expressions shared by the models. Everything stays inside Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Order states that do not count as sales.
NOT_A_SALE = ("cancelled", "unknown")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return col(c).cast(MONEY)


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def one_of(c: Column | str, allowed: Sequence[str]) -> Column:
    """Lower-cased value when it is in the allow-list, otherwise 'unknown' (null included)."""
    lowered = F.lower(col(c))
    return F.when(lowered.isin(*allowed), lowered).otherwise(F.lit("unknown"))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator as double, null unless the denominator is positive."""
    n, d = col(numerator), col(denominator)
    return F.when(d > 0, n.cast("double") / d.cast("double"))


def divide(numerator: Column | str, denominator: Column | str) -> Column:
    """BI-style divide: null only when the denominator is null or zero."""
    n, d = col(numerator).cast("double"), col(denominator).cast("double")
    return F.try_divide(n, d)


def month_of(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")


def month_index(c: Column | str) -> Column:
    """Months since year 0, so that month arithmetic is plain integer arithmetic."""
    return F.year(col(c)) * 12 + F.month(col(c)) - 1


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(col(end), col(start))


def is_sale(status: Column | str = "order_status") -> Column:
    return ~col(status).isin(*NOT_A_SALE)


def stock_status(quantity: Column | str, low_below: int) -> Column:
    q = col(quantity)
    return F.when(q == 0, "out_of_stock").when(q < low_below, "low_stock").otherwise("in_stock")


def reconciliation_status(variance: Column, match, warn) -> Column:
    size = F.abs(variance)
    return F.when(size <= F.lit(match), "MATCHED").when(size <= F.lit(warn), "WARNING").otherwise("EXCEPTION")


def record_hash(columns: Sequence[str]) -> Column:
    """md5 over the JSON of the business columns in name order; nulls are kept as JSON nulls."""
    fields = [F.col(c).cast("string").alias(c) for c in sorted(columns)]
    return F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def hash_bytes(text: Column | str) -> Column:
    """A record hash as bytes: half the size of its text and in the same order. Any other text keeps its bytes."""
    digest = col(text).rlike("^[0-9a-f]{32}$")
    return F.when(digest, F.unhex(col(text))).otherwise(col(text).cast("binary"))


def present(df: DataFrame) -> DataFrame:
    """Output form: exact decimals become doubles and times become text; ratios are doubles already."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        out.append(c)
    return df.select(*out)
