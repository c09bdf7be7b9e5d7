"""Small column helpers with the null semantics the reports expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def rx_extract(c, pattern: str, idx: int = 1) -> Column:
    """Regex extract that is NULL when nothing matches (Spark alone gives '')."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, idx))


def safe_div(a, b) -> Column:
    """NULL instead of an error on a zero or NULL divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def flag(cond: Column) -> Column:
    """1/0 bigint indicator; NULL conditions count as 0."""
    return F.when(cond, 1).otherwise(0).cast("bigint")


def growing(df: DataFrame) -> DataFrame:
    """A join input that grows with the learners or the course outline.

    Spark judges stored tables by their compressed size, so it would collect such an input on the driver for a broadcast
    join when it is many times larger in memory.
    """
    return df.hint("merge")


def outline(df: DataFrame) -> DataFrame:
    """A join input of narrow rows per item or problem, met by many learners' rows.

    Each task hashes its share of it, so the learners' rows need no sort.
    """
    return df.hint("shuffle_hash")


def last_segment(c, sep: str = "/") -> Column:
    return F.element_at(F.split(col(c), sep), -1)


def json_str(c, path: str) -> Column:
    """Scalar JSON value as text (strings unquoted)."""
    return F.get_json_object(col(c), path)


def to_double(c) -> Column:
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")
