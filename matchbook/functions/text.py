"""NULL-safe text helpers: capture groups, numbers, fixed-width fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rx(value: Column | str, pattern: str, group: int = 1) -> Column:
    """Capture group, NULL when the pattern does not match (Spark alone would give '')."""
    found = F.regexp_extract(col_of(value), pattern, group)
    return F.when(found != "", found)


def to_int(value: Column | str) -> Column:
    """Whole number or NULL. Decimals round half up, so '7.4' is 7."""
    return col_of(value).try_cast("decimal(38,0)").try_cast("long")


def to_dec(value: Column | str, scale: int) -> Column:
    """decimal(10, scale) or NULL, rounding half up."""
    return col_of(value).try_cast(f"decimal(10,{scale})")


def squeeze(value: Column | str) -> Column:
    """Runs of whitespace become one blank; outer blanks go."""
    return F.trim(F.regexp_replace(col_of(value), r"\s+", " "))


def part(value: Column | str, sep: str, n: int) -> Column:
    """n-th piece, '' past the end."""
    return F.split_part(col_of(value), F.lit(sep), F.lit(n))


def fixed(value: Column | str, start: int, length: int | None = None) -> Column:
    """Fixed-width field at 1-based ``start``; to the end of the line without ``length``."""
    return F.substr(col_of(value), F.lit(start), None if length is None else F.lit(length))


def dash_zero(value: Column) -> Column:
    """A lone '-' prints a true zero; anything else is parsed as a number."""
    return F.when(value == "-", F.lit(0).cast("long")).otherwise(to_int(value))


def first_match(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """Ordered rules; the first condition that holds gives the label."""
    chain = F
    for condition, label in rules:
        chain = chain.when(condition, label if isinstance(label, Column) else F.lit(label))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the text of the columns, joined by '-', with NULL marked."""
    # Fixed value: the NULL marker of the public key macro, needed for equal keys.
    null_marker = "_dbt_utils_surrogate_key_null_"
    pieces: list[Column] = []
    for i, column in enumerate(columns):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(F.coalesce(col_of(column).cast("string"), F.lit(null_marker)))
    return F.md5(F.concat(*pieces))


def other_of(value: Column | str, home: Column | str, away: Column | str) -> Column:
    """The other side of a pair: away for home, home for anything else."""
    return F.when(col_of(value) == col_of(home), col_of(away)).otherwise(col_of(home))
