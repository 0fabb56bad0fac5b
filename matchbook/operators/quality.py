"""Data checks as frames: no rows means the check passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named check. ``rows`` are its failures, or, with ``bad``, the rows ``bad`` picks from.

    ``shared`` names the frame of ``rows`` where checks of several tables look at one, so that one pass counts them all."""

    name: str
    table: str
    column: str
    rows: DataFrame
    severity: str = "error"
    bad: Column | None = None
    shared: str | None = None

    @property
    def failures(self) -> DataFrame:
        return self.rows if self.bad is None else self.rows.where(self.bad)


def _row_check(name, df, table, column, bad: Column, where: Column | None = None, severity="error") -> Check:
    return Check(name, table, column, df, severity, bad if where is None else where & bad)


def not_null(df: DataFrame, table: str, column: str, where: Column | None = None, **kw) -> Check:
    return _row_check("not_null", df, table, column, F.col(column).isNull(), where, **kw)


def unique(df: DataFrame, table: str, *columns: str, near: Sequence[str] = (), **kw) -> Check:
    """No value (or combination) twice; NULLs are not compared. ``near`` may name columns that follow from them, by
    which the rows lie together."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = df.where(present).groupBy(*near, *columns).count().where("count > 1")
    return Check("unique" if len(columns) == 1 else "unique_combination", table, ",".join(columns), repeated, **kw)


def accepted_values(
    df: DataFrame, table: str, column: str, values: Sequence, where: Column | None = None, **kw
) -> Check:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return _row_check("accepted_values", df, table, column, bad, where, **kw)


def relationship(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str, near: Sequence[str] = (), **kw
) -> Check:
    """Every non-null key exists in the parent table. ``near`` may name columns of both tables that follow from the
    key, by which the rows lie together."""
    keys = [*near, parent_key]
    child = df.where(F.col(column).isNotNull()).select(*near, F.col(column).alias(parent_key))
    return Check("relationships", table, column, child.join(parent.select(*keys), keys, "left_anti"), **kw)


def accepted_range(
    df: DataFrame, table: str, column: str, low=None, high=None, inclusive: bool = True, **kw
) -> Check:
    value = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < low if inclusive else value <= low)
    if high is not None:
        bad = bad | (value > high if inclusive else value >= high)
    return _row_check("accepted_range", df, table, column, bad, **kw)


def expression_true(
    df: DataFrame, table: str, label: str, holds: Column, where: Column | None = None, **kw
) -> Check:
    """Rows where the expression is false or unknown fail."""
    return _row_check("expression_is_true", df, table, label, ~F.coalesce(holds, F.lit(False)), where, **kw)


def numbered(df: DataFrame, group: str, number: str, name: str, *more: Column) -> DataFrame:
    """One row per group: as ``name`` what its line numbers add up to, and the aggregates ``more``.

    Numbers are unique per group in a sound table, so their count, bounds and sum tell (the sum of their halves, which no
    long overflows); all are combined on the map side.
    """
    n = F.col(number)
    halves = [F.sum(F.shiftright(n, 32)), F.sum(n.bitwiseAND(F.lit(0xFFFFFFFF)))]
    facts = F.struct(F.count(n).alias("rows"), F.min(n).alias("first"), F.max(n).alias("last"), *[h.alias(f"sum_{i}") for i, h in enumerate(halves)])
    return df.groupBy(group).agg(facts.alias(name), *more)


def side_by_side(group: str, *sides: DataFrame) -> DataFrame:
    """One row per group with the columns of all sides, which have a row per group at most. Rows without a group stay
    apart, one for each side that has one. Sides that lie together by the group are not shuffled."""
    # A union of rows that lie by a column keeps them there if each side names the column anew.
    apart = [
        s.withColumnRenamed(group, "_group").withColumn("_side", F.when(F.col("_group").isNull(), F.lit(i))) for i, s in enumerate(sides)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), apart)
    columns = [c for c in stacked.columns if c not in ("_group", "_side")]
    one_each = stacked.groupBy("_group", "_side").agg(*[F.max(c).alias(c) for c in columns])
    return one_each.select(F.col("_group").alias(group), *columns)


def same_row_count(
    source: DataFrame, derived: DataFrame, table: str, group: str, number: str, **kw
) -> Check:
    """Per group, the same line numbers in the derived table as in the source, by ``numbered``.

    One row per group meets, so no lines are shuffled. A group of only one side fails.
    """
    both = numbered(source, group, number, "source_lines").join(
        numbered(derived, group, number, "lines").hint("merge"), group, "full"
    )
    return Check("same_row_count", table, number, both.where(~F.col("source_lines").eqNullSafe(F.col("lines"))), **kw)


def same_rows_counted(counted: DataFrame, source: str, derived: str, table: str, number: str, **kw) -> Check:
    """The same check, of two columns of ``numbered`` that stand side by side already."""
    return Check("same_row_count", table, number, counted, bad=~F.col(source).eqNullSafe(F.col(derived)), **kw)


def report(checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, table_name, column_name, severity, failures, passed.

    All row-by-row checks of a table (by its name and columns), or of a shared frame, are counted in one pass over it. An error fails
    the build, a warning is only listed.
    """
    passes: dict[tuple, list[Check]] = {}
    counted: list[DataFrame] = []
    for check in checks:
        if check.bad is None:
            total = check.rows.agg(F.count(F.lit(1)).alias("failures"))
            counted.append(total.select(*_labels(check), "failures"))
        else:
            passes.setdefault((check.shared or check.table, *check.rows.columns), []).append(check)
    for group in passes.values():
        totals = group[0].rows.agg(*[F.count_if(c.bad).alias(f"c{i}") for i, c in enumerate(group)])
        listed = F.array(
            *[F.struct(*_labels(c), F.col(f"c{i}").alias("failures")) for i, c in enumerate(group)]
        )
        counted.append(totals.select(F.inline(listed)))
    return reduce(DataFrame.unionByName, counted).withColumn("passed", F.col("failures") == 0)


def enforce(found: DataFrame) -> DataFrame:
    """Stop on failed error checks; return the failed warnings. ``found`` has one row per check."""
    failed = found.where(~F.col("passed"))
    errors = failed.where(F.col("severity") == "error").select("check", "table_name", "column_name").collect()
    if errors:
        listed = "; ".join(f"{r[0]} on {r[1]}.{r[2]}" for r in errors)
        raise ValueError(f"failed checks: {listed}")
    return failed


def _labels(check: Check) -> list[Column]:
    return [
        F.lit(check.name).alias("check"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"),
    ]
