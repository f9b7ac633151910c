"""Column-expression helpers shared by every report.

All helpers build Catalyst expressions (no Python UDFs), so they stay inside
whole-stage codegen and are pushed through projections by the optimizer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(x: float) -> Column:
    """A DOUBLE literal. Bare ``1.0`` in Spark SQL is a DECIMAL and would
    truncate averages of 0/1 flags."""
    return F.lit(float(x)).cast("double")


def round_half_away(c: ColumnOrName, digits: int = 0) -> Column:
    """ROUND on doubles, half away from zero applied to the binary value
    scaled by 10^digits: ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Spark's own ``round`` goes through BigDecimal of the decimal string and
    rounds 1.005 up; this form rounds the IEEE product, which is what the
    reports were written against (checked on thousands of values).
    """
    x = col(c).cast("double")
    m = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(m) + F.lit(0.5)).cast("double") / F.lit(m)


def ratio(n: ColumnOrName, total: ColumnOrName) -> Column:
    """n / total as DOUBLE; NULL instead of an ANSI error when total is 0."""
    return F.try_divide(col(n).cast("double"), col(total).cast("double"))


def pct(n: ColumnOrName, total: ColumnOrName, digits: int | None = 2) -> Column:
    """Percentage ``(n / total) * 100``, optionally rounded."""
    p = ratio(n, total) * F.lit(100.0)
    return p if digits is None else round_half_away(p, digits)


def flag(c: ColumnOrName, *fallbacks: ColumnOrName) -> Column:
    """Boolean with NULL treated as false: ``coalesce(c, ..., false)``."""
    return F.coalesce(col(c), *[col(x) for x in fallbacks], F.lit(False))


def count_if(pred: Column) -> Column:
    return F.count_if(pred).cast("bigint")


def exact_avg(c: ColumnOrName, digits: int = 6) -> Column:
    """AVG of a double column that does not depend on partitioning.

    Double sums depend on addition order, so a plain AVG can flip a rounded
    tie (0.4875 -> 0.487 / 0.488) or a rank between runs. Values are summed
    in fixed point instead, as two LONGs (exact, order-independent, and
    primitive aggregation buffers): whole units of 10^-digits, and what is
    left of each value in millionths of a unit. So 12 decimals count, as far
    as a double has them; values of at most 6 decimals give the same average
    as units alone. A LONG holds the sums for ~9e12 rows per group at 0-1
    scale."""
    return fixed_avg(*fixed_sums(c, digits), digits)


def fixed_sums(c: ColumnOrName, digits: int = 6) -> list[Column]:
    """The three LONG aggregates behind :func:`exact_avg` (units, rest, rows); sums of them are those of all their rows."""
    m = float(10 ** digits)
    x = col(c).cast("double")
    units = F.floor(x * F.lit(m)).cast("long")
    rest = F.floor((x * F.lit(m) - units.cast("double")) * F.lit(1e6) + F.lit(0.5)).cast("long")
    return [F.sum(units), F.sum(rest), F.count(x)]


def fixed_avg(units: Column, rest: Column, n: Column, digits: int = 6) -> Column:
    """The average that sums of :func:`fixed_sums` stand for; NULL without rows."""
    total = units.cast("double") + rest.cast("double") / F.lit(1e6)
    return F.try_divide(total, n.cast("double")) / F.lit(float(10 ** digits))


def rate(pred: Column) -> Column:
    """Share of rows where ``pred`` holds; NULL counts as not holding."""
    return F.avg(F.when(pred, dbl(1.0)).otherwise(dbl(0.0)))


def ladder(rungs: Sequence[tuple[Column, object]], default: object) -> Column:
    """CASE WHEN chain, first matching rung wins."""
    out = None
    for cond, value in rungs:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def day(c: ColumnOrName) -> Column:
    """Midnight of a timestamp, kept as TIMESTAMP_NTZ."""
    return F.date_trunc("day", col(c)).cast("timestamp_ntz")


def trunc_ntz(unit: str, c: ColumnOrName) -> Column:
    return F.date_trunc(unit, col(c)).cast("timestamp_ntz")


def as_of_ts(as_of) -> Column:
    """The report date as a TIMESTAMP_NTZ literal at midnight."""
    return F.lit(str(as_of)).cast("date").cast("timestamp_ntz")


def days_before(as_of, n: int) -> Column:
    return F.date_sub(F.lit(str(as_of)).cast("date"), n).cast("timestamp_ntz")


def date_diff_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Calendar days between two instants (midnights crossed), not 24 h units."""
    return F.datediff(col(end).cast("date"), col(start).cast("date")).cast("bigint")


def rank_by(*order: Column, partition: Iterable[ColumnOrName] = ()) -> Column:
    from pyspark.sql import Window
    w = Window.orderBy(*order)
    parts = list(partition)
    if parts:
        w = Window.partitionBy(*parts).orderBy(*order)
    return F.rank().over(w).cast("bigint")


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Put several one-row frames side by side without a join."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def select_ordered(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(n) for n in names])


# Higher-order functions (filter/exists/transform/aggregate, and array_compact,
# which is a filter) are evaluated outside generated code and switch whole-stage
# codegen off for the operator that contains them. The helpers below build the
# same results from codegen-able expressions for per-row hot paths.

def messages(*pairs: tuple[Column, Column | str]) -> Column:
    """Ordered array of the messages whose condition holds (NULL condition = no)."""
    empty = F.array().cast("array<string>")
    parts = [F.when(c, F.array(m if isinstance(m, Column) else F.lit(m))).otherwise(empty) for c, m in pairs]
    return F.concat(*parts) if parts else empty


def first_contained(text: Column, needles: Sequence[str]) -> Column:
    """First needle (in list order) that occurs in ``text``; NULL if none."""
    out = None
    for n in needles:
        cond = F.instr(text, n) > 0
        out = F.when(cond, F.lit(n)) if out is None else out.when(cond, F.lit(n))
    return out


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | (F.instr(text, n) > 0)
    return out


def first_null_index(arr: Column) -> Column:
    """0-based index of the first NULL element of a string array; NULL if none."""
    sep, null_mark = "\u0001", "\u0002"
    joined = F.array_join(arr, sep, null_mark)
    before = F.substring_index(joined, null_mark, 1)
    idx = F.when(before == "", F.lit(0)).otherwise(F.size(F.split(before, sep)) - 1)
    return F.when(F.instr(joined, null_mark) > 0, idx)
