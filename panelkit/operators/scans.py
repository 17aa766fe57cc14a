"""History columns of series too long for one task: a scan in two passes over ranges.

The rows are cut into ranges of (entity, period). A range holds many short series or a stretch of a long
one. The first pass notes what later ranges have to know of each series that reaches over a cut: its
last known value, its first one, its last rows. The second works inside the ranges only and
starts from what was noted. Results equal the windows in ``windows``, whose groups are whole series.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.config import ENTITY, PERIOD
from panelkit.functions.expressions import INF
from panelkit.session import store

RANGE = "_range"


def in_ranges(df: DataFrame, entity: str, period: str, parts: int) -> DataFrame:
    """The rows with the number of their range. The written table fixes the ranges."""
    return store(df.repartitionByRange(parts, entity, period).withColumn(RANGE, F.spark_partition_id()), "ranges")


def _crossing(rows: DataFrame, values: list[str], entity: str, period: str) -> DataFrame:
    """(entity, range, last_<v>: the last known value before the range, first_<v>: the series' first known value)
    of the series that lie in several ranges: two rows for each range at most."""
    known = lambda v: F.when(F.col(v).isNotNull(), F.col(period))
    ends = [f(v, known(v)).alias(f"{n}_{v}") for v in values for n, f in (("last", F.max_by), ("first", F.min_by))]
    parts = rows.groupBy(entity, RANGE).agg(F.count(F.lit(1)).alias("_rows"), *ends)
    series = Window.partitionBy(entity)
    ordered = series.orderBy(RANGE)
    parts = parts.withColumn("_parts", F.count(F.lit(1)).over(series)).filter("_parts > 1")
    columns = [F.last(f"last_{v}", True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias(f"last_{v}") for v in values]
    columns += [F.first(f"first_{v}", True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"first_{v}") for v in values]
    return store(parts.select(entity, RANGE, *columns), "crossing")


def _tails(rows: DataFrame, crossing: DataFrame, values: list[str], n: int, entity: str, period: str) -> DataFrame:
    """(entity, range, tail: the up to ``n`` rows before the range, oldest first) of the series that lie in several ranges."""
    inside = Window.partitionBy(RANGE, entity)
    own = rows.select(entity, period, RANGE, *values).join(F.broadcast(crossing.select(entity, RANGE)), [entity, RANGE])
    last = own.withColumn("_back", F.row_number().over(inside.orderBy(F.desc(period)))).filter(F.col("_back") <= n)
    # The last rows of all earlier ranges, one after the other, end with the n rows before this one.
    ordered = Window.partitionBy(entity).orderBy(RANGE, period)
    before = F.array(*[F.lag(F.struct(*values), i).over(ordered) for i in range(n, 0, -1)])
    first = last.withColumn("_tail", before).withColumn("_place", F.row_number().over(inside.orderBy(period))).filter("_place = 1")
    return store(first.select(entity, RANGE, F.filter("_tail", lambda t: t.isNotNull()).alias("_tail")), "tails")


def with_history(
    df: DataFrame, percent_changes: Mapping[str, str] | None = None, rolling_means: Mapping[str, tuple[str, int, int]] | None = None,
    fills: Mapping[str, str] | None = None, entity: str = ENTITY, period: str = PERIOD, parts: int | None = None,
) -> DataFrame:
    """``df`` with history columns, named by the keys.

    ``percent_changes``: the change of a value against the one known before; ``rolling_means``: (value, rows,
    least known values); ``fills``: forward, then backward fill. Rows are unique on (entity, period).
    What goes to all tasks are two rows per range.
    """
    percent_changes, rolling_means, fills = dict(percent_changes or {}), dict(rolling_means or {}), dict(fills or {})
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(df, entity, period, parts)
    known = sorted({*percent_changes.values(), *fills.values()})
    crossing = _crossing(rows, known, entity, period)
    joined = rows.join(F.broadcast(crossing), [entity, RANGE], "left")
    reach = max((n for _, n, _ in rolling_means.values()), default=1) - 1
    if reach:
        tails = _tails(rows, crossing, sorted({v for v, _, _ in rolling_means.values()}), reach, entity, period)
        joined = joined.join(F.broadcast(tails), [entity, RANGE], "left")

    inside = Window.partitionBy(RANGE, entity)
    w = inside.orderBy(period)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def change(v: str) -> Column:
        now = F.coalesce(F.last(v, True).over(upto), F.col(f"last_{v}"))
        before = F.coalesce(F.last(v, True).over(earlier), F.col(f"last_{v}"))
        return F.when(before != 0, (now / before - 1) * 100).when((before == 0) & (now > 0), INF).when((before == 0) & (now < 0), -INF)

    def mean(v: str, n: int, least: int) -> Column:
        frame = w.rowsBetween(1 - n, 0)
        missing = n - F.least(F.row_number().over(w), F.lit(n))
        tail = F.coalesce("_tail", F.array()) if reach else F.array()
        taken = F.filter(F.slice(tail, F.greatest(F.size(tail) - missing + 1, F.lit(1)), missing), lambda t: t[v].isNotNull()) if reach else F.array()
        carried = F.aggregate(taken, F.lit(0.0), lambda s, t: s + t[v]) if reach else F.lit(0.0)
        count = F.size(taken) + F.count(v).over(frame)
        return F.when(count >= least, (carried + F.coalesce(F.sum(v).over(frame), F.lit(0.0))) / count)

    def fill(v: str) -> Column:
        return F.coalesce(F.last(v, True).over(upto), F.col(f"last_{v}"), F.col(f"first_{v}"), F.first(v, True).over(whole))

    out = {**{o: change(v) for o, v in percent_changes.items()}, **{o: mean(*spec) for o, spec in rolling_means.items()}, **{o: fill(v) for o, v in fills.items()}}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    return joined.select(*kept, *[c.alias(o) for o, c in out.items()])
