"""Ordered per-key results computed in two levels.

A window over ``partitionBy(key)`` puts all rows of a key in one task. Here each key is cut
into buckets that follow the order (days, ranges between sampled splitters): the window runs inside
one bucket, and one row per bucket carries the state of the earlier buckets. A key holding a
third of all rows is then spread over as many tasks as it has buckets.

Keys must be non-null; a row without a key belongs to no group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions.clock import HOUR_MICROS, micros
from opsloom.functions.staging import materialize

_BUCKET = "_bucket"


def time_bucket(ts: str | Column, hours: int = 24) -> Column:
    return F.floor(micros(ts) / F.lit(hours * HOUR_MICROS))


# Rows of one range, about.
RANGE_ROWS = 1 << 20


def with_ranges(frame: DataFrame, order: str, out: str = "_range") -> DataFrame:
    """The rows, written, with the number of the range of ``order`` they lie in.

    Splitters come from the engine's sample of the values, so ranges hold about ``RANGE_ROWS`` rows
    wherever the values crowd; equal values share a range, and numbers never decrease with the value.
    """
    rows = materialize(frame, "range-rows")
    parts = rows.count() // RANGE_ROWS + 1
    ranged = rows.repartitionByRange(parts, order) if parts > 1 else rows.coalesce(1)
    return materialize(ranged.withColumn(out, F.spark_partition_id()), "ranged")


def running_totals(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    bucket: Column,
    *,
    include_current: bool = True,
) -> DataFrame:
    """Add running sums per key; ``order`` must be free of ties inside a key.

    With ``include_current=False`` each sum covers strictly earlier rows. ``bucket`` must not
    decrease along ``order``.
    """
    names = list(totals)
    rows = frame.withColumns({_BUCKET: bucket, **{f"_v_{n}": totals[n] for n in names}})
    level = [*keys, _BUCKET]
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*level)
        .agg(*[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in names])
        .select(*level, *[F.coalesce(F.sum(f"_b_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in names])
    )
    inside = (
        Window.partitionBy(*level)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    within = rows.withColumns({f"_w_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in names})
    # The totals hold one row per bucket; the left join keeps the rows from being broadcast.
    return within.join(offsets, level, "left").select(
        *frame.columns,
        *[(F.col(f"_w_{n}") + F.coalesce(f"_o_{n}", F.lit(0))).alias(n) for n in names],
    )


def previous_value(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    bucket: Column,
) -> DataFrame:
    """Add the non-null ``value`` of the row before, in ``order``, within each key."""
    rows = frame.withColumn(_BUCKET, bucket)
    level = [*keys, _BUCKET]
    carried = (
        rows.groupBy(*level)
        .agg(F.max_by(value, F.struct(*order)).alias("_last"))
        .select(*level, F.lag("_last").over(Window.partitionBy(*keys).orderBy(_BUCKET)).alias("_carried"))
    )
    within = rows.withColumn("_lag", F.lag(value).over(Window.partitionBy(*level).orderBy(*order)))
    return within.join(carried, level, "left").select(
        *frame.columns, F.coalesce("_lag", "_carried").alias(out)
    )
