"""Exact order statistics that never gather a group, by selection over counted slots.

The built-in exact ``percentile`` keeps every distinct value of a group in one buffer, which a
hot group of continuous values overflows. Here values are mapped to slots by a function that never
decreases, rows are counted per group and slot, and the counts tell which slot holds a wanted rank,
with its least and greatest value. The first slots are steps of the logarithm, so any range of
magnitudes fits; only rows of the chosen slots are read on, and each later round cuts what is left
of a slot's range into ``SLOTS`` equal parts. A rank is found once its slot holds a single value.

The input is read twice, whatever its order or distribution. Doubles and longs need four counts at
most, since every round keeps one part in ``SLOTS`` of a slot's range; the usual number is two. All
group sizes take the same path, and the size of the generated code depends on neither the number of
ranks nor the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions.staging import materialize

# Steps of the natural logarithm in the first count, and parts of a range in the later ones.
LOG_STEPS = 1 << 13
SLOTS = 1 << 16
# Logarithms of doubles lie between these bounds; zero, infinities and NaN get slots of their own.
_LOG_SPAN = 750.0


@dataclass(frozen=True)
class Rank:
    """A zero-based rank, as SQL over the group size ``n``."""

    position: str


def _first_slot(value: Column) -> Column:
    """A number that never decreases with the value, NaN last."""
    x = value.cast("double")
    log = F.least(F.ln(F.abs(x)), F.lit(_LOG_SPAN)) + F.lit(_LOG_SPAN)
    signed = F.when(x == 0, 0.0).otherwise(F.signum(x) * log)
    return F.when(F.isnan(x), F.lit(1 << 30).cast("long")).otherwise(F.floor(signed * LOG_STEPS))


def _holders(counted: DataFrame, inside: Sequence[str], ranks: Sequence[Rank]) -> DataFrame:
    """The slots of each group that hold a rank, one row per rank.

    ``counted`` has one row per slot; slots are numbered inside ``inside``, which at first is the
    group itself. Later rounds know the group size ``n``, the ranks that are still open there and
    the rows before the range.
    """
    order = Window.partitionBy(*inside).orderBy("_slot")
    upto = F.sum("_rows").over(order)
    if "n" not in counted.columns:
        size = F.sum("_rows").over(Window.partitionBy(*inside))
        counted = counted.withColumns({"n": size, "_before": upto - F.col("_rows")})
        wanted = F.array(*[F.struct(F.lit(i).alias("rank"), F.expr(f"bigint({r.position})").alias("at")) for i, r in enumerate(ranks)])
        counted = counted.withColumn("_ranks", wanted)
    else:
        counted = counted.withColumn("_before", F.col("_start") + upto - F.col("_rows"))
    held = F.expr("filter(_ranks, r -> r.at >= _before and r.at < _before + _rows)")
    return counted.withColumn("_ranks", held).where(F.size("_ranks") > 0)


def values_at_ranks(
    frame: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Mapping[str, Rank],
    *,
    few_groups: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """One row per group: ``n`` non-null values and the value at each named rank.

    Groups with a null key or without values give no row. Without ``keys`` the whole table is
    one group, and an empty table gives no row. ``few_groups`` is for keys whose number the
    caller has proven small (columns of a table, candidate models, tree leaves): their chosen
    slots are broadcast. Otherwise the engine decides by the size it measures. A ``weight`` is a
    long that says how many times its row counts, for values that were counted before.
    """
    keys = list(keys)
    known = " and ".join(f"`{c}` is not null" for c in [*keys, "_value"])
    carried = [] if weight is None else [F.col(weight).alias("_weight")]
    rows = frame.select(*keys, F.col(value).alias("_value"), *carried).where(known)
    rows = rows.withColumn("_slot", _first_slot(F.col("_value")))
    size = F.count("*") if weight is None else F.sum("_weight")
    sizes = [size.alias("_rows"), F.min("_value").alias("_low"), F.max("_value").alias("_high")]
    inside = keys
    kept: list[DataFrame] = []
    while True:
        counted = rows.groupBy(*inside, "_slot", *(() if inside is keys else ("n", "_start", "_ranks")))
        # One row per group and rank; written, because the rows are narrowed by it and it is read back.
        chosen = materialize(_holders(counted.agg(*sizes), inside, list(ranks.values())), "ranks")
        kept.append(chosen.where("_low <=> _high").select(*keys, "n", F.col("_low").alias("_value"), "_ranks"))
        still = chosen.where("not (_low <=> _high)")
        if still.isEmpty():
            break
        still = still.select(
            *(F.col(c).alias(f"_of_{c}") for c in [*inside, "_slot"]),
            F.struct("_low", "_high").alias("_left"), "n", F.col("_before").alias("_start"), "_ranks",
        )
        same = [F.col(c) == F.col(f"_of_{c}") for c in [*inside, "_slot"]]
        held = ["_value", *(["_weight"] if carried else [])]
        narrowed = rows.select(*inside, "_slot", *held).join(F.broadcast(still) if few_groups or not keys else still, same)
        narrowed = narrowed.select(*keys, *held, F.col("_left").alias("_range"), "n", "_start", "_ranks")
        # The second and last look at the input; later rounds read the written rows.
        rows = materialize(narrowed, "rank-rows")
        low, high = F.col("_range._low"), F.col("_range._high")
        part = (F.col("_value") - low).cast("double") / (high - low).cast("double")
        rows = rows.withColumn("_slot", F.floor(part * (SLOTS - 1)))
        inside = [*keys, "_range"]
    found = kept[0]
    for more in kept[1:]:
        found = found.union(more)
    entries = F.transform("_ranks", lambda r: F.struct(r["rank"].alias("rank"), F.col("_value").alias("value")))
    listed = found.select(*keys, "n", F.explode(entries).alias("_entry")).groupBy(*keys, "n")
    by_rank = listed.agg(F.map_from_entries(F.collect_list("_entry")).alias("_at"))
    return by_rank.select(*keys, "n", *(F.col("_at")[F.lit(i)].alias(name) for i, name in enumerate(ranks)))


def _quoted(name: str) -> str:
    return f"`{name}`"


def exact_percentiles(
    frame: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Mapping[str, float],
    *,
    few_groups: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, as ``n`` and one double per named point."""
    ranks: dict[str, Rank] = {}
    results = []
    for name, p in points.items():
        position = f"((n - 1) * {p!r}D)"
        ranks[f"_lo_{name}"] = Rank(f"floor({position})")
        ranks[f"_hi_{name}"] = Rank(f"ceil({position})")
        low, high = f"double(`_lo_{name}`)", f"double(`_hi_{name}`)"
        share = f"({position} - floor({position}))"
        # Anchor on the nearer end, so equal neighbours give exactly that value.
        results.append(
            f"if({share} >= 0.5D, {high} - ({high} - {low}) * (1 - {share}), "
            f"{low} + ({high} - {low}) * {share}) as `{name}`"
        )
    found = values_at_ranks(frame, keys, value, ranks, few_groups=few_groups, weight=weight)
    return found.selectExpr(*map(_quoted, keys), "n", *results)
