"""Resampling statistics that keep a dominant bin distributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions.buckets import mid_bin, resample_bin
from sensorlake.session import small_side

COMPUTED_OPS = ("mean", "average", "median", "mode", "stdev")
PICK_OPS = ("min", "minimum", "max", "maximum", "first", "last")
NAN = float("nan")


def _with_bin(df: DataFrame, ts: str, count: int, unit: str, keys: list[str], anchor: str) -> DataFrame:
    """Add ``bin``. The anchor is each stream's first day (or first reading); it only needs to be looked up when
    the bins do not line up with midnight anyway."""
    if anchor not in ("day", "first"):
        raise ValueError("anchor must be 'day' or 'first'")
    aligned = count == 1 or (unit == "H" and 24 % count == 0)
    if anchor == "day" and aligned:
        origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return df.withColumn("bin", resample_bin(F.col(ts), count, unit, origin))
    firsts = small_side(df.groupBy(*keys).agg(F.min(ts).alias("_first")))
    origin = F.col("_first") if anchor == "first" else F.date_trunc("day", "_first").cast("timestamp_ntz")
    return df.join(firsts, keys).withColumn("bin", resample_bin(F.col(ts), count, unit, origin)).drop("_first")


def mode_first_seen(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Most frequent value per group; of equally frequent ones the first seen. NaN when a group has no value."""
    counts = df.groupBy(*keys, value).agg(F.count(value).alias("n"), F.min(order).alias("first_seen"))
    least = F.min(F.struct((-F.col("n")).alias("n"), "first_seen", F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(least.alias("m")).select(
        *keys, F.coalesce(F.when(F.col("m.n") < 0, F.col("m.v")), F.lit(NAN)).alias(value))


def exact_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact median per group of the non-missing values, by one way for groups of all sizes (:func:`sliced_median`)."""
    v = F.col(value)
    return sliced_median(df.filter(v.isNotNull() & ~F.isnan(v)).select(*keys, value), keys, value)


# Beyond the slice of every finite number.
ENDLESS = 20_000


def sliced_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact median per group without holding a group in one task.

    Values are first reduced to distinct value and count. A monotone coarse slice (sixteenths of a power of two)
    gives every group a small histogram; its running sum tells which slice holds the middle ranks, and only the
    distinct values of those slices are ranked.
    """
    v = F.col(value)
    counts = (df.groupBy(*keys, value).agg(F.count("*").alias("n"))
              .withColumn("slice", F.when(F.abs(v) == float("inf"), F.signum(v) * ENDLESS)
                          .otherwise(F.floor(F.signum(v) * F.log2(F.abs(v) + 1.0) * 16)).cast("int")))
    running = W.partitionBy(*keys).orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    histogram = (counts.groupBy(*keys, "slice").agg(F.sum("n").alias("n"))
                 .withColumn("upto", F.sum("n").over(running))
                 .withColumn("total", F.sum("n").over(W.partitionBy(*keys))))
    low_rank, high_rank = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    middle = (histogram.withColumn("below", F.col("upto") - F.col("n"))
              .filter((F.col("upto") >= low_rank) & (F.col("below") < high_rank))
              .select(*keys, "slice", "below", low_rank.alias("low_rank"), high_rank.alias("high_rank")))
    inside = W.partitionBy(*keys, "slice").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = (counts.join(middle, [*keys, "slice"])
              .withColumn("upto", F.col("below") + F.sum("n").over(inside))
              .withColumn("from", F.col("upto") - F.col("n")))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("upto") >= F.col(rank)) & (F.col("from") < F.col(rank)), v))

    return ranked.groupBy(*keys).agg(((at("low_rank") + at("high_rank")) / 2).alias(value))


def _valid(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def resample(df: DataFrame, ts: str, value: str, count: int, unit: str, op: str, keys: list[str],
             anchor: str = "day", keep_row: bool = False) -> DataFrame:
    """One row per stream and ``count`` x ``unit`` bin: ``keys, ts, value``.

    Computed statistics are stamped with the middle of the bin, picked ones (min, max, first, last) with the time
    of the picked reading; ``keep_row`` then keeps the reading's other columns too. Bins without readings do not
    appear. NaN readings are ignored unless a bin has nothing else; infinite results are dropped.
    """
    binned = _with_bin(df, ts, count, unit, keys, anchor)
    if op in PICK_OPS:
        out = _pick(binned, ts, value, op, keys, keep_row)
    elif op in COMPUTED_OPS:
        out = _compute(binned, ts, value, op, keys).withColumn("bin", mid_bin(F.col("bin"), count, unit))
        out = out.select(*keys, F.col("bin").alias(ts), value)
    else:
        raise ValueError(f"unknown operation {op!r}, expected one of {COMPUTED_OPS + PICK_OPS}")
    return out.filter(~F.coalesce(F.col(value).isin(float("inf"), float("-inf")), F.lit(False)))


def _compute(binned: DataFrame, ts: str, value: str, op: str, keys: list[str]) -> DataFrame:
    groups = [*keys, "bin"]
    if op == "mode":
        return mode_first_seen(binned.withColumn(value, _valid(F.col(value))), groups, value, ts)
    if op == "median":
        present = binned.groupBy(*groups).agg(F.count(_valid(F.col(value))).alias("present"))
        medians = exact_median(binned, groups, value)
        empty = present.filter("present = 0").select(*groups, F.lit(NAN).alias(value))
        return medians.unionByName(empty)
    aggregate = F.stddev_samp if op == "stdev" else F.avg
    return binned.groupBy(*groups).agg(F.coalesce(aggregate(_valid(F.col(value))), F.lit(NAN)).alias(value))


def _pick(binned: DataFrame, ts: str, value: str, op: str, keys: list[str], keep_row: bool) -> DataFrame:
    """The reading with the smallest, largest, first or last position; ties go to the earlier, then smaller one."""
    others = [c for c in binned.columns if c not in (*keys, "bin", ts, value)] if keep_row else []
    missing = F.col(value).isNull() | F.isnan(value)
    epoch = F.unix_micros(F.col(ts).cast("timestamp"))
    number = F.coalesce(F.col(value), F.lit(NAN))
    order = {
        "min": [missing, number, epoch],
        "max": [missing, -number, epoch],
        "first": [epoch, missing, number],
        "last": [-epoch, missing, number],
    }[{"minimum": "min", "maximum": "max"}.get(op, op)]
    row = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(ts), F.col(value), *others)
    picked = binned.groupBy(*keys, "bin").agg(F.min(row).alias("r"))
    return picked.select(*keys, f"r.{ts}", f"r.{value}", *[f"r.{c}" for c in others])
