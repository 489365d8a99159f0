"""Deduplication, survivorship, outliers and imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000


def keep_best(df: DataFrame, keys: list[str], *best: Column) -> DataFrame:
    """One row per key, the greatest by ``best``: a partial aggregate, no window, so hot keys cost nothing."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*best)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def survivor(df: DataFrame, key: str, value: str, priority: Column, tie: Column) -> DataFrame:
    """Per key the first non-null value by priority, the majority value, and how many rows agree with it."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("votes"), F.min(F.struct(priority.alias("p"), tie.alias("t"))).alias("best"))
    return counts.groupBy(key).agg(
        F.min_by(value, F.struct("best.p", "best.t")).alias("by_priority"),
        F.max_by(value, F.struct(F.col("votes"), value)).alias("by_majority"),
        F.max("votes").alias("votes"),
    )


def rolling_stats(df: DataFrame, key: str, at: str, value: str, days: int) -> DataFrame:
    """Adds rolling_n, rolling_sum, rolling_avg, rolling_std over the last ``days`` days of the key, the row included.

    The time line is cut into blocks of ``days``; a row goes to its own block and, as context, to the next, so
    no task holds more than two blocks of a key, however hot.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    span = days * DAY
    placed = df.withColumn("_at", micros).withColumn("_block", F.floor(F.col("_at") / span))
    copies = placed.withColumn("_in", F.explode(F.array(F.col("_block"), F.col("_block") + 1)))
    w = Window.partitionBy(key, "_in").orderBy("_at").rangeBetween(-span, 0)
    exact = F.col(value).cast("decimal(20,4)")
    n, total, squares = F.count(value).over(w), F.sum(exact).over(w).cast("double"), F.sum((exact * exact).cast("decimal(30,8)")).over(w).cast("double")
    measured = copies.withColumn("rolling_n", n).withColumn("rolling_sum", total).withColumn("_squares", squares).filter("_in = _block")
    mean = F.col("rolling_sum") / F.col("rolling_n")
    variance = F.greatest(F.lit(0.0), (F.col("_squares") - F.col("rolling_sum") * mean) / (F.col("rolling_n") - 1))
    return (
        measured.withColumn("rolling_avg", F.when(F.col("rolling_n") > 0, mean))
        .withColumn("rolling_std", F.when(F.col("rolling_n") > 1, F.sqrt(variance)))
        .drop("_at", "_block", "_in", "_squares")
    )


def quartile_fences(df: DataFrame, keys: list[str], value: str, reach: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """Per group the quartiles and the fences around them.

    Exact by default over (value, frequency) pairs, which a partial aggregate makes first; with ``accuracy``
    a sketch of bounded size, for values without bound.
    """
    if accuracy:
        q = df.groupBy(*keys).agg(F.percentile_approx(value, [0.25, 0.75], accuracy).alias("q"))
    else:
        counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
        q = counted.groupBy(*keys).agg(F.percentile(value, [0.25, 0.75], F.col("n")).alias("q"))
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select(*keys, q1.alias("q1"), q3.alias("q3"), (q1 - reach * (q3 - q1)).alias("low"), (q3 + reach * (q3 - q1)).alias("high"))


def outside_fences(df: DataFrame, fences: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows beyond their group's fences. The fences join by AQE's measured size, not by a hint."""
    return df.join(fences.select(*keys, "low", "high"), keys).filter((F.col(value) < F.col("low")) | (F.col(value) > F.col("high"))).drop("low", "high")


#: Blocks of the order's range in which the rows of a key are sorted.
BLOCKS = 1024


def last_known(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the last non-null ``value`` of the key at or before the row, by ``order`` (the first a number or time).

    The range of the order is cut into blocks. Rows are sorted within a (key, block); what the blocks before know is
    one row per block, so a key with a third of all rows is sorted in many tasks.
    """
    first = order[0]
    kind = dict(df.dtypes)[first]
    number = F.unix_micros(F.col(first).cast("timestamp")) if kind.startswith(("timestamp", "date")) else F.col(first).cast("long")
    low, high = df.agg(F.min(number), F.max(number)).first()
    width = max(1, ((high or 0) - (low or 0)) // BLOCKS + 1)
    placed = df.withColumn("_block", F.coalesce(F.floor((number - F.lit(low or 0)) / width), F.lit(-1)))
    known = placed.filter(F.col(value).isNotNull()).groupBy(key, "_block").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    over = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    every = placed.select(key, "_block").distinct().join(known, [key, "_block"], "left")
    carried = every.select(F.col(key).alias("_key"), F.col("_block").alias("_b"), F.last("_last", ignorenulls=True).over(over).alias("_before"))
    inner = Window.partitionBy(key, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = placed.join(carried, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_block") == F.col("_b")), "left")
    return both.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(inner), F.col("_before"))).drop("_block", "_before", "_key", "_b")


def forward_fill(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    """The last known value of the key at or before the row, and whether it was filled in."""
    return last_known(df, key, order, value, out).withColumn("is_imputed", F.col(value).isNull() & F.col(out).isNotNull())


def mode_fill(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Null values replaced by the most frequent one of their group (of equals the smallest), with method and flag."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    modes = counted.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias("_mode"))
    filled = df.join(modes, key, "left").withColumn(out, F.coalesce(value, "_mode"))
    gone = F.col(value).isNull() & F.col("_mode").isNotNull()
    return filled.withColumn("is_imputed", gone).withColumn("imputation_method", F.when(gone, "group_mode")).drop("_mode")


def weighted_survivor(df: DataFrame, key: str, value: str, weight: Column) -> DataFrame:
    """Per key the value with the greatest sum of weights, and its share of them (of equals the smallest value)."""
    sums = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.sum(weight.cast("decimal(20,6)")).cast("double").alias("_w"))
    best = sums.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_w"), F.col(value))).alias(value), F.max("_w").alias("_top"), F.sum("_w").alias("_all"))
    return best.select(key, value, F.round(F.try_divide("_top", "_all"), 6).alias("confidence"))


def median_fill(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Null values replaced by the median of their group, with method and flag."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    medians = counted.groupBy(key).agg(F.percentile(value, 0.5, F.col("_n")).alias("_median"))
    filled = df.join(medians, key, "left").withColumn(out, F.coalesce(value, "_median"))
    gone = F.col(value).isNull()
    return filled.withColumn("is_imputed", gone & F.col("_median").isNotNull()).withColumn("imputation_method", F.when(F.col("is_imputed"), "group_median")).drop("_median")


def drops(scores: DataFrame, order: str, score: str, threshold: float) -> DataFrame:
    """Places where a score falls by the threshold or more against the one before. Scores are one row per period."""
    w = Window.orderBy(order)
    fall = F.round(F.lag(score).over(w) - F.col(score), 6)
    return scores.withColumn("fall", fall).filter(F.col("fall") >= threshold)
