"""Inventory analytics on keyed changes: balances, roll-ups, thresholds, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.keyed import running, running_sum, spaced

#: From the most to the least specific level of a threshold.
LEVELS = ("sku", "product", "brand", "category", "department", "global")


def stock_key(warehouse: Column, sku: Column) -> Column:
    return F.concat_ws(":", warehouse, sku)


def impact(kind: Column, quantity: Column) -> Column:
    """Signed change of stock: sales leave, restocks and returns come, adjustments are signed already."""
    return F.when(kind == "sale", -quantity).when(kind.isin("restock", "return"), quantity).when(kind == "adjustment", quantity)


def running_stock(df: DataFrame, keys: Sequence[str], order: Sequence[str], change: str, snapshot: str | None = None, bucket: Column | None = None) -> DataFrame:
    """stock after each row: a snapshot (not null) replaces it, changes add up after the last one. bucket: as for keyed.running_sum."""
    if snapshot is None:
        return running_sum(df, keys, order, F.col(change), "stock", bucket)
    # The number of snapshots so far tells apart what adds up.
    df = running_sum(df, keys, order, F.col(snapshot).isNotNull().cast("long"), "_epoch", bucket)
    return running_sum(df, [*keys, "_epoch"], order, F.coalesce(snapshot, change), "stock", bucket).drop("_epoch")


def current_state(df: DataFrame, keys: Sequence[str], ts: str, change: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(change).alias("stock"), F.count("*").alias("transactions"), F.max(ts).alias("last_change"))


def available(current: Column, reserved: Column) -> Column:
    return current - F.coalesce(reserved, F.lit(0))


def rolled_up(df: DataFrame, levels: Sequence[str], measure: str) -> DataFrame:
    """Totals at each level of the hierarchy; level: how many of its names are set."""
    return df.rollup(*levels).agg(F.sum(measure).alias("total"), F.count("*").alias("n"), (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int").alias("level"))


def at_level(rollup: DataFrame, level: int) -> DataFrame:
    return rollup.where(F.col("level") == level)


def resolved_thresholds(items: DataFrame, thresholds: DataFrame, columns: dict[str, str], default: int, key: Sequence[str]) -> DataFrame:
    """threshold of each item: the most specific level whose value matches, of its warehouse before any.

    thresholds: level, value, warehouse (null: all), threshold: at most one row each. key: columns that tell items apart. One join
    of an item's levels with the thresholds, and the best of each item.
    """
    named = [lv for lv in LEVELS if lv in columns]
    level = lambda name, value: F.struct(F.lit(name).alias("level"), value.cast("string").alias("value"), F.lit(LEVELS.index(name)).alias("rank"))
    asked = F.array(*(level(lv, F.col(columns[lv])) for lv in named), level("global", F.lit("all")))
    rows = items.select(*key, "warehouse", F.explode(asked).alias("l")).select(*key, F.col("warehouse").alias("_own"), "l.*")
    given = thresholds.select("level", F.when(F.col("level") == "global", "all").otherwise(F.col("value")).alias("value"), F.col("warehouse").alias("_for"), "threshold")
    met = rows.join(given, ["level", "value"]).where(F.col("_for").isNull() | (F.col("_for") == F.col("_own")))
    best = met.groupBy(*key).agg(F.min_by("threshold", F.struct("rank", F.col("_for").isNull())).alias("threshold"))
    return items.join(best, list(key), "left").withColumn("threshold", F.coalesce("threshold", F.lit(default)))


def current_thresholds(events: DataFrame, updates: DataFrame, keys: Sequence[str], ts: str, column: str = "threshold", bucket: Column | None = None) -> DataFrame:
    """events with the threshold that was last set for their keys at or before their time (updates: keys, ts, column); null before the first.

    Updates and events of a key are read in the order of time, an update before events of the same time: no join by ranges. bucket: of ts, as for
    keyed.running, so that no task has all rows of a key.
    """
    rows = events.withColumn("_set", F.lit(None).cast(updates.schema[column].dataType)).withColumn("_event", F.lit(True))
    sets = updates.select(*keys, ts, F.col(column).alias("_set"), F.lit(False).alias("_event"))
    both = running(rows.unionByName(sets, allowMissingColumns=True), keys, [ts, "_event"], F.col("_set"), column, bucket, "last")
    return both.where("_event").drop("_event", "_set")


def velocity(df: DataFrame, keys: Sequence[str], day: str, sold: str, days: int) -> DataFrame:
    """sold per day over the days before and with each row; day is a day number."""
    w = Window.partitionBy(*keys).orderBy(day).rangeBetween(-(days - 1), 0)
    return df.withColumn("per_day", F.sum(sold).over(w) / F.lit(float(days)))


def cover_days(stock: Column, per_day: Column) -> Column:
    return F.when(per_day > 0, stock / per_day)


def cover_threshold(per_day: Column, days: float) -> Column:
    """The stock that lasts so many days, in whole pieces."""
    return F.ceil(per_day * F.lit(float(days))).cast("long")


def depletion(df: DataFrame, keys: Sequence[str], day: str, change: str) -> DataFrame:
    """per_day: what a key loses a day, net, between its first and last day with a change; 0 for keys that gain."""
    days = F.max(day) - F.min(day) + 1
    return df.groupBy(*keys).agg(days.cast("long").alias("days"), F.sum(change).alias("change")).withColumn("per_day", F.greatest(-F.col("change") / F.col("days"), F.lit(0.0)))


def across_warehouses(df: DataFrame, warehouse: str, item: str, measure: str) -> DataFrame:
    """stock and warehouses of each item over all of them."""
    return df.groupBy(item).agg(F.sum(measure).alias("stock"), F.count_distinct(warehouse).alias("warehouses"))


def stock_metrics(stock: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame:
    """items, out_of_stock, below (threshold or less), and the share out of stock, from one row an item (column stock)."""
    counted = stock.groupBy(*keys).agg(F.count("*").alias("items"), F.count_if(F.col("stock") <= 0).alias("out_of_stock"), F.count_if(F.col("stock") <= threshold).alias("below"))
    return counted.withColumn("stockout_rate", F.col("out_of_stock") / F.col("items"))


def dynamic_threshold(df: DataFrame, keys: Sequence[str], measure: str, deviations: float) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(measure).alias("mean"), F.stddev_samp(measure).alias("deviation")).withColumn("threshold", F.col("mean") + F.lit(deviations) * F.coalesce("deviation", F.lit(0.0)))


def alert_kind(stock: Column, threshold: Column) -> Column:
    """stockout, low_stock (half the threshold or less), reorder, or null."""
    return F.when(stock <= 0, "stockout").when(2 * stock <= threshold, "low_stock").when(stock <= threshold, "reorder")


def severity(kind: Column) -> Column:
    return F.when(kind == "stockout", "critical").when(kind == "low_stock", "high").when(kind == "reorder", "medium")


def breaches(df: DataFrame, keys: Sequence[str], order: Sequence[str], breached: Column) -> DataFrame:
    """Rows at which a key goes from fine (or unknown) to breached: one alert until it recovers."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_now", F.coalesce(breached, F.lit(False)))
    return df.withColumn("_was", F.coalesce(F.lag("_now").over(w), F.lit(False))).where(F.col("_now") & ~F.col("_was")).drop("_now", "_was")


def alerts(df: DataFrame, keys: Sequence[str], seconds: str, order: Sequence[str], breached: Column, cooldown: float) -> DataFrame:
    """Rows that alert: when a key becomes breached, and again each time that it still is after `cooldown` seconds since its last alert.
    A key that recovers starts afresh."""
    w = Window.partitionBy(*keys).orderBy(seconds, *order)
    now = F.coalesce(breached, F.lit(False))
    starts = df.withColumn("_now", now).withColumn("_start", (F.col("_now") & ~F.coalesce(F.lag("_now").over(w), F.lit(False))).cast("int"))
    runs = starts.withColumn("breach_run", F.sum("_start").over(w)).where("_now").drop("_now", "_start")
    return spaced(runs, [*keys, "breach_run"], seconds, cooldown, order).where("kept").drop("kept", "breach_run")


def alert_id(day: Column, warehouse: Column, sku: Column) -> Column:
    return F.concat_ws("-", F.lit("alt"), F.date_format(day, "yyyyMMdd"), warehouse, sku)


def unexpired(df: DataFrame, ts: str, now: Column, ttl_seconds: int) -> DataFrame:
    """State without the rows that weren't touched for longer than ttl_seconds."""
    return df.where(F.unix_timestamp(now) - F.unix_timestamp(ts) <= ttl_seconds)
