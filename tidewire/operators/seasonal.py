"""Thresholds that follow a season, from quantile sketches that add up: of a day, of all the days of a kind, of any span of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, and the error of a quantile's rank that it keeps to with 99 % confidence, whatever the number of values.
SIZE, RANK_ERROR = 400, 0.01


def daily(df: DataFrame, keys: Sequence[str], day: Column, measure: Column, size: int = SIZE) -> DataFrame:
    """keys, day, sketch of each key's values of a day: state of a few kilobytes that is written once and never recomputed. Null values don't count."""
    rows = df.select(*keys, day.alias("day"), measure.cast("double").alias("_value")).where("_value is not null and not isnan(_value)")
    return rows.groupBy(*keys, "day").agg(F.kll_sketch_agg_double("_value", F.lit(size)).alias("sketch"))


def seasons(sketches: DataFrame, keys: Sequence[str], season: Column) -> DataFrame:
    """keys, season, sketch, n, from daily sketches or from sketches of seasons: what season gives alike is merged, in any order and grouping."""
    merged = sketches.withColumn("season", season).groupBy(*keys, "season").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.withColumn("n", F.kll_sketch_get_n_double("sketch"))


def weekday(day: Column) -> Column:
    """1 (Monday) to 7."""
    return F.weekday(day) + 1


def quantile(sketches: DataFrame, share: float, out: str = "threshold") -> DataFrame:
    """The value that this share of a sketch's values doesn't exceed; its rank is within RANK_ERROR of the share (for sketches of SIZE)."""
    return sketches.withColumn(out, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))))


def above(df: DataFrame, thresholds: DataFrame, keys: Sequence[str], season: Column, measure: Column) -> DataFrame:
    """Rows whose value exceeds the threshold of their key's season (thresholds: keys, season, threshold)."""
    return df.withColumn("season", season).join(thresholds.select(*keys, "season", "threshold"), [*keys, "season"]).where(measure > F.col("threshold"))
