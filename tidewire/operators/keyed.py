"""Keyed and sequential operators: deduplication, batching, rate limits, breakers, retries, sampling.

Ordered folds that no window expresses run over partitions sorted by key and time; a fold keeps one
small state, so a group of any size passes through a task without being held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.sources.scratch import written

#: Parts that rows without a key are dealt into, as no key needs them together.
KEYLESS = 1024


def fresh(df: DataFrame, keys: Sequence[str], ts: str, arrival: str, bucket: Column | None = None) -> DataFrame:
    """Rows whose ts is above every earlier one of their key, in order of arrival; rows with a null key all stay.

    One key's rows pass through one task, a sorted stream that isn't held, or through many by a bucket (as for `running`); rows without a key are spread.
    """
    keyless = F.lit(False)
    for k in keys:
        keyless |= F.col(k).isNull()
    df = df.withColumn("_part", F.when(keyless, F.pmod(F.xxhash64(arrival), F.lit(KEYLESS))))
    df = running(df, [*keys, "_part"], [arrival], F.col(ts), "_before", bucket, "max", earlier=True)
    return df.where(F.col("_part").isNotNull() | F.col("_before").isNull() | (F.col(ts) > F.col("_before"))).drop("_before", "_part")


def newest(df: DataFrame, ts: str, most: int, *ties: str, since: Column | None = None) -> DataFrame:
    """The rows of the most recent times, of equal times those highest by ties: a bounded store's content. since: older ones are left out."""
    kept = df if since is None else df.where(F.col(ts) >= since)
    return kept.orderBy(F.desc(ts), *map(F.desc, ties)).limit(most)


#: How what came before a bucket and what came in it are one: of a sum, a maximum, the last value that isn't null.
COMBINED: dict[str, Callable[[Column, Column], Column]] = {"sum": lambda b, i: F.coalesce(b + i, b, i), "max": F.greatest, "last": lambda b, i: F.coalesce(i, b)}


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: Column, out: str, bucket: Column | None = None, how: str = "sum", earlier: bool = False) -> DataFrame:
    """The sum, maximum or last (not null) value over a key's rows up to each row, or with earlier up to the one before it.

    bucket: a column that never falls along the order (a day, a range of ids). Then no task has all rows of a key: each bucket is taken
    apart, and what came before it is added, from one row a key and bucket.
    """
    over = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[how]
    until = -1 if earlier else 0
    if bucket is None:
        return df.withColumn(out, over(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, until)))
    df = df.withColumn("_bucket", bucket).withColumn("_value", value)
    names = [*keys, "_bucket"]
    at = [F.col(c) if isinstance(c, str) else c for c in order]
    whole = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*(c.alias(f"o{n}") for n, c in enumerate(at))))) if how == "last" else over(F.col("_value"))
    sums = df.groupBy(*names).agg(whole.alias("_whole"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.select(*(F.col(n).alias(f"_of_{n}") for n in names), over(F.col("_whole")).over(before).alias("_before"))
    same = F.lit(True)
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"_of_{n}"))
    inner = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, until)
    both = df.withColumn("_inner", over(F.col("_value")).over(inner)).join(known, same)
    # Nulls add nothing; without any value yet the result is null.
    return both.withColumn(out, COMBINED[how](F.col("_before"), F.col("_inner"))).drop("_inner", "_before", "_value", "_bucket", *(f"_of_{n}" for n in names))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, bucket: Column | None = None) -> DataFrame:
    """The sum of value over a key's rows up to each row; bucket: as for running."""
    return running(df, keys, order, value, out, bucket)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, bucket: Column | None = None) -> DataFrame:
    """The number of each row among its key's, from 1; bucket: as for running_sum."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), out, bucket)


def batched(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, bucket: Column | None = None) -> DataFrame:
    """batch_id: consecutive runs of size rows for each key; bucket: as for running_sum."""
    return numbered(df, keys, order, "_n", bucket).withColumn("batch_id", F.floor((F.col("_n") - 1) / size)).drop("_n")


def batched_in_time(df: DataFrame, keys: Sequence[str], seconds: str, size: int, latency: float, order: Sequence[str] = ()) -> DataFrame:
    """batch_id: runs of rows for each key that close at `size` rows, or once `latency` seconds have passed since their first."""

    def step(state: tuple[int, int, float], row: Any) -> tuple[tuple[int, int, float], int]:
        batch, count, first = state
        now = float(getattr(row, seconds))
        if count and (count >= size or now - first >= latency):
            batch, count = batch + 1, 0
        return (batch, count + 1, first if count else now), batch

    return folded(df, keys, [seconds, *order], lambda: (0, 0, 0.0), step, "batch_id", "long")


def folded(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: Callable[[], Any], step: Callable[[Any, Any], tuple[Any, Any]], name: str, kind: str) -> DataFrame:
    """A column from an ordered fold per key: step(state, row) -> (state, value).

    Each state follows from the one before, so a key's rows pass through one task in their order; only the state is held.
    More keys (a device, a warehouse) are the way to more tasks.
    """
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{name}` {kind}"])
    keys = list(keys)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), None
        for frame in frames:
            values = []
            for row in frame.itertuples(index=False):
                key = tuple(getattr(row, k) for k in keys)
                if key != now:
                    now, state = key, start()
                state, value = step(state, row)
                values.append(value)
            yield frame.assign(**{name: values})

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def token_bucket(df: DataFrame, keys: Sequence[str], seconds: str, rate: float, burst: float, order: Sequence[str] = ()) -> DataFrame:
    """granted: whether a full bucket that refills at rate a second had a token left."""

    def step(state: tuple[float, float | None], row: Any) -> tuple[tuple[float, float | None], bool]:
        tokens, at = state
        now = float(getattr(row, seconds))
        tokens = min(burst, tokens + (now - at) * rate) if at is not None else tokens
        return ((tokens - 1, now), True) if tokens >= 1 else ((tokens, now), False)

    return folded(df, keys, [seconds, *order], lambda: (burst, None), step, "granted", "boolean")


#: Rows of a key that may pass through one task as a sorted stream; the rows of larger keys are spaced by many.
FOLD_ROWS = 5_000_000


def spaced(df: DataFrame, keys: Sequence[str], seconds: str, gap: float, order: Sequence[str] = (), most: int = FOLD_ROWS) -> DataFrame:
    """kept: at least gap seconds since the last kept row of the key (rate-limited samples, alert cooldowns).

    Keys of up to `most` rows pass through a task each; for larger ones see `spaced_widely`, with the same result. Rows without seconds aren't kept.
    """

    def step(last: float | None, row: Any) -> tuple[float | None, bool]:
        now = float(getattr(row, seconds))
        if now != now:
            return last, False
        return (now, True) if last is None or now >= last + gap else (last, False)

    large = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > most).drop("_rows")
    if gap <= 0 or not large.limit(1).count():
        return folded(df, keys, [seconds, *order], lambda: None, step, "kept", "boolean")
    large = written(large.select(*(F.col(k).alias(f"_of_{k}") for k in keys)), "large-keys")
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return folded(df.join(large, same, "left_anti"), keys, [seconds, *order], lambda: None, step, "kept", "boolean").unionByName(spaced_widely(df.join(large, same, "left_semi"), keys, seconds, gap, order))


#: Buckets, of a gap each, that a task looks through for the next one with a row.
RANGE = 4096


def spaced_widely(df: DataFrame, keys: Sequence[str], seconds: str, gap: float, order: Sequence[str] = ()) -> DataFrame:
    """As spaced, where no task holds a key.

    After each time the next that could be kept is the first at least a gap later. In buckets as long as a gap it lies in the bucket after, or is the first of the next bucket
    with a time: a pointer that a window over one bucket, and one over ranges of buckets, finds. The kept times are those that the pointers lead to
    from a key's first: pointers are doubled, and what is reached doubles with them, in rounds of the logarithm of their number. Each round is a written table.
    """
    keys = list(keys)
    names = [f"_k{n}" for n in range(len(keys))]
    bucket = lambda t: F.floor(t / F.lit(float(gap))).cast("long")
    timed = df.where(F.col(seconds).isNotNull() & ~F.isnan(F.col(seconds).cast("double")))
    # Keys may be null, which no join meets: a struct of them isn't.
    key = F.struct(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)))
    at = written(timed.select(F.to_json(key, {"ignoreNullFields": "false"}).alias("k"), F.col(seconds).cast("double").alias("t")).distinct(), "times")
    targets = at.select("k", "t", bucket(F.col("t")).alias("b"))
    asks = at.select("k", F.col("t").alias("from"), (F.col("t") + F.lit(float(gap))).alias("t"))
    # The bucket of t + gap is never before that of the next time, as both are rounded alike.
    both = asks.select("k", "from", "t", bucket(F.col("t")).alias("b")).unionByName(targets.withColumn("from", F.lit(None).cast("double")))
    ahead = Window.partitionBy("k", "b").orderBy("t", F.col("from").isNull()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = both.withColumn("here", F.first(F.when(F.col("from").isNull(), F.col("t")), ignorenulls=True).over(ahead)).where(F.col("from").isNotNull())
    # The first time of the next bucket that has any, for each bucket that is asked in.
    firsts = targets.groupBy("k", "b").agg(F.min("t").alias("first"))
    marks = firsts.unionByName(found.where("here is null").select("k", "b", F.lit(None).cast("double").alias("first")).distinct()).withColumn("r", F.floor(F.col("b") / RANGE))
    within = Window.partitionBy("k", "r").orderBy("b").rangeBetween(1, Window.unboundedFollowing)
    ranges = firsts.withColumn("r", F.floor(F.col("b") / RANGE)).groupBy("k", "r").agg(F.min("first").alias("range_first"))
    asked_ranges = ranges.unionByName(marks.select("k", "r", F.lit(None).cast("double").alias("range_first")).distinct()).groupBy("k", "r").agg(F.min("range_first").alias("range_first"))
    later = asked_ranges.select("k", "r", F.min("range_first").over(Window.partitionBy("k").orderBy("r").rowsBetween(1, Window.unboundedFollowing)).alias("later"))
    nexts = marks.withColumn("inside", F.min("first").over(within)).join(later, ["k", "r"]).groupBy("k", "b").agg(F.min(F.coalesce("inside", "later")).alias("next"))
    pointers = found.join(nexts, ["k", "b"], "left").select("k", F.col("from").alias("t"), F.coalesce("here", "next").alias("to")).where("to is not null")
    pointers = written(pointers, "pointers")
    reached = written(at.groupBy("k").agg(F.min("t").alias("t")), "reached")
    size = reached.count()
    while True:
        more = written(reached.union(reached.join(pointers, ["k", "t"]).select("k", F.col("to").alias("t"))).distinct(), "reached")
        grown = more.count()
        if grown == size:
            break
        reached, size = more, grown
        twice = pointers.select("k", F.col("t").alias("to"), F.col("to").alias("_to"))
        pointers = written(pointers.join(twice, ["k", "to"]).select("k", "t", F.col("_to").alias("to")), "pointers")
    first = Window.partitionBy("_k", "_t").orderBy(*order) if order else Window.partitionBy("_k", "_t").orderBy(F.lit(0))
    rows = df.withColumns({"_k": F.to_json(key, {"ignoreNullFields": "false"}), "_t": F.col(seconds).cast("double")}).withColumn("_first", F.row_number().over(first) == 1)
    kept = reached.select(F.col("k").alias("_k"), F.col("t").alias("_t"), F.lit(True).alias("_kept"))
    return rows.join(kept, ["_k", "_t"], "left").withColumn("kept", F.coalesce("_kept", F.lit(False)) & F.col("_first")).drop("_k", "_t", "_first", "_kept")


def circuit_breaker(df: DataFrame, keys: Sequence[str], seconds: str, ok: str, failures: int = 3, reset: float = 1.0, trials: int = 3) -> DataFrame:
    """state after each call: closed, open (the call was refused) or half_open."""

    def step(s: tuple[str, int, float], row: Any) -> tuple[tuple[str, int, float], str]:
        state, count, since = s
        now, good = float(getattr(row, seconds)), bool(getattr(row, ok))
        if state == "open":
            if now - since < reset:
                return s, "open"
            state, count = "half_open", 0
        if state == "half_open":
            s = ("closed", 0, now) if good and count + 1 >= trials else ("half_open", count + 1, now) if good else ("open", 0, now)
        else:
            count = 0 if good else count + 1
            s = ("open", 0, now) if count >= failures else ("closed", count, now)
        return s, s[0]

    return folded(df, keys, [seconds], lambda: ("closed", 0, 0.0), step, "state", "string")


def adaptive_rate(df: DataFrame, keys: Sequence[str], order: Sequence[str], success_rate: str, start: float = 1000, low: float = 100, high: float = 5000) -> DataFrame:
    """rate after each window: up a tenth at 95 % success, down a fifth at 80 % or less, within bounds."""

    def step(rate: float, row: Any) -> tuple[float, float]:
        share = getattr(row, success_rate)
        rate = min(high, rate * 1.1) if share >= 0.95 else max(low, rate * 0.8) if share <= 0.8 else rate
        return rate, rate

    return folded(df, keys, order, lambda: float(start), step, "rate", "double")


def success_metrics(df: DataFrame, keys: Sequence[str], ok: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("operations"), F.coalesce(F.avg(ok.cast("int")), F.lit(1.0)).alias("success_rate"))


def backoff_seconds(attempt: Column, first: float = 1.0, factor: float = 2.0, most: float = 30.0) -> Column:
    """Delay before retry number attempt (from 0)."""
    return F.least(F.lit(first) * F.pow(F.lit(factor), attempt), F.lit(most))


def jittered_backoff(attempt: Column, first: float = 1.0, factor: float = 2.0, jitter: float = 0.1, most: float = 60.0) -> Column:
    """Delay before reconnection number attempt (from 0): each is the last one times factor plus its share of jitter, up to most."""
    return F.least(F.lit(first) * F.pow(F.lit(factor + jitter), attempt), F.lit(most))


def classified(error: Column, classes: dict[str, str]) -> Column:
    """The class of an error type; unknown ones are fatal."""
    return F.coalesce(F.create_map(*(F.lit(x) for kv in classes.items() for x in kv))[error], F.lit("fatal"))


def ladder(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the highest step that value reaches."""
    out = F.lit(otherwise)
    for least, label in sorted(steps):
        out = F.when(value >= least, label).otherwise(out)
    return out


def top_counts(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return df.groupBy(column).count().orderBy(F.desc("count"), column).limit(k)


def health(df: DataFrame, keys: Sequence[str], component_ok: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.bool_and(component_ok).alias("healthy"))


def hashed_sample(df: DataFrame, columns: Sequence[str], percent: int) -> DataFrame:
    """The same rows at every run: by the first 28 bits of an md5."""
    digest = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in columns)))
    return df.where(F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % 100 < percent)


def systematic_sample(df: DataFrame, keys: Sequence[str], order: Sequence[str], every: int, bucket: Column | None = None) -> DataFrame:
    """Every so many-th row of a key; bucket: as for running_sum."""
    return numbered(df, keys, order, "_n", bucket).where(F.col("_n") % every == 0).drop("_n")


def random_sample(df: DataFrame, rate: float, seed: int = 0) -> DataFrame:
    return df.sample(rate, seed)


def reservoir_sample(df: DataFrame, k: int, columns: Sequence[str], seed: int = 0) -> DataFrame:
    """k rows, all equally likely, and the same ones at every run: those of the least hashes of these columns."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns))), *columns).limit(k)


def sampling_rate(level: Column, kind: Column, rules: dict[tuple[str, str | None], float], default: float) -> Column:
    """Errors always; then (level, kind), (level, None), default."""
    out = F.lit(default)
    for (lv, kd), rate in sorted(rules.items(), key=lambda r: r[0][1] is not None):
        out = F.when((level == lv) & (F.lit(True) if kd is None else kind == kd), rate).otherwise(out)
    return F.when(level.isin("ERROR", "CRITICAL"), 1.0).otherwise(out)
