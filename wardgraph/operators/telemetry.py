"""Summaries of pipeline telemetry: counters, histograms, quantiles, errors, requests, alerts, health."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgraph.sources.tables import written

# fixed values: default histogram buckets, quantiles, alert steps by severity
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf"))
QUANTILES = (0.5, 0.9, 0.95, 0.99)
ALERT_STEPS = {"critical": 1, "high": 5, "medium": 20, "low": 50}


def exact_sum(c) -> Column:
    """A sum of values with at most four decimals that does not depend on their order."""
    return F.sum(F.col(c).cast("decimal(24,4)") if isinstance(c, str) else c.cast("decimal(24,4)")).cast("double")


def error_summary(errors: DataFrame) -> DataFrame:
    """Counts in total, by category, by severity and by both; level: 0 both, 1 category, 2 severity, 3 total."""
    sets = errors.groupingSets([["category"], ["severity"], ["category", "severity"], []], "category", "severity")
    return sets.agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def ranged(rows: DataFrame, keys: list[str], order: list[str], group: str, at: str) -> DataFrame:
    """rows as a table, dealt to ranges of keys and order, with the number of their range and their place in order."""
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn(at, F.monotonically_increasing_id())
    return written(dealt.withColumn(group, F.shiftright(at, 33)), "ranges")


def with_heads(dealt: DataFrame, keys: list[str], group: str, heads: DataFrame, name: str) -> DataFrame:
    """dealt with what `heads` says of each key and range: a row for each that holds rows of the key."""
    theirs = heads.select(*(F.col(k).alias(f"__{name}_{i}") for i, k in enumerate([*keys, group])), *(c for c in heads.columns if c not in (*keys, group)))
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{name}_{i}")) for i, k in enumerate([*keys, group])))
    return dealt.join(theirs, on).drop(*(f"__{name}_{i}" for i in range(len(keys) + 1)))


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """rows with their number from 1 among those of their keys, in order. Rows are dealt to ranges of keys and order and
    numbered there; the counts of the ranges before are added, so a key of any size is numbered by many tasks. The order
    should tell the rows of a key apart."""
    at, group, first, before = (f"__{name}_{x}" for x in ("at", "range", "first", "before"))
    dealt = ranged(rows, keys, order, group, at)
    heads = dealt.groupBy(*keys, group).agg(F.min(at).alias(first), F.count("*").alias("n"))
    earlier = Window.partitionBy(*keys).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn(before, F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return with_heads(dealt, keys, group, heads, name).select(*rows.columns, (F.col(before) + F.col(at) - F.col(first) + 1).alias(name))


def running_sum(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """rows with the sum of value over the rows of their keys up to them, in order: summed in ranges of keys and order, to which
    the sums of the ranges before are carried. A window never holds more of a key than a range does."""
    at, group, own, before = (f"__{name}_{x}" for x in ("at", "range", "own", "before"))
    dealt = ranged(rows.withColumn(own, value), keys, order, group, at)
    earlier = Window.partitionBy(*keys).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    heads = dealt.groupBy(*keys, group).agg(F.sum(own).alias(before)).withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    inside = F.sum(own).over(Window.partitionBy(*keys, group).orderBy(at).rowsBetween(Window.unboundedPreceding, 0))
    return with_heads(dealt.withColumn(own, inside), keys, group, heads, name).select(*rows.columns, (F.col(before) + F.coalesce(own, F.lit(0))).alias(name))


def alerts(errors: DataFrame) -> DataFrame:
    """Each n-th error of a (category, severity) by time, n by severity."""
    step = F.coalesce(F.create_map(*(F.lit(x) for kv in ALERT_STEPS.items() for x in kv))[F.col("severity")], F.lit(100))
    return numbered(errors, ["category", "severity"], ["ts", "event_id"], "nth").where(F.col("nth") % step == 0)


def request_stats(requests: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """completed, total, success_rate in percent, mean duration; zeros when there are none. active: open requests."""
    done = requests.agg(F.count("*").alias("completed"), F.count_if("success").alias("ok"), (exact_sum("duration") / F.count("*")).alias("mean"))
    open_ = (active if active is not None else requests.limit(0)).agg(F.count("*").alias("active"))
    both = done.join(F.broadcast(open_))
    rate = F.coalesce(F.round(F.try_divide(F.col("ok") * 100.0, F.col("completed")), 2), F.lit(0.0))
    return both.select("active", "completed", (F.col("active") + F.col("completed")).alias("total"), rate.alias("success_rate"), F.coalesce(F.round("mean", 3), F.lit(0.0)).alias("avg_duration"))


def perf_summary(timings: DataFrame) -> DataFrame:
    """operations, total duration and items, and the unweighted mean of items a second (0 where no time passed)."""
    rate = F.when(F.col("duration") > 0, F.col("items") / F.col("duration")).otherwise(0.0)
    return timings.agg(F.count("*").alias("operations"), exact_sum("duration").alias("total_duration"), F.sum("items").alias("total_items"), F.coalesce(F.avg(rate), F.lit(0.0)).alias("mean_rate"))


def counter_totals(samples: DataFrame) -> DataFrame:
    return samples.groupBy("name", "label_key").agg(exact_sum("value").alias("total"))


def gauge_values(samples: DataFrame) -> DataFrame:
    """Per key the last `set`, plus the inc and minus the dec after it; seq orders the samples of a key."""
    last = samples.where("op = 'set'").groupBy("label_key").agg(F.max_by(F.struct("seq", "value"), "seq").alias("last"))
    after = samples.join(last, "label_key", "left").where("last is null or seq > last.seq")
    signed = F.when(F.col("op") == "inc", F.col("value")).when(F.col("op") == "dec", -F.col("value"))
    moved = after.groupBy("label_key").agg(F.sum(signed.cast("decimal(24,4)")).alias("delta"))
    keys = samples.select("label_key").distinct().join(last, "label_key", "left").join(moved, "label_key", "left")
    value = F.coalesce(F.col("last.value").cast("decimal(24,4)"), F.lit(0)) + F.coalesce("delta", F.lit(0))
    return keys.select("label_key", value.cast("double").alias("value"))


def bucket_counts(buckets: Sequence[float]) -> list[Column]:
    """How many values are at most each bucket."""
    return [F.count_if(F.col("value") <= b).alias(f"b{i}") for i, b in enumerate(buckets)]


def bucket_rows(wide: DataFrame, keys: list[str], buckets: Sequence[float]) -> DataFrame:
    """keys, n, total and the counts of bucket_counts -> one row a bucket."""
    rows = F.array(*(F.struct(F.lit("+Inf" if b == float("inf") else str(b)).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, b in enumerate(buckets)))
    return wide.select(*keys, "n", "total", F.explode(rows).alias("b")).select(*keys, "n", "total", "b.le", "b.cumulative")


def histogram(samples: DataFrame, buckets: Sequence[float] = BUCKETS) -> DataFrame:
    """Per key count, sum and cumulative counts up to each bucket, in one pass, then one row a bucket."""
    wide = samples.groupBy("label_key").agg(F.count("*").alias("n"), exact_sum("value").alias("total"), *bucket_counts(buckets))
    return bucket_rows(wide, ["label_key"], buckets)


def quantiles(samples: DataFrame, q: Sequence[float] = QUANTILES) -> DataFrame:
    """Per key count, sum, mean and the order statistics at int(q n - 1), not below the first. Values are dealt to ranges of key and
    value; the counts of the ranges say where each rank lies, and those rows alone are picked."""
    # equal values in any order
    dealt = ranged(samples.select("label_key", "value", F.monotonically_increasing_id().alias("tie")), ["label_key"], ["value", "tie"], "range", "at")
    heads = dealt.groupBy("label_key", "range").agg(F.min("at").alias("first"), F.count("*").alias("own"), F.sum(F.col("value").cast("decimal(24,4)")).alias("total"))
    key = Window.partitionBy("label_key")
    before = F.coalesce(F.sum("own").over(key.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = heads.select("label_key", "first", "own", before.alias("before"), F.sum("own").over(key).alias("n"), F.sum("total").over(key).alias("total"))
    rank = lambda x: F.greatest(F.expr(f"cast({x}D * n - 1 as long)"), F.lit(0))
    named = {f"q{str(x)[2:]}": rank(x) for x in q}
    ranks = heads.withColumn("w", F.explode(F.array(*(F.struct(F.lit(c).alias("q"), r.alias("rank")) for c, r in named.items()))))
    here = F.col("w.rank") - F.col("before")
    wanted = ranks.where((here >= 0) & (here < F.col("own"))).select("label_key", "n", "total", "w.q", (F.col("first") + here).alias("at"))
    found = wanted.join(dealt.select("at", "value"), "at").groupBy("label_key", "n", "total").agg(*(F.max(F.when(F.col("q") == c, F.col("value"))).alias(c) for c in named))
    total = F.col("total").cast("double")
    return found.select("label_key", "n", total.alias("total"), (total / F.col("n")).alias("mean"), *named)


#: Size parameter of the quantile sketches, and the error of a rank that it gives in 99 of 100 cases (as Apache DataSketches states for 200).
SKETCH_K, SKETCH_ERROR = 200, 0.0133


def sketches(samples: DataFrame, *keys: str, k: int = SKETCH_K) -> DataFrame:
    """A KLL sketch of the values of each key, some kilobytes whatever their number: a table to store and to merge again. Null values are left out."""
    return samples.where("value is not null").groupBy(*keys).agg(F.kll_sketch_agg_double(F.col("value").cast("double"), F.lit(k)).alias("sketch"))


def merged(stored: DataFrame, *keys: str, k: int = SKETCH_K) -> DataFrame:
    """Sketches of finer keys -> those of coarser ones."""
    return stored.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketched_quantiles(stored: DataFrame, q: Sequence[float] = QUANTILES) -> DataFrame:
    """Sketches -> their keys, the count, and an approximate value at each q."""
    picks = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(x))).alias(f"q{str(x)[2:]}") for x in q]
    return stored.select(*(c for c in stored.columns if c != "sketch"), F.kll_sketch_get_n_double("sketch").alias("n"), *picks)


def rank_errors(samples: DataFrame, found: DataFrame, key: str, q: Sequence[float] = QUANTILES) -> DataFrame:
    """How far each approximate quantile of `found` (a row a key) is from its rank among the samples, as a share of them: 0 if the
    rank lies between the values below it and those up to it. A row a key and quantile."""
    names = [f"q{str(x)[2:]}" for x in q]
    both = samples.where("value is not null").join(found.select(F.col(key).alias("__key"), *names), F.col(key).eqNullSafe(F.col("__key")))
    share = lambda c: F.count_if(c) / F.count("*")
    error = [F.greatest(share(F.col("value") < F.col(c)) - x, x - share(F.col("value") <= F.col(c)), F.lit(0.0)).alias(c) for c, x in zip(names, q, strict=True)]
    rows = F.array(*(F.struct(F.lit(float(x)).alias("q"), F.col(c).alias("error")) for c, x in zip(names, q, strict=True)))
    return both.groupBy(key).agg(*error).select(key, F.explode(rows).alias("r")).select(key, "r.q", "r.error")


def profile(samples: DataFrame) -> DataFrame:
    return samples.groupBy("func").agg(F.count("*").alias("n"), exact_sum("value").alias("total"), (exact_sum("value") / F.count("*")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))


def last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key by seq. The whole row travels in one aggregate, so a hot key is combined before it moves."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def retain_newest(rows: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rn") <= n)


def retain_samples(rows: DataFrame, key: str, seq: str, most: int = 10_000, keep: int = 5_000) -> DataFrame:
    """What is left of each key's samples if each time that they exceed `most` only the last `keep` stay. seq tells the samples
    of a key apart."""
    ranked = numbered(rows, [key], [seq], "__rn")
    totals = ranked.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__n"))
    left = F.when(F.col("__n") <= most, F.col("__n")).otherwise(keep + (F.col("__n") - most - 1) % (most - keep + 1))
    return ranked.join(totals, F.col(key).eqNullSafe(F.col("__key"))).where(F.col("__rn") > F.col("__n") - left).select(*rows.columns)


def failure_runs(rows: DataFrame, key: str, threshold: int) -> DataFrame:
    """Runs of consecutive failures per key, by time: first event, length, and whether it reaches the threshold. The failures
    between two successes have the same number of successes before them, which is carried from range to range of a key's
    time; a run is counted where its rows are before it moves."""
    ok = F.coalesce(F.col("success").cast("int"), F.lit(0))
    runs = running_sum(rows.select(key, "ts", "event_id", "success"), [key], ["ts", "event_id"], ok, "run").where("not success")
    return runs.groupBy(key, "run").agg(F.min("event_id").alias("first_event"), F.count("*").alias("length")).select(key, "first_event", "length", (F.col("length") >= threshold).alias("opens"))


def trailing_rate(rows: DataFrame, key: str, us: str, seconds: int, limit: int) -> DataFrame:
    """Calls in (t - w, t] of each call's key, whether the others among them already reach the limit, and the
    microseconds until the oldest of them leaves the window (0 if below the limit). All calls count, admitted or not.

    A key's calls are counted in stretches of w, each of which also gets the calls of the stretch before; so no task
    has more of a key than it makes in twice that time. Calls without a time are among themselves."""
    width = seconds * 1_000_000
    at = F.floor(F.col(us) / F.lit(width)).cast("long")
    mine = lambda n, own: F.struct(n.alias("stretch"), F.lit(own).alias("own"))
    in_ = F.when(at.isNull(), F.array(mine(at, True))).otherwise(F.array(mine(at, True), mine(at + 1, False)))
    # a call of the stretch before stands where it leaves the window; of the rows behind a call there are then its own stretch's later calls
    # and the earlier one's that are still in the window, so both frames only grow
    place = F.when(F.col("__in.own"), F.col(us)).otherwise(F.col(us) + width)
    every = Window.partitionBy(key, "__in.stretch")
    behind = every.orderBy(F.col("__place").desc()).rangeBetween(Window.unboundedPreceding, -1)
    own, mine_at = F.col("__in.own"), F.when(F.col("__in.own"), F.col(us))
    calls = F.when(F.col(us).isNull(), F.col("__all")).otherwise(F.col("__all") - F.col("__later") + F.col("__held"))
    out = rows.withColumn("__in", F.explode(in_)).withColumn("__place", place)
    out = out.withColumn("__all", F.count_if(own).over(every)).withColumn("__first", F.min(mine_at).over(every))
    out = out.withColumn("__later", F.count_if(own).over(behind)).withColumn("__held", F.count_if(~own).over(behind))
    out = out.withColumn("__before", F.min(F.when(~own, F.col(us))).over(behind)).where("__in.own")
    out = out.withColumn("calls", calls).withColumn("oldest", F.coalesce("__before", "__first"))
    full = F.col("calls") - 1 >= limit
    wait = F.when(full, F.col("oldest") + width - F.col(us)).otherwise(0).cast("long")
    return out.select(*rows.columns, "calls", full.alias("limited"), wait.alias("wait_us"))


def admitted(rows: DataFrame, key: str, us: str, tie: str, seconds: int, limit: int) -> DataFrame:
    """rows with `admitted`: whether a limiter lets a call through that admits at most `limit` in any (t - w, t] of a key. Only admitted
    calls fill the window, so each answer follows from those before, in order of us and tie. Calls without a time have none.

    A call that has no other in its window begins anew: there a key's calls are cut into stretches, counted from range to range.
    In a stretch where no window holds more than the limit all calls are admitted. The others are walked through, each in one
    task, which keeps the last `limit` admitted times alone; a key that never pauses for the window's length and goes over
    the limit is one stretch, since its answers depend on each other."""
    calls = trailing_rate(rows.where(F.col(us).isNotNull()), key, us, seconds, limit).drop("limited", "wait_us").withColumnRenamed("calls", "__calls")
    cut = running_sum(calls, [key], [us, tie], (F.col("__calls") == 1).cast("int"), "__cut")
    busy = cut.groupBy(F.col(key).alias("__key"), F.col("__cut").alias("__at")).agg((F.max("__calls") > limit).alias("__busy"))
    both = written(cut.join(busy, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__cut") == F.col("__at"))).select(*rows.columns, "__cut", "__busy"), "calls")
    free = both.where(~F.col("__busy")).select(*rows.columns, F.lit(True).alias("admitted"))
    width = seconds * 1_000_000

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, deque()
        for part in parts:
            out = []
            for k, at, t in zip(part[key].tolist(), part["__cut"].tolist(), part[us].tolist(), strict=True):
                if (k, at) != last:
                    last, held = (k, at), deque()
                while held and held[0] <= t - width:
                    held.popleft()
                out.append(len(held) < limit)
                if out[-1]:
                    held.append(t)
            yield part.drop(columns=["__cut"]).assign(admitted=out)

    schema = StructType([*rows.schema.fields]).add("admitted", "boolean")
    walked = both.where("__busy").drop("__busy").repartition(key, "__cut").sortWithinPartitions(key, "__cut", us, tie).mapInPandas(walk, schema)
    return free.union(walked).union(rows.where(F.col(us).isNull()).withColumn("admitted", F.lit(None).cast("boolean")))


def batches(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Fixed-size batches in order."""
    return numbered(rows, [], order, "__n").select(*rows.columns, F.floor((F.col("__n") - 1) / size).alias("batch"))
