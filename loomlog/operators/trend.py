"""Quality trends: windows, groups, percentiles, category counts, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.functions.text import ratio


def in_window(ts: Column, start: str, end: str) -> Column:
    """Half-open; a null time is in no window."""
    return (ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp"))


def window_index(ts: Column, anchor: str, days: int) -> Column:
    """Equal windows of days before an anchor: 0 for the last one, null after it."""
    back = (F.unix_timestamp(F.lit(anchor).cast("timestamp")) - F.unix_timestamp(ts) - 1) / (86400 * days)
    return F.when(ts < F.lit(anchor).cast("timestamp"), F.floor(back).cast("long"))


def model_written(mode: Column) -> Column:
    return F.coalesce(F.nullif(mode, F.lit("")), F.lit("llm")).isin("llm", "verbatim-fallback-llm")


def pass_stats(passed: Column, value: Column) -> list[Column]:
    """Graded, passed, rate and mean to four places; rate and mean null where nothing is graded."""
    graded = F.count(passed)
    good = F.count_if(passed)
    return [graded.alias("graded"), good.alias("passed"), ratio(good, graded).alias("rate"), F.bround(F.avg(value), 4).alias("mean_value")]


def order_statistics(df: DataFrame, group: list[str], value: str, ranks: dict[str, Column], cuts: int = 64) -> DataFrame:
    """The exact values at ranks from 1 on (columns over n, the group's values), by group. Approximate
    quantiles cut each group into parts; only the parts that hold a rank are counted value by value, so
    that no task sorts a whole group. Null values count as none; a group of nulls alone has no row."""
    x = df.where(F.col(value).isNotNull()).select(F.struct(*group).alias("g"), F.col(value).alias("v"))
    probs = [k / cuts for k in range(1, cuts)]
    edges = x.groupBy("g").agg(F.percentile_approx("v", probs, 1000).alias("edges"), F.count(F.lit(1)).alias("n"))
    wide = edges.count() > 50_000
    x = x.join(edges.select("g", "edges") if wide else F.broadcast(edges.select("g", "edges")), "g")  # 8 * cuts bytes a group
    x = x.select("g", "v", F.size(F.filter("edges", lambda e: e < F.col("v"))).alias("part"))
    sizes = x.groupBy("g", "part").agg(F.count(F.lit(1)).alias("m"))
    sizes = sizes.withColumn("upto", F.sum("m").over(Window.partitionBy("g").orderBy("part")))  # cuts rows a group at most
    asked = edges.select("g", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), r.cast("long").alias("rank")) for k, r in ranks.items()])).alias("a")).select("g", "a.*")
    asked = asked.join(sizes, "g").where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("m"))).select("g", "part", "name", (F.col("rank") - F.col("upto") + F.col("m")).alias("rank"))
    parts = asked.select("g", "part").distinct()
    values = x.join(parts, ["g", "part"], "left_semi").groupBy("g", "part", "v").agg(F.count(F.lit(1)).alias("m"))
    values = values.withColumn("upto", F.sum("m").over(Window.partitionBy("g", "part").orderBy("v")))
    found = asked.join(values, ["g", "part"]).where(F.col("upto") >= F.col("rank")).groupBy("g").agg(*[F.min(F.when(F.col("name") == k, F.col("v"))).alias(k) for k in ranks])
    return found.select("g.*", *ranks)


def nearest_rank(q: float) -> Column:
    """The rank of the smallest value that at least the share q of n values do not exceed."""
    return F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("n")))


def upper_median_rank() -> Column:
    return F.floor(F.col("n") / 2) + 1


def interpolated(df: DataFrame, group: list[str], value: str, q: float, out: str) -> DataFrame:
    """(group..., out): the quantile linear between ranks, cut to a whole number."""
    at = F.lit(q) * (F.col("n") - 1)
    x = order_statistics(df, group, value, {"_lo": F.floor(at) + 1, "_hi": F.ceil(at) + 1})
    n = df.where(F.col(value).isNotNull()).groupBy(F.struct(*group).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    x = x.withColumn("g", F.struct(*group)).join(n, "g")
    lo, hi, part = F.col("_lo").cast("double"), F.col("_hi").cast("double"), at - F.floor(at)
    return x.select(*group, F.when(part == 0, lo).otherwise((1 - part) * lo + part * hi).cast("long").alias(out))


def category(value: Column, default: str = "unrecorded") -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def merge_maps(df: DataFrame, map_col: str) -> DataFrame:
    """Sums of the maps' values by key, the largest first, then by key."""
    return df.select(F.explode(map_col).alias("key", "n")).groupBy("key").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "key")


def group_order(*cols: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cols]


def new_values(current: Column, previous: Column) -> Column:
    return F.array_sort(F.array_except(current, previous))


def other_modes(modes: Column, usual: str = "llm") -> Column:
    """Render modes besides the usual one, in order; empty where there is none."""
    return F.array_sort(F.array_except(modes, F.array(F.lit(usual))))


def absent_count(by_kind: Column) -> Column:
    """Sum of `absent` over a map of maps."""
    return F.aggregate(F.map_values(by_kind), F.lit(0).cast("long"), lambda acc, m: acc + F.coalesce(F.try_element_at(m, F.lit("absent")), F.lit(0)))


def verdict(graded: Column, rate: Column, previous_graded: Column, previous_rate: Column, least: int, floor: float, drop: float) -> Column:
    """0 good; 1 under the floor or fallen by more than the drop; 3 where there is too little to say."""
    compared = F.coalesce(previous_graded >= least, F.lit(False))
    return (
        F.when(F.coalesce(graded < least, F.lit(True)), 3).when(rate < floor, 1).when(compared & (F.bround(previous_rate - rate, 4) > drop), 1).when(~compared, 3).otherwise(0)
    )


def breaches(rate: Column, previous_rate: Column, floor: float, drop: float) -> Column:
    return F.array_compact(F.array(F.when(rate < floor, "floor"), F.when(F.bround(previous_rate - rate, 4) > drop, "drop")))


def corrupt(bad: Column, total: Column) -> Column:
    """More than one bad line and more than one in a hundred."""
    return (bad > 1) & (bad * 100 > total)


def sweep_totals(df: DataFrame, flags: list[str], sums: list[str], passed: str, value: str) -> DataFrame:
    """One row of a sweep: how many sessions, how many have each flag, sums, the pass rate and the
    mean; the last two are null where nothing was graded."""
    return df.agg(F.count(F.lit(1)).alias("sessions"), *[F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], *pass_stats(F.col(passed), F.col(value)))


def findings_by(df: DataFrame, key: str, cols: list[str], keep: int = 20) -> DataFrame:
    """Counts of a record's findings by each column, as maps, and its first claims in order."""
    out = None
    for c in cols:
        m = df.groupBy(key, c).agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(f"by_{c}"))
        out = m if out is None else out.join(m, key)
    top = df.groupBy(key).agg(F.slice(F.array_sort(F.collect_set("claim")), 1, keep).alias("claims"))
    return out.join(top, key)
