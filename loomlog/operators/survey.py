"""Surveys and probes over a corpus of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomlog.operators.trend import interpolated


def with_logs(blocks: DataFrame, logs: DataFrame, key: str) -> DataFrame:
    """Blocks with their logs; has_log says whether there is one."""
    return blocks.join(logs.withColumn("_log", F.lit(True)), key, "left").withColumn("has_log", F.coalesce("_log", F.lit(False))).drop("_log")


def grains(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts in all, by outer and by both; nulls of the data stay apart from totals by grain."""
    return df.rollup(outer, inner).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("grain"))


def sampled(df: DataFrame, group: str, item: str, seed: str, n: int, salts: int = 64) -> DataFrame:
    """n items of each group in the order of a digest: the same at every run and size. The first n of
    each of `salts` parts of a group are found first, so that no group is sorted in one task."""
    x = df.withColumn("_o", F.sha2(F.concat_ws("|", F.col(item).cast("string"), F.col(group).cast("string"), F.lit(seed)), 256))
    x = x.withColumn("_s", F.pmod(F.xxhash64("_o"), F.lit(salts)))
    x = x.withColumn("_n", F.row_number().over(Window.partitionBy(group, "_s").orderBy("_o", item))).where(F.col("_n") <= n)
    return x.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy("_o", item))).where(F.col("_n") <= n).drop("_n", "_o", "_s")


def field_survey(df: DataFrame, fields: list[str], floor: float) -> DataFrame:
    """For each denominator: n, max, p99, median, how many are over the floor."""
    long = df.select(F.explode(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("double"))])).alias("field", "value"))
    n = long.groupBy("field").agg(F.count("value").alias("n"), F.max("value").alias("max"), F.count_if(F.col("value") > floor).alias("over"))
    for name, q in (("p99", 0.99), ("median", 0.5)):
        n = n.join(interpolated(long, ["field"], "value", q, name), "field", "left")
    return n.select("field", "n", "max", "p99", "median", "over")


def foreign_probe(claims: DataFrame, corpora: DataFrame, n: int, seed: str, grounded) -> DataFrame:
    """How often claims sampled from other sessions are grounded in a session's text. claims:
    (session_id, claim), corpora: (session_id, corpus); grounded(claim, corpus) -> Column. The pool is
    the distinct claims of all sessions on a ring in the order of a digest; each corpus meets the
    first n from its own hashed place on that are not its session's, or all others if they are fewer."""
    ring = claims.select("claim").where("claim is not null").distinct().withColumn("h", F.sha2(F.concat_ws("|", "claim", F.lit(seed)), 256)).withColumn("part", F.substring("h", 1, 3))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over 4096 counts at most
    parts = ring.groupBy("part").agg(F.count(F.lit(1)).alias("c")).withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    own_rank = F.row_number().over(Window.partitionBy("part").orderBy("h", "claim"))
    ranked = ring.join(F.broadcast(parts), "part").select("claim", (F.col("before") + own_rank - 1).alias("rank"))
    size = ring.agg(F.count(F.lit(1)).alias("size"))
    own = claims.where("claim is not null").groupBy("session_id").agg(F.countDistinct("claim").alias("own"))
    start = F.conv(F.substring(F.sha2(F.concat_ws("|", "session_id", F.lit(seed)), 256), 1, 15), 16, 10).cast("long") % F.col("size")
    asks = corpora.select("session_id").distinct().join(own, "session_id", "left").join(F.broadcast(size)).where("size > 0")
    steps = F.sequence(F.lit(0), F.least(F.coalesce("own", F.lit(0)) + n, F.col("size")).cast("int") - 1)
    asks = asks.withColumn("start", start).withColumn("k", F.explode(steps)).withColumn("rank", (F.col("start") + F.col("k")) % F.col("size"))
    pairs = asks.join(ranked, "rank").select("session_id", "claim", "k").join(claims, ["session_id", "claim"], "left_anti")
    pairs = pairs.withColumn("_n", F.row_number().over(Window.partitionBy("session_id").orderBy("k"))).where(F.col("_n") <= n)
    x = pairs.join(corpora, "session_id").withColumn("hit", grounded(F.col("claim"), F.col("corpus")))
    return x.groupBy("session_id").agg(F.count(F.lit(1)).alias("asked"), F.count_if("hit").alias("grounded"))


def trim_probe(spans: DataFrame, lengths: tuple[int, ...] = (0, 3, 4, 5, 6, 8, 10, 12)) -> DataFrame:
    """How many spans (span, corpus) would be grounded without the signs around them, for each least
    length of what is left."""
    bare = F.regexp_replace("span", r"^[\p{Punct}\s]+|[\p{Punct}\s]+$", "")
    x = spans.withColumn("bare", bare).withColumn("least", F.explode(F.array(*map(F.lit, lengths))))
    hit = (F.length("bare") >= F.col("least")) & (F.col("bare") != "") & F.contains("corpus", F.col("bare"))
    return x.groupBy("least").agg(F.count(F.lit(1)).alias("spans"), F.count_if(hit).alias("grounded"))
