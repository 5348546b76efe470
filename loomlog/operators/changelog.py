"""Change logs: compaction to the current rows, drift between two tables, adjacency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.plans.folders import shared_folder


def last_wins(df: DataFrame, key: list[str], order: list[str], tombstone: Column | None = None) -> DataFrame:
    """The last row of each key, unless it is a tombstone. A partial aggregate, not a window: no key's
    rows are brought together before they are reduced."""
    rest = [c for c in df.columns if c not in key]
    rows = df.withColumn("_gone", F.lit(False) if tombstone is None else F.coalesce(tombstone, F.lit(False)))
    top = rows.groupBy(*key).agg(F.max_by(F.struct(*rest, "_gone"), F.struct(*order)).alias("_r"))
    return top.where("NOT _r._gone").select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def repeated(df: DataFrame, key: list[str], least: int = 2, out: str = "n") -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) >= least)


def drift(expected: DataFrame, actual: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Keys whose sides differ: status missing (expected alone), stale (actual alone) or changed, with
    the differing fields, comma-joined."""
    e, a = expected.select(*key, *fields, F.lit(True).alias("_e")).alias("e"), actual.select(*key, *fields, F.lit(True).alias("_a")).alias("a")
    on = reduce(lambda x, y: x & y, [F.col(f"e.{k}") == F.col(f"a.{k}") for k in key])
    x = e.join(a, on, "full")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"e.{f}").eqNullSafe(F.col(f"a.{f}")), F.lit(f)) for f in fields]))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "stale").when(F.size(changed) > 0, "changed")
    keys = [F.coalesce(F.col(f"e.{k}"), F.col(f"a.{k}")).alias(k) for k in key]
    return x.withColumn("status", status).where("status is not null").select(*keys, "status", F.when(F.col("status") == "changed", F.array_join(changed, ",")).otherwise("").alias("fields"))


def drift_json(found: DataFrame, key: list[str]) -> DataFrame:
    """One row: the drift as a JSON object of lists by status, each in order of its keys."""
    one = F.struct(*key, "fields")
    lists = {s: F.coalesce(F.array_sort(F.collect_list(F.when(F.col("status") == s, one))), F.array()) for s in ("missing", "stale", "changed")}
    return found.agg(F.to_json(F.struct(*[c.alias(s) for s, c in lists.items()])).alias("json"))


def packages_drift(locked: DataFrame, deployed: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Packages (name, version) whose deployed version differs, is missing or is not locked."""
    x = locked.select("name", F.col("version").alias("locked")).join(deployed.select("name", F.col("version").alias("deployed")), "name", "full")
    status = F.when(F.col("deployed").isNull(), "missing").when(F.col("locked").isNull(), "unlocked").when(F.col("locked") != F.col("deployed"), "mismatched")
    return x.withColumn("status", status).where(F.col("status").isNotNull() & ~F.col("name").isin(*ignore))


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Names reachable from roots over edges (name, needs), the roots included; cycles end, as a name is
    followed once. Each round ends in a checkpoint in the shared folder."""
    shared_folder(edges.sparkSession)
    found = front = roots.select("name").where("name is not null").distinct().checkpoint()
    while not front.isEmpty():
        front = front.join(edges, "name").select(F.col("needs").alias("name")).where("name is not null").distinct().join(found, "name", "left_anti").checkpoint()
        found = found.unionByName(front)
    return found


def adjacent_days(df: DataFrame, key: str, day: str, id_col: str) -> DataFrame:
    """Pairs of rows of one key on consecutive days, by an equi-join on key and day."""
    a = df.select(key, F.col(id_col).alias("left_id"), F.date_add(day, 1).alias("_d"))
    b = df.select(key, F.col(id_col).alias("right_id"), F.col(day).cast("date").alias("_d"))
    return a.join(b, [key, "_d"]).select(key, "left_id", "right_id")


def current_block(blocks: DataFrame) -> DataFrame:
    """For each session its last final block, else its last."""
    rest = [c for c in blocks.columns if c != "session_id"]
    top = blocks.groupBy("session_id").agg(F.max_by(F.struct(*rest), F.struct((F.col("provisional") == "").alias("f"), F.col("block_ord"))).alias("r"))
    return top.select("session_id", *[F.col(f"r.{c}").alias(c) for c in rest])


def supersede(blocks: DataFrame, new: DataFrame) -> DataFrame:
    """A new block takes its session's first slot and the others go; a stand-in replaces no final
    one. new: one row for each session, with the columns of blocks but for block_ord."""
    old = blocks.groupBy("file", "session_id").agg(F.min("block_ord").alias("block_ord"), F.max((F.col("provisional") == "").cast("int")).alias("_final"))
    put = new.join(old, ["file", "session_id"], "left").where((F.col("provisional") == "") | (F.coalesce("_final", F.lit(0)) == 0)).drop("_final")
    kept = blocks.join(put.select("file", "session_id"), ["file", "session_id"], "left_anti")
    return kept.unionByName(put)
