"""Sessions: turns, tool pairing, subagents, rollups, counters and the size ladder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Tool tables, argument keys in order of preference, prefixes of injected texts.
TOOLS = [
    ("Read", "file_read", "file_path"), ("NotebookRead", "file_read", "notebook_path"), ("Write", "file_write", "file_path"), ("Edit", "file_write", "file_path"),
    ("MultiEdit", "file_write", "file_path"), ("NotebookEdit", "file_write", "notebook_path"), ("Glob", "search", "pattern"), ("Grep", "search", "pattern"),
    ("ToolSearch", "search", "query"), ("WebFetch", "web", "url"), ("WebSearch", "web", "query"), ("Task", "agent", "description"), ("Agent", "agent", "description"),
    ("Skill", "agent", "skill"), ("Bash", "bash", "command"),
]
MCP_KEYS = "command repo repo_path path file file_path task_id room_name query url branch pr_number project_id name".split()
INJECTED = ["Base directory for this skill:", "<command-name>", "<command-message>", "<command-args>"]
ROLLUP_CAP = 200
LADDER = (200, 80)


def segment_turns(df: DataFrame, session: str, order: list[str], opens: Column, out: str = "turn_ix") -> DataFrame:
    """Numbers turns from 0 by a running count of the rows that open one; what comes before the first
    is in the synthetic turn 0 with it. Null `opens` opens none."""
    w = Window.partitionBy(session).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.greatest(F.sum(F.coalesce(opens, F.lit(False)).cast("long")).over(w) - 1, F.lit(0)).cast("long"))


def sequence(df: DataFrame, session: str, order: list[str], out: str = "seq") -> DataFrame:
    return df.withColumn(out, (F.row_number().over(Window.partitionBy(session).orderBy(*order)) - 1).cast("long"))


def disposition(kind: Column, meta: Column, compact: Column, text: Column) -> Column:
    """Why a record is skipped, or keep."""
    injected = reduce(lambda a, b: a | b, [F.ltrim(text).startswith(p) for p in INJECTED])
    return F.when(~kind.isin("user", "assistant"), "other").when(meta, "meta").when(compact, "compact").when((kind == "user") & injected, "injected").otherwise("keep")


def from_harness(origin_kind: Column, command_mode: Column) -> Column:
    return F.coalesce(origin_kind == "task-notification", F.lit(False)) | F.coalesce(command_mode == "task-notification", F.lit(False))


def classify_tool(tool: Column, args: Column) -> Column:
    """struct<kind, target> of a tool call whose arguments are a map of texts."""
    def found(key: str) -> Column:
        return F.nullif(F.try_element_at(args, F.lit(key)), F.lit(""))

    kind, target = F.when(tool.startswith("mcp__"), F.lit("mcp")).otherwise("other"), F.when(tool.startswith("mcp__"), F.coalesce(*map(found, MCP_KEYS)))
    for name, k, key in TOOLS:
        kind, target = F.when(tool == name, k).otherwise(kind), F.when(tool == name, found(key)).otherwise(target)
    return F.struct(kind.alias("kind"), F.coalesce(target, F.lit("")).alias("target"))


def args_summary(raw: Column, skip: Column) -> Column:
    """`k=v` of a JSON object in its own order, without the skipped key and empty values."""
    pairs = F.map_entries(F.from_json(raw, "map<string,string>"))
    return F.array_join(F.transform(F.filter(pairs, lambda p: (p["key"] != skip) & (p["value"] != "")), lambda p: F.concat_ws("=", p["key"], p["value"])), " ")


def result_text(text: Column, stdout: Column, stderr: Column) -> Column:
    def part(name: str, x: Column) -> Column:
        return F.when(F.coalesce(x, F.lit("")) != "", F.concat(F.lit(f"[{name}] "), x))

    return F.concat_ws("\n", F.nullif(text, F.lit("")), part("stdout", stdout), part("stderr", stderr))


def first_filled(col: str, order: str) -> Column:
    return F.min_by(F.when(F.col(col) != "", F.col(col)), F.when(F.col(col) != "", F.col(order)))


def pair_results(df: DataFrame, session: list[str], order: list[str], is_use: Column, is_result: Column) -> DataFrame:
    """Pairs each use with the first result after it and before the next use of the same key. Adds
    role (use, result), pair (the use's number in its key, null for an orphan result) and paired."""
    by = Window.partitionBy(*session).orderBy(*order)
    df = df.withColumn("role", F.when(is_use, "use").when(is_result, "result")).where("role is not null")
    df = df.withColumn("_open", F.sum((F.col("role") == "use").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy(*session, "_open")
    df = df.withColumn("_nth", F.row_number().over(within.orderBy((F.col("role") == "use").desc(), *order)))
    df = df.withColumn("_n", F.count(F.lit(1)).over(within))
    matched = (F.col("_open") > 0) & (F.col("_nth") <= 2)
    df = df.withColumn("paired", matched & (F.col("_n") >= 2)).withColumn("pair", F.when(matched, F.col("_open")))
    return df.drop("_open", "_nth", "_n")


def ordered_distinct(value: Column, order: Column, cap: int | None = ROLLUP_CAP) -> Column:
    """Distinct non-empty values of a group in first-seen order. Sorts first appearances alone."""
    out = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(value != "", F.struct(order.alias("o"), value.alias("v"))))), lambda x: x["v"]))
    return out if cap is None else F.slice(out, 1, cap)


def first_seen(df: DataFrame, group: list[str], value: str, order: str, out: str, cap: int | None = ROLLUP_CAP) -> DataFrame:
    """ordered_distinct of each group with the duplicates gone before the lists are collected, so
    that a list is no longer than its distinct values."""
    once = df.where(F.col(value) != "").groupBy(*group, value).agg(F.min(order).alias("_o"))
    return once.groupBy(*group).agg(ordered_distinct(F.col(value), F.col("_o"), cap).alias(out))


def merged_rollup(lists: Column) -> Column:
    """Turns' lists in turn order as the session's, without the cap of a turn."""
    return F.array_distinct(F.flatten(lists))


def subagents(calls: DataFrame, results: DataFrame, notices: DataFrame, key: str = "tool_use_id") -> DataFrame:
    """Agent calls with their result's id and status, and the last notification that has a status."""
    last = notices.where(F.coalesce("status", F.lit("")) != "").groupBy(key).agg(F.max_by("status", "line_no").alias("notified"))
    out = calls.join(results.select(key, "agent_id", F.col("status").alias("result_status")), key, "left").join(last, key, "left")
    return out.withColumn("status", F.coalesce("notified", "result_status")).drop("notified", "result_status")


def background_pending(launched: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks of a session's final turn that no notification ended."""
    final = Window.partitionBy("session_id")
    return launched.withColumn("_last", F.max("turn_index").over(final)).where("turn_index = _last").drop("_last").join(done, ["session_id", "task_id"], "left_anti")


def log_exists(agents: DataFrame, listing: DataFrame) -> DataFrame:
    """Adds log_exists: null where there is no path to look for."""
    seen = listing.select(F.col("path").alias("log_path"), F.lit(True).alias("_have")).distinct()
    return agents.join(seen, "log_path", "left").withColumn("log_exists", F.when(F.col("log_path").isNotNull(), F.coalesce("_have", F.lit(False)))).drop("_have")


def degradation_level(sizes: list[Column], budget: int) -> Column:
    """The first rung whose size fits the budget, else the last."""
    out = F.lit(len(sizes) - 1)
    for k in range(len(sizes) - 2, -1, -1):
        out = F.when(sizes[k] <= budget, k).otherwise(out)
    return out


def rung(text: Column, level: Column, cleared_from: int) -> Column:
    return F.when(level >= cleared_from, "").otherwise(text)


def rung_target(target: Column, level: Column) -> Column:
    def cut(n: int) -> Column:
        return F.when(F.length(target) > n, F.concat(F.substring(target, 1, n), F.lit("…"))).otherwise(target)

    return F.when(level >= 4, cut(LADDER[1])).when(level == 3, cut(LADDER[0])).otherwise(target)


def closing_statement(turns: DataFrame, session: str, least: int = 1) -> DataFrame:
    """The last text of the final turn that has at least `least` characters, else of the turn before."""
    w = Window.partitionBy(session).orderBy(F.desc("turn_ix"))
    last = F.try_element_at(F.filter("texts", lambda t: F.trim(t) != ""), F.lit(-1))
    x = turns.withColumn("_n", F.row_number().over(w)).where("_n <= 2").withColumn("_t", last)
    own = F.max(F.when((F.col("_n") == 1) & (F.length("_t") >= least), F.col("_t")))
    return x.groupBy(session).agg(own.alias("_own"), F.max(F.when(F.col("_n") == 2, F.col("_t"))).alias("_prev")).select(
        session, F.coalesce("_own", "_prev").alias("closing"), F.when(F.col("_own").isNotNull(), "final-turn").when(F.col("_prev").isNotNull(), "previous-turn").alias("closing_source")
    )


def inactive_sessions(df: DataFrame, key: str, ts: str, order: list[str], gap_seconds: int) -> DataFrame:
    """Adds session_ix: a new session after more than the gap without an event."""
    w = Window.partitionBy(key).orderBy(ts, *order)
    new = F.coalesce((F.unix_timestamp(ts) - F.unix_timestamp(F.lag(ts).over(w))) > gap_seconds, F.lit(True))
    df = df.withColumn("_new", new.cast("long"))
    return df.withColumn("session_ix", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def count_dispositions(df: DataFrame, session: str, kinds: list[str], col: str = "disposition") -> DataFrame:
    return df.groupBy(session).agg(F.count(F.lit(1)).alias("records"), *[F.count_if(F.col(col) == k).alias(f"n_{k}") for k in kinds])


def session_document(keys: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Each key with its rows of every part, as arrays of structs; an empty array where there are none."""
    out = keys.select(key).distinct()
    for name, df in parts.items():
        rest = [c for c in df.columns if c != key]
        own = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias(name))
        out = out.join(own, key, "left").withColumn(name, F.coalesce(name, F.array().cast(own.schema[name].dataType)))
    return out


def commits(text: Column) -> Column:
    """The one commit that a command's texts name, or `ambiguous` for several; null for none."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b[0-9a-f]{7,40}\b"), F.lit(0)))
    return F.when(F.size(found) == 1, found[0]).when(F.size(found) > 1, "ambiguous")
