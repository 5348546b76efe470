"""Lost summaries: stand-ins, what has superseded them, and what a recovery may reset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.operators.digest import PLACEHOLDER, SUPPRESSED


def kind_of(body: Column) -> Column:
    """placeholder, suppressed, or null for a real summary."""
    return F.when(F.contains(body, F.lit(PLACEHOLDER)), "placeholder").when(F.contains(body, F.lit(SUPPRESSED)), "suppressed")


def superseded(found: DataFrame, blocks: DataFrame, done: DataFrame) -> DataFrame:
    """Stand-ins whose turn is recorded as written and whose transcript has a real block somewhere: both,
    as either alone also holds for summaries that were lost."""
    covered = blocks.where(kind_of(F.col("body")).isNull()).select("transcript_path").distinct()
    return found.join(covered, "transcript_path", "left_semi").join(done.select("turn_uuid"), "turn_uuid", "left_semi")


def usable(logs: DataFrame, parsed: str = "parsed", session: str = "session_id") -> DataFrame:
    """Sessions whose log is there and can be read."""
    return logs.where(F.coalesce(F.col(parsed), F.lit(False))).select(session).distinct()


def plan(blocks: DataFrame, done: DataFrame, state: DataFrame, logs: DataFrame) -> DataFrame:
    """(transcript_path, turn_uuid, session_id, kind, action) of every stand-in: superseded, missing where
    the state doesn't know its transcript, no-log where nothing could be summarised, else reset."""
    found = blocks.withColumn("kind", kind_of(F.col("body"))).where("kind is not null").select("transcript_path", "turn_uuid", "session_id", "kind")
    over = superseded(found, blocks, done).select("transcript_path", "turn_uuid", F.lit(True).alias("over")).distinct()
    known = state.select(F.col("path").alias("transcript_path"), F.lit(True).alias("known")).distinct()
    x = found.join(over, ["transcript_path", "turn_uuid"], "left").join(known, "transcript_path", "left").join(usable(logs).withColumn("log", F.lit(True)), "session_id", "left")
    action = F.when(F.col("over"), "superseded").when(F.col("known").isNull(), "missing").when(F.col("log").isNull(), "no-log").otherwise("reset")
    return x.select("transcript_path", "turn_uuid", "session_id", "kind", action.alias("action"))


def totals(planned: DataFrame) -> DataFrame:
    """One row: blocks, each kind, each action, and the exit code: 0 for nothing left to do, 1 for stand-ins
    that a recovery resets, 3 where some are beyond it."""
    kinds = [F.count_if(F.col("kind") == k).alias(k) for k in ("placeholder", "suppressed")]
    actions = [F.count_if(F.col("action") == a).alias(a.replace("-", "_")) for a in ("superseded", "missing", "no-log", "reset")]
    x = planned.agg(F.count(F.lit(1)).alias("blocks"), *kinds, *actions)
    return x.withColumn("exit", F.when((F.col("missing") > 0) | (F.col("no_log") > 0), 3).when(F.col("reset") > 0, 1).otherwise(0))


def backfill(blocks: DataFrame, recorded: DataFrame, logs: DataFrame) -> DataFrame:
    """Blocks to add to the run record: not recorded by (session_id, turn_uuid), each once, with a log."""
    key = ["session_id", "turn_uuid"]
    return blocks.dropDuplicates(key).join(recorded.select(*key), key, "left_anti").join(usable(logs), "session_id", "left_semi")


def render_mode(provisional: Column, body: Column) -> Column:
    """How a block was made, from what is on disk: its anchor, and a marker on a line of its own."""
    return F.when(provisional == "pending", "pending").when(body.rlike(r"(?m)^<!-- verbatim -->$"), "verbatim").otherwise("llm")


def answered(mode: Column, summarized: Column, suppressed: Column, placeholder: Column) -> Column:
    """Whether the provider answered: modes without a call say nothing."""
    any_ = F.coalesce(summarized, F.lit(False)) | F.coalesce(suppressed, F.lit(False)) | F.coalesce(placeholder, F.lit(False))
    return F.coalesce(mode.isin("llm", "verbatim-fallback-llm"), F.lit(False)) & any_


def headless(entrypoint: Column, agent: Column, entrypoints: list[str], agents: list[str]) -> Column:
    """Whether a session is summarised without a model: its entry point is listed, and its agent is, if
    any agent is."""
    return entrypoint.isin(*entrypoints) & (F.lit(not agents) | agent.isin(*agents))
