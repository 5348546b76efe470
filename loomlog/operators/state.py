"""Per-session state: readiness, idempotent progress, retries, upserts, orphans."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ATTEMPTS = 3


def has_unread(size: Column, offset: Column) -> Column:
    return size > offset


def is_retryable(status: Column, attempts: Column) -> Column:
    return (status == "provisional") & (attempts < MAX_ATTEMPTS)


def ready(found: DataFrame, state: DataFrame, quiet_seconds: int, key: str = "path") -> DataFrame:
    """Files idle for the quiet period with unread bytes or a summary to retry."""
    x = found.join(state, key, "left")
    unread = has_unread(F.col("size_bytes"), F.coalesce("last_offset", F.lit(0)))
    return x.where((F.col("idle_seconds") >= quiet_seconds) & (unread | F.coalesce(is_retryable(F.col("status"), F.col("attempts")), F.lit(False))))


def status_after(idle: Column, quiet_seconds: int, status: Column, grown: Column) -> Column:
    """active while written to, complete once idle, and what it was where nothing is new."""
    return F.when(idle < quiet_seconds, "active").when(grown | status.isNull() | (status == "active"), "complete").otherwise(status)


def upsert(state: DataFrame, new: DataFrame, key: str, texts: list[str], offsets: list[str]) -> DataFrame:
    """Merges rows by key: texts keep their old value where the new one is empty, offsets never fall,
    other columns take the new value."""
    rest = [c for c in state.columns if c not in (key, *texts, *offsets)]
    s, n = state.alias("s"), new.alias("n")
    cols = [F.coalesce(F.col(f"n.{key}"), F.col(f"s.{key}")).alias(key)]
    cols += [F.coalesce(F.nullif(F.col(f"n.{c}"), F.lit("")), F.col(f"s.{c}")).alias(c) for c in texts]
    cols += [F.greatest(F.col(f"s.{c}"), F.col(f"n.{c}")).alias(c) for c in offsets]
    cols += [F.coalesce(F.col(f"n.{c}"), F.col(f"s.{c}")).alias(c) for c in rest]
    return s.join(n, F.col(f"s.{key}") == F.col(f"n.{key}"), "full").select(*cols)


def unprocessed(turns: DataFrame, done: DataFrame, key: str | list[str] = "turn_uuid") -> DataFrame:
    return turns.join(done.select(key), key, "left_anti")


def insert_new(done: DataFrame, turns: DataFrame, key: str = "turn_uuid") -> DataFrame:
    """Rows to append: turns not recorded yet, one for each key."""
    return unprocessed(turns.dropDuplicates([key]), done, key)


def orphaned(state: DataFrame, files: DataFrame, logs: DataFrame, path: str = "path", session: str = "session_id") -> DataFrame:
    """Sessions whose transcript is gone but whose event log is there."""
    return state.join(files.select(path), path, "left_anti").join(logs.select(session), session, "left_semi")


def lookup(state: DataFrame, session: str) -> DataFrame:
    """A session by id or by the end of its path, the exact id first, then the newest."""
    exact = F.col("session_id") == session
    return state.where(exact | F.col("path").endswith(f"/{session}.jsonl")).orderBy(F.coalesce(exact, F.lit(False)).desc(), F.desc("updated_at"))


def by_status(state: DataFrame, status: str) -> DataFrame:
    return state.where(F.col("status") == status).orderBy("updated_at")


def as_provisional(state: DataFrame, hit: Column, offset: Column) -> DataFrame:
    """The offset advances, no turn is recorded, and an attempt is counted."""
    return (
        state.withColumn("last_offset", F.when(hit, F.greatest("last_offset", offset)).otherwise(F.col("last_offset")))
        .withColumn("attempts", F.when(hit, F.col("attempts") + 1).otherwise(F.col("attempts"))).withColumn("status", F.when(hit, "provisional").otherwise(F.col("status")))
    )


def as_summarised(state: DataFrame, hit: Column, offset: Column) -> DataFrame:
    return (
        state.withColumn("last_offset", F.when(hit, F.greatest("last_offset", offset)).otherwise(F.col("last_offset")))
        .withColumn("attempts", F.when(hit, F.lit(0)).otherwise(F.col("attempts"))).withColumn("status", F.when(hit, "summarized").otherwise(F.col("status")))
    )


def reset(state: DataFrame, done: DataFrame, hit: Column) -> tuple[DataFrame, DataFrame]:
    """Offsets and attempts from anew, and the turns of those sessions forgotten."""
    gone = state.where(hit).select(F.col("path").alias("transcript_path"))
    fresh = [F.when(hit, F.lit(0)).otherwise(F.col(c)).cast(state.schema[c].dataType).alias(c) if c in ("last_offset", "attempts") else F.when(hit, "complete").otherwise(F.col(c)).alias(c) if c == "status" else F.col(c) for c in state.columns]
    return state.select(*fresh), done.join(gone, "transcript_path", "left_anti")


def forget(state: DataFrame, done: DataFrame, hit: Column) -> tuple[DataFrame, DataFrame]:
    gone = state.where(hit).select(F.col("path").alias("transcript_path"))
    return state.where(~F.coalesce(hit, F.lit(False))), done.join(gone, "transcript_path", "left_anti")


def migrated(state: DataFrame) -> DataFrame:
    """Fills empty session ids from a safe file name; others stay."""
    name = F.nullif(F.regexp_extract("path", r"([A-Za-z0-9][A-Za-z0-9_-]{0,127})\.jsonl$", 1), F.lit(""))
    return state.withColumn("session_id", F.coalesce(F.nullif("session_id", F.lit("")), name, F.lit("")))


def sweep_identity(totals: DataFrame) -> DataFrame:
    """Adds consistent: every written block is of one kind, and none is discarded."""
    return totals.withColumn("consistent", (F.col("written") == F.col("summarized") + F.col("suppressed") + F.col("placeholder") + F.col("pending")) & (F.col("discarded") == 0))


def sweep(rows: Iterable, attempt: Callable, deferred: Callable, answered: Callable, not_attempted) -> list:
    """Results of a sweep in order, with the circuit breaker. attempt(row, allow_defer) handles a row;
    deferred(result) says that the provider was down, answered(result) that it was there. The first
    deferral makes its row a suspect: an answer later clears it and runs it again, without leave to
    defer; a second deferral trips the breaker, and later rows give not_attempted(row). Steers the
    driver's loop over batches; no table passes through it."""
    results, suspect, tripped = [], None, False
    for row in rows:
        if tripped:
            results.append(not_attempted(row))
            continue
        result = attempt(row, True)
        results.append(result)
        if deferred(result):
            tripped = suspect is not None
            suspect = suspect or (len(results) - 1, row)
        elif answered(result) and suspect:
            results[suspect[0]], suspect = attempt(suspect[1], False), None
    up = any(answered(r) for r in results)
    if suspect and up and not tripped:
        results[suspect[0]] = attempt(suspect[1], False)
    return results


def breaker(outcomes: list[str]) -> list[str]:
    """sweep() over logged outcomes: what becomes of each, where a re-run suspect counts as ok."""
    return sweep(outcomes, lambda x, may: x if may else "ok", lambda x: x == "deferred", lambda x: x == "ok", lambda x: "not_attempted")


def set_status(state: DataFrame, hit: Column, status: str, error: Column | None = None) -> DataFrame:
    """Status and error of the hit rows, unconditionally."""
    out = state.withColumn("status", F.when(hit, status).otherwise(F.col("status")))
    return out if error is None else out.withColumn("error", F.when(hit, error).otherwise(F.col("error")))


def count_attempt(state: DataFrame, hit: Column) -> DataFrame:
    return state.withColumn("attempts", F.when(hit, F.col("attempts") + 1).otherwise(F.col("attempts")))


def apply_outcomes(state: DataFrame, outcomes: DataFrame) -> DataFrame:
    """State after a batch of outcomes (path, outcome, offset): summarised and provisional rows move on,
    pending ones count as summarised, and deferred ones are as if they had never been tried."""
    x = state.join(outcomes.where("outcome <> 'deferred'"), "path", "left")
    x = as_summarised(x, F.coalesce(F.col("outcome").isin("summarized", "pending"), F.lit(False)), F.col("offset"))
    return as_provisional(x, F.coalesce(F.col("outcome") == "provisional", F.lit(False)), F.col("offset")).drop("outcome", "offset")


def swept(ready_rows: DataFrame, orphans: DataFrame, limit: int | None = None, order: str = "path") -> DataFrame:
    """What a sweep takes: scanned rows, then orphans, which share none with them; limit keeps the first."""
    x = ready_rows.withColumn("_part", F.lit(0)).unionByName(orphans.withColumn("_part", F.lit(1)), allowMissingColumns=True).orderBy("_part", order).drop("_part")
    return x if limit is None else x.limit(limit)
