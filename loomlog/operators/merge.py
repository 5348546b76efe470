"""Tables of blocks under change: merges by turn, stamps, edits with their ledger, ordered writes."""

from __future__ import annotations

import subprocess
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SOURCES = ["live", "correct"]


def merge_blocks(blocks: DataFrame, new: DataFrame, key: tuple[str, ...] = ("file", "turn_uuid")) -> DataFrame:
    """Blocks after new ones came: a provisional block of the same key is replaced in its place, a final one
    stays, and a new key is appended behind its file's last. new: one row a key, without block_ord."""
    old = blocks.select(*key, "block_ord", F.col("provisional").alias("_was"))
    x = new.join(old, list(key), "left")
    replaced = x.where("_was <> ''").drop("_was")
    last = blocks.groupBy("file").agg(F.max("block_ord").alias("_top"))
    added = x.where("_was is null").drop("_was", "block_ord").join(last, "file", "left")
    nth = F.row_number().over(Window.partitionBy("file").orderBy(*[k for k in key if k != "file"]))
    added = added.withColumn("block_ord", (F.coalesce("_top", F.lit(-1)) + nth).cast(blocks.schema["block_ord"].dataType)).drop("_top")
    kept = blocks.join(replaced.select(*key), list(key), "left_anti")
    return kept.unionByName(replaced.select(blocks.columns)).unionByName(added.select(blocks.columns))


def stamp(blocks: DataFrame, kinds: DataFrame, key: tuple[str, ...] = ("file", "block_ord")) -> DataFrame:
    """Older anchors that carry no kind get the one found for their block; others stay as they are."""
    x = blocks.join(kinds.select(*key, F.col("kind").alias("_kind")), list(key), "left")
    return x.withColumn("provisional", F.when((F.col("provisional") == "") & F.col("_kind").isNotNull(), F.col("_kind")).otherwise(F.col("provisional"))).select(blocks.columns)


def turns_of(blocks: DataFrame, provisional: bool) -> DataFrame:
    """Turns with a provisional block, or with a final one."""
    return blocks.where((F.col("provisional") != "") if provisional else (F.col("provisional") == "")).select("file", "turn_uuid").distinct()


def apply_edits(blocks: DataFrame, rewritten: DataFrame, key: str = "session_id") -> DataFrame:
    """Blocks with the corrected bodies in place; their order and their number stay."""
    x = blocks.join(rewritten.select(key, F.col("rewritten").alias("_new")), key, "left")
    return x.withColumn("body", F.coalesce("_new", "body")).select(blocks.columns)


def ledger(edits: DataFrame, source: str, reason: str) -> DataFrame:
    """Correction records (session_id, line, before, after, source, reason): tokens alone, from a source
    that is known and with a reason."""
    if source not in SOURCES or not reason.strip():
        raise ValueError("a correction needs a known source and a reason")
    return edits.select("session_id", F.explode("edits").alias("e")).select("session_id", "e.line", "e.before", "e.after", F.lit(source).alias("source"), F.lit(reason).alias("reason"))


def partition_of(agent: Column, when: Column) -> Column:
    """struct<agent, date> of the file that a block belongs to; an agent that is no plain name is unknown."""
    from loomlog.functions.text import day, valid_name

    return F.struct(F.when(valid_name(agent), agent).otherwise(F.lit("unknown")).alias("agent"), day(when).alias("date"))


def after_write(batch: DataFrame, steps: list[tuple[str, Callable[[DataFrame], None]]]) -> list[str]:
    """Runs the writers of a batch in order, each after the one before it has ended; a failing one stops the
    rest, and the names of those that ended are what a retry may skip. For foreachBatch."""
    done = []
    for name, step in steps:
        try:
            step(batch)
        except Exception as e:
            raise RuntimeError(f"{name} failed after {', '.join(done) or 'nothing'}") from e
        done.append(name)
    return done


def run_hook(argv: list[str], text: str, env: dict[str, str], timeout: float = 30.0) -> tuple[str, str]:
    """Runs a program on the driver with a text on its input and only the given environment, in a process
    group of its own: (ok, failed or timeout, the end of its error output)."""
    import os
    import signal

    p = subprocess.Popen(argv, stdin=subprocess.PIPE, stdout=subprocess.DEVNULL, stderr=subprocess.PIPE, env=env, start_new_session=True)
    try:
        _, err = p.communicate(text.encode(), timeout=timeout)
    except subprocess.TimeoutExpired:
        os.killpg(p.pid, signal.SIGKILL)
        p.communicate()
        return "timeout", ""
    return ("ok" if p.returncode == 0 else "failed"), err.decode("utf-8", "replace")[-200:]


def journal(previews: DataFrame, agent: str = "agent") -> DataFrame:
    """(agent, context, payload) of journals' preview lines (agent, name, pos, line): files from the newest on,
    lines in order, as text and as the JSON that a hook hands on."""
    x = previews.groupBy(agent, "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda p: p["line"]), "\n").alias("text"))
    x = x.groupBy(agent).agg(F.reverse(F.array_sort(F.collect_list(F.struct("name", "text")))).alias("files"))
    context = F.array_join(F.transform("files", lambda f: F.concat(F.lit("### "), f["name"], F.lit("\n"), f["text"])), "\n\n")
    payload = F.to_json(F.struct(F.struct(F.lit("SessionStart").alias("hookEventName"), context.alias("additionalContext")).alias("hookSpecificOutput")))
    return x.select(agent, context.alias("context"), payload.alias("payload"))
