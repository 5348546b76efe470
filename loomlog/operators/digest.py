"""Digests: validation, caps, rendering, the choice of what is written without a model."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loomlog.functions.contamination import signal
from loomlog.functions.text import bullet, derived_cap, json_body

# Fields, headroom and floors of caps.
LISTS = ["done", "found", "decisions", "open_items", "artifacts", "tickets"]
CAPS = {"done": (0.5, 200), "tickets": (1.5, 100), "artifacts": (2.0, 100)}
FIXED_CAP, MAX_ITEM = 40, 2000
PLACEHOLDER, SUPPRESSED = "_No summary could be made for this session._", "_The summary of this session was withheld._"


def parse(raw: Column) -> Column:
    """struct<asked, done, ..., error> of a model's JSON: single values become lists, numbers and
    booleans texts, items are trimmed and cut; error says what is wrong, null for nothing."""
    v = F.try_parse_json(json_body(raw))

    def items(name: str) -> Column:
        one, many = F.try_variant_get(v, f"$.{name}", "string"), F.try_variant_get(v, f"$.{name}", "array<string>")
        got = F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))
        return F.filter(F.transform(got, lambda x: F.substring(F.trim(F.coalesce(x, F.lit(""))), 1, MAX_ITEM)), lambda x: x != "")

    asked = F.trim(F.coalesce(F.try_variant_get(v, "$.asked", "string"), F.lit("")))
    error = F.when(v.isNull(), "not JSON").when(asked == "", "asked is empty").when(F.size(items("done")) == 0, "done is empty")
    return F.struct(asked.alias("asked"), *[items(n).alias(n) for n in LISTS], error.alias("error"))


def field_caps(tool_events: Column, tickets: Column, artifacts: Column) -> Column:
    den = {"done": tool_events, "tickets": tickets, "artifacts": artifacts}
    return F.struct(*[(derived_cap(den[n], *CAPS[n]) if n in CAPS else F.lit(FIXED_CAP).cast("long")).alias(n) for n in LISTS])


def apply_cap(items: Column, cap: Column, bounded: bool) -> Column:
    """struct<items, truncated, error>: a bounded field over its cap is an error, another is cut."""
    over = F.greatest(F.size(items) - cap, F.lit(0))
    return F.struct(F.slice(items, F.lit(1), cap.cast("int")).alias("items"), (F.lit(0) if bounded else over).alias("truncated"), (F.when(over > 0, "over its cap") if bounded else F.lit(None).cast("string")).alias("error"))


def render(digest: Column, truncated: Column | None = None) -> Column:
    """Markdown sections of a digest's non-empty fields, with notes that are no bullets."""
    parts = [F.concat(F.lit("**Asked:** "), digest["asked"])]
    for n in LISTS:
        own = F.array_join(F.transform(digest[n], bullet), "\n")
        note = F.lit("") if truncated is None else F.when(F.coalesce(F.try_element_at(truncated, F.lit(n)), F.lit(0)) > 0, F.format_string("\n\n_%d more not shown._", F.try_element_at(truncated, F.lit(n)))).otherwise("")
        parts.append(F.when(F.size(digest[n]) > 0, F.concat(F.lit(f"**{n.replace('_', ' ').capitalize()}**\n"), own, note)))
    return F.concat_ws("\n\n", *parts)


def choose(outstanding: Column, closing: Column, rollup: Column) -> Column:
    """What is written without a model: pending, fallback or the closing statement verbatim."""
    return F.when(outstanding, "pending").when(F.coalesce(closing, F.lit("")) == "", "fallback").when(signal(closing).isNotNull(), "fallback").when(signal(rollup).isNotNull() & (rollup != ""), "fallback").otherwise("verbatim")


def agent_lines(subagents: Column, descriptions: Column) -> Column:
    """Structured agents, or the older list of descriptions where they were not recorded."""
    return F.when(subagents.isNull(), descriptions).otherwise(F.transform(subagents, lambda a: F.concat_ws(" ", a["subagent_type"], a["description"], F.concat(F.lit("("), a["status"], F.lit(")")))))


def last_tasks(events: DataFrame, session: str = "session_id") -> DataFrame:
    """The last non-empty status of each task, with where it was first seen."""
    return events.groupBy(session, "task_id").agg(F.max_by("status", F.when(F.coalesce("status", F.lit("")) != "", F.col("seq"))).alias("status"), F.min("seq").alias("first_seq"))


def summarised(logs: DataFrame, complete: Callable[[list[str]], list[str]] | None = None, text: str = "text", out: str = "reply") -> DataFrame:
    """Adds the model's reply. complete gets the texts of an Arrow batch at once and gives a reply for
    each, so that it may send them together; without it a fixed reply stands in for a model."""
    if complete is None:
        stub = F.to_json(F.struct(F.substring(F.col(text), 1, 80).alias("asked"), F.array(F.lit("nothing recorded")).alias("done")))
        return logs.withColumn(out, stub)
    @F.pandas_udf(StringType())
    def call(texts: pd.Series) -> pd.Series:
        return pd.Series(complete(texts.tolist()), dtype=object)

    return logs.withColumn(out, call(text))
